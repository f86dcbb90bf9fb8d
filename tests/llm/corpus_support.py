"""Helpers of the corpus tests."""

from __future__ import annotations

import random


def prose(seed: int, words: int, stem: str = "abcdefgh") -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(stem, k=rng.randint(1, 7))) for _ in range(words))
