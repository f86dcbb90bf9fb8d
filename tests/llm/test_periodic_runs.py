from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from gondola.llm import periodic_runs
from gondola.llm.queries import runs as run_query

SF_DIR = "/root/testdata/sf0.001"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(words, times=3, least=24):
    """(start, length, period) by comparing the words with themselves at every distance."""
    numbers = {w: i for i, w in enumerate(words)}
    ids, best = np.array([numbers[w] for w in words], int), {}
    for q in range(1, len(words) // times + 1):
        equal = np.concatenate([[False], ids[q:] == ids[:-q], [False]]).astype(int)
        change = np.diff(equal)
        for a, b in zip(np.flatnonzero(change == 1), np.flatnonzero(change == -1), strict=True):
            length = int(b - a + q)
            if length >= max(least, times * q):
                best.setdefault((int(a), length), q)
    return sorted((s, n, q) for (s, n), q in best.items())


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def check(found, texts, **bounds):
    for row, text in zip(found, texts, strict=True):
        words = words_of(text)
        want = brute(words, **bounds)
        assert [tuple(r) for r in row.runs] == want
        assert row.n_words == len(words) and row.collapsed == collapsed(words, want)


def test_odd_rows(odd):
    found = periodic_runs.detect_runs(odd).collect()
    given = odd.select("doc_id", "text").collect()
    assert [r.doc_id for r in found] == [r.doc_id for r in given]
    check(found, [r.text for r in given])


def test_no_rows(empty):
    assert periodic_runs.detect_runs(empty).collect() == []


@pytest.mark.parametrize("bounds", [{}, {"times": 4, "least": 9}, {"times": 3, "least": 3}])
def test_random_repeats(spark, bounds):
    rng, texts = random.Random(3), []
    for _ in range(400):
        words = []
        for _ in range(rng.randint(0, 8)):
            base, size = [rng.choice("abc") for _ in range(rng.randint(1, 9))], rng.randint(1, 60)
            words += (base * size)[:size]
            if rng.random() < 0.3:
                words += words[-rng.randint(1, 30) :]
        texts.append(rng.choice([" ", "\t\n", "\r "]).join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    check(periodic_runs.detect_runs(docs, **bounds).collect(), texts, **bounds)


def test_runs_of_a_hundred_thousand_words(spark):
    """One word, then another, and a long line many times over; wide characters; no-break spaces
    belong to words."""
    line = " ".join(f"w{i}é" for i in range(500))
    texts = ["a " * 50_000 + "b " + "a " * 50_001, " ".join([line] * 100), "x\u00a0y " * 30 + "z"]
    found = periodic_runs.detect_runs(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)).collect()
    assert [[tuple(r) for r in row.runs] for row in found] == [[(0, 50_000, 1), (50_001, 50_001, 1)], [(0, 50_000, 500)], [(0, 30, 1)]]
    assert found[0].collapsed == "a b a" and found[1].collapsed == line


def test_query_equals_brute_force(spark, small):
    """Every document, with the planted repeats worked out again here."""
    got = {r.doc_id: r for r in run_query(spark, SF_DIR).collect()}
    rows = small.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    n_planted = 0
    for doc_id, text in rows:
        words, h = words_of(text), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            n_planted += 1
        want, row = brute(words), got[doc_id]
        best = min(want, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        assert row.n_runs == len(want)
        assert (row.start, row.length, row.period) == (best or (None, None, None))
        assert row.exponent_milli == (best and 1000 * best[1] // best[2])
        assert row.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in want).encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(collapsed(words, want).encode()).hexdigest()
    assert n_planted > 5
