"""Splits text into the words of a byte-level BPE vocabulary, with array operations.

The words are those of the pattern
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``:
runs of one character class, to which a single blank before them belongs; of several white-space
characters the last stays alone or joins what follows.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import regex
from tokenizers.pre_tokenizers import ByteLevel

OTHER, LETTER, NUMBER, SPACE = range(4)
#: The Unicode property White_Space.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of every code point. Unicode versions differ by what was assigned between them: where
    an older and a newer one disagree, the tokenizers library itself is asked."""
    table = np.full(0x110000, OTHER, np.uint8)
    every = "".join(chr(c) if not 0xD800 <= c < 0xE000 else " " for c in range(0x110000))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for found in regex.finditer(pattern, every):
            table[found.start() : found.end()] = kind
    kinds = {"L": LETTER, "N": NUMBER}
    older = np.fromiter((kinds.get(unicodedata.category(c)[0], OTHER) for c in every), np.uint8, 0x110000)
    library = ByteLevel(add_prefix_space=False)
    for c in np.flatnonzero(table != older).tolist():
        joins = [len(library.pre_tokenize_str(before + chr(c))) == 1 for before in "x1"]
        table[c] = LETTER if joins[0] else NUMBER if joins[1] else OTHER
    table[WHITE] = SPACE
    return table


def cut_words(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All texts joined, the byte offsets of their words (and the end), and the number of words of
    each text. Empty texts have no words."""
    joined = b"".join(texts)
    if not joined:
        return joined, np.zeros(1, np.int64), np.zeros(len(texts), np.int64)
    points = np.frombuffer(joined.decode("utf-8").encode("utf-32-le"), np.uint32)
    n = len(points)
    if n == len(joined):
        at = None
    else:
        widths = 1 + (points > 0x7F).astype(np.int8) + (points > 0x7FF) + (points > 0xFFFF)
        at = np.concatenate([[0], np.cumsum(widths, dtype=np.int64)])
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    first = np.concatenate([[0], ends[:-1]])  # bytes where texts begin
    begins = first[first < len(joined)]
    begins = np.unique(begins if at is None else np.searchsorted(at, begins))

    kind = classes()[points]
    border = np.empty(n, bool)  # a run begins here
    border[0] = True
    np.not_equal(kind[1:], kind[:-1], out=border[1:])
    border[begins] = True
    runs = np.flatnonzero(border)
    stops = np.append(runs[1:], n)
    white = kind[runs] == SPACE
    open_end = np.zeros(n + 1, bool)  # a text ends here
    open_end[begins] = True
    open_end[n] = True
    open_end[0] = False

    start = border.copy()
    # White space before something else: its last character stands alone or joins what follows.
    held = white & ~open_end[stops]
    start[stops[held] - 1] = True
    joins = stops[held]
    joins = joins[points[joins - 1] == 0x20]
    start[joins] = False
    # Contractions: an apostrophe that begins a word, then certain letters.
    marks = np.flatnonzero(points == 0x27)
    if len(marks):
        marks = marks[start[marks] & (marks + 1 < n)]
        marks = marks[(kind[marks + 1] == LETTER) & ~open_end[marks + 1]]
        one = points[marks + 1]
        after = np.minimum(marks + 2, n - 1)
        two = np.where((marks + 2 < n) & ~open_end[marks + 2], points[after], 0)
        taken = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, 0)
        for a, b in ("re", "ve", "ll"):
            taken = np.where((one == ord(a)) & (two == ord(b)), 2, taken)
        marks, taken = marks[taken > 0], taken[taken > 0]
        start[marks + 1] = False
        rest = marks + 1 + taken
        rest = rest[rest < n]
        start[rest[(kind[rest] == LETTER) & ~open_end[rest]]] = True

    offsets = np.append(np.flatnonzero(start), n)
    if at is not None:
        offsets = at[offsets]
    counts = np.diff(np.searchsorted(offsets[:-1], np.append(first, len(joined))))
    return joined, offsets, counts
