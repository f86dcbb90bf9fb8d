"""Periodic stretches of words, found as maximal pairs in the tree of common prefixes.

Two occurrences of the same words form a maximal pair if neither the words before nor the words
behind them agree. A pair of ``l`` words at distance ``q <= l / 2`` is a stretch of ``l + q`` words
with period ``q`` that no neighbour extends, and every such stretch is such a pair: what the tree
enumerates under these bounds are the runs, and nothing has to be extended.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gondola.llm.base import raw, slices

#: Blank and the control characters of white space.
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class Words:
    """The words of several texts as numbers: equal words have equal numbers."""

    def __init__(self, texts: list[bytes]):
        # A separator behind every text keeps words of two texts apart.
        self.bytes = np.frombuffer(b"".join(t + b" " for t in texts), np.uint8)
        gap = SEPARATOR[self.bytes]
        edge = np.flatnonzero(np.diff(np.concatenate([[True], gap]).astype(np.int8)))
        self.starts, self.stops = edge[::2], edge[1::2]
        text_ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
        #: Number of the first word behind each text.
        self.ends = np.searchsorted(self.starts, text_ends)
        offsets = np.concatenate([[0], np.cumsum(self.stops - self.starts)]).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), len(self.starts), [None, pa.py_buffer(offsets), pa.py_buffer(self.bytes[~gap])])
        self.ids = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)

    def without(self, dropped: np.ndarray) -> list[bytes]:
        """Each text's words that aren't dropped, joined by one blank."""
        kept = ~dropped
        here = np.zeros(len(self.bytes) + 1, np.int8)
        here[self.starts[kept]] = 1
        here[self.stops[kept] + 1] -= 1  # words apart by one separator meet: 1 - 1
        out = self.bytes.copy()
        out[self.stops] = 0x20
        joined = out[np.cumsum(here[:-1], dtype=np.int8) > 0].tobytes()
        sizes = np.concatenate([[0], np.cumsum(np.where(kept, self.stops - self.starts + 1, 0))])
        cuts = sizes[np.concatenate([[0], self.ends])]
        return [joined[a:b][:-1] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def near_repeats(ids: np.ndarray, text: np.ndarray, end: np.ndarray, least: int) -> np.ndarray:
    """Which words can begin an occurrence of a pair with at least ``least`` words whose distance
    is at most half its length: for some power of two, at least ``least``'s, so many words from
    there occur again less than so many words away. Words are compared by hash, so that more may
    be named, but never fewer."""
    n = len(ids)
    marked = np.zeros(n, bool)
    hashes = _mixed(_mixed(ids.astype(np.uint64)) + text.astype(np.uint64))
    alive, width = np.arange(n), 1
    while len(alive):
        if 2 * width > least:
            order = alive[np.argsort(hashes[alive], kind="stable")]  # by hash, then place
            same = hashes[order[1:]] == hashes[order[:-1]]
            near = same & (np.diff(order) < width)
            marked[order[1:][near]] = marked[order[:-1][near]] = True
            twice = np.zeros(n, bool)
            twice[order[1:][same]] = twice[order[:-1][same]] = True
            alive = np.flatnonzero(twice)
        alive = alive[alive + 2 * width <= end[alive]]
        if len(alive):
            hashes[:-width] = _mixed(hashes[:-width] * np.uint64(0xBF58476D1CE4E5B9) + hashes[width:])
        width *= 2
    return marked


def sorted_suffixes(ids: np.ndarray, text: np.ndarray, end: np.ndarray, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The marked suffixes in order, and the number of words each shares with the one before it.

    Ranks by 1, 2, 4, … words; of those with a rank of their own nothing is sorted again. Ranks of
    every width are kept, so that common prefixes are put together of powers of two.
    """
    n = len(ids)
    order = np.lexsort((ids, text))
    keys = text[order] * (int(ids.max()) + 1) + ids[order]
    ranks = np.empty(n, np.int64)
    starts = np.zeros(n, np.int64)  # place of the old group's first member
    levels, width = [], 1
    while True:
        fresh = np.concatenate([[True], keys[1:] != keys[:-1]])
        first = np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))
        ranks[order] = starts + first
        levels.append(ranks.astype(np.int32))
        grouped = ~(fresh & np.append(fresh[1:], True))
        order = order[grouped]
        if not len(order):
            break
        ahead = np.minimum(order + width, n - 1)
        second = np.where(order + width < end[order], ranks[ahead] + 1, 0)
        keys = ranks[order] * (n + 1) + second
        by = np.argsort(keys, kind="stable")
        order, keys = order[by], keys[by]
        own = ranks[order]
        begins = np.concatenate([[True], own[1:] != own[:-1]])
        starts = own - np.maximum.accumulate(np.where(begins, np.arange(len(order)), 0))
        width *= 2
    places = np.flatnonzero(marked)
    places = places[np.argsort(ranks[places])]
    a, b = places[:-1].copy(), places[1:].copy()
    shared = np.zeros(max(len(places) - 1, 0), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = np.maximum(a, b) < n
        level = levels[k]
        equal = inside & (level[np.minimum(a, n - 1)] == level[np.minimum(b, n - 1)])
        step = np.where(equal, 1 << k, 0)
        a, b, shared = a + step, b + step, shared + step
    return places, np.concatenate([[0], shared])


def maximal_pairs(places: list[int], shared: list[int], left: list[int], least: int, total: int) -> Iterator[tuple[int, int, int]]:
    """(first, distance, length) of all maximal pairs with a distance of at most half their length
    and at least ``total`` words from end to end.

    Bottom-up through the intervals of common prefixes. Each node holds its places in order, and
    lists of them by the word on their left; the smaller node is put into the larger one. Places
    within half a length of each other lie a fixed period apart, and the word on their left is the
    period's last but for the first of them: so of a place's neighbours in the other node, either
    only the one farthest left, or all on the right are of another class.
    """
    found: list[tuple[int, int, int]] = []

    def joined(one: tuple[list, dict], other: tuple[list, dict], length: int) -> tuple[list, dict]:
        small, large = (one, other) if len(one[0]) < len(other[0]) else (other, one)
        half = length // 2
        rows, classes = large
        for x in small[0]:
            own = left[x]
            k = bisect_right(rows, x)
            if k < len(rows) and rows[k] - x <= half and left[rows[k]] != own:
                peers = classes[left[rows[k]]]
                for y in peers[bisect_right(peers, x) : bisect_right(peers, x + half)]:
                    found.append((x, y - x, length))
            k = bisect_left(rows, x - half)
            if k < len(rows) and rows[k] < x and left[rows[k]] != own:
                found.append((rows[k], x - rows[k], length))
        for x in small[0]:
            insort(rows, x)
        for word, peers in small[1].items():
            mine = classes.setdefault(word, [])
            for x in peers:
                insort(mine, x)
        return large

    nodes: list[tuple[list, dict]] = []
    depths: list[int] = []
    for place, depth in zip([*places, -1], [*shared, 0], strict=True):
        while depths and depths[-1] > depth:
            top = nodes.pop()
            nodes[-1] = joined(nodes[-1], top, depths.pop())
        yield from (p for p in found if p[1] + p[2] >= total)
        found.clear()
        if depth < least:
            nodes.clear()
            depths.clear()
        else:
            depths.append(depth)
        if place >= 0:
            nodes.append(([place], {left[place]: [place]}))


def find_runs(words: Words, times: int = 3, least: int = 24) -> np.ndarray:
    """(text, start, length, period) of all runs, by text, start and period: stretches with a
    smallest period ``q`` of at least ``max(least, times * q)`` words; ``times`` is 3 or more."""
    counts = np.diff(np.concatenate([[0], words.ends]))
    text = np.repeat(np.arange(len(counts)), counts)
    shortest = -(-least * (times - 1) // times)  # of a pair whose stretch is long enough
    none = np.empty((0, 4), np.int64)
    if not len(text):
        return none
    marked = near_repeats(words.ids, text, words.ends[text], shortest)
    rich = np.zeros(len(counts), bool)
    rich[text[marked]] = True
    chosen = np.flatnonzero(rich[text])  # whole texts
    if not len(chosen):
        return none
    ids, text = words.ids[chosen], text[chosen]
    begin = np.searchsorted(text, text)
    places, shared = sorted_suffixes(ids, text, np.searchsorted(text, text, "right"), marked[chosen])
    left = np.where(np.arange(len(ids)) > begin, np.concatenate([[-1], ids[:-1]]), -1)
    best: dict[tuple[int, int], int] = {}
    for first, distance, length in maximal_pairs(places.tolist(), shared.tolist(), left.tolist(), shortest, least):
        # Multiples of the period give the same stretch.
        if length >= (times - 1) * distance:
            whole = (first, length + distance)
            best[whole] = min(distance, best.get(whole, distance))
    if not best:
        return none
    rows = np.array([(s, n, q) for (s, n), q in best.items()], np.int64)
    out = np.column_stack([text[rows[:, 0]], rows[:, 0] - begin[rows[:, 0]], rows[:, 1], rows[:, 2]])
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def repeated_words(words: Words, runs: np.ndarray) -> np.ndarray:
    """Which words lie in a run behind its first period."""
    change = np.zeros(len(words.ids) + 1, np.int64)
    first = np.concatenate([[0], words.ends])[runs[:, 0]] + runs[:, 1]
    np.add.at(change, first + runs[:, 3], 1)
    np.add.at(change, first + runs[:, 2], -1)
    return np.cumsum(change[:-1]) > 0


def _detect(batches: Iterator[pa.RecordBatch], times: int, least: int) -> Iterator[pa.RecordBatch]:
    fields = ["start", "length", "period"]
    for batch in batches:
        for part in slices(batch, "text"):
            words = Words(raw(part.column("text")))
            runs = find_runs(words, times, least)
            offsets = np.searchsorted(runs[:, 0], np.arange(part.num_rows + 1)).astype(np.int32)
            values = pa.StructArray.from_arrays([pa.array(runs[:, k + 1]) for k in range(3)], fields)
            counts = np.diff(np.concatenate([[0], words.ends]))
            texts = [t.decode("utf-8") for t in words.without(repeated_words(words, runs))]
            columns = [part.column("doc_id"), pa.array(counts), pa.ListArray.from_arrays(offsets, values), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])


def detect_runs(docs: DataFrame, times: int = 3, least: int = 24) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): the periodic stretches of every whole text of ``docs``.

    Words are what lies between blanks and tabs, line ends, form feeds. ``runs`` are stretches of
    consecutive words with smallest period ``q`` and at least ``max(least, times * q)`` words that
    no neighbouring word extends, by start, then period; starts count from 0. ``collapsed`` has the
    words that no run contains behind its first ``q``, joined by one blank.

    One row per input row, repeated rows and null doc_ids included; other columns don't matter. A
    null text counts as empty: no words, no runs, empty text. No shuffle: a text is worked on where
    it is read, about 2 MB of texts at a time. Longer texts are a portion of their own; they need
    some 100 bytes a word, and for texts with runs 4 more for each doubling of the longest one.
    """
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(partial(_detect, times=times, least=least), f"doc_id {kind}, n_words bigint, runs {RUNS}, collapsed string")
