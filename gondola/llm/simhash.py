"""SimHash near-duplicates with pivot distance tables.

Fingerprints link if they differ in few bits. Only candidates that agree in enough blocks of bits
(by the pigeonhole principle every linked pair does) meet; for these, distances to a set of
reference fingerprints are at hand, and since distances to a third point differ by no more than the
distance of the pair, a pair whose tables differ too much anywhere is discarded. Survivors are
verified on all bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations, repeat
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm.base import raw, settle, slices
from gondola.llm.components import components

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Reference fingerprints: more discard more pairs, and cost a byte per fingerprint each.
PIVOTS = 24
#: Rows of a bucket that one tile holds; larger buckets are dealt out as pairs of tiles.
TILE = 4096
BYTE_OF = np.uint64(0x0101010101010101)


def hash_shingles(text: bytes, size: int) -> list[int]:
    """Unsigned XXH64 (seed 42) of the word shingles of a lower-cased text, repeats included."""
    words = text.translate(LOWER).split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(joined, 42)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)[: len(words) - size + 1].tolist()
    return list(map(xxhash.xxh64_intdigest, [joined[a:b] for a, b in zip(starts, ends[size - 1 :].tolist(), strict=True)], repeat(42)))


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprint of each run of ``counts`` hashes: a bit is 1 if set in over half of them. Bits
    are counted eight at a time, as the bytes of a number that sums up to 255 hashes."""
    out = np.zeros(len(counts), np.uint64)
    busy = np.flatnonzero(counts)
    if not len(busy):
        return out
    own = counts[busy]
    parts = -(-own // 255)
    firsts = np.cumsum(parts) - parts
    steps = np.arange(parts.sum()) - np.repeat(firsts, parts)
    cuts = np.repeat(np.cumsum(own) - own, parts) + 255 * steps
    for bit in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(bit)) & BYTE_OF, cuts)
        tally = np.add.reduceat(sums.view(np.uint8).reshape(-1, 8).astype(np.int64), firsts, axis=0)
        ones = (2 * tally > own[:, None]).astype(np.uint64)
        for byte in range(8):
            out[busy] |= ones[:, byte] << np.uint64(8 * byte + bit)
    return out


def _fingerprints(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            found = [hash_shingles(t, size) for t in raw(part.column("text"))]
            counts = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter((h for f in found for h in f), np.uint64, int(counts.sum()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(majority(flat, counts).view(np.int64))], names=["doc_id", "bits"])


def fingerprints(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, bits): the 64-bit fingerprint of every whole text as a signed number."""
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(partial(_fingerprints, size=size), f"doc_id {kind}, bits long")


def plan_blocks(n: int, most: int) -> tuple[list[int], int]:
    """Widths of the bit blocks, and how many of them a key joins. ``most`` differing bits leave all
    blocks but ``most`` alike. More blocks make longer keys, and more of them: the first with as
    many key values as fingerprints. Any choice finds all pairs."""
    for blocks in range(most + 1, 33):
        same = blocks - most
        if 64 * same / blocks >= np.log2(max(n, 2)) or comb(blocks + 1, same + 1) > 100:
            break
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    return [b - a for a, b in zip(edges, edges[1:], strict=False)], same


def _keys(frames: Iterator[pd.DataFrame], widths: list[int], same: int) -> Iterator[pd.DataFrame]:
    """A row for each fingerprint and combination of blocks: (key, bits)."""
    starts = np.cumsum([0, *widths[:-1]])
    for frame in frames:
        bits = frame["bits"].to_numpy(np.int64)
        for k in range(0, len(bits), 50_000):
            own = bits[k : k + 50_000].view(np.uint64)
            for number, chosen in enumerate(combinations(range(len(widths)), same)):
                mask = np.uint64(sum(((1 << widths[b]) - 1) << int(starts[b]) for b in chosen))
                # Mixed, so that the key alone also tells its combination.
                key = ((own & mask) * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64((number * 0xD6E8FEB86659FD93) & (2**64 - 1))
                yield pd.DataFrame({"key": key.view(np.int64), "bits": own.view(np.int64)})


def pivots(count: int) -> np.ndarray:
    """Reference fingerprints: fixed pseudo-random numbers."""
    return np.random.default_rng(7).integers(0, 2**64, count, np.uint64)


def distance_table(bits: np.ndarray, count: int) -> np.ndarray:
    """Hamming distances of fingerprints to the pivots, a row for each pivot."""
    return np.stack([np.bitwise_count(bits ^ p) for p in pivots(count)]).astype(np.int8)


def linked(table: np.ndarray, bits: np.ndarray, i: np.ndarray, j: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (i, j) of fingerprints that differ in at most ``most`` bits: those whose distances
    to some pivot differ by more are discarded pivot by pivot, the rest are verified."""
    for row in table:
        near = np.abs(row[i] - row[j]) <= most
        i, j = i[near], j[near]
    near = np.bitwise_count(bits[i] ^ bits[j]) <= most
    return i[near], j[near]


def unite(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest row that links connect each row to, ``root`` so far, with the links (i, j) added."""
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return root
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while ((up := root[root]) != root).any():
            root = up


def _edges(root: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    rest = np.flatnonzero(root != np.arange(len(root)))
    return bits[rest], bits[root[rest]]


def _inside(keys: np.ndarray, bits: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows with the same key, as many as connect what all of them connect. Rows are
    sorted by their first pivot distance and compared with the next, the one after and so on, up to
    where that distance differs too much; what is connected already isn't compared."""
    table = distance_table(bits, PIVOTS)
    order = np.lexsort((bits, table[0], keys))
    keys, bits, table = keys[order], bits[order], table[:, order]
    root, base, step = np.arange(len(keys)), np.arange(len(keys)), 1
    while len(base := base[base + step < len(keys)]):
        base = base[(keys[base + step] == keys[base]) & (table[0][base + step] - table[0][base] <= most)]
        apart = base[root[base] != root[base + step]]
        root = unite(root, *linked(table, bits, apart, apart + step, most))
        step += 1
    return _edges(root, bits)


def _across(first: np.ndarray, second: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The same among two sets of fingerprints, of each row of one with rows of the other."""
    bits = np.concatenate([first, second])
    table = distance_table(bits, PIVOTS)
    other = len(first) + np.argsort(table[0][len(first) :], kind="stable")
    column = table[0][other]
    low = np.searchsorted(column, table[0][: len(first)] - most)
    high = np.searchsorted(column, table[0][: len(first)] + most, side="right")
    root = np.arange(len(bits))
    for i in range(len(first)):
        j = other[low[i] : high[i]]
        j = j[root[j] != root[i]]
        if len(j):
            root = unite(root, *linked(table, bits, np.full(len(j), i), j, most))
    return _edges(root, bits)


def _frame(found: tuple[np.ndarray, np.ndarray]) -> pd.DataFrame:
    return pd.DataFrame({"a": found[0].view(np.int64), "b": found[1].view(np.int64)})


def _links(frames: Iterator[pd.DataFrame], most: int) -> Iterator[pd.DataFrame]:
    """Links among the rows of a partition that is sorted by key; a key may span batches."""
    keys, bits = np.empty(0, np.int64), np.empty(0, np.int64)
    for frame in frames:
        keys = np.concatenate([keys, frame["key"].to_numpy(np.int64)])
        bits = np.concatenate([bits, frame["bits"].to_numpy(np.int64)])
        if len(keys) > 100_000 and keys[0] != keys[-1]:
            cut = int(np.searchsorted(keys, keys[-1]))
            yield _frame(_inside(keys[:cut], bits[:cut].view(np.uint64), most))
            keys, bits = keys[cut:], bits[cut:]
    yield _frame(_inside(keys, bits.view(np.uint64), most))


def _tile(frame: pd.DataFrame, most: int) -> pd.DataFrame:
    """Links of one pair of tiles: of the rows of the first with those of the second."""
    bits, side = frame["bits"].to_numpy(np.int64).view(np.uint64), frame["side"].to_numpy()
    first, second = bits[side == 0], bits[side == 1]
    return _frame(_across(first, second, most) if len(second) else _inside(np.zeros(len(first), np.int64), first, most))


def links(prints: DataFrame, most: int, tile: int = TILE) -> DataFrame:
    """(a, b): links that connect whatever pairs of distinct fingerprints ``bits`` connect."""
    n = prints.count()
    widths, same = plan_blocks(n, most)
    keyed = settle(prints.select("bits").mapInPandas(partial(_keys, widths=widths, same=same), "key long, bits long"), "keys")
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = settle(sizes, "sizes")
    small = keyed.join(sizes.where(F.col("n") <= tile), "key", "left_semi")
    out = small.repartition("key").sortWithinPartitions("key").mapInPandas(partial(_links, most=most), "a long, b long")
    # A large bucket is cut into tiles of about ``tile`` rows, and each pair of tiles is a task's.
    large = keyed.join(sizes.where(F.col("n") > tile), "key").withColumn("tiles", F.ceil(F.col("n") / tile).cast("int"))
    large = large.withColumn("own", F.pmod(F.xxhash64("bits"), "tiles").cast("int"))
    pairs = large.select("key", "bits", "own", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")).select(
        "key", "bits", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side")
    )
    out = out.unionByName(pairs.groupBy("key", "i", "j").applyInPandas(lambda frame: _tile(frame, most), "a long, b long"))
    return out.distinct()


def near_components(docs: DataFrame, size: int = 4, most: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per row of ``docs``.

    Words are what lies between characters ``[\\x20\\x09-\\x0D]``, with A-Z lower-cased; shingles are
    ``size`` words with blanks between. A fingerprint bit is 1 if set in over half the shingles'
    XXH64 (seed 42). Fingerprints link if ``most`` or fewer bits differ; ``component_id`` is the
    smallest doc_id that links reach. A null, empty or blank text has fingerprint zero and links
    like any other. Null doc_ids stay in the result but name no component (a component of nothing
    else is null). Repeated rows share a component. Copies meet as one fingerprint.
    """
    rows = settle(fingerprints(docs, size), "fingerprints")
    prints = settle(rows.groupBy("bits").agg(F.min("doc_id").alias("first")), "prints")
    found = components(links(prints, most)).select(F.col("node").alias("bits"), "component")
    member = prints.join(found, "bits", "left").select("bits", "first", F.coalesce("component", "bits").alias("component"))
    least = member.groupBy("component").agg(F.min("first").alias("component_id"))
    named = settle(member.join(least, "component").select("bits", "component_id"), "components")
    return rows.join(named, "bits").select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")
