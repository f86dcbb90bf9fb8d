"""Near-duplicate texts by their smallest shingle hashes, verified on their shingles.

Candidates meet by the smallest of their shingle hashes, within bands of about equal numbers of
shingles. Sizes and parities discard pairs: hashes fall into slots, and a bit tells whether a set
has an odd number in a slot. Every hash that only one of two sets holds changes one bit, so that
sets have at least as many such hashes as bits that differ; no similar pair is lost. What survives
is verified on the whole sets of shingles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial
from math import log

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm.base import raw, settle, slices
from gondola.llm.components import components
from gondola.llm.exact_dedup import bitmap, in_bitmap
from gondola.llm.simhash import hash_shingles, unite

#: Smallest hashes that a text is found by: of two texts with similarity s, none is shared with a
#: probability of about (1 - s) to this power.
KEYS = 8
#: Words of parities that are compared at a time.
COMPARED = 1 << 20
#: Rows of a bucket that one task compares; larger ones are dealt out as pairs of tiles.
TILE = 2048


def parities(hashes: np.ndarray) -> np.ndarray:
    """Words of 64 slots, each 1 where an odd number of the hashes falls into it: between half a slot
    and one for each hash, so that about half the bits of unlike sets differ. The number of words is
    a power of two; see ``folded``."""
    words = 1 << max(0, (len(hashes) // 64).bit_length() - 1)
    slots = np.bincount((hashes & np.uint64(64 * words - 1)).astype(np.int64), minlength=64 * words)
    return np.packbits((slots & 1).astype(np.uint8), bitorder="little").view("<u8")


def _sketch(batches: Iterator[pa.RecordBatch], size: int, keys: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            sets = [np.unique(np.array(hash_shingles(t, size), np.uint64)) for t in raw(part.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), pa.array([parities(s).tobytes() for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([s[:keys].view(np.int64) for s in sets], pa.list_(pa.int64())),
                ],
                names=["doc_id", "odd", "n", "same", "keys"],
            )


def _sets(batches: Iterator[pa.RecordBatch], size: int, shared) -> Iterator[pa.RecordBatch]:
    """Whole sets of shingles of the rows that the bitmap may hold: no other text is shuffled."""
    for batch in batches:
        for part in slices(batch, "text"):
            rows = np.flatnonzero(in_bitmap(shared.value, part.column("mark").to_numpy()))
            texts = raw(part.column("text").take(pa.array(rows)))
            sets = [np.unique(np.array(hash_shingles(t, size), np.uint64)).tobytes() for t in texts]
            yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(rows)), pa.array(sets, pa.binary())], names=["doc_id", "hashes"])


def folded(odd: list[bytes], words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All parities with so many ``words`` each, one after the other, and where each begins: with
    half as many slots, two that become one are odd if one of them is."""
    out = []
    for row, n in zip(odd, words.tolist(), strict=True):
        own = np.frombuffer(row, "<u8")
        out.append(own if len(own) == n else np.bitwise_xor.reduce(own.reshape(-1, n), axis=0))
    return np.concatenate([*out, np.empty(0, "<u8")]), np.cumsum(words) - words


def close(i: np.ndarray, j: np.ndarray, flat: np.ndarray, at: np.ndarray, words: np.ndarray, n: np.ndarray, home: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (of as many words) whose sizes and parities allow the similarity. One of the two must be
    in its own band: guests from the band below meet each other there."""
    fits = (home[i] | home[j]) & (np.minimum(n[i], n[j]) >= similarity * np.maximum(n[i], n[j]))
    i, j = i[fits], j[fits]
    # Of n + m hashes, sets of similarity s share s / (1 + s) at least, so this part is in one only.
    most = (n[i] + n[j]) * ((1 - similarity) / (1 + similarity)) + 1e-6
    near = np.zeros(len(i), bool)
    for w in np.unique(words[i]).tolist():
        rows, step = np.flatnonzero(words[i] == w), max(1, COMPARED // w)
        for k in range(0, len(rows), step):
            own = rows[k : k + step]
            differ = flat[at[i[own], None] + np.arange(w)] ^ flat[at[j[own], None] + np.arange(w)]
            near[own] = np.bitwise_count(differ).sum(1, dtype=np.int64) <= most[own]
    return i[near], j[near]


def _pairs(odd: list[bytes], frame: pd.DataFrame, similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Candidate pairs of a frame of one bucket, or, with both sides, of two tiles of it."""
    n, side, home = frame["n"].to_numpy(), frame["side"].to_numpy(), frame["home"].to_numpy(bool)
    words = np.full(len(odd), min(map(len, odd)) // 8)
    flat, at = folded(odd, words)
    first, second = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    for k, i in enumerate(first.tolist()):
        others = second if len(second) else first[k + 1 :]
        yield close(np.full(len(others), i), others, flat, at, words, n, home, similarity)


def partners(frame: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """Rows of a bucket, or of two tiles of it, that have a candidate partner, as (key, id, home)."""
    have = np.zeros(len(frame), bool)
    for i, j in _pairs(frame["odd"].tolist(), frame, similarity):
        have[i] = have[j] = True
    return frame.loc[have, ["key", "id", "home"]]


def _partners(frames: Iterator[pd.DataFrame], similarity: float) -> Iterator[pd.DataFrame]:
    """The same for all buckets of a partition sorted by key, many at once: each row is compared
    with the next, the one after and so on, as far as its bucket goes."""
    for frame in _whole_buckets(frames, 100_000):
        keys, n, home, odd = frame["key"].to_numpy(), frame["n"].to_numpy(), frame["home"].to_numpy(bool), frame["odd"].tolist()
        begins = np.append(True, keys[1:] != keys[:-1])
        words = np.fromiter(map(len, odd), np.int64, len(odd)) // 8
        words = np.minimum.reduceat(words, np.flatnonzero(begins))[np.cumsum(begins) - 1]
        flat, at = folded(odd, words)
        have = np.zeros(len(frame), bool)
        base, step = np.arange(len(frame)), 1
        while len(base := base[base + step < len(frame)]):
            base = base[keys[base + step] == keys[base]]
            i, j = close(base, base + step, flat, at, words, n, home, similarity)
            have[i] = have[j] = True
            step += 1
        yield frame.loc[have, ["key", "id", "home"]]


def verified(frame: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """Links among the rows of a bucket, or of two tiles of it, by their whole sets of shingles: as
    many as connect what all would. Sets are rows of a bit matrix over the shingles that occur."""
    sets = [np.frombuffer(h, np.uint64) for h in frame["hashes"]]
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    _, column = np.unique(np.concatenate([*sets, np.empty(0, np.uint64)]), return_inverse=True)
    width = int(column.max(initial=0)) // 64 + 1
    matrix = np.zeros((len(sets), width), np.uint64)
    np.bitwise_or.at(matrix, (np.repeat(np.arange(len(sets)), sizes), column >> 6), np.uint64(1) << (column & 63).astype(np.uint64))
    root, ids = np.arange(len(frame)), frame["id"].to_numpy(np.int64)
    for i, j in _pairs([parities(s).tobytes() for s in sets], frame, similarity):
        apart = root[i] != root[j]
        i, j = i[apart], j[apart]
        for k in range(0, len(j), max(1, (8 << 20) // (8 * width))):
            a, b = i[k : k + max(1, (8 << 20) // (8 * width))], j[k : k + max(1, (8 << 20) // (8 * width))]
            shared = np.bitwise_count(matrix[a[0]] & matrix[b]).sum(1, dtype=np.int64)
            alike = shared >= similarity * (sizes[a] + sizes[b] - shared)
            root = unite(root, a[alike], b[alike])
    rest = np.flatnonzero(root != np.arange(len(root)))
    return pd.DataFrame({"a": ids[rest], "b": ids[root[rest]]})


def _whole_buckets(frames: Iterator[pd.DataFrame], least: int) -> Iterator[pd.DataFrame]:
    """Frames of at least so many rows (but the last) that cut no bucket of a partition sorted by key."""
    rest: list[pd.DataFrame] = []
    for frame in frames:
        rest.append(frame)
        if sum(map(len, rest)) >= least:
            whole = pd.concat(rest, ignore_index=True)
            keys = whole["key"].to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut:
                yield whole.iloc[:cut].reset_index(drop=True)
            rest = [whole.iloc[cut:]]
    if rest:
        yield pd.concat(rest, ignore_index=True)


def _verified(frames: Iterator[pd.DataFrame], similarity: float) -> Iterator[pd.DataFrame]:
    for frame in _whole_buckets(frames, 1):
        keys = frame["key"].to_numpy()
        edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(edges, edges[1:], strict=False):
            if b - a > 1:
                yield verified(frame.iloc[a:b].reset_index(drop=True), similarity)


def _over_buckets(rows: DataFrame, many: Callable, one: Callable, schema: str, similarity: float, tile: int, wide: DataFrame | None = None) -> DataFrame:
    """``many`` over all buckets (rows of one key) of two to ``tile`` rows; ``one`` over pairs of
    tiles of each larger one. ``wide`` has more columns by id, joined to what is compared only."""
    sizes = settle(rows.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1"), "sizes")
    small = rows.join(sizes.where(F.col("rows") <= tile).select("key"), "key").withColumn("side", F.lit(0))
    small = small if wide is None else small.join(wide, "id")
    out = small.repartition("key").sortWithinPartitions("key").mapInPandas(partial(many, similarity=similarity), schema)
    large = rows.join(sizes.where(F.col("rows") > tile), "key").withColumn("tiles", F.ceil(F.col("rows") / tile).cast("int")).drop("rows")
    large = large.withColumn("own", F.pmod(F.xxhash64("id"), "tiles").cast("int"))
    pairs = large.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    pairs = pairs.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other"), "side": F.when(F.col("own") <= F.col("other"), 0).otherwise(1)})
    pairs = pairs if wide is None else pairs.join(wide, "id")
    return out.unionByName(pairs.drop("tiles", "own", "other").groupBy("key", "i", "j").applyInPandas(lambda frame: one(frame, similarity), schema))


def near_text_components(docs: DataFrame, size: int = 5, similarity: float = 0.8, keys: int = KEYS, tile: int = TILE) -> DataFrame:
    """(doc_id, component_id): one row per row of ``docs`` (doc_id, text); doc_ids are distinct.

    Texts link if their sets of ``size``-word shingles (words as in ``gondola.llm.simhash``; a text
    of fewer words is one shingle) have a Jaccard similarity of at least ``similarity``;
    ``component_id`` is the smallest doc_id that links reach. A null, empty or blank text has no
    shingle and links with the other such texts. Texts with equal sets meet as one, so that
    repeated rows cost no more than one. Other columns don't matter.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", "text")
    slim = docs.mapInArrow(partial(_sketch, size=size, keys=keys), f"doc_id {kind}, odd binary, n long, same binary, keys array<long>")
    slim = settle(slim.withColumn("id", F.monotonically_increasing_id()), "sketches")
    classes = slim.groupBy("same").agg(F.min_by(F.struct("odd", "n", "keys"), "id").alias("s"), F.min("id").alias("id"))
    classes = settle(classes.select("same", "id", "s.*"), "classes")
    # Sizes of similar texts are in one band or in neighbouring ones; each row is in its own and the next.
    band = F.floor(F.log(F.col("n").cast("double")) / log(1 / similarity)) if similarity < 1 else F.col("n")
    meets = F.explode(F.array(F.struct(band.alias("band"), F.lit(True).alias("home")), F.struct((band + 1).alias("band"), F.lit(False).alias("home"))))
    keyed = classes.where("n > 0").withColumn("m", meets).withColumn("k", F.explode("keys"))
    keyed = settle(keyed.select(F.xxhash64("k", "m.band").alias("key"), "id", "n", "m.home"), "keyed")
    near = _over_buckets(keyed, _partners, partners, "key long, id long, home boolean", similarity, tile, classes.select("id", "odd"))
    near = settle(near.distinct().join(classes.select("id", "n"), "id"), "partners")
    wanted = settle(slim.join(near.select("id").distinct(), "id").select("doc_id", "id", F.xxhash64("doc_id").alias("fingerprint")), "wanted")
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(wanted))
    sets = docs.select("doc_id", "text", F.xxhash64("doc_id").alias("mark")).mapInArrow(partial(_sets, size=size, shared=shared), f"doc_id {kind}, hashes binary")
    sets = settle(sets.join(wanted, "doc_id").select("id", "hashes"), "sets")
    links = _over_buckets(near, _verified, verified, "a long, b long", similarity, tile, sets)
    found = components(links).select(F.col("node").alias("id"), "component")
    member = classes.select("same", "id").join(found, "id", "left").select("same", F.coalesce("component", "id").alias("component"))
    named = slim.select("doc_id", "same").join(settle(member, "members"), "same")
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return named.join(least, "component").select("doc_id", "component_id")
