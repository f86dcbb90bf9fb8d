"""Exact deduplication by counting quotient filters.

Each task builds a filter of its rows' 64-bit fingerprints: the upper bits, the quotient, name a
run; a run holds the sorted remainders and their counts. Filters of all tasks merge run by run,
by the order of the remainders, and nothing is lost, since quotient and remainder are the whole
fingerprint. Only fingerprints counted more than once go on to the comparison of bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm.base import raw, settle, slices

WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Bits of the bitmap that keeps most unrepeated texts from being shuffled: 8 MB at most.
BITMAP_BITS = 26
FILTER = "block long, quotients array<long>, runs array<int>, remainders array<long>, counts array<long>"


def fingerprint(text: bytes, bits: int) -> int:
    """The upper ``bits`` of the hash, as a signed 64-bit number."""
    h = xxhash.xxh64_intdigest(text) >> (64 - bits)
    return h - (1 << 64) if h >= 1 << 63 else h


def _sign(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            texts = raw(part.column("text"))
            norms = [t.translate(None, WHITE) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([fingerprint(t, bits) for t in norms], pa.int64()),
                    pa.array([len(t.decode()) for t in texts], pa.int64()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in norms], pa.string()),
                ],
                names=["doc_id", "fingerprint", "points", "text_sha256"],
            )


def signed(docs: DataFrame, bits: int = 64) -> DataFrame:
    """(doc_id, fingerprint, points, text_sha256, row): one row per row; null texts are empty."""
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(partial(_sign, bits=bits), f"doc_id {kind}, fingerprint long, points long, text_sha256 string")
    return out.withColumn("row", F.monotonically_increasing_id())


def _runs(prints: np.ndarray, counts: np.ndarray, quotient_bits: int, block_bits: int) -> Iterator[dict]:
    """The filter of sorted unsigned fingerprints, a row for each block of neighbouring quotients."""
    shift = np.uint64(64 - quotient_bits)
    quotients = prints >> shift
    remainders = (prints & ((np.uint64(1) << shift) - np.uint64(1))).astype(np.int64)
    blocks = quotients >> np.uint64(quotient_bits - block_bits)
    edges = np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1])) if len(blocks) else []
    for a, b in zip(edges, [*edges[1:], len(blocks)], strict=True):
        own, sizes = np.unique(quotients[a:b], return_counts=True)
        yield {"block": int(blocks[a]), "quotients": own.astype(np.int64), "runs": sizes.astype(np.int32), "remainders": remainders[a:b], "counts": counts[a:b]}


def _summed(prints: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct fingerprints and their summed counts."""
    order = np.argsort(prints, kind="stable")
    prints, counts = prints[order], counts[order]
    first = np.flatnonzero(np.append(True, prints[1:] != prints[:-1]))
    return prints[first], np.add.reduceat(counts, first)


def _build(frames: Iterator[pd.DataFrame], quotient_bits: int, block_bits: int) -> Iterator[pd.DataFrame]:
    prints, counts, waiting = np.empty(0, np.uint64), np.empty(0, np.int64), []
    for frame in frames:
        waiting.append(frame["fingerprint"].to_numpy(np.int64).view(np.uint64))
        if sum(map(len, waiting)) > max(1 << 18, len(prints)):
            new = np.concatenate(waiting)
            prints, counts = _summed(np.concatenate([prints, new]), np.concatenate([counts, np.ones(len(new), np.int64)]))
            waiting = []
    new = np.concatenate([*waiting, np.empty(0, np.uint64)])
    if len(prints) + len(new):
        prints, counts = _summed(np.concatenate([prints, new]), np.concatenate([counts, np.ones(len(new), np.int64)]))
        yield pd.DataFrame(_runs(prints, counts, quotient_bits, block_bits))


def _merge(frame: pd.DataFrame, quotient_bits: int) -> pd.DataFrame:
    """Merges the filters of one block; returns fingerprints counted more than once."""
    shift = np.uint64(64 - quotient_bits)
    quotients = np.concatenate([np.repeat(np.asarray(q, np.int64), r) for q, r in zip(frame["quotients"], frame["runs"], strict=True)])
    remainders = np.concatenate([np.asarray(r, np.int64) for r in frame["remainders"]])
    prints = (quotients.view(np.uint64) << shift) | remainders.view(np.uint64)
    prints, counts = _summed(prints, np.concatenate([np.asarray(c, np.int64) for c in frame["counts"]]))
    many = counts > 1
    return pd.DataFrame({"fingerprint": prints[many].view(np.int64), "count": counts[many]})


def repeated(prints: DataFrame, quotient_bits: int = 40) -> DataFrame:
    """(fingerprint, count) of the fingerprints that occur more than once in the whole table."""
    spark = prints.sparkSession
    blocks = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    block_bits = min(quotient_bits, blocks.bit_length())
    filters = prints.select("fingerprint").mapInPandas(partial(_build, quotient_bits=quotient_bits, block_bits=block_bits), FILTER)
    return filters.groupBy("block").applyInPandas(lambda frame: _merge(frame, quotient_bits), "fingerprint long, count long")


def _slot(prints: np.ndarray) -> np.ndarray:
    return ((prints.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def _map_bits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        yield pd.DataFrame({"slot": _slot(frame["fingerprint"].to_numpy()) + 1})


def bitmap(repeats: DataFrame) -> np.ndarray:
    """One bit for each slot a repeated fingerprint falls in: of fixed size, whatever the input."""
    slots = repeats.select("fingerprint").mapInPandas(_map_bits, "slot long")
    rows = slots.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    out = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    for row in rows.collect():  # 2^11 rows of 4 KB at most
        at = (row.bucket - 1) * 4096  # slots count from 1, so do buckets
        out[at : at + 4096] = np.frombuffer(row.bits, np.uint8)
    return out


def in_bitmap(seen: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """Whether a fingerprint may be in the bitmap; all that were put in are."""
    slots = _slot(prints)
    return (seen[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1


def _candidates(batches: Iterator[pa.RecordBatch], bits: int, shared) -> Iterator[pa.RecordBatch]:
    seen = shared.value
    for batch in batches:
        for part in slices(batch, "text"):
            texts = raw(part.column("text"))
            norms = [t.translate(None, WHITE) for t in texts]
            prints = np.array([fingerprint(t, bits) for t in norms], np.int64)
            rows = np.flatnonzero(in_bitmap(seen, prints))
            if len(rows):
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(rows)),
                        pa.array(prints[rows]),
                        pa.array([len(texts[i].decode()) for i in rows.tolist()], pa.int64()),
                        pa.array([norms[i] for i in rows.tolist()], pa.binary()),
                    ],
                    names=["doc_id", "fingerprint", "points", "norm"],
                )


def find_copies(docs: DataFrame, bits: int = 64, quotient_bits: int = 40) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256, copies): one row per row of ``docs``.

    Texts are equal if identical without the characters ``[\\x20\\x09-\\x0D]``; a null text is
    empty, and all empty texts are equal. The row with the most code points stays, then that with
    the smallest doc_id (null last). Of rows that repeat doc_id and text, one is ``kept``;
    ``copies`` counts such rows. ``text_sha256`` is that of the text without those characters.
    Equality is that of bytes: a fingerprint that two texts share is told apart by the bytes
    themselves, at any width ``bits``. Other columns don't matter.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = settle(signed(docs, bits), "signed")
    repeats = settle(repeated(rows, quotient_bits), "repeats")
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(repeats))
    texts = docs.select("doc_id", "text").mapInArrow(
        partial(_candidates, bits=bits, shared=shared), f"doc_id {kind}, fingerprint long, points long, norm binary"
    )
    # Groups of equal bytes; each task first reduces its own copies to one row.
    groups = texts.groupBy("fingerprint", "norm").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.min(F.struct((-F.col("points")).alias("points"), F.col("doc_id").isNull().alias("none"), "doc_id")).alias("best"),
    )
    groups = settle(
        groups.where("group_size > 1").select("fingerprint", "group_size", F.col("best.doc_id").alias("keep_id"), (-F.col("best.points")).alias("most"), F.sha2("norm", 256).alias("text_sha256")),
        "groups",
    )
    # Of the best rows of a group (repeats of one row) the first is kept.
    best = (F.col("points") == F.col("most")) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    heads = (
        rows.join(groups, ["fingerprint", "text_sha256"]).where(best).groupBy("fingerprint", "text_sha256")
        .agg(F.min("row").alias("head"), F.count(F.lit(1)).alias("copies"), F.first("group_size").alias("group_size"), F.first("keep_id").alias("keep_id"))
    )
    return rows.join(heads, ["fingerprint", "text_sha256"], "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("row") == F.col("head"), F.lit(True)).alias("kept"),
        "text_sha256",
        F.coalesce("copies", F.lit(1)).cast("long").alias("copies"),
    )
