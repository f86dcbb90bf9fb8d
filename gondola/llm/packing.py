"""Sum-of-squares packing of documents into token sequences of a fixed length.

A document is its ids and one closing id. Longer ones are cut into full pieces, the first of which
may be shorter. Each piece goes where the sum, over all gaps, of the squared number of open
sequences with that gap becomes smallest. Tasks pack their own pieces; sequences that stay open
are then packed again, as wholes, with those of other tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm.base import settle, slices
from gondola.llm.bpe import encode_texts, vocabulary

#: The words of a byte-level vocabulary, see ``gondola.llm.words``.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces that one task packs: more fill better, fewer are more tasks.
TASK_PIECES = 65_536


@lru_cache(maxsize=4)
def encoding(path: str) -> tiktoken.Encoding:
    """The vocabulary file as ranks, which this library merges faster, to the same ids."""
    v = vocabulary(path)
    special = {t.decode(): i for t, i in v.special.items()}
    ranks = {t: i for i, t in enumerate(v.token) if t and t not in v.special}
    return tiktoken.Encoding("file", pat_str=WORDS, mergeable_ranks=ranks, special_tokens=special)


def encode(path: str, text: str) -> np.ndarray:
    """Ids of a text. The library's word pattern gives up on white space of a million characters;
    such texts are encoded as in ``gondola.llm.bpe``."""
    try:
        return encoding(path).encode_to_numpy(text, allowed_special="all")
    except ValueError:
        v = vocabulary(path)
        return np.frombuffer(encode_texts([text.encode()], v.cache, v.learn, v.special)[0], "<u4")


def _pieces(batches: Iterator[pa.RecordBatch], path: str, length: int, closing: int, keep: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            rows, numbers, starts, lengths, sums, kept = [], [], [], [], [], []
            for row, text in enumerate(part.column("text").to_pylist()):
                ids = np.append(encode(path, text or ""), closing).astype("<u4")
                cuts = [0, *range(len(ids) % length or length, len(ids) + 1, length)]
                for number, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    own = ids[a:b].tobytes()
                    rows.append(row)
                    numbers.append(number)
                    starts.append(a)
                    lengths.append(b - a)
                    sums.append(zlib.crc32(own))
                    kept.append(own if keep else None)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(numbers, pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(sums, pa.int64()), pa.array(kept, pa.binary())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"],
            )


def cut_pieces(docs: DataFrame, path: str, length: int = 2048, closing: int = 0, keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids): the pieces of every whole text; ``ids``
    (little-endian unsigned 32-bit numbers) only with ``keep_ids``. A null text counts as empty:
    one piece, the closing id. One task's work per row, no shuffle."""
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        partial(_pieces, path=path, length=length, closing=closing, keep=keep_ids),
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, ids binary",
    )


def place(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item, in order of falling size.

    An item that turns a gap g into g - s changes the sum of squares by 2 (N[g-s] - N[g]) + 2; one
    that fills its bin takes N[g]² back to (N[g]-1)²; a new bin adds to N[length-s] alone. Ties go
    to the smaller gap, a new bin comes last.
    """
    order = np.argsort(-sizes, kind="stable")
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(length + 1)]
    count = np.zeros(length + 1, np.int64)
    made = 0
    for i in order.tolist():
        s = int(sizes[i])
        gain = np.where(count[s:length] > 0, 2 * (count[: length - s] - count[s:length]) + 2, np.iinfo(np.int64).max)
        if s < length and count[s]:
            gain[0] = 1 - 2 * count[s]
        best = int(gain.argmin()) if s < length else 0
        fresh = 2 * count[length - s] + 1 if s < length else 0
        if s < length and gain[best] <= fresh:
            gap = s + best
            at = open_bins[gap].pop()
            count[gap] -= 1
        else:
            gap, at = length, made
            made += 1
        bins[i], offsets[i] = at, length - gap
        left = gap - s
        if left:
            open_bins[left].append(at)
            count[left] += 1
    return bins, offsets


def _pack(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(batches) if (batches := list(batches)) else None
    if table is None or not table.num_rows:
        return
    task = pa.array(np.full(table.num_rows, table.column("item")[0].as_py()), pa.int64())  # names this task
    bins, offsets = place(table.column("size").to_numpy(), length)
    yield pa.RecordBatch.from_arrays([table.column("item").combine_chunks(), table.column("size").combine_chunks(), task, pa.array(bins), pa.array(offsets)], names=["item", "size", "task", "bin", "at"])


def _packed(items: DataFrame, length: int, task_pieces: int) -> DataFrame:
    """(item, size, task, bin, at) for (item, size); items are dealt evenly over tasks."""
    tasks = max(1, -(-items.count() // task_pieces))
    dealt = items.repartition(tasks, F.xxhash64("item"))
    return dealt.mapInArrow(partial(_pack, length=length), "item long, size long, task long, bin long, at long")


def pack(pieces: DataFrame, length: int = 2048, task_pieces: int = TASK_PIECES) -> DataFrame:
    """Adds (sequence_id, offset) to ``pieces``; offsets of a sequence are gapless from 0.

    A sequence id is any number. Ties and repeated rows are packed like any other row; no row is
    lost. The second round takes every sequence with room left, so that few stay open however many
    tasks there are.
    """
    rows = settle(pieces.withColumn("item", F.monotonically_increasing_id()), "pieces")
    full = rows.where(F.col("length") >= length).select("item", F.col("item").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    first = settle(_packed(rows.where(F.col("length") < length).select("item", F.col("length").alias("size")), length, task_pieces), "packed")
    # One item of each sequence stands for it.
    filled = first.groupBy("task", "bin").agg(F.sum("size").alias("size"), F.min("item").alias("head"))
    again = settle(_packed(filled.where(F.col("size") < length).select(F.col("head").alias("item"), "size"), length, task_pieces), "repacked")
    moved = again.select(F.col("item").alias("head"), F.col("task").alias("task2"), F.col("bin").alias("bin2"), F.col("at").alias("at2"))
    names = again.groupBy(F.col("task").alias("task2"), F.col("bin").alias("bin2")).agg(F.min("item").alias("sequence_id"))
    homes = (
        filled.join(moved.join(names, ["task2", "bin2"]), "head", "left")
        .select("task", "bin", F.coalesce("sequence_id", "head").alias("sequence_id"), F.coalesce("at2", F.lit(0)).alias("at2"))
    )
    mixed = first.join(homes, ["task", "bin"]).select("item", "sequence_id", (F.col("at") + F.col("at2")).alias("offset"))
    return rows.join(mixed.unionByName(full), "item").drop("item")


def pack_documents(docs: DataFrame, path: str, length: int = 2048, closing: int = 0, keep_ids: bool = False) -> DataFrame:
    """Pieces of every document with their place: (doc_id, piece, start, length, ids_crc32, ids,
    sequence_id, offset). Repeated rows are packed as often as they occur; an empty table gives an
    empty result; columns other than doc_id and text don't matter."""
    return pack(cut_pieces(docs, path, length, closing, keep_ids), length)
