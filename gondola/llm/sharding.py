"""Contiguous shards of nearly equal bytes, by prefix sums over the whole table.

Rows are dealt by ranges of doc_id. The totals of the ranges, one row each, are summed up in
order; a row's place in all bytes is the sum before its range plus the sum before it there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gondola.llm.base import settle


def shard_by_bytes(docs: DataFrame, shards: int = 8) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): one row per row of ``docs``.

    In order of doc_id (nulls first; then by size, checksum and place in the input), each row goes
    to the shard that holds the middle of its bytes if all bytes are cut into ``shards`` equal
    parts. So shards are contiguous, and a shard's bytes differ from an equal part by less than one
    row's. ``size`` is the text's bytes in UTF-8 plus 1; a null text has none, and the checksum of
    the empty text. ``slot`` counts a shard's rows from 0 without gaps. Repeated rows are rows like
    any other. Fewer rows than shards leave shards empty.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    order = ["doc_id", "size", "text_crc32", "row"]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # ``row`` lets rows that are alike otherwise lie in different ranges.
    rows = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(parts, *order)
    rows = settle(rows.withColumn("part", F.spark_partition_id()), "ranges")
    totals = rows.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    totals = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(Window.partitionBy(F.lit(0))).alias("all_bytes"),
    )
    inside = Window.partitionBy("part").orderBy(*order)
    rows = rows.join(F.broadcast(totals), "part")  # as many rows as there are ranges
    start = F.col("bytes_before") + F.sum("size").over(inside) - F.col("size")
    shard = F.least(F.floor((2 * start + F.col("size")) * shards / (2 * F.col("all_bytes"))), F.lit(shards - 1))
    placed = settle(
        rows.select("doc_id", "size", "text_crc32", (F.col("rows_before") + F.row_number().over(inside) - 1).alias("rank"), shard.cast("int").alias("shard")),
        "placed",
    )
    firsts = placed.groupBy("shard").agg(F.min("rank").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("rank") - F.col("first")).alias("slot"))
