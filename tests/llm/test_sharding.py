from __future__ import annotations

import zlib

import pytest
from pyspark.sql import functions as F

from gondola.llm.sharding import shard_by_bytes


def check(docs, shards):
    rows = shard_by_bytes(docs, shards).collect()
    texts = [(r.doc_id, (r.text or "").encode()) for r in docs.select("doc_id", "text").collect()]
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == sorted((str(i), len(t) + 1, zlib.crc32(t)) for i, t in texts)
    order = lambda r: (r.doc_id is not None, r.doc_id or 0, r.size, r.text_crc32)
    total = sum(r.size for r in rows)
    largest = max((r.size for r in rows), default=0)
    last = None
    for k in range(shards):
        own = sorted((r for r in rows if r.shard == k), key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(len(own)))
        assert abs(sum(r.size for r in own) - total / shards) <= largest
        for r in own:  # contiguous in the order of the table
            assert last is None or order(last) <= order(r)
            last = r
    assert {r.shard for r in rows} <= set(range(shards))


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_table(small, shards):
    check(small, shards)


def test_odd_rows(odd, empty):
    check(odd, 8)
    assert shard_by_bytes(empty).count() == 0
    assert shard_by_bytes(empty).columns == ["doc_id", "size", "text_crc32", "shard", "slot"]


def test_one_row_repeated(spark):
    docs = spark.range(1000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    counts = shard_by_bytes(docs).groupBy("shard").count().collect()
    assert [r["count"] for r in counts] == [125] * 8
