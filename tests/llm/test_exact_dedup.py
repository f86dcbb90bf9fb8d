from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from gondola.llm import exact_dedup


def brute(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((i, text or ""))
    out = []
    for norm, own in groups.items():
        best = min(own, key=lambda r: (-len(r[1]), r[0] is None, r[0] or 0))
        for k, (i, _) in enumerate(own):
            out.append((str(i), str(best[0]), len(own), hashlib.sha256(norm.encode()).hexdigest()))
        assert k + 1 == len(own)
    return sorted(out)


@pytest.mark.parametrize("bits", [64, 6])
def test_table_at_any_width(small, bits):
    """Six bits make many texts share a fingerprint: bytes tell them apart."""
    rows = exact_dedup.find_copies(small, bits=bits).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in rows) == brute([(r.doc_id, r.text) for r in small.collect()])
    assert all(r.kept == (r.doc_id == r.keep_id) for r in rows)


def test_odd_rows(odd, empty):
    rows = exact_dedup.find_copies(odd).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in rows) == brute([(r.doc_id, r.text) for r in odd.collect()])
    kept = [r for r in rows if r.kept]
    assert len(kept) == len({r.text_sha256 for r in rows})  # one of repeated rows, too
    assert {r.copies for r in rows if r.doc_id == 8 and r.group_size == 2} == {2}
    assert exact_dedup.find_copies(empty).count() == 0


def test_filters_merge_without_loss(spark):
    prints = spark.range(20_000).select(F.xxhash64(F.pmod("id", F.lit(7000))).alias("fingerprint")).unionByName(spark.range(5).select(F.xxhash64(F.col("id") + 10**6).alias("fingerprint"))).repartition(7)
    want = {r.fingerprint: r["count"] for r in prints.groupBy("fingerprint").count().where("count > 1").collect()}
    for quotient_bits in (3, 16, 40):
        assert {r.fingerprint: r["count"] for r in exact_dedup.repeated(prints, quotient_bits).collect()} == want


def test_bitmap_holds_every_repeat(spark):
    repeats = spark.range(3000).select(F.xxhash64("id").alias("fingerprint"))
    seen = exact_dedup.bitmap(repeats)
    slots = exact_dedup._slot(repeats.toPandas()["fingerprint"].to_numpy())
    assert ((seen[slots >> 3] >> (slots & 7).astype("u1")) & 1).all()
    assert sum(bin(b).count("1") for b in seen.tolist()) == len(set(slots.tolist()))


def test_sql_keeps_one_of_repeated_rows_too(spark, tmp_path):
    import duckdb

    from gondola.llm.queries import QUERIES, SQL

    rows = [(1, "a b"), (1, "a b"), (2, "ab"), (3, None), (4, ""), (None, "ab "), (5, "c"), (5, "c")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    database = duckdb.connect()
    database.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = database.sql(SQL["op10_exact_dedup"])
    got = QUERIES["op10_exact_dedup"](spark, str(tmp_path)).select(*want.columns).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want.fetchall()))
    assert sum(r.kept for r in got) == 3
