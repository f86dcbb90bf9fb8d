"""Corpus queries against their SQL on DuckDB, and what every query promises."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point
from gondola.llm.queries import QUERIES, SQL

SF_DIR = Path("/root/testdata/sf0.001")
COLUMNS = {
    "op1_surrogates": ["doc_id", "text"],
    "op2_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op3_language": ["doc_id", "held_out", "lang_pred", "score"],
    "op4_url_filters": ["page_id", "host", "path", "rule", "verdict"],
    "op5_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op6_top_k": ["query_id", "rank", "vec_id", "score"],
    "op7_simhash": ["doc_id", "fingerprint", "component_id"],
    "op8_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op9_token_counts": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op10_exact_dedup": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op11_periodic_runs": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
    "op12_merkle_manifest": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
    "op13_neighbours": ["query_id", "rank", "vec_id", "score"],
}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    database = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        database.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    want = database.sql(SQL[name])
    got = QUERIES[name](spark, str(SF_DIR))
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(str, map(tuple, got.select(*want.columns).collect()))) == sorted(map(str, want.fetchall()))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_promised_columns(spark, name):
    assert name in entry_point.queries()
    got = QUERIES[name](spark, str(SF_DIR))
    assert got.columns[: len(COLUMNS[name])] == COLUMNS[name]
    if name.startswith("op5"):
        assert all(len(r.ids_sha256) == len(r.decoded_sha256) == 64 for r in got.collect())
