"""Every registered query against its SQL on DuckDB."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_point
from gondola.workload import QUERIES, SQL

duckdb = pytest.importorskip("duckdb")
SF_DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _comparable(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        # Adding 0.0 makes a negative zero positive.
        [repr(r[i] + 0.0) if isinstance(r[i], float) else str(r[i]) for i in order]
        for r in records
    )


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, database, name):
    got = QUERIES[name](spark, str(SF_DIR))
    want = database.sql(SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert _comparable(got.columns, got.collect()) == _comparable(want.columns, want.fetchall())


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).count() > 0
