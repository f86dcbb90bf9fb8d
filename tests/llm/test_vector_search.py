from __future__ import annotations

import numpy as np
import pytest

from gondola.llm import vector_search


def brute(rows, k=5, every=50, scale=256):
    """Every row is a candidate; a query asks once, with its best vector."""
    fine = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    whole = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in fine]
    out = []
    for q in {i for i, _ in whole if i % every == 0}:
        asks = [v for i, v in whole if i == q]
        scores = [(-min(max(max(sum(a * b for a, b in zip(p, v, strict=True)) for p in asks if len(p) == len(v)), -(2**63)), 2**63 - 1), j) for j, v in whole if j != q and any(len(p) == len(v) for p in asks)]
        out += [(q, n, j, -s) for n, (s, j) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize(("queries", "candidates"), [(1024, 8192), (3, 40)])
def test_equals_brute_force(spark, queries, candidates):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    got = vector_search.top_k(table, queries=queries, candidates=candidates)
    assert sorted(map(tuple, got.collect())) == brute([(r.vec_id, r.embedding) for r in table.collect()])


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(int(k), rng.normal(size=8).round(2).tolist()) for k in range(200)]
    rows += [(50, None), (None, [1.0] * 8), (300, [None] + [1.0] * 7), (350, [float("nan")] * 8), (400, [float("inf")] * 8), (450, []), (500, [1.0, 2.0])]
    rows += [rows[7], rows[100]]  # repeated rows
    rows += [(600 + k, rows[3][1]) for k in range(20)]  # ties
    rows += [(700, [5e5] * 8), (701, [5e5] * 8)]  # beyond exact floats
    rows += [(800, [1e18] + [0.0] * 7), (801, [1e18] * 8), (802, [-1e18] * 8), (803, [3e38] * 8), (804, [3e38, -3e38] * 4), (850, [-3e38] * 8)]  # beyond 64 bits
    rows += [(900, [0.1] * 8), (900, [-0.1] * 8), (900, [0.1] * 8), (901, [0.2] * 8), (901, [0.2] * 8), (901, [0.2] * 8)]  # repeated ids
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, rank int, v int")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    for more in ({}, {"queries": 2, "candidates": 10, "growth": 2}):
        assert sorted(map(tuple, vector_search.top_k(table, **more).collect())) == brute(rows)
    assert vector_search.top_k(table.limit(0)).count() == 0


def test_largest_doubles(spark):
    rows = [(0, [1.7e308, 1.0]), (1, [1.7e308, 1.7e308]), (2, [-1.7e308, 0.5]), (3, [2.0, 2.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert [(r.vec_id, r.score) for r in vector_search.top_k(table).orderBy("rank").collect()] == [(1, 2**63 - 1), (3, 2**63 - 1), (2, -(2**63))]


def test_repeated_rows_equal_the_sql(spark):
    import duckdb

    from gondola.llm.queries import SQL

    rows = [(i, [((7 * i + c) % 11) / 4 - 1 for c in range(6)]) for i in [*range(120), 1, 1, 50, 7, 100, 100]] + [(50, [0.5] * 6)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    frame = table.toPandas()
    database = duckdb.connect()
    database.register("embeddings", frame)
    want = sorted(database.sql(SQL["op6_top_k"]).fetchall())
    assert sorted(map(tuple, vector_search.top_k(table).select("query_id", "rank", "vec_id", "score").collect())) == want == brute([(r.vec_id, r.embedding) for r in table.collect()])


def test_few_rows_leave_later_waves():
    """Bounds of earlier waves hold back most rows of the later ones: 81 blocks in three waves."""
    rng = np.random.default_rng(8)
    values, ids, k = np.floor(256 * rng.normal(size=(8100, 32))), np.arange(8100), 5
    queries, floors, best, sent = values[:40], np.full(40, -np.inf), [np.empty(0, np.int64)] * 40, 0
    for begin, end in ((0, 1), (1, 9), (9, 81)):
        for block in range(begin, end):
            rows = slice(100 * block, 100 * block + 100)
            for row, hits, scores in vector_search.hits_of_block(queries, ids[:40], floors, values[rows], ids[rows], k):
                best[row], sent = np.append(best[row], scores), sent + len(hits)
        best = [np.sort(b)[-k:] for b in best]
        floors = np.array([float(b.min()) for b in best])
    assert sent < 40 * k * 81 / 3
    whole = values[:40] @ values.T
    assert all((np.sort(np.delete(whole[r], r))[-k:] == best[r]).all() for r in range(40))


def test_bounds_drop_candidates_but_no_result():
    rng = np.random.default_rng(5)
    x = np.floor(256 * rng.normal(size=(500, 70)) * np.linspace(2, 0.01, 70)).astype(np.int64)
    ids = rng.permutation(500).astype(np.int64)
    q, j, s = vector_search.best_of_block(x[:20], ids[:20], x, ids, 5)
    for k in range(20):
        scores = x @ x[k]
        best = sorted((-scores[n], ids[n]) for n in range(500) if n != k)[:5]
        assert [(-a, b) for a, b in zip(s[5 * k : 5 * k + 5], j[5 * k : 5 * k + 5], strict=True)] == best
