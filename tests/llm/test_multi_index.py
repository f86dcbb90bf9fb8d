from __future__ import annotations

import math
import random

import numpy as np
import pytest

from gondola.llm import multi_index
from gondola.llm.queries import neighbours

SCHEMA = "vec_id long, embedding array<float>, label int, query_id string, tile int"


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)


def brute(rows, k=20, every=20):
    """Exact results: query_id -> [(vec_id, score)]."""
    rows = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and usable(v)]
    width = max((len(v) for _, v in rows), default=0)
    rows = [(i, np.pad(v, (0, width - len(v)))) for i, v in rows]
    out = {}
    for q in {i for i, _ in rows if i % every == 0}:
        points = [v for i, v in rows if i == q]
        scores = [(-max(float((p * v).sum()) for p in points), i) for i, v in rows if i != q]
        out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def results(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    pairs = sum(len(v) for v in want.values())
    met = sum(len({i for i, _ in got[q]} & {i for i, _ in v}) for q, v in want.items())
    return met / pairs


def close(got, want):
    assert got.keys() == want.keys()
    for q, rows in want.items():
        assert [i for i, _ in got[q]] == [i for i, _ in rows]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in rows], rel=1e-12)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_recall_of_the_query(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").collect()]
    got, want, known = results(neighbours(spark, f"/root/testdata/{sf}")), brute(rows), dict(rows)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    assert recall(got, want) >= 0.9
    for q, found in got.items():
        assert found == sorted(found, key=lambda r: (-r[1], r[0])) and q not in {i for i, _ in found}
        for i, s in found:
            assert s == pytest.approx(float(np.dot(np.float64(known[q]), np.float64(known[i]))), rel=1e-12)


def test_clustered_vectors_in_small_tiles(spark):
    """Dense groups of vectors, many queries and entries per cell; the result is nearly exact."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 16))
    rows = [(i, (centres[rng.integers(20) if i % 3 else 0] + rng.normal(scale=0.1, size=16)).tolist()) for i in range(3000)]
    docs = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA)
    rows = [(r.vec_id, r.embedding) for r in docs.collect()]
    whole = results(multi_index.nearest(docs, every=30))
    assert recall(whole, brute(rows, every=30)) >= 0.9
    assert results(multi_index.nearest(docs, every=30, tile=50, block=7)) == whole


def test_copies_by_the_hundred(spark):
    """A third of all rows are one vector, with one more third of ids on one row: exact, ties to
    the smaller vec_id, queries among the copies."""
    rng = random.Random(2)
    base = [rng.gauss(0, 1) for _ in range(8)]
    rows = [(i, base) for i in range(0, 400)] + [(1000 + i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(400)] + [(77, [1.0] * 8)] * 300
    docs = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA)
    rows = [(r.vec_id, r.embedding) for r in docs.collect()]
    close(results(multi_index.nearest(docs, k=5, target=1.0)), brute(rows, k=5))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0, 0.0]), (0, [0.0, 1.0, 0.0]), (0, [1.0, 0.0, 0.0]), (1, [1.0, 0.0, 0.0]), (1, [1.0, 0.0, 0.0]), (2, None), (3, []), (4, [0.0, 0.0, 0.0]),
        (5, [nan, 1.0, 1.0]), (6, [inf, 0.0, 0.0]), (7, [None, 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (-20, [2.0, 1.0, 0.5]), (8, [3.0e38, -3.0e38, 1.0]), (9, [1.0]), (20, [0.0, 0.0, -1.0]), (40, None),
    ]
    docs = spark.createDataFrame([(i, v, None, None, None) for i, v in rows], SCHEMA)
    rows = [(r.vec_id, r.embedding) for r in docs.collect()]
    for k in (1, 3, 20):
        close(results(multi_index.nearest(docs, k=k)), brute(rows, k=k))


def test_query_with_many_vectors_of_its_own(spark):
    """They are the nearest to each other, but none of them is a candidate."""
    rows = [(20, [5.0, i / 100]) for i in range(60)] + [(i, [1.0, i / 7]) for i in range(1, 20)]
    docs = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA)
    rows = [(r.vec_id, r.embedding) for r in docs.collect()]
    close(results(multi_index.nearest(docs, k=4, target=1.0)), brute(rows, k=4))


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(20, [1.0, 2.0])], [(20, None)]])
def test_nothing_to_find(spark, rows):
    docs = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA)
    assert multi_index.nearest(docs).collect() == []
