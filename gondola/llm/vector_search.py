"""Exact top-k search by integer inner product: branch and bound over blocks of dimensions.

Queries and candidates are dealt into blocks, and each pair of blocks is one task's. There,
candidates lie dimension by dimension. After each block of dimensions, what the remaining ones can
still add is at most the product of the remaining masses; candidates that can no longer reach a
query's k-th best score are dropped and the rest compacted. Blocks of candidates are met in waves of
growing size: what a query's k best of earlier waves reach is its bound in later ones, so that few
rows leave their tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gondola.llm.base import settle

#: Rows of a block of queries, and of candidates.
QUERIES, CANDIDATES = 16_384, 8192
#: Each wave has so many times the blocks of all waves before it.
GROWTH = 8
#: Dimensions that are accumulated between two bounds.
STEP = 16
#: Sums of products below are exact as 64-bit floats.
EXACT = float(1 << 53)
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def exact_hits(queries: np.ndarray, query_ids: np.ndarray, floors: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, candidates, scores) as ``hits_of_block`` gives them, where sums of products are exact
    as floats. The candidates are in order of their ids."""
    columns = np.ascontiguousarray(vectors.T)
    cuts = [*range(0, max(queries.shape[1], 1), STEP), queries.shape[1]]
    tails_q = [np.sqrt((queries[:, c:] ** 2).sum(1)) for c in cuts]
    tails_x = [np.sqrt((columns[c:] ** 2).sum(0)) for c in cuts]
    heads = columns[: cuts[1]]
    for start in range(0, len(queries), 64):
        block = queries[start : start + 64]
        partial_sums = block[:, : cuts[1]] @ heads
        for row, sums in enumerate(partial_sums):
            q, own = block[row], query_ids[start + row]
            alive = np.flatnonzero(ids != own)
            sums = sums[alive]
            if not len(alive):
                continue
            # Lower limits of the k-th best: that of earlier waves, and whole scores of the k most
            # promising so far.
            floor = floors[start + row]
            if len(sums) >= k:
                first = np.argpartition(-sums, k - 1)[:k]
                floor = max(floor, (q @ columns[:, alive[first]]).min())
            for n in range(1, len(cuts)):
                # A little more than enough for the rounding of the masses.
                keep = np.flatnonzero(sums + tails_q[n][start + row] * tails_x[n][alive] * (1 + 1e-9) + 1e-6 >= floor)
                alive, sums = alive[keep], sums[keep]
                if n + 1 < len(cuts):
                    a, b = cuts[n], cuts[n + 1]
                    sums = sums + q[a:b] @ columns[a:b, alive]
            yield start + row, alive, sums.astype(np.int64)


def hits_of_block(queries: np.ndarray, query_ids: np.ndarray, floors: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, candidates, scores) of the k best candidates of each query in a block that reach its
    floor: best first, ties by id. Values are whole numbers held as floats. Sums that floats don't
    hold are worked out in integers of any length, and cut at the ends of 64 bits."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    limit = (EXACT / max(queries.shape[1], 1)) ** 0.5
    near_q, near_x = (np.abs(m).max(axis=1, initial=0) < limit for m in (queries, vectors))
    at = np.flatnonzero(near_x)
    found = {}
    rows = np.flatnonzero(near_q)
    for row, hits, scores in exact_hits(queries[rows], query_ids[rows], floors[rows], vectors[at], ids[at], k):
        found[int(rows[row])] = (at[hits], scores)
    whole = lambda m: np.array([[int(x) for x in v] for v in m], object).reshape(m.shape)
    far = np.flatnonzero(~near_x)
    for row in range(len(queries)):
        others = far if near_q[row] else np.arange(len(ids))
        others = others[ids[others] != query_ids[row]]
        hits, scores = found.get(row, (np.empty(0, np.int64), np.empty(0, np.int64)))
        if len(others):
            long = whole(vectors[others]) @ whole(queries[row : row + 1])[0]
            cut = np.array([min(max(x, LOWEST), HIGHEST) for x in long], np.int64)
            hits, scores = np.concatenate([hits, others]), np.concatenate([scores, cut])
        hits, scores = hits[scores >= floors[row]], scores[scores >= floors[row]]
        # No negation: the lowest number has no counterpart.
        top = np.lexsort((ids[hits], ~scores))[:k]
        if len(top):
            yield row, order[hits[top]], scores[top]


def best_of_block(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, score) of each query's k best candidates in a block, all integers. Other
    rows than a query's own with its very score and a smaller id go first."""
    floors = np.full(len(queries), -np.inf)
    out = [(np.full(len(hits), query_ids[row]), ids[hits], scores) for row, hits, scores in hits_of_block(queries.astype(np.float64), query_ids, floors, vectors.astype(np.float64), ids, k)]
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    a, b, c = (np.concatenate(x) for x in zip(*out, strict=True))
    return a, b, c


FOUND = "query_id long, u long, vec_id long, n long, score long"


def _search(frame: pd.DataFrame, k: int) -> pd.DataFrame:
    asks = frame["asks"].to_numpy(bool)
    out: list[list[np.ndarray]] = [[np.empty(0, np.int64)] for _ in range(5)]
    if asks.any() and not asks.all():
        vectors = np.array(frame["v"].tolist(), np.float64).reshape(len(frame), -1)
        ids, u, n = (frame[c].to_numpy(np.int64) for c in ("vec_id", "u", "n"))
        floors = frame["floor"].to_numpy(np.float64)[asks]
        for row, hits, scores in hits_of_block(vectors[asks], ids[asks], floors, vectors[~asks], ids[~asks], k):
            for values, new in zip(out, (np.full(len(hits), ids[asks][row]), u[~asks][hits], ids[~asks][hits], n[~asks][hits], scores), strict=True):
                values.append(new)
    return pd.DataFrame({c: np.concatenate(v) for c, v in zip(("query_id", "u", "vec_id", "n", "score"), out, strict=True)})


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256, queries: int = QUERIES, candidates: int = CANDIDATES, growth: int = GROWTH) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of all other rows for each query.

    ``vectors`` has (vec_id, embedding). Queries are the rows whose vec_id is divisible by ``every``,
    candidates all rows with another vec_id. A component x counts as floor(scale * x), as a double;
    the score is the inner product; ties go to the smaller vec_id; ranks start at 1. Rows with a
    null vec_id, a null vector, or a null or non-finite component take no part. Vectors of other
    lengths than a query's aren't compared with it. Candidate rows that are repeated count each; a
    query that is repeated asks once, and where its vec_id has several vectors, a candidate's best
    score counts. Any finite component is taken: scores beyond 64 bits are the largest or smallest
    number of 64 bits, and products beyond doubles are those of the largest double.
    """
    most = np.finfo(np.float64).max
    scaled = lambda x: F.greatest(F.least(x.cast("double") * scale, F.lit(most)), F.lit(-most))
    # From 2^53 on doubles are whole, and 64-bit integers may not hold them.
    floored = lambda y: F.when(F.abs(y) < EXACT, F.floor(y).cast("double")).otherwise(y)
    whole = F.transform(F.transform("embedding", scaled), floored)
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))
    rows = rows.groupBy("vec_id", "v").agg(F.count(F.lit(1)).alias("n")).withColumn("u", F.monotonically_increasing_id())
    rows = settle(rows, "vectors")
    asked = rows.where(F.col("vec_id") % every == 0)
    q_blocks = max(1, -(-asked.count() // queries))
    x_blocks = max(8, -(-rows.count() // candidates))
    own = lambda n, seed: F.pmod(F.xxhash64("u", F.lit(seed)), F.lit(n)).cast("int")
    asked, rows = asked.withColumn("i", own(q_blocks, 1)), rows.withColumn("j", own(x_blocks, 2))
    best: DataFrame | None = None
    begin = 0
    while begin < x_blocks:
        end = min(x_blocks, max(1, begin * (growth + 1)))
        here = F.explode(F.sequence(F.lit(begin), F.lit(end - 1)))
        floor = F.lit(float("-inf"))
        left = asked
        if best is not None:
            reached = best.groupBy("query_id").agg(F.count(F.lit(1)).alias("m"), F.min("score").alias("least"))
            left = left.join(reached, F.col("vec_id") == F.col("query_id"), "left")
            # One less than the score, as that may lose its last digits.
            floor = F.coalesce(F.when(F.col("m") == k, F.col("least").cast("double") * (1 - F.signum("least") * 1e-15) - 1), floor)
        left = left.select("vec_id", "v", "u", "n", F.lit(True).alias("asks"), floor.alias("floor"), "i", here.alias("j"))
        every_block = F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)))
        right = rows.where((F.col("j") >= begin) & (F.col("j") < end))
        right = right.select("vec_id", "v", "u", "n", F.lit(False).alias("asks"), F.lit(0.0).alias("floor"), every_block.alias("i"), "j")
        both = left.unionByName(right).withColumn("d", F.size("v"))
        found = both.groupBy("i", "j", "d").applyInPandas(lambda frame: _search(frame, k), FOUND)
        if best is not None:
            found = found.unionByName(best)
        # Several vectors of one vec_id are one query.
        found = found.groupBy("query_id", "u", "vec_id", "n").agg(F.max("score").alias("score"))
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id", "u")
        best = settle(found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("place"), "best")
        begin = end
    copies = best.select("query_id", "vec_id", "score", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k)).cast("int"))))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return copies.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
