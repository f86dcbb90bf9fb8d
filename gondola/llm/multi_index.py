"""Approximate nearest neighbours by an inverted multi-index.

Both halves of the vectors have a codebook of their own; a pair of centroids is a cell. A query
goes through the cells in falling order of the two centroids' summed inner products, held in a
heap, until it has met enough entries; those are scored exactly. How many are enough is measured
beforehand: some queries are answered exactly, and their neighbours looked for in that order.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gondola.llm.base import settle

#: Vectors that the codebooks are fitted on, and components of all of them, at most.
SAMPLE, SAMPLE_VALUES = 8192, 1 << 22
#: Queries that are answered exactly to learn how many entries are enough.
TRIALS = 256
#: Centroids of a half, at most: there are no more than the square of it cells.
CENTROIDS = 256
#: Share of the trials' neighbours that must be met.
TARGET = 0.96
#: Vectors of a tile of cells, and queries that are scored against it at a time.
TILE, BLOCK = 4096, 1024
#: Queries that one task takes through the cells.
ROUTED = 256


def matrix(vectors, width: int) -> np.ndarray:
    """Rows of numbers; shorter ones are filled up with zeros."""
    rows = [np.asarray(v, np.float64) for v in vectors]
    if all(len(r) == width for r in rows):
        return np.array(rows).reshape(len(rows), width)
    out = np.zeros((len(rows), width))
    for k, r in enumerate(rows):
        out[k, : len(r)] = r
    return out


def codebook(points: np.ndarray, size: int, rounds: int = 12) -> np.ndarray:
    """Centroids of k-means from ``size`` different points; those that lose all theirs stay."""
    points = np.unique(points, axis=0)
    centroids = points[np.random.default_rng(5).permutation(len(points))[:size]].copy()
    for _ in range(rounds):
        own = nearest_centroids(points, centroids)
        counts = np.bincount(own, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, points)
        filled = counts > 0
        centroids[filled] = sums[filled] / counts[filled, None]
    return centroids


def nearest_centroids(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    out = np.empty(len(points), np.int64)
    offsets = (centroids**2).sum(1) / 2
    for start in range(0, len(points), 4096):
        out[start : start + 4096] = np.argmax(points[start : start + 4096] @ centroids.T - offsets, axis=1)
    return out


@dataclass
class Codebooks:
    """The centroids of both halves of vectors with ``width`` components."""

    width: int
    left: np.ndarray
    right: np.ndarray

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        half = self.width // 2
        return nearest_centroids(vectors[:, :half], self.left) * len(self.right) + nearest_centroids(vectors[:, half:], self.right)

    def parts(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Inner products of each half with its centroids."""
        half = self.width // 2
        return vectors[:, :half] @ self.left.T, vectors[:, half:] @ self.right.T


def fit(sample: np.ndarray, total: int) -> Codebooks:
    """Codebooks for ``total`` vectors: about 16 vectors a cell, as long as there are few enough."""
    size = int(max(1, min(CENTROIDS, total**0.5 / 4)))
    half = sample.shape[1] // 2
    return Codebooks(sample.shape[1], codebook(sample[:, :half], size), codebook(sample[:, half:], size))


def cells_in_order(left: np.ndarray, right: np.ndarray, counts: np.ndarray, enough: int) -> list[int]:
    """Cells that hold vectors, by falling sums of ``left[i] + right[j]``, until they hold
    ``enough``. A heap has the border of the pairs seen so far."""
    rows, columns = np.argsort(-left, kind="stable"), np.argsort(-right, kind="stable")
    a, b = left[rows].tolist(), right[columns].tolist()
    rows, columns, n = (rows * len(right)).tolist(), columns.tolist(), counts.tolist()
    reached = [0] * len(a)  # columns seen of each row
    heap, met, out = [(-(a[0] + b[0]), 0)], 0, []
    while heap and met < enough:
        _, i = heapq.heappop(heap)
        j = reached[i]
        cell = rows[i] + columns[j]
        if n[cell]:
            out.append(cell)
            met += n[cell]
        reached[i] = j + 1
        if j + 1 < len(b):
            heapq.heappush(heap, (-(a[i] + b[j + 1]), i))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (-(a[i + 1] + b[0]), i + 1))
    return out


def entries_needed(books: Codebooks, queries: np.ndarray, neighbours: list[list[int]], counts: np.ndarray, target: float) -> int:
    """Entries that a query has to meet for ``target`` of all neighbours, given by their cells, to
    be among them."""
    needed = []
    for left, right, cells in zip(*books.parts(queries), neighbours, strict=True):
        order = np.argsort(-(left[:, None] + right).ravel(), kind="stable")
        met = np.empty(len(counts), np.int64)
        met[order] = np.cumsum(counts[order])
        needed += met[cells].tolist()
    needed.sort()
    return needed[min(len(needed) - 1, int(target * len(needed)))] if needed else 1


@dataclass
class Tiles:
    """Cells in order, put together up to ``TILE`` vectors; of larger cells, several tiles each."""

    first: np.ndarray  # of each cell, its first tile
    parts: np.ndarray  # and how many it has

    @classmethod
    def of(cls, counts: np.ndarray, most: int = TILE) -> Tiles:
        first, parts = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64)
        tile, filled = 0, 0
        for cell in np.flatnonzero(counts).tolist():
            n = int(counts[cell])
            if filled and filled + n > most:
                tile, filled = tile + 1, 0
            first[cell], parts[cell] = tile, -(-n // most)
            filled += n
            if n > most:
                tile, filled = tile + int(parts[cell]), 0
        return cls(first, parts)


def best_of(queries: np.ndarray, allowed: np.ndarray, vectors: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query the ``allowed`` vectors that may be among its ``k + 1`` best, and their scores,
    summed up the same way whatever else is in the block."""
    for start in range(0, len(queries), 128):
        block = queries[start : start + 128]
        scores = np.where(allowed[start : start + 128], block @ vectors.T, -np.inf)
        scores[np.isnan(scores)] = -np.inf
        if scores.shape[1] > k + 1:
            limits = np.partition(scores, scores.shape[1] - k - 1, axis=1)[:, scores.shape[1] - k - 1]
        else:
            limits = np.full(len(block), -np.inf)
        slack = np.where(np.isfinite(limits), np.abs(limits) * 1e-9 + 1e-12, 0)
        for row in range(len(block)):
            hits = np.flatnonzero((scores[row] >= limits[row] - slack[row]) & allowed[start + row])
            if len(hits):
                exact = (vectors[hits] * block[row]).sum(axis=1)
                yield start + row, hits, np.where(np.isnan(exact), -np.inf, exact)


def others(ids: np.ndarray, holders: list) -> np.ndarray:
    """For each query and entry, whether another row than the query's own holds the entry."""
    alone = np.array([len(h) == 1 for h in holders])
    return ~(alone & (np.array([h[0]["vec_id"] for h in holders]) == ids[:, None]))


FOUND = "query_id long, u long, vec_id long, n int, score double"


def _score(asked: pd.DataFrame, entries: pd.DataFrame, width: int, k: int) -> pd.DataFrame:
    columns: list[list] = [[], [], [], [], []]
    if len(asked) and len(entries):
        vectors, own_cells = matrix(entries["v"], width), entries["cell"].to_numpy()
        cells, column = np.unique(own_cells, return_inverse=True)
        visits = np.zeros((len(asked), len(cells)), bool)
        for row, wanted in enumerate(asked["cells"]):
            visits[row] = np.isin(cells, wanted)
        holders, u, ids = entries["holders"].tolist(), entries["u"].to_numpy(), asked["query_id"].to_numpy()
        for row, hits, scores in best_of(matrix(asked["v"], width), visits[:, column] & others(ids, holders), vectors, k):
            rows = [(-s, h["vec_id"], int(u[x]), h["n"]) for x, s in zip(hits.tolist(), scores.tolist(), strict=True) for h in holders[x] if h["vec_id"] != ids[row]]
            for s, vec_id, number, n in sorted(rows)[:k]:
                for values, value in zip(columns, (int(ids[row]), number, vec_id, n, -s), strict=True):
                    values.append(value)
    return pd.DataFrame({"query_id": np.array(columns[0], np.int64), "u": np.array(columns[1], np.int64), "vec_id": np.array(columns[2], np.int64), "n": np.array(columns[3], np.int32), "score": np.array(columns[4], np.float64)})


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part."""
    number = F.transform("embedding", lambda x: x.cast("double"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), number.alias("v"))
    return rows.where("vec_id is not null and v is not null").where(fine)


def different(rows: DataFrame, k: int) -> DataFrame:
    """(u, v, holders): every vector once, with the ``k + 1`` smallest ids that hold it and how many
    rows each has (up to ``k``). Others can't be among the ``k`` best of any query: of equal scores
    the smaller id goes first. Ids are cut down before the shuffle, so that no vector's rows meet."""
    held = rows.groupBy("v", "vec_id").agg(F.least(F.count(F.lit(1)), F.lit(k)).cast("int").alias("n"))
    first = held.withColumn("place", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("place") <= k + 1)
    vectors = first.groupBy("v").agg(F.collect_list(F.struct("vec_id", "n")).alias("holders"))
    return settle(vectors.withColumn("u", F.monotonically_increasing_id()), "vectors")


def exact_neighbours(entries: DataFrame, queries: pd.DataFrame, width: int, k: int) -> list[list[int]]:
    """The cells of the ``k`` best entries of each of a bounded number of queries: every task finds
    its own best, and those of all tasks are ranked."""
    asks = entries.sparkSession.sparkContext.broadcast((matrix(queries["v"], width), queries["query_id"].to_numpy()))

    def best(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        points, ids = asks.value
        for frame in frames:
            if not len(frame):
                continue
            cells, holders = frame["cell"].to_numpy(), frame["holders"].tolist()
            rows = []
            for row, hits, scores in best_of(points, others(ids, holders), matrix(frame["v"], width), k):
                rows += [(row, int(cells[x]), h["vec_id"], s) for x, s in zip(hits.tolist(), scores.tolist(), strict=True) for h in holders[x] if h["vec_id"] != ids[row]]
            yield pd.DataFrame(rows, columns=["row", "cell", "vec_id", "score"])

    found = entries.select("v", "cell", "holders").mapInPandas(best, "row int, cell long, vec_id long, score double")
    ranked = found.withColumn("place", F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "vec_id"))).where(F.col("place") <= k)
    out: list[list[int]] = [[] for _ in range(len(queries))]
    for r in ranked.select("row", "cell").collect():  # TRIALS * k rows at most
        out[r.row].append(r.cell)
    return out


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, target: float = TARGET, tile: int = TILE, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest rows found for each query, by inner product.

    ``vectors`` has (vec_id, embedding). Queries are the rows whose vec_id is divisible by
    ``every``, candidates all rows with another vec_id. The largest inner products go first, ties to
    the smaller vec_id; ranks start at 1; with fewer candidates all are found. Null, empty and
    zero vectors, those with a null or non-finite component and rows without vec_id take no part.
    Shorter vectors count as filled up with zeros. Candidate rows that are repeated count each; a
    query that is repeated asks once, and where its vec_id has several vectors, a candidate's best
    score counts. Sums that overflow to no number come last. No rows, no result.

    Every row is indexed. Codebooks are fitted on ``SAMPLE`` different vectors, chosen by hash, and
    ``TRIALS`` queries are answered exactly to learn how many entries meet ``target`` of all
    neighbours: both numbers are bounds, whatever the table's size. Equal vectors are one entry.
    Cells are dealt out as tiles of ``tile`` entries, large cells in parts, and a tile's queries in
    blocks: that is what one task holds.
    """
    spark = vectors.sparkSession
    rows = settle(usable(vectors), "vectors")
    entries = different(rows, k)
    asked = rows.where(F.col("vec_id") % every == 0).distinct().withColumnRenamed("vec_id", "query_id")
    # Going through cells takes milliseconds a query: tasks of few queries, whatever their bytes.
    asked = settle(asked.repartition(max(1, -(-asked.count() // ROUTED)), F.xxhash64("query_id", "v")), "queries")
    size = entries.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width")).first()
    trials = asked.orderBy(F.xxhash64("v", "query_id"), "query_id").limit(TRIALS).toPandas()
    if not len(trials):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width = int(size.width)
    sample = entries.orderBy(F.xxhash64("v"), "v").limit(max(1, min(SAMPLE, SAMPLE_VALUES // width))).select("v").toPandas()
    books = fit(matrix(sample["v"], width), size.n)
    shared = spark.sparkContext.broadcast(books)

    def indexed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(cell=shared.value.cells(matrix(frame["v"], width)))

    entries = settle(entries.mapInPandas(indexed, "v array<double>, holders array<struct<vec_id:bigint,n:int>>, u long, cell long"), "entries")
    counts = np.zeros(len(books.left) * len(books.right), np.int64)
    for r in entries.groupBy("cell").count().collect():  # CENTROIDS squared at most
        counts[r["cell"]] = r["count"]
    enough = entries_needed(books, matrix(trials["v"], width), exact_neighbours(entries, trials, width, k), counts, target)
    enough = max(enough, k + 1)
    tiles = Tiles.of(counts, tile)
    routes = spark.sparkContext.broadcast((counts, tiles))

    def routed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, tiles = routes.value
        for frame in frames:
            out = []
            for query_id, v, left, right in zip(frame["query_id"], frame["v"], *shared.value.parts(matrix(frame["v"], width)), strict=True):
                cells: dict[int, list[int]] = {}
                for cell in cells_in_order(left, right, counts, enough):
                    for part in range(tiles.parts[cell]):
                        cells.setdefault(int(tiles.first[cell]) + part, []).append(cell)
                out += [(query_id, v, t, own) for t, own in cells.items()]
            yield pd.DataFrame(out, columns=["query_id", "v", "tile", "cells"])

    def placed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tiles = routes.value[1]
        for frame in frames:
            cell = frame["cell"].to_numpy()
            yield frame.assign(tile=tiles.first[cell] + frame["u"].to_numpy() % tiles.parts[cell])

    kind = "query_id long, v array<double>, tile long, cells array<long>"
    wanted = settle(asked.mapInPandas(routed, kind), "routes")
    blocks = wanted.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    left = wanted.join(blocks, "tile").withColumn("block", F.pmod(F.xxhash64("query_id", "v"), "blocks").cast("int")).drop("blocks")
    right = entries.mapInPandas(placed, "v array<double>, holders array<struct<vec_id:bigint,n:int>>, u long, cell long, tile long")
    right = right.join(blocks, "tile").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    found = left.groupBy("tile", "block").cogroup(right.groupBy("tile", "block")).applyInPandas(lambda asks, has: _score(asks, has, width, k), FOUND)
    # Several vectors of one vec_id are one query.
    found = found.groupBy("query_id", "u", "vec_id").agg(F.max("score").alias("score"), F.max("n").alias("n"))
    found = found.select("query_id", "vec_id", "score", F.explode(F.sequence(F.lit(1), "n")))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
