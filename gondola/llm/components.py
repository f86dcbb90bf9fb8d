"""Connected components of a graph given as a table of edges, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm.base import settle


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for ``edges`` (a, b) of any one ordered type; the component is the
    smallest node in it. Every node of an edge occurs once; edges with a null end, and loops, are
    left out. No edges, no rows.

    Each round links the larger neighbours of every node to the smallest node around it, then the
    smaller ones, until only stars are left: about log(n) rounds whatever the shape. The least
    neighbour is a map-side aggregate and joined back, so that no node's neighbours are gathered.
    """
    # Downward edges: ``a`` is the larger end.
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = settle(edges.distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = settle(large, "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        # A node and all its smaller neighbours go to the smallest of them.
        small = small.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        edges = settle(small.where("a <> b").distinct(), "edges")
        # Stars: every node has one edge, down to a node that has none. Then nothing changes.
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
