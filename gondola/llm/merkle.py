"""Merkle manifest of a table: a hash tree for each group of rows, and one over the groups.

Rows are numbered within their group in order and dealt into superblocks of a fixed number of
consecutive ones. Superblocks are reduced to their top nodes, those again to fewer, until each
group has one. On the way back a superblock's nodes are cogrouped with what lies outside of it on
its path to the root: one task finishes the nodes inside, their proofs, and the check of each row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gondola.llm.base import settle

#: Levels that are reduced within one superblock: 1,024 nodes of two children.
DEPTH = 10
#: Between the siblings on the left of a node and those on its right.
HERE = "|"


def record_hash(*fields: Column) -> Column:
    """Hash of a record: of each field ``-`` if null, else the number of its UTF-8 bytes, a colon
    and its value as text, so that no two records read alike."""
    texts = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """Adds ``i``, a row's number from 0 within its group ``g`` in the given order, and ``n``, the
    group's rows. Rows alike in all of these are told apart by where they were read, so that any
    number of them is spread over tasks; no window sees more than one row per range of rows."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["g", *order, "__read"]
    ranged = rows.withColumn("__read", F.monotonically_increasing_id()).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    placed = settle(ranged.drop("__read").withColumn("__at", F.monotonically_increasing_id()), "numbered")
    placed = placed.withColumn("__range", F.shiftright("__at", 33))
    ranges = placed.groupBy("g", "__range").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    group = Window.partitionBy("g")
    before = F.sum("__rows").over(group.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    ranges = ranges.select("g", "__range", (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__shift"), F.sum("__rows").over(group).alias("n"))
    return placed.join(ranges, ["g", "__range"]).withColumn("i", F.col("__at") + F.col("__shift")).drop("__at", "__range", "__shift")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def levels_of(nodes: list[str], total: int, arity: int, depth: int) -> list[list[str]]:
    """The levels of a superblock up from its nodes: ``depth`` more, or as many as a level of
    ``total`` nodes is away from its single top."""
    levels = [nodes]
    while total > 1 and len(levels) <= depth:
        last = levels[-1]
        levels.append([digest("".join(last[k : k + arity])) for k in range(0, len(last), arity)])
        total = -(-total // arity)
    return levels


def paths_in(levels: list[list[str]], arity: int) -> list[list[str]]:
    """For each node of the lowest level the siblings on its way up, a text for each level."""
    beside = []
    for level in levels[:-1]:
        runs = [level[k : k + arity] for k in range(0, len(level), arity)]
        beside.append([HERE.join(("".join(run[:k]), "".join(run[k + 1 :]))) for run in runs for k in range(len(run))])
    return [[row[k // arity**n] for n, row in enumerate(beside)] for k in range(len(levels[0]))]


def folded(node: str, path: Sequence[str]) -> str:
    """The root that a node and its siblings give."""
    for level in path:
        before, after = level.split(HERE)
        node = digest(before + node + after)
    return node


def _top(frame: pd.DataFrame, arity: int, depth: int) -> pd.DataFrame:
    frame = frame.sort_values("i")
    total, size = int(frame["n"].iloc[0]), arity**depth
    top = levels_of(frame["node"].tolist(), total, arity, depth)[-1][0]
    return pd.DataFrame({"g": [frame["g"].iloc[0]], "i": [int(frame["i"].iloc[0]) // size], "n": [-(-total // size)], "node": [top]})


def _extended(frame: pd.DataFrame, outer: pd.DataFrame, arity: int, depth: int) -> pd.DataFrame:
    """Paths of a superblock's nodes to the root, their siblings inside before those outside."""
    frame = frame.sort_values("i", ignore_index=True)
    inside = paths_in(levels_of(frame["node"].tolist(), int(frame["n"].iloc[0]), arity, depth), arity)
    outside = list(outer["path"].iloc[0])
    return frame.drop(columns=["n", "b"]).assign(path=[p + outside for p in inside], subroot=outer["subroot"].iloc[0], root=outer["root"].iloc[0])


def _finished(frame: pd.DataFrame, outer: pd.DataFrame, arity: int, depth: int, proofs: bool) -> pd.DataFrame:
    """A superblock's rows with their proofs, and the roots that their checked hashes lead to."""
    done = _extended(frame, outer, arity, depth)
    done["proof_sha256"] = [digest("".join(p).replace(HERE, "")) for p in done["path"]]
    done["folded_root"] = [folded(c, p) for c, p in zip(done["checked"], done["path"], strict=True)]
    done["verified"] = done["folded_root"] == done["root"]
    done = done.rename(columns={"node": "leaf", "path": "proof"})
    return done if proofs else done.drop(columns=["proof"])


def _tiers(nodes: DataFrame, arity: int, depth: int) -> list[DataFrame]:
    """``nodes`` (g, i, n, node, …), then the top nodes of their superblocks, of those, …, until
    every group has one."""
    tiers = [nodes.withColumn("b", F.expr(f"i div {arity**depth}"))]
    while (tiers[-1].agg(F.max("n").alias("n")).first().n or 1) > 1:
        below = tiers[-1].select("g", "b", "i", "n", "node")
        tops = below.groupBy("g", "b").applyInPandas(lambda frame: _top(frame, arity, depth), "g string, i bigint, n bigint, node string")
        tiers.append(settle(tops, "tops").withColumn("b", F.expr(f"i div {arity**depth}")))
    return tiers


def _meeting(tier: DataFrame, outer: DataFrame):
    """A tier's superblocks and what is known of their top nodes, cogrouped."""
    return tier.groupBy("g", "b").cogroup(outer.groupBy("g", "i"))


PATHS = "g string, i bigint, node string, path array<string>, subroot string, root string"


def _descend(tiers: list[DataFrame], outer: DataFrame, arity: int, depth: int) -> DataFrame:
    """From paths of the single nodes of the last tier to those of the second one's nodes."""
    for tier in reversed(tiers[1:-1]):
        down = lambda frame, above: _extended(frame, above, arity, depth)
        outer = settle(_meeting(tier, outer).applyInPandas(down, PATHS), "paths")
    return outer


def manifest(docs: DataFrame, leaf: Column, checked: Column, by: str = "lang", order: str = "doc_id", arity: int = 2, depth: int = DEPTH, proofs: bool = False) -> DataFrame:
    """(order, by, leaf, subroot, root, proof_sha256, folded_root, verified): one row per row.

    ``leaf`` is a row's hash, ``checked`` the hash it is held against the manifest with, both over
    columns of ``docs``. The rows of each value of ``by`` form a tree in order of ``order``: while
    there is more than one node, every ``arity`` consecutive ones, of which the last may be fewer,
    are hashed into one. The tops, ``subroot``, form one more tree in order of ``by``, null first,
    and its top is ``root``. ``proof_sha256`` is the hash of a row's siblings from its leaf to the
    root, ``folded_root`` what ``checked`` leads to with them, ``verified`` whether that is the root.
    With ``proofs`` the siblings themselves are returned: for each level those on the left, a bar,
    those on the right.

    Null values of ``order`` come first; rows with equal ones are in order of their leaves, so that
    the root doesn't depend on where rows were read. Repeated rows are leaves like any other. No
    rows, no result. Other columns don't matter. Texts are hashed where they are read, and only
    hashes are shuffled. A superblock has ``arity ** depth`` rows at most, whatever a group's size.
    """
    group = F.coalesce(F.concat(F.lit("1"), F.col(by).cast("string")), F.lit("0"))  # bytewise, null first
    kind = docs.schema[order].dataType.simpleString()
    rows = settle(docs.select(group.alias("g"), F.col(order).alias("id"), leaf.alias("node"), checked.alias("checked")), "leaves")
    # Ids pass through pandas as texts, which keep nulls and all digits.
    leaves = numbered(rows, "id", "node").withColumn("id", F.col("id").cast("string"))
    trees = _tiers(settle(leaves, "leaves"), arity, depth)
    subroots = trees[-1].select("g", "node")
    crown = _tiers(settle(numbered(subroots.select(F.lit("").alias("g"), "node", F.col("g").alias("of")), "of"), "subroots"), arity, depth)
    root = crown[-1].select("g", F.col("node").alias("root"))
    ends = root.select("g", F.lit(0).cast("long").alias("i"), F.array().cast("array<string>").alias("path"), F.lit("").alias("subroot"), "root")
    down = lambda frame, above: _extended(frame, above, arity, depth)
    outer = _meeting(crown[0], _descend(crown, ends, arity, depth)).applyInPandas(down, PATHS + ", of string")
    outer = settle(outer.select(F.col("of").alias("g"), F.lit(0).cast("long").alias("i"), "path", F.col("node").alias("subroot"), "root"), "paths")
    outer = _descend(trees, outer, arity, depth)
    columns = "g string, i bigint, id string, leaf string, checked string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    finish = lambda frame, above: _finished(frame, above, arity, depth, proofs)
    done = _meeting(trees[0], outer).applyInPandas(finish, columns + (", proof array<string>" if proofs else ""))
    value = F.when(F.col("g") != "0", F.substring("g", 2, 2**31 - 1)).cast(docs.schema[by].dataType)
    extra = ["proof"] if proofs else []
    return done.select(F.col("id").cast(kind).alias(order), value.alias(by), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", *extra)
