"""Exact distinct counts that fold: bitmaps of numbered ids by date.

Ids get numbers once. A date's ids are bitmaps of 32,768 bits, one for each stretch of numbers;
those of several dates are or-ed, so that any range of dates is counted from a few small rows a
date, and never from the facts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Numbers of one task's ids lie in a stretch of their own.
STRETCH = 33


def number_ids(ids: DataFrame, known: DataFrame | None = None, column: str = "id_producto") -> DataFrame:
    """(column, numero) for the ids that ``known`` (column, numero) lacks; null ids get none.

    Numbers are dense within what one task deals with and above all known ones: no id is ranked
    against all others. Dealing is by ranges of the id, in order, so that the same ids get the same
    numbers however often they are worked out; store the result to keep them.
    """
    fresh = ids.select(column).where(F.col(column).isNotNull()).distinct()
    first = F.lit(0).cast("long")
    if known is not None:
        fresh = fresh.join(known, column, "left_anti")
        last = known.agg(F.max(F.shiftright("numero", STRETCH)).alias("n")).scalar()
        first = F.shiftleft(F.coalesce(last + 1, first), STRETCH)
    parts = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = fresh.repartitionByRange(parts, column).sortWithinPartitions(column)
    return dealt.withColumn("numero", F.monotonically_increasing_id() + first)


def id_sets(days: DataFrame, numbers: DataFrame, column: str = "id_producto", *keys: str) -> DataFrame:
    """(*keys, tramo, conjunto): the ids of each date (or other keys) as bitmaps; foldable."""
    keys = keys or ("fecha",)
    numbered = days.select(*keys, column).where(F.col(column).isNotNull()).distinct().join(numbers, column)
    stretch, bit = F.bitmap_bucket_number("numero"), F.bitmap_bit_position("numero")
    return numbered.groupBy(*keys, stretch.alias("tramo")).agg(F.bitmap_construct_agg(bit).alias("conjunto"))


def fold_sets(sets: DataFrame, *keys: str) -> DataFrame:
    """Sets of coarser keys, of none for all."""
    return sets.groupBy(*keys, "tramo").agg(F.bitmap_or_agg("conjunto").alias("conjunto"))


def count_sets(sets: DataFrame, *keys: str) -> DataFrame:
    """(*keys, productos_distintos) of folded sets."""
    return sets.groupBy(*keys).agg(F.coalesce(F.sum(F.bitmap_count("conjunto")), F.lit(0)).alias("productos_distintos"))


def distinct_in_ranges(sets: DataFrame, ranges: DataFrame) -> DataFrame:
    """(desde, hasta, productos_distintos) for every range of dates in ``ranges`` (desde, hasta),
    both ends included; ranges without dates count 0."""
    asked = ranges.select("desde", "hasta").distinct()
    days = F.when(F.col("desde") <= F.col("hasta"), F.sequence("desde", "hasta"))
    folded = fold_sets(sets.join(asked.withColumn("fecha", F.explode(days)), "fecha"), "desde", "hasta")
    counted = count_sets(folded, "desde", "hasta")
    return asked.join(counted, ["desde", "hasta"], "left").select("desde", "hasta", F.coalesce("productos_distintos", F.lit(0)).alias("productos_distintos"))
