"""Exact ranks and quantiles per date, without gathering a date in one task.

Spark's exact ``percentile`` keeps all distinct values of a group in one aggregation buffer.
Here each date is cut into value slices of about equal size, ranks are counted inside the
slices, and the slices' own totals give the offsets. Equal values are counted together first.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICES = 64


def ranked_values(values: DataFrame, value: str, slices: int = SLICES) -> DataFrame:
    """(fecha, value) -> distinct values with their rank range within the date.

    Adds ``veces`` (how often the value occurs), ``desde`` / ``hasta`` (its 0-based ranks,
    end exclusive) and ``total`` (values of the date). Null values are left out.
    """
    # Equal values first: what comes before (windows, joins) is worked out once, as both uses of
    # these counts read the same exchange. The condition keeps the counts in both of them.
    counted = values.where(F.col(value).isNotNull()).groupBy("fecha", value).agg(F.count("*").alias("veces"))
    fractions = F.array(*[F.lit(i / slices) for i in range(1, slices)])
    # The sketch only balances the slices; the ranks do not depend on its accuracy.
    cuts = counted.groupBy("fecha").agg(
        F.percentile_approx(F.when(F.col("veces") > 0, F.col(value)), fractions, slices * 10).alias("_cuts")
    )
    # One row per date: bounded by the calendar.
    counted = counted.join(F.broadcast(cuts), "fecha").select(
        "fecha",
        F.size(F.filter("_cuts", lambda cut: cut < F.col(value))).alias("_slice"),
        value,
        "veces",
    )

    by_date = Window.partitionBy("fecha")
    up_to_slice = by_date.orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0)
    totals = (
        counted.groupBy("fecha", "_slice")
        .agg(F.sum("veces").alias("_size"))
        .select(
            "fecha",
            "_slice",
            (F.sum("_size").over(up_to_slice) - F.col("_size")).alias("_before"),
            F.sum("_size").over(by_date).alias("total"),
        )
    )
    up_to_value = (
        Window.partitionBy("fecha", "_slice")
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    within = counted.withColumn("_upto", F.sum("veces").over(up_to_value))
    # At most ``slices`` rows per date: bounded by the calendar.
    return within.join(F.broadcast(totals), ["fecha", "_slice"]).select(
        "fecha",
        value,
        "veces",
        (F.col("_before") + F.col("_upto") - F.col("veces")).alias("desde"),
        (F.col("_before") + F.col("_upto")).alias("hasta"),
        "total",
    )


def _position(share: float) -> Column:
    """0-based rank of a quantile, fractional between two values."""
    return (F.col("total") - 1) * F.lit(float(share))


def _at(rank: Column, column: str) -> Column:
    """Aggregate: the column of the value that holds a rank."""
    return F.max(F.when((F.col("desde") <= rank) & (rank < F.col("hasta")), F.col(column)))


def quantile(value: str, share: float) -> Column:
    """Aggregate over :func:`ranked_values`: exact quantile with linear interpolation."""
    position = _position(share)
    low, high = _at(F.floor(position), value), _at(F.ceil(position), value)
    part = F.max(position - F.floor(position))
    # From the nearer neighbour, which keeps rounding symmetric.
    return F.when(part < 0.5, low + (high - low) * part).otherwise(
        high - (high - low) * (1 - part)
    )


def trimmed_mean(value: str, low: float, high: float) -> Column:
    """Aggregate over :func:`ranked_values`: mean of the values within two quantiles, inclusive.

    Ranks tell which values lie inside, so no second pass is needed. Only the value just
    outside each quantile is compared with it: where two values are neighbouring floats, the
    interpolated quantile may round onto the outer one, which then counts as inside.
    """
    first, last = _position(low), _position(high)
    inside = (F.col("hasta") > F.ceil(first)) & (F.col("desde") <= F.floor(last))
    total = F.sum(F.when(inside, F.col(value) * F.col("veces")))
    times = F.sum(F.when(inside, F.col("veces")))
    edges = (
        (F.floor(first), F.ceil(first), lambda edge: edge >= quantile(value, low)),
        (F.ceil(last), F.floor(last), lambda edge: edge <= quantile(value, high)),
    )
    for outer, inner, reaches in edges:
        edge = _at(outer, value)
        kept = (edge != _at(inner, value)) & reaches(edge)
        total += F.when(kept, edge * _at(outer, "veces")).otherwise(0)
        times += F.when(kept, _at(outer, "veces")).otherwise(0)
    return total / times


def date_quantiles(values: DataFrame, value: str, shares: Mapping[str, float]) -> DataFrame:
    """One row per date with the named exact quantiles."""
    return (
        ranked_values(values, value)
        .groupBy("fecha")
        .agg(*[quantile(value, share).alias(name) for name, share in shares.items()])
    )
