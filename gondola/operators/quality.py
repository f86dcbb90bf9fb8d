"""The Silver contract and the metrics of a run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.settings import Settings


def _contract(settings: Settings) -> list[tuple[str, str, Column]]:
    """(column, rule, is violated) of every rule."""
    price = F.col("precio_lista")
    nulls = ("id_producto", "id_comercio", "id_sucursal", "precio_lista")
    return [
        *[(c, "not_nullable", F.col(c).isNull()) for c in nulls],
        ("precio_lista", "min_price", F.coalesce(price < settings.min_price, F.lit(False))),
        ("precio_lista", "max_price", F.coalesce(price > settings.max_price, F.lit(False))),
    ]


def failure_count(settings: Settings = Settings()) -> Column:
    """Number of rules a row violates."""
    return sum(
        (bad.cast("int") for _, _, bad in _contract(settings)), start=F.lit(0)
    ).cast("long")


def contract_failures(
    df: DataFrame, settings: Settings = Settings(), keep: Sequence[str] = ()
) -> DataFrame:
    """One row per violated rule and row: the kept columns, ``columna``, ``regla``, ``valor``."""
    cases = F.array(
        *[
            F.when(
                bad,
                F.struct(
                    F.lit(column).alias("columna"),
                    F.lit(rule).alias("regla"),
                    F.col(column).cast("string").alias("valor"),
                ),
            )
            for column, rule, bad in _contract(settings)
        ]
    )
    # Exploding with nulls and filtering after keeps the optimizer from testing the whole
    # array once more below the cleaning steps.
    exploded = df.select(*keep, F.explode_outer(F.array_compact(cases)).alias("_case"))
    return exploded.where(F.col("_case").isNotNull()).select(*keep, "_case.*")


def quality_report(
    prepared: DataFrame,
    retailers: DataFrame,
    is_written: Column,
    failures: Column,
    retailer: str = "archivo",
) -> DataFrame:
    """Run metrics per (tipo, fecha).

    ``prepared`` holds every record read (footers removed), ``is_written`` tells which are
    kept and ``failures`` how many rules a kept record violates. ``retailers`` holds the
    readable archives (tipo, fecha, retailer), including those without records.
    """
    keys = ["tipo", "fecha"]
    flagged = prepared.select(
        *keys, retailer, is_written.alias("_written"), failures.alias("_failures")
    )
    # Per retailer first: its count of distinct values is then a plain count.
    per_retailer = flagged.groupBy(*keys, retailer).agg(
        F.count("*").alias("_read"),
        F.count_if("_written").alias("_kept"),
        F.sum(F.when(F.col("_written"), F.col("_failures"))).alias("_failed"),
    )
    listed = retailers.select(*keys, retailer).distinct()
    per_date = (
        listed.join(per_retailer, [*keys, retailer], "full")
        .groupBy(*keys)
        .agg(
            F.coalesce(F.sum("_read"), F.lit(0)).alias("rows_read"),
            F.coalesce(F.sum("_kept"), F.lit(0)).alias("rows_written"),
            F.coalesce(F.sum("_failed"), F.lit(0)).alias("validation_failures"),
            F.count_if(F.col("_kept") > 0).alias("retailers"),
            F.count_if(F.coalesce(F.col("_kept"), F.lit(0)) == 0).alias("retailers_empty"),
        )
    )
    return finished_report(per_date)


def finished_report(per_date: DataFrame) -> DataFrame:
    """The report's columns from what was counted per (tipo, fecha)."""
    completeness = F.lit(100.0) * F.col("rows_written") / F.greatest("rows_read", F.lit(1))
    return per_date.select(
        F.date_format("fecha", "yyyy-MM-dd").alias("date"),
        "tipo",
        "rows_read",
        "rows_written",
        (F.col("rows_read") - F.col("rows_written")).alias("rows_dropped"),
        "validation_failures",
        "retailers",
        "retailers_empty",
        F.bround(completeness, 2).alias("completeness_pct"),
    )
