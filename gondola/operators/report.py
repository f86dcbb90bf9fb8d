"""Headline figures and report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gondola.functions import localised as es
from gondola.functions.numbers import direction


def quality_history(reports: DataFrame) -> DataFrame:
    """Run reports in date order, with ``fecha`` as a date."""
    return reports.withColumn("fecha", F.to_date("date")).orderBy("fecha", "tipo")


def headline_kpis(index: DataFrame, quality: DataFrame) -> DataFrame:
    """The latest date's figures, their change and the latest quality score: one row."""
    # Both inputs have one row per date.
    by_date = Window.orderBy("fecha")
    average = F.col("indice_precio_global")
    previous = F.lag(average).over(by_date)
    change = F.when(previous != 0, (average - previous) / previous * 100)
    latest = (
        index.withColumns(
            {
                "variacion_promedio_pct": change,
                "fecha_previa": F.lag("fecha").over(by_date),
                "dias": F.row_number().over(by_date).cast("long"),
            }
        )
        .orderBy(F.desc("fecha"))
        .limit(1)
    )
    scores = F.struct(
        F.col("completeness_pct").alias("calidad_pct"),
        F.col("validation_failures").alias("fallas_validacion"),
    )
    # A global aggregate: exactly one row, nulls without reports.
    score = quality.agg(F.max_by(scores, "fecha")).scalar()
    matched = F.col("variacion_matched_pct")
    return latest.withColumn("_score", score).select(
        "fecha",
        "fecha_previa",
        "dias",
        "indice_matched_base100",
        "variacion_matched_pct",
        direction(matched).alias("sentido_matched"),
        "indice_precio_global",
        "variacion_promedio_pct",
        direction(F.col("variacion_promedio_pct")).alias("sentido_promedio"),
        "pct_productos_con_cambio",
        "productos_comparables",
        "_score.calidad_pct",
        "_score.fallas_validacion",
    )


def localised_index(index: DataFrame) -> DataFrame:
    """Index table as display texts."""
    return index.select(
        "fecha",
        es.fecha(F.col("fecha")).alias("dia"),
        es.fecha(F.col("fecha"), with_year=False).alias("dia_corto"),
        es.ars(F.col("indice_precio_global")).alias("precio_promedio"),
        es.numero(F.col("indice_matched_base100"), 1).alias("indice"),
        es.pct(F.col("variacion_matched_pct")).alias("variacion"),
        es.pct(F.col("pct_productos_con_cambio"), 1, signed=False).alias("remarcados"),
        es.count(F.col("productos_comparables")).alias("comparables"),
    )


def rounded(df: DataFrame, decimals: int = 2) -> DataFrame:
    """All floating-point columns rounded (halves to even), as for an export."""
    names = [f.name for f in df.schema if f.dataType.typeName() in ("double", "float")]
    unit = 10.0**decimals
    return df.withColumns({n: F.rint(F.col(n) * unit) / unit for n in names})
