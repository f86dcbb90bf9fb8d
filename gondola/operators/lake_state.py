"""Which dates the lake holds, lacks, may fetch or may retire."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gondola.functions.dates import as_day, weekday_slug
from gondola.settings import Settings

Day = Column | dt.date | str


def partition_inventory(table: DataFrame) -> DataFrame:
    """Dates of a partitioned table, ascending. Reads partition names only."""
    return table.select("fecha").where(F.col("fecha").isNotNull()).distinct().orderBy("fecha")


def coverage_calendar(dates: DataFrame, start: Day, end: Day) -> DataFrame:
    """One row per calendar day from start to end with a ``presente`` flag."""
    present = dates.select("fecha").distinct().withColumn("_seen", F.lit(True))
    return (
        _daily_sequence(dates, start, end)
        .join(present, "fecha", "left")
        .select("fecha", F.coalesce("_seen", F.lit(False)).alias("presente"))
        .orderBy("fecha")
    )


def coverage_gaps(dates: DataFrame, start: Day | None = None, end: Day | None = None) -> DataFrame:
    """Runs of missing days of every tipo: (tipo, desde, hasta, dias), in order.

    Looked for from ``start`` to ``end``, which default to a tipo's own first and last date. A tipo
    without a date in that range is missing as a whole if both ends are given. Null dates don't
    count. A run is what lies between two dates that follow each other, so that no calendar is laid
    out: long gaps cost no more than short ones, and each tipo is a window of its own.
    """
    held = dates.where(F.col("tipo").isNotNull()).select("tipo", F.col("fecha").cast("date").alias("fecha")).distinct()
    first = F.min("fecha") if start is None else F.max(as_day(start))
    last = F.max("fecha") if end is None else F.max(as_day(end))
    ends = held.groupBy("tipo").agg(first.alias("_first"), last.alias("_last"))
    # The day before the range and the day behind it close the outer gaps.
    edges = ends.select("tipo", F.explode(F.array(F.date_sub("_first", 1), F.date_add("_last", 1))).alias("fecha"))
    inside = held.join(ends, "tipo").where(F.col("fecha").between(F.col("_first"), F.col("_last")))
    marks = inside.select("tipo", "fecha").unionByName(edges.where(F.col("fecha").isNotNull()))
    before = F.lag("fecha").over(Window.partitionBy("tipo").orderBy("fecha"))
    days = F.datediff("fecha", "_before") - 1
    return (
        marks.withColumn("_before", before)
        .where(days > 0)
        .select("tipo", F.date_add("_before", 1).alias("desde"), F.date_sub("fecha", 1).alias("hasta"), days.alias("dias"))
        .orderBy("tipo", "desde")
    )


def coverage_counts(dates: DataFrame) -> DataFrame:
    """Per tipo: its first and last date, days held, days missing between them, and in how many
    gaps, of which the longest: (tipo, desde, hasta, presentes, faltantes, huecos, hueco_mayor)."""
    held = dates.where(F.col("tipo").isNotNull() & F.col("fecha").isNotNull()).select("tipo", "fecha").distinct()
    window = held.groupBy("tipo").agg(F.min("fecha").alias("desde"), F.max("fecha").alias("hasta"), F.count("fecha").alias("presentes"))
    gaps = coverage_gaps(held).groupBy("tipo").agg(F.count("*").alias("huecos"), F.max("dias").alias("hueco_mayor"))
    none = F.lit(0)
    return (
        window.join(gaps, "tipo", "left")
        .select(
            "tipo",
            "desde",
            "hasta",
            "presentes",
            (F.datediff("hasta", "desde") + 1 - F.col("presentes")).alias("faltantes"),
            F.coalesce("huecos", none).alias("huecos"),
            F.coalesce("hueco_mayor", none).alias("hueco_mayor"),
        )
        .orderBy("tipo")
    )


def _daily_sequence(df: DataFrame, start: Day, end: Day) -> DataFrame:
    first, last = as_day(start), as_day(end)
    # An end before the start gives no days rather than a descending sequence.
    days = F.when(first <= last, F.sequence(first, last, F.expr("interval 1 day")))
    return df.sparkSession.range(1).select(F.explode(days).alias("fecha"))


def missing_dates(
    published: DataFrame, present: DataFrame, newest: int | None = None
) -> DataFrame:
    """Published dates absent from the lake, oldest first.

    ``newest`` looks at the newest published dates only (of each ``tipo`` if there is one);
    0 or None looks at all.
    """
    keys = [c for c in ("tipo", "fecha") if c in published.columns]
    offered = published.where(F.col("fecha").isNotNull()).select(*keys).distinct()
    if newest:
        offered = _newest(offered, newest)
    return offered.join(present.select(*keys).distinct(), keys, "left_anti").orderBy(
        *reversed(keys)
    )


def _newest(dates: DataFrame, count: int, keep_older: bool = False) -> DataFrame:
    """The newest dates of each tipo, or all but those. One row per tipo and date comes in."""
    by = ["tipo"] if "tipo" in dates.columns else []
    age = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("fecha")))
    ranked = dates.withColumn("_age", age)
    wanted = F.col("_age") > count if keep_older else F.col("_age") <= count
    return ranked.where(wanted).drop("_age")


def backfill_plan(archived: DataFrame, start: Day, end: Day, overwrite: bool = False) -> DataFrame:
    """Days of a range to fetch; days already archived are skipped unless overwriting."""
    days = _daily_sequence(archived, start, end)
    if not overwrite:
        days = days.join(archived.select("fecha").distinct(), "fecha", "left_anti")
    return days.orderBy("fecha")


def retention_plan(archived: DataFrame, keep_days: int) -> DataFrame:
    """(tipo, fecha) of raw archives older than the newest ``keep_days``; 0 keeps all."""
    dates = archived.select("tipo", "fecha").distinct()
    if keep_days <= 0:
        return dates.where(F.lit(False))
    return _newest(dates, keep_days, keep_older=True).orderBy("tipo", "fecha")


def resolve_dates(
    requests: DataFrame,
    resources: DataFrame,
    today: Day,
    strict: bool = True,
    retention_days: int = Settings.retention_days,
) -> DataFrame:
    """Requested (tipo, fecha) -> the weekday slot that serves it, with a ``estado``.

    ``ok``; ``sin_recursos`` (the dataset has no slot at all); ``sin_slot`` (none for that
    weekday); ``fuera_de_retencion``; ``desactualizado`` (strict) or ``aceptado`` (lenient)
    when the slot holds another date. Only accepted rows carry a url.
    """
    slots = resources.groupBy("tipo", "slug").agg(
        # The first listed resource of a slot serves it.
        F.min_by(F.struct("url", F.to_date("last_modified").alias("publicado")), "posicion").alias(
            "_slot"
        )
    )
    # At most seven slots per tipo: the pre-aggregated lists stay tiny.
    listed = slots.groupBy("tipo").agg(F.count("*").alias("_slots"))
    published = F.col("_slot.publicado")
    status = (
        F.when(F.col("_slots").isNull(), "sin_recursos")
        .when(F.col("_slot").isNull(), "sin_slot")
        .when(published == F.col("fecha"), "ok")
        .when(F.col("fecha") < F.date_sub(as_day(today), retention_days), "fuera_de_retencion")
        .otherwise("desactualizado" if strict else "aceptado")
    )
    return (
        requests.select("tipo", "fecha", weekday_slug(F.col("fecha")).alias("slug"))
        .join(listed, "tipo", "left")
        .join(slots, ["tipo", "slug"], "left")
        .select("tipo", "fecha", "slug", published.alias("publicado"), status.alias("estado"), "_slot")
        .select(
            "tipo",
            "fecha",
            "slug",
            "publicado",
            "estado",
            F.when(F.col("estado").isin("ok", "aceptado"), F.col("_slot.url")).alias("url"),
        )
    )


def run_outcomes(outcomes: DataFrame) -> DataFrame:
    """Per tipo: dates asked for, done and failed, and whether the run went well.

    ``outcomes`` has one row per attempt (tipo, fecha, error); a row without a date reports an
    error of the run itself, one without date and error a run with nothing to do. Where a column
    ``paso`` tells the steps apart, dates count for the Silver step only.
    """
    failed = F.col("error").isNotNull()
    dated = F.col("fecha").isNotNull()
    if "paso" in outcomes.columns:
        dated &= F.col("paso") == "silver"
    return outcomes.groupBy("tipo").agg(
        F.count_if(dated).alias("total"),
        F.count_if(dated & ~failed).alias("exitosas"),
        F.count_if(dated & failed).alias("fallidas"),
        F.bool_and(~failed).alias("ok"),
    )


def failed_dates(outcomes: DataFrame) -> DataFrame:
    """The failed dates themselves, as rows rather than one list per tipo."""
    return outcomes.where(F.col("error").isNotNull() & F.col("fecha").isNotNull()).select(
        "tipo", "fecha", "error"
    )
