"""The daily job: bring Silver up to date with the raw archives, refresh Gold, retire raw."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from gondola.operators.lake_state import missing_dates, retention_plan
from gondola.plans.gold import refresh_gold
from gondola.plans.silver import publish_silver
from gondola.settings import TIPOS, Settings
from gondola.sources.archive import archive_status, read_entries
from gondola.sources.lake import Lake, drop_dates, published_dates, stored_dates

#: ``paso`` is what an outcome belongs to: one date's ``silver``, the whole ``gold`` of a tipo, a
#: ``retirada`` raw date, or the ``corrida`` itself.
OUTCOME = "tipo string, paso string, fecha date, error string"


def pending_dates(spark: SparkSession, lake: Lake, tipo: str) -> DataFrame:
    """All archived dates that Silver lacks, oldest first."""
    archived = stored_dates(spark, lake.bronze(tipo))
    return missing_dates(archived, published_dates(spark, lake.silver_root(tipo), "precios"))


def refused_dates(
    spark: SparkSession, lake: Lake, tipo: str, dates: list[dt.date], strict: bool = True
) -> dict[dt.date, str]:
    """Dates with a raw file that can't be taken for theirs, and why."""
    if not dates:
        return {}
    entries = read_entries(spark, lake.bronze(tipo), dates=",".join(map(str, dates)))
    bad = archive_status(entries, strict).where(~F.col("aceptado"))
    states = bad.groupBy("fecha").agg(F.min("estado").alias("estado")).collect()  # a row per date
    return {row.fecha: f"archive: {row.estado}" for row in states}


def outdated_dates(spark: SparkSession, lake: Lake, tipo: str) -> list[dt.date]:
    """Silver dates that Gold lacks: those of a refresh that failed, for one."""
    silver = published_dates(spark, lake.silver_root(tipo), "precios")
    gold = published_dates(spark, lake.gold_root(tipo), "daily_product_prices")
    return [row.fecha for row in missing_dates(silver, gold).collect()]


def prune_raw(
    spark: SparkSession, lake: Lake, tipo: str, settings: Settings = Settings()
) -> list:
    """Delete raw archives beyond the newest ``raw_keep_days``, of dates that Silver holds; Silver
    is never pruned."""
    archived = stored_dates(spark, lake.bronze(tipo)).withColumn("tipo", F.lit(tipo))
    held = published_dates(spark, lake.silver_root(tipo), "precios")
    stale = retention_plan(archived, settings.raw_keep_days).join(held, "fecha", "left_semi")
    return drop_dates(spark, lake.bronze(tipo), [row.fecha for row in stale.collect()])


def run_daily(
    spark: SparkSession,
    lake: Lake,
    tipos: Iterable[str] = TIPOS,
    settings: Settings = Settings(),
    prune: bool = False,
    strict: bool = True,
) -> DataFrame:
    """Ingest what is pending for each tipo; returns outcome rows (tipo, paso, fecha, error).

    A failed date, step or tipo does not stop the others, and what was done before stays
    reported. Gold takes the fresh dates and whatever it lacks of Silver, so that a refresh that
    failed is made up for by the next run. A tipo with nothing to do gives one row without a date.
    With ``strict`` a raw file dated otherwise than its folder is refused.
    """
    outcomes: list[Row] = []

    def tell(tipo: str, step: str, fecha: dt.date | None = None, error: object = None) -> None:
        outcomes.append(Row(tipo=tipo, paso=step, fecha=fecha, error=None if error is None else str(error)))

    for tipo in tipos:
        before = len(outcomes)
        fresh: list[dt.date] = []
        try:
            dates = [row.fecha for row in pending_dates(spark, lake, tipo).collect()]
            refused = refused_dates(spark, lake, tipo, dates, strict)
            for fecha, reason in sorted(refused.items()):
                tell(tipo, "silver", fecha, reason)
            dates = [d for d in dates if d not in refused]
            for o in publish_silver(spark, lake, tipo, dates, settings) if dates else []:
                tell(tipo, "silver", o.fecha, o.error)
                fresh += [o.fecha] if o.error is None else []
        except Exception as error:  # noqa: BLE001 - reported per tipo
            tell(tipo, "corrida", None, error)
        try:
            due = sorted({*fresh, *outdated_dates(spark, lake, tipo)})
            if due:
                refresh_gold(spark, lake, tipo, due, settings)
                tell(tipo, "gold")
        except Exception as error:  # noqa: BLE001
            tell(tipo, "gold", None, error)
        try:
            for fecha in prune_raw(spark, lake, tipo, settings) if prune else []:
                tell(tipo, "retirada", fecha)
        except Exception as error:  # noqa: BLE001
            tell(tipo, "retirada", None, error)
        if len(outcomes) == before:
            tell(tipo, "corrida")
    return spark.createDataFrame(outcomes, OUTCOME)
