"""Raw archives -> cleaned, enriched, checked price facts, one partition per date."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from gondola.operators.cleaning import (
    clean_strings,
    conform_silver,
    in_category,
    parse_prices,
    price_in_band,
    resolve_layout,
    strip_footer,
    trim_keys,
)
from gondola.operators.enrich import (
    decode_province,
    enrich_chains,
    enrich_stores,
    prepare_dimension,
)
from gondola.operators.quality import failure_count, finished_report
from gondola.schemas import ARCHIVE_ROWS
from gondola.settings import CHAIN_COLUMNS, PRODUCT_COLUMNS, STORE_COLUMNS, Settings
from gondola.sources.archive import read_archives
from gondola.sources.files import delete_folder
from gondola.sources.lake import Lake, write_quality
from gondola.sources.published import Draft, sweep

# Dimensions belong to the archive they came in.
ARCHIVE_KEYS = ("tipo", "fecha", "archivo")
#: Dates that are staged, counted and published together.
BATCH = 31


class NoRows(ValueError):
    """A date gave no usable rows."""


class ValidationFailed(ValueError):
    """A date violates the Silver contract."""


def member(raw: DataFrame, kind: str) -> DataFrame:
    return raw.where(F.col("miembro") == kind).drop("miembro")


def prepared_products(raw: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Every product record read, cleaned; ``_kept`` marks those that go on."""
    records = resolve_layout(member(raw, "productos"), PRODUCT_COLUMNS)
    cleaned = clean_strings(parse_prices(trim_keys(strip_footer(records))))
    kept = price_in_band(F.col("precio_lista"), settings)
    if settings.category_filter:
        kept &= in_category(cleaned, settings.food_keywords)
    return cleaned.withColumn("_kept", F.coalesce(kept, F.lit(False)))


def silver_facts(raw: DataFrame, products: DataFrame) -> DataFrame:
    """Kept products with store, chain and province, in the Silver layout."""
    stores = prepare_dimension(resolve_layout(member(raw, "sucursales"), STORE_COLUMNS), ARCHIVE_KEYS)
    chains = prepare_dimension(resolve_layout(member(raw, "comercio"), CHAIN_COLUMNS), ARCHIVE_KEYS)
    facts = products.where("_kept").drop("_kept")
    facts = enrich_stores(facts, stores.drop("linea"), ARCHIVE_KEYS)
    facts = enrich_chains(facts, chains.drop("linea"), ARCHIVE_KEYS)
    return conform_silver(decode_province(facts), extra=("tipo", "fecha"))


def observed(products: DataFrame, days: Sequence[str], settings: Settings = Settings()) -> tuple[DataFrame, Observation]:
    """``products`` with what the report needs of each date counted by the tasks that write them:
    records, kept ones, broken rules, and the archives that kept ones came from. A few numbers and
    an archive's name each, for the dates of one batch."""
    watch = Observation()
    kept, archive = F.col("_kept"), F.col("archivo")

    def of(day: str) -> list[Column]:
        here = F.col("fecha") == F.lit(day).cast("date")
        return [
            F.count_if(here).alias(f"read {day}"),
            F.count_if(here & kept).alias(f"kept {day}"),
            F.sum(F.when(here & kept, failure_count(settings))).alias(f"failed {day}"),
            F.collect_set(F.when(here & kept, archive)).alias(f"archives {day}"),
        ]

    return products.observe(watch, *(c for day in days for c in of(day))), watch


def run_report(raw: DataFrame, found: dict, tipo: str, days: Sequence[str]) -> DataFrame:
    """The report from what was observed and from the readable archives, a row each."""
    listed = raw.where(F.col("miembro").isNull()).groupBy("fecha").agg(F.count_distinct("archivo").alias("n"))
    archives = {str(row.fecha): row.n for row in listed.collect()}
    counts = [
        (tipo, dt.date.fromisoformat(d), found[f"read {d}"], found[f"kept {d}"], found[f"failed {d}"] or 0, len(found[f"archives {d}"]), archives.get(d, 0) - len(found[f"archives {d}"]))
        for d in days
        if d in archives or found[f"read {d}"]
    ]
    schema = "tipo string, fecha date, rows_read long, rows_written long, validation_failures long, retailers long, retailers_empty long"
    return finished_report(raw.sparkSession.createDataFrame(counts, schema))


def stage(raw: DataFrame, path: str) -> DataFrame:
    """Write the parsed lines once; report and facts then read columnar files.

    A written table also lets later stages recover from lost executors without parsing the
    archives again.
    """
    raw.write.mode("overwrite").partitionBy("miembro").parquet(path)
    return raw.sparkSession.read.schema(ARCHIVE_ROWS).parquet(path)


def publish_silver(
    spark: SparkSession,
    lake: Lake,
    tipo: str,
    dates: Iterable[dt.date | str],
    settings: Settings = Settings(),
    allow_violations: bool = False,
) -> list[Row]:
    """Build the Silver partitions of some dates; returns one outcome per date.

    The contract is checked before anything is published: a date without rows or with
    violations keeps its old partition and is reported with an ``error``, the others go on.
    Dates are worked on ``BATCH`` at a time; those of a batch are published together.
    """
    days = sorted({str(d)[:10] for d in dates})
    outcomes = []
    for start in range(0, len(days), BATCH):
        batch = days[start : start + BATCH]
        parsed = read_archives(spark, lake.bronze(tipo), dates=",".join(batch))
        # A folder of its own for every run, so that runs never see each other's lines.
        folder = lake.staging(uuid.uuid4().hex)
        try:
            outcomes += _publish(stage(parsed, f"{folder}/lines"), f"{folder}/products", lake, tipo, batch, settings, allow_violations)
        finally:
            delete_folder(spark, folder)
    return outcomes


def _publish(
    staged: DataFrame,
    cleaned: str,
    lake: Lake,
    tipo: str,
    days: list[str],
    settings: Settings,
    allow_violations: bool,
) -> list[Row]:
    # Cleaned, flagged and counted in one pass; the facts read what it wrote.
    products, watch = observed(prepared_products(staged, settings), days, settings)
    products.write.parquet(cleaned)
    products = staged.sparkSession.read.schema(products.schema).parquet(cleaned)
    # One row per date.
    report = {row.date: row for row in run_report(staged, watch.get, tipo, days).collect()}

    def problem(day: str) -> str | None:
        row = report.get(day)
        if row is None or row.rows_written == 0:
            return f"no rows ({row.rows_read if row else 0} read)"
        if row.validation_failures and not allow_violations:
            return f"{row.validation_failures} contract violations"
        return None

    outcomes = [Row(tipo=tipo, fecha=dt.date.fromisoformat(d), error=problem(d)) for d in days]
    good = [o.fecha for o in outcomes if o.error is None]
    if good:
        facts = silver_facts(
            staged.where(F.col("fecha").isin(good)),
            products.where(F.col("fecha").isin(good)),
        )
        draft = Draft(staged.sparkSession, lake.silver_root(tipo))
        try:
            draft.put_dates("precios", facts.drop("tipo"))
            draft.publish()
        except BaseException:
            draft.discard()
            raise
        sweep(staged.sparkSession, lake.silver_root(tipo))
    # Dates without rows have no report.
    rows = [row for row in report.values() if row.rows_written]
    if rows:
        write_quality(staged.sparkSession.createDataFrame(rows), lake, tipo)
    return outcomes


def require_ok(outcomes: Iterable[Row]) -> None:
    """Raise for the first failed date, for callers that want a hard gate."""
    for outcome in outcomes:
        if outcome.error:
            kind = NoRows if outcome.error.startswith("no rows") else ValidationFailed
            raise kind(f"{outcome.tipo} {outcome.fecha}: {outcome.error}")
