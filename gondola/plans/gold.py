"""Silver facts -> the four Gold tables, in full or for some dates only."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.operators.aggregates import (
    PRODUCT_PROVINCE_KEYS,
    STORE_KEYS,
    daily_product_prices,
    label_candidates,
    price_partials,
    province_product_prices,
    store_stats,
)
from gondola.operators.distinct_sets import id_sets, number_ids
from gondola.operators.index import chained_index, daily_relatives, inflation_index, stale_after
from gondola.operators.lake_state import missing_dates
from gondola.schemas import DAILY_PRODUCT_PRICES, PRODUCT_NUMBERS
from gondola.settings import Settings
from gondola.sources.catalogue import available_dates
from gondola.sources.lake import Lake, load_gold, published_dates, read_silver
from gondola.sources.published import Draft, Published, sweep


class NoSilverData(ValueError):
    """There is nothing to aggregate."""


def gold_tables(silver: DataFrame, settings: Settings = Settings()) -> dict[str, DataFrame]:
    """All four tables as lazy frames, without a lake."""
    products = daily_product_prices(price_partials(silver, PRODUCT_PROVINCE_KEYS))
    return {
        "daily_product_prices": products,
        "store_stats": store_stats(price_partials(silver, STORE_KEYS)),
        "province_product_prices": province_product_prices(
            price_partials(silver, PRODUCT_PROVINCE_KEYS)
        ),
        "daily_inflation_index": inflation_index(products, settings),
    }


def refresh_gold(
    spark: SparkSession,
    lake: Lake,
    tipo: str,
    dates: Sequence[dt.date] | None = None,
    settings: Settings = Settings(),
) -> dict[str, DataFrame]:
    """Rebuild Gold; with ``dates`` only those partitions are recomputed, and removed where Silver
    has them no more.

    All tables change at once, when the last of them is written; a run that fails before leaves the
    old ones. Silver is scanned once per grain. The product and province tables share one stored
    table of partials, far smaller than the facts. Of the index only the refreshed dates and
    the date after each are computed, and chained with the stored rows of the others.
    """
    held = Published(spark, lake.silver_root(tipo)).dates("precios")
    whole = dates is None
    asked = held if whole else sorted({as_date(d) for d in dates})
    days = [d for d in asked if d in set(held)]
    if not days:
        raise NoSilverData(f"no Silver rows for {tipo} under {lake.silver(tipo)}")
    draft = Draft(spark, lake.gold_root(tipo))
    try:
        _put_tables(draft, read_silver(spark, lake, tipo, days), asked, days, whole, settings)
        draft.publish()
    except BaseException:
        draft.discard()
        raise
    sweep(spark, lake.gold_root(tipo))
    return load_gold(spark, lake, tipo)


def _put_tables(draft: Draft, silver: DataFrame, asked: list[dt.date], days: list[dt.date], whole: bool, settings: Settings) -> None:
    lost = sorted(set(asked) - set(days))

    def put(name: str, table: DataFrame, *order: str, all_dates: bool = whole) -> None:
        draft.drop_dates(name, lost)
        draft.put_dates(name, table, order, all_dates)

    partials = price_partials(silver, PRODUCT_PROVINCE_KEYS)
    put("price_partials", partials)
    partials = draft.read("price_partials", partials.schema, days)
    put("daily_product_prices", daily_product_prices(partials), "descripcion_producto")
    put("province_product_prices", province_product_prices(partials), "provincia")
    put("store_stats", store_stats(price_partials(silver, STORE_KEYS)), "precio_promedio_general")

    loaded = draft.dates("daily_product_prices")
    if whole or not draft.has("daily_relatives"):
        stale, read, all_dates = loaded, loaded, True
    else:
        # The refreshed dates and their successors, from their own partitions and those before.
        (stale, read), all_dates = stale_after(loaded, asked), False
    relatives = daily_relatives(draft.read("daily_product_prices", DAILY_PRODUCT_PRICES, read), settings)
    put("daily_relatives", relatives.where(F.col("fecha").isin(stale)), all_dates=all_dates)
    _put_labels(draft, days, asked, whole, put)
    _put_sets(draft, days, whole, put)

    # One row per date from here on.
    index = chained_index(draft.read("daily_relatives", relatives.schema))
    draft.put("daily_inflation_index", index.coalesce(1).sortWithinPartitions("fecha"))


def _put_labels(draft: Draft, days: list[dt.date], asked: list[dt.date], whole: bool, put: Callable[..., None]) -> None:
    """Labels of each date, of each month, of all: what a date no longer has goes when its month is
    folded anew, and a refresh reads the dates of the months it touches and a row for each product
    and month of the rest."""
    best = label_candidates(draft.read("daily_product_prices", DAILY_PRODUCT_PRICES, days), "fecha")
    first = not draft.has("label_partials")
    if first and not whole:
        best = label_candidates(draft.read("daily_product_prices", DAILY_PRODUCT_PRICES), "fecha")
    put("label_partials", best, all_dates=whole or first)
    months = sorted({d.replace(day=1) for d in (draft.dates("label_partials") if whole or first else asked)})
    touched = [d for d in draft.dates("label_partials") if d.replace(day=1) in set(months)]
    parts = draft.read("label_partials", best.schema, touched)
    draft.drop_dates("label_months", months)
    draft.put_dates("label_months", label_candidates(parts, F.trunc("fecha", "month").alias("fecha")), whole=whole or first)
    draft.put("product_labels", label_candidates(draft.read("label_months", best.schema)))


def _put_sets(draft: Draft, days: list[dt.date], whole: bool, put: Callable[..., None]) -> None:
    """Each date's products as bitmaps, over numbers that ids keep until all is built anew."""
    every = whole or not draft.has("product_numbers")
    products = draft.read("daily_product_prices", DAILY_PRODUCT_PRICES, None if every else days)
    if every:
        draft.put("product_numbers", number_ids(products))
    else:
        known = draft.read("product_numbers", PRODUCT_NUMBERS)
        draft.put("product_numbers", known.unionByName(number_ids(products, known)))
    put("product_sets", id_sets(products, draft.read("product_numbers", PRODUCT_NUMBERS)), all_dates=every)


def as_date(day: dt.date | str) -> dt.date:
    return day if isinstance(day, dt.date) else dt.date.fromisoformat(str(day)[:10])


def catch_up_plan(
    spark: SparkSession,
    lake: Lake,
    tipo: str,
    resources: DataFrame,
) -> DataFrame:
    """Dates the publisher still offers and Silver lacks, oldest first."""
    offered = available_dates(resources).where(F.col("tipo") == tipo)
    present = published_dates(spark, lake.silver_root(tipo), "precios").withColumn("tipo", F.lit(tipo))
    return missing_dates(offered, present)
