"""Shopper questions over the product and province tables: search, movers, savings, baskets.

Each is one aggregation over the rows it needs: filters on dates and hand-picked ids reach
the scan, and two-date comparisons are conditional aggregates instead of self-joins.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gondola.functions.dates import as_day
from gondola.functions.text import contains_ignore_case
from gondola.operators.aggregates import (
    label,
    product_day_weighted,
    product_labels,
    weighted_price,
)
from gondola.settings import PRESET_BASKETS, Settings

Day = Column | dt.date | str

# A wider max/min ratio comes of different units under one id.
MAX_PLAUSIBLE_RATIO = 3.0
# Characters of a label that the charts of savings, movers and chains show.
SAVINGS_CHARS, MOVERS_CHARS, CHAIN_CHARS = 42, 38, 40


def date_range_filter(df: DataFrame, start: Day, end: Day) -> DataFrame:
    """Rows between two dates, both inclusive; series are not rebased."""
    return df.where(F.col("fecha").between(as_day(start), as_day(end)))


def latest_date(df: DataFrame) -> Column:
    """Last date of a table, as a scalar subquery."""
    return df.agg(F.max("fecha")).scalar()


def previous_date(df: DataFrame) -> Column:
    """Last date but one, null when there is none."""
    days = df.select("fecha").distinct().orderBy(F.desc("fecha")).limit(2)
    return days.agg(F.when(F.count("*") == 2, F.min("fecha"))).scalar()


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Non-null distinct values in order, for a list of options."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def province_scoped_products(
    products: DataFrame, provinces: DataFrame, province: str, labels: DataFrame | None = None
) -> DataFrame:
    """One province's prices, labelled from stored ``labels`` or else from the product table;
    unlabelled ids are left out."""
    scoped = provinces.where(F.col("provincia") == province)
    if labels is None:
        labels = product_labels(products).where(F.col("descripcion_producto").isNotNull())
    named = scoped.join(labels.select("id_producto", "descripcion_producto"), "id_producto")
    return named.withColumn("marca", F.lit(None).cast("string"))


# --- search ---------------------------------------------------------------------------


def search_products(products: DataFrame, term: str, brand: str | None = None) -> DataFrame:
    """Rows whose description holds the term, whatever its case; optionally of one brand."""
    if not term:
        return products.where(F.lit(False))
    found = products.where(contains_ignore_case(F.col("descripcion_producto"), term))
    return found.where(F.col("marca") == brand) if brand else found


def search_summary(found: DataFrame) -> DataFrame:
    return found.agg(F.count_distinct("id_producto").alias("productos"))


def search_top(found: DataFrame, top: int = 4) -> DataFrame:
    """All rows of the products with most samples."""
    best = (
        found.where(F.col("id_producto").isNotNull())
        .groupBy("id_producto")
        .agg(F.sum("cantidad_muestras").alias("_samples"))
        .orderBy(F.desc("_samples"), "id_producto")
        .limit(top)
    )
    # ``top`` rows at most.
    return found.join(F.broadcast(best.select("id_producto")), "id_producto", "left_semi")


def search_table(found: DataFrame, rows: int = 300) -> DataFrame:
    """Newest first, cheapest first, cut to the rows shown."""
    order = [F.desc("fecha"), "precio_promedio", "id_producto", "descripcion_producto", "marca"]
    return found.orderBy(*order).limit(rows)


# --- movers and savings -----------------------------------------------------------------


def price_movers(
    products: DataFrame,
    previous: Day | None,
    latest: Day,
    min_samples: int = 2,
    labels: DataFrame | None = None,
) -> DataFrame:
    """Price change per product between two dates, largest rise first.

    With stored ``labels`` (id_producto, descripcion_producto) only the two dates are read;
    without, the descriptions come from all dates of the table.
    """
    if labels is not None:
        days = [as_day(latest)] if previous is None else [as_day(previous), as_day(latest)]
        rows = products.where(F.col("fecha").isin(*days)).withColumn(
            "descripcion_producto", F.lit(None).cast("string")
        )
        movers = price_movers(rows, previous, latest, min_samples).drop("descripcion_producto")
        named = movers.join(labels.select("id_producto", "descripcion_producto"), "id_producto", "left")
        return named.orderBy(F.desc("variacion_pct"), "id_producto")
    before = F.col("fecha") == (as_day(previous) if previous is not None else F.lit(None))
    after = F.col("fecha") == as_day(latest)
    change = (F.col("precio_actual") - F.col("precio_anterior")) / F.col("precio_anterior") * 100
    return (
        products.where(F.col("id_producto").isNotNull())
        .groupBy("id_producto")
        .agg(
            weighted_price(before).alias("precio_anterior"),
            weighted_price(after).alias("precio_actual"),
            F.sum(F.when(after, F.col("cantidad_muestras"))).alias("muestras"),
            label().alias("descripcion_producto"),
        )
        .where(
            F.col("precio_actual").isNotNull()
            & (F.col("precio_anterior") > 0)
            & (F.col("muestras") >= min_samples)
        )
        .withColumn("variacion_pct", change)
        .orderBy(F.desc("variacion_pct"), "id_producto")
    )


def top_movers(movers: DataFrame, top: int = 10) -> DataFrame:
    """The largest rises and the largest falls, told apart by ``sentido``."""
    # One pass for both ends: ranks are limited in each task before anything is shuffled.
    both = movers.withColumn("sentido", F.explode(F.array(F.lit("aumentos"), F.lit("bajas"))))
    rising = F.col("sentido") == "aumentos"
    change = F.when(rising, -F.col("variacion_pct")).otherwise(F.col("variacion_pct"))
    # Equal rises go by id, equal falls by id backwards.
    ties = (F.when(rising, F.col("id_producto")).asc(), F.when(~rising, F.col("id_producto")).desc())
    rank = F.row_number().over(Window.partitionBy("sentido").orderBy(change, *ties))
    return both.withColumn("_rank", rank).where(F.col("_rank") <= top).drop("_rank")


def savings_opportunities(
    products: DataFrame,
    day: Day,
    min_samples: int = 5,
    top: int = 15,
    max_ratio: float = MAX_PLAUSIBLE_RATIO,
) -> DataFrame:
    """Products with the widest plausible spread between stores on one day."""
    low, high = F.col("precio_minimo"), F.col("precio_maximo")
    return (
        products.where(
            (F.col("fecha") == as_day(day))
            & (F.col("cantidad_muestras") >= min_samples)
            & (low > 0)
        )
        .withColumn("ratio", high / low)
        .where(F.col("ratio") <= max_ratio)
        .withColumns({"ahorro_pct": (high - low) / high * 100, "ahorro_abs": high - low})
        .orderBy(F.desc("ahorro_pct"), "id_producto", "descripcion_producto", "marca")
        .limit(top)
    )


# --- baskets ------------------------------------------------------------------------------


def _quantity(quantities: Mapping[str, float] | None) -> Column:
    if not quantities:
        return F.lit(1.0)
    lookup = F.create_map(
        *[F.lit(x) for pair in quantities.items() for x in (str(pair[0]), float(pair[1]))]
    )
    return F.coalesce(F.try_element_at(lookup, F.col("id_producto")), F.lit(1.0))


def _cost(quantities: Mapping[str, float] | None) -> Column:
    return F.sum(F.col("precio_promedio") * _quantity(quantities)).alias("costo_total")


def basket_series(
    products: DataFrame, ids: Sequence[str], quantities: Mapping[str, float] | None = None
) -> DataFrame:
    """Basket cost per date, on dates that have every item. ``ids`` is a hand-picked list."""
    wanted = sorted(set(ids))
    chosen = products.where(F.col("id_producto").isin(wanted))
    return (
        product_day_weighted(chosen)
        .groupBy("fecha")
        .agg(_cost(quantities), F.count("*").alias("items"))
        .where(F.lit(bool(wanted)) & (F.col("items") == len(wanted)))
        .orderBy("fecha")
    )


def basket_by_province(
    province_prices: DataFrame,
    ids: Sequence[str],
    day: Day,
    quantities: Mapping[str, float] | None = None,
    min_coverage: float = 1.0,
) -> DataFrame:
    """Basket cost per province on one day, where enough of the basket is reported."""
    wanted = sorted(set(ids))
    return (
        province_prices.where(
            (F.col("fecha") == as_day(day))
            & F.col("id_producto").isin(wanted)
            & F.col("provincia").isNotNull()
        )
        .groupBy("provincia")
        .agg(_cost(quantities), F.count_distinct("id_producto").alias("items"))
        .withColumn("cobertura", F.col("items") / F.lit(max(len(wanted), 1)))
        .where(F.col("cobertura") >= min_coverage)
        .orderBy("costo_total", "provincia")
    )


def basket_spread(by_province: DataFrame) -> DataFrame:
    """Cheapest and dearest province and the gap between them."""
    order = F.struct("costo_total", "provincia")
    return by_province.agg(
        F.min_by("provincia", order).alias("mas_barata"),
        F.min("costo_total").alias("costo_minimo"),
        F.max_by("provincia", order).alias("mas_cara"),
        F.max("costo_total").alias("costo_maximo"),
    ).where(F.col("mas_barata").isNotNull()).withColumns(
        {
            "diferencia": F.col("costo_maximo") - F.col("costo_minimo"),
            "diferencia_pct": F.try_divide(
                F.col("costo_maximo") - F.col("costo_minimo"), F.col("costo_maximo")
            )
            * 100,
        }
    )


def basket_change(series: DataFrame) -> DataFrame:
    """First and last cost of a basket series and the change between them."""
    ends = series.agg(
        F.min("fecha").alias("desde"),
        F.max("fecha").alias("hasta"),
        F.min_by("costo_total", "fecha").alias("costo_inicial"),
        F.max_by("costo_total", "fecha").alias("costo_final"),
        F.count("*").alias("dias"),
    ).where(F.col("dias") > 0)
    gain = F.col("costo_final") - F.col("costo_inicial")
    return ends.withColumn("variacion_pct", F.try_divide(gain, F.col("costo_inicial")) * 100)


def basket_sheet(
    products: DataFrame,
    ids: Sequence[str],
    day: Day,
    quantities: Mapping[str, float] | None = None,
    labels: DataFrame | None = None,
) -> DataFrame:
    """Label, quantity and unit price of the chosen ids on one day; ids without data stay.

    With stored ``labels`` (id_producto, descripcion_producto) only that day is read.
    """
    wanted = list(dict.fromkeys(ids))
    spark = products.sparkSession
    chosen = spark.createDataFrame(list(enumerate(wanted)), "posicion int, id_producto string")
    rows, on_day = products.where(F.col("id_producto").isin(wanted)), F.col("fecha") == as_day(day)
    if labels is None:
        priced = rows.groupBy("id_producto").agg(
            label().alias("_label"), weighted_price(on_day).alias("precio_unitario")
        )
    else:
        named = labels.where(F.col("id_producto").isin(wanted)).select(
            "id_producto", F.col("descripcion_producto").alias("_label")
        )
        prices = rows.where(on_day).groupBy("id_producto").agg(weighted_price().alias("precio_unitario"))
        priced = named.join(prices, "id_producto", "full")
    return (
        chosen.join(priced, "id_producto", "left")
        .select(
            "posicion",
            "id_producto",
            F.coalesce("_label", "id_producto").alias("producto"),
            _quantity(quantities).alias("cantidad"),
            "precio_unitario",
        )
        .orderBy("posicion")
    )


def resolve_preset(products: DataFrame, terms: Sequence[str], day: Day) -> DataFrame:
    """Search terms -> one product id each, in term order, at most ``len(terms)`` rows.

    Descriptions that start with the term beat those that hold it elsewhere; then most
    samples win. Terms without a match are skipped, an id chosen twice counts once.
    """
    return resolve_presets(products, day, {"": terms}).drop("canasta").orderBy("posicion")


def resolve_presets(
    products: DataFrame, day: Day, presets: Mapping[str, Sequence[str]] = PRESET_BASKETS
) -> DataFrame:
    """The same for several named baskets in one pass: canasta, posicion, termino, id_producto."""
    description = F.coalesce("descripcion_producto", F.lit(""))
    needles = F.array(
        *[
            F.struct(F.lit(name).alias("canasta"), F.lit(i).alias("posicion"), F.lit(term.strip()).alias("termino"))
            for name, terms in presets.items()
            for i, term in enumerate(terms)
        ]
    )
    hits = (
        products.where(F.col("fecha") == as_day(day))
        .select(
            "id_producto",
            "cantidad_muestras",
            description.alias("_text"),
            F.explode(
                F.filter(needles, lambda n: contains_ignore_case(description, n["termino"]))
            ).alias("_hit"),
        )
        .select("_hit.*", "id_producto", "cantidad_muestras", "_text")
    )
    is_prefix = F.startswith(F.upper("_text"), F.upper("termino"))
    # The smallest id among equals makes the choice a total order.
    rank = F.struct((~is_prefix).alias("late"), -F.col("cantidad_muestras"), "id_producto")
    chosen = hits.groupBy("canasta", "posicion", "termino").agg(
        F.min_by("id_producto", rank).alias("id_producto")
    )
    return (
        chosen.groupBy("canasta", "id_producto")
        .agg(
            F.min("posicion").alias("posicion"),
            F.min_by("termino", "posicion").alias("termino"),
        )
        .select("canasta", "posicion", "termino", "id_producto")
        .orderBy("canasta", "posicion")
    )


def preset_ids(resolved: DataFrame) -> list[str]:
    """The chosen ids as a basket list; no longer than the list of terms."""
    return [row.id_producto for row in resolved.orderBy("posicion").collect()]


# --- stores ---------------------------------------------------------------------------------


def cheapest_stores(
    stores: DataFrame, day: Day, min_products: int = Settings.min_store_samples, top: int = 12
) -> DataFrame:
    """Cheapest stores of a day among those that report enough products."""
    return (
        stores.where(
            (F.col("fecha") == as_day(day)) & (F.col("productos_reportados") >= min_products)
        )
        .orderBy("precio_promedio_general", "id_comercio", "nombre_sucursal", "provincia")
        .limit(top)
    )


def clipped(df: DataFrame, column: str, chars: int) -> DataFrame:
    """Adds ``etiqueta``: the column's first ``chars`` characters, as a chart shows them."""
    return df.withColumn("etiqueta", F.substring(column, 1, chars))


def savings_labels(savings: DataFrame) -> DataFrame:
    return clipped(savings, "descripcion_producto", SAVINGS_CHARS)


def movers_labels(movers: DataFrame) -> DataFrame:
    return clipped(movers, "descripcion_producto", MOVERS_CHARS)


def chain_labels(chains: DataFrame) -> DataFrame:
    return clipped(chains, "nombre_comercio", CHAIN_CHARS)


def store_labels(stores: DataFrame, chars: int = 34) -> DataFrame:
    """Adds ``etiqueta``: store and province, a dash where one is missing."""
    name = F.substring(F.coalesce("nombre_sucursal", F.lit("—")), 1, chars)
    province = F.coalesce("provincia", F.lit("—"))
    return stores.withColumn("etiqueta", F.concat_ws("  ·  ", name, province))
