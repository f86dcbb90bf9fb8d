"""Daily price index: the plain average, and a chain of matched-product price relatives."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gondola.operators.ranks import quantile, ranked_values, trimmed_mean
from gondola.settings import Settings

# A relative within these bounds counts as an unchanged price.
UNCHANGED = (0.999, 1.001)


def _product_days(products: DataFrame) -> DataFrame:
    """One row per (fecha, id_producto), the grain both index series start from."""
    return (
        products.where(F.col("fecha").isNotNull())
        .groupBy("fecha", "id_producto")
        .agg(
            F.sum(F.col("precio_promedio") * F.col("cantidad_muestras")).alias("_total"),
            F.sum("cantidad_muestras").alias("muestras"),
            # The relatives use the plain mean of a product's rows, weights ignored.
            F.avg("precio_promedio").alias("precio"),
        )
    )


def _daily_totals(product_days: DataFrame) -> DataFrame:
    return product_days.groupBy("fecha").agg(
        F.sum("muestras").alias("muestras"),
        F.count("id_producto").alias("productos_distintos"),
        F.try_divide(F.sum("_total"), F.sum("muestras")).alias("indice_precio_global"),
    )


def global_index(products: DataFrame) -> DataFrame:
    """Per date: samples, distinct products and their sample-weighted average price."""
    return _daily_totals(_product_days(products))


def previous_dates(dates: DataFrame) -> DataFrame:
    """Each loaded date with the loaded date before it (not calendar yesterday)."""
    days = dates.select("fecha").distinct()
    # One row per date: bounded by the calendar, so one partition is fine.
    return days.withColumn("fecha_previa", F.lag("fecha").over(Window.orderBy("fecha")))


def _pairs(product_days: DataFrame, dates: DataFrame) -> DataFrame:
    calendar = F.broadcast(previous_dates(dates))
    of_product = Window.partitionBy("id_producto").orderBy("fecha")
    return (
        product_days.where(F.col("id_producto").isNotNull() & F.col("precio").isNotNull())
        .join(calendar, "fecha")
        .select(
            "fecha",
            "fecha_previa",
            "id_producto",
            F.lag("fecha").over(of_product).alias("_seen"),
            F.lag("precio").over(of_product).alias("precio_previo"),
            F.col("precio").alias("precio_actual"),
        )
        # Seen last on the previous loaded date, or it is no match.
        .where((F.col("_seen") == F.col("fecha_previa")) & (F.col("precio_previo") > 0))
        .drop("_seen")
        .withColumn("relativo", F.col("precio_actual") / F.col("precio_previo"))
    )


def matched_pairs(products: DataFrame) -> DataFrame:
    """Products present on a date and on the previous loaded date, with their relative."""
    days = _product_days(products)
    return _pairs(days, days)


def relatives_summary(pairs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per date: trimmed mean, mean, median and repriced share of the relatives.

    The trimmed mean keeps relatives within the [trim, 1 - trim] quantiles, both inclusive;
    below ``min_trim_samples`` it is the plain mean.
    """
    relative, times = F.col("relativo"), F.col("veces")
    mean = F.sum(relative * times) / F.sum(times)
    trimmed = trimmed_mean("relativo", settings.trim, 1 - settings.trim)
    repriced = F.sum(F.when(~relative.between(*UNCHANGED), times).otherwise(0))
    return (
        ranked_values(pairs, "relativo")
        .groupBy("fecha")
        .agg(
            F.when(F.sum(times) < settings.min_trim_samples, mean)
            .otherwise(trimmed)
            .alias("relativo_recortado"),
            mean.alias("relativo_medio"),
            quantile("relativo", 0.5).alias("relativo_mediano"),
            F.sum(times).alias("productos_comparables"),
            (repriced / F.sum(times) * 100).alias("pct_productos_con_cambio"),
        )
    )


def trimmed_relatives(products: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return relatives_summary(matched_pairs(products), settings)


def daily_relatives(products: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """What the index needs of each date, one row per date: totals, and relatives to the date
    before it among those of ``products``. A stored table of these makes the index incremental."""
    days = _product_days(products)
    return _daily_totals(days).join(relatives_summary(_pairs(days, days), settings), "fecha", "left")


def stale_after(loaded: list, refreshed: list) -> tuple[list, list]:
    """Dates whose row of :func:`daily_relatives` a refresh changes (the refreshed ones and the
    date loaded after each), and the dates to read for them (those and the one before each)."""
    loaded = sorted(loaded)
    after = dict(zip(loaded, loaded[1:]))
    changed = set(refreshed) & set(loaded)
    # A refreshed date may be gone; its successor then follows the date before it.
    following = {min((d for d in loaded if d > gone), default=None) for gone in refreshed}
    stale = (changed | {after.get(d) for d in changed} | following) - {None}
    before = dict(zip(loaded[1:], loaded))
    return sorted(stale), sorted((stale | {before.get(d) for d in stale}) - {None})


def inflation_index(products: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The full index table, one row per loaded date."""
    return chained_index(daily_relatives(products, settings))


def chained_index(daily: DataFrame) -> DataFrame:
    """The index over all rows of :func:`daily_relatives`.

    A date without matched products (the first one, for a start) repeats the chained level.
    """

    def or_default(name: str, default: float):
        return F.coalesce(F.col(name), F.lit(default))

    daily = daily.withColumns(
        {
            "_relative": or_default("relativo_recortado", 1.0),
            "productos_comparables": or_default("productos_comparables", 0),
            "pct_productos_con_cambio": or_default("pct_productos_con_cambio", 0.0),
        }
    )
    # One row per date from here on, so the unpartitioned windows stay small.
    by_date = Window.orderBy("fecha")
    so_far = by_date.rowsBetween(Window.unboundedPreceding, 0)
    average = F.col("indice_precio_global")
    first = F.first_value(average).over(so_far)
    return daily.select(
        "fecha",
        "muestras",
        "productos_distintos",
        "indice_precio_global",
        ((F.col("_relative") - 1) * 100).alias("variacion_matched_pct"),
        ((or_default("relativo_mediano", 1.0) - 1) * 100).alias("variacion_mediana_pct"),
        ((or_default("relativo_medio", 1.0) - 1) * 100).alias("variacion_media_pct"),
        F.col("productos_comparables").cast("long"),
        "pct_productos_con_cambio",
        (F.product("_relative").over(so_far) * 100).alias("indice_matched_base100"),
        F.when(first == 0, 0.0)
        .otherwise(F.try_divide(average, first) * 100)
        .alias("indice_global_base100"),
        ((F.try_divide(average, F.lag(average).over(by_date)) - 1) * 100).alias(
            "variacion_diaria_pct"
        ),
    )


def index_moves(index: DataFrame) -> DataFrame:
    """Change per date without the first date, with its sign class (zero counts as down)."""
    by_date = Window.orderBy("fecha")
    moved = index.where(F.col("variacion_matched_pct").isNotNull())
    return moved.select(
        "fecha",
        "variacion_matched_pct",
        F.when(F.col("variacion_matched_pct") > 0, "sube").otherwise("baja").alias("sentido"),
        F.row_number().over(by_date).alias("_n"),
    ).where(F.col("_n") > 1).drop("_n")


def repricing_activity(index: DataFrame) -> DataFrame:
    """Repriced share of the dates that have matched products."""
    return index.where(F.col("productos_comparables") > 0).select(
        "fecha", "pct_productos_con_cambio", "productos_comparables"
    )


# Display names of the two series.
SERIES_LABELS = {
    "indice_matched_base100": "Productos comparables",
    "indice_global_base100": "Promedio simple",
}


def index_long(index: DataFrame, columns: tuple[str, ...] = tuple(SERIES_LABELS)) -> DataFrame:
    """The index series as (fecha, serie, valor) rows; unnamed series keep their column name."""
    present = [c for c in columns if c in index.columns]
    labels = F.create_map(*[F.lit(t) for pair in SERIES_LABELS.items() for t in pair])
    return index.unpivot("fecha", present, "serie", "valor").withColumn(
        "serie", F.coalesce(F.try_element_at(labels, F.col("serie")), F.col("serie"))
    )
