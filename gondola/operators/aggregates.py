"""Price aggregates at product, store and province grain, and their collapses."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRODUCT_KEYS = ("fecha", "id_producto", "descripcion_producto", "marca")
STORE_KEYS = ("fecha", "id_comercio", "nombre_comercio", "nombre_sucursal", "provincia")
PROVINCE_KEYS = ("fecha", "provincia", "id_producto")
# Facts for each partition that partials are folded in: their groups fit some 100 MB.
FACTS_PER_PART = 250_000
# One pre-aggregate serves both product and province tables.
PRODUCT_PROVINCE_KEYS = (*PRODUCT_KEYS, "provincia")


def price_partials(facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Foldable partials of the list price; null keys form a group."""
    price = F.col("precio_lista")
    return facts.groupBy(*keys).agg(
        F.sum(price).alias("suma"),
        F.min(price).alias("minimo"),
        F.max(price).alias("maximo"),
        F.count(price).alias("muestras"),
    )


def merge_partials(
    partials: Sequence[DataFrame], keys: Sequence[str], parts: int | None = None
) -> DataFrame:
    """Fold partials, possibly of a finer grain, into partials of ``keys``.

    Several are folded each on its own, then dealt by key to ``parts`` partitions (by default the
    session's number for shuffles) and folded together. Otherwise a task would hold the groups of
    all of them at once, for as many rows as compress into one partition of adaptive execution.
    """
    if len(partials) > 1:
        dealt = parts or int(partials[0].sparkSession.conf.get("spark.sql.shuffle.partitions"))
        partials = [_at_grain(p, keys).repartition(dealt, *keys) for p in partials]
    return reduce(DataFrame.unionByName, partials).groupBy(*keys).agg(
        F.sum("suma").alias("suma"),
        F.min("minimo").alias("minimo"),
        F.max("maximo").alias("maximo"),
        F.sum("muestras").alias("muestras"),
    )


def finish_partials(partials: DataFrame) -> DataFrame:
    """Averages of the folded sums and counts."""
    average = F.try_divide(F.col("suma"), F.col("muestras"))
    return partials.withColumn("precio_promedio", average).drop("suma")


MEASURES = ("suma", "minimo", "maximo", "muestras")


def _at_grain(partials: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Partials at exactly these keys, folded if they are finer."""
    same = set(partials.columns) == {*keys, *MEASURES}
    return partials if same else merge_partials([partials], keys)


def _priced(partials: DataFrame, keys: Sequence[str]) -> DataFrame:
    return finish_partials(_at_grain(partials, keys)).select(
        *keys,
        F.col("minimo").alias("precio_minimo"),
        F.col("maximo").alias("precio_maximo"),
        F.col("muestras").alias("cantidad_muestras"),
        "precio_promedio",
    )


def daily_product_prices(partials: DataFrame) -> DataFrame:
    """Product table, from partials at its own or a finer grain."""
    return _priced(partials, PRODUCT_KEYS)


def province_product_prices(partials: DataFrame) -> DataFrame:
    """Province table; facts without a province are left out."""
    return _priced(partials.where(F.col("provincia").isNotNull()), PROVINCE_KEYS)


def store_stats(partials: DataFrame) -> DataFrame:
    """Store table: products reported and their average price."""
    return finish_partials(_at_grain(partials, STORE_KEYS)).select(
        *STORE_KEYS,
        F.col("muestras").alias("productos_reportados"),
        F.col("precio_promedio").alias("precio_promedio_general"),
    )


def product_day_mean(products: DataFrame) -> DataFrame:
    """Plain mean of a product's rows per day, weights ignored; null ids dropped."""
    return (
        products.where(F.col("fecha").isNotNull() & F.col("id_producto").isNotNull())
        .groupBy("fecha", "id_producto")
        .agg(F.avg("precio_promedio").alias("precio_promedio"))
    )


def product_day_weighted(products: DataFrame) -> DataFrame:
    """Sample-weighted mean of a product's rows per day; null ids dropped."""
    return (
        products.where(F.col("fecha").isNotNull() & F.col("id_producto").isNotNull())
        .groupBy("fecha", "id_producto")
        .agg(
            F.sum("cantidad_muestras").alias("cantidad_muestras"),
            F.min("precio_minimo").alias("precio_minimo"),
            F.max("precio_maximo").alias("precio_maximo"),
            weighted_price().alias("precio_promedio"),
        )
    )


def weighted_price(when=None):
    """Sample-weighted average price, optionally of the rows meeting a condition only."""
    total = F.col("precio_promedio") * F.col("cantidad_muestras")
    weight = F.col("cantidad_muestras")
    if when is not None:
        total, weight = F.when(when, total), F.when(when, weight)
    return F.try_divide(F.sum(total), F.sum(weight))


def label():
    """Description of the row with most samples; null ones are passed over."""
    description = F.col("descripcion_producto")
    return F.max_by(
        description,
        F.when(description.isNotNull(), F.struct("cantidad_muestras", "descripcion_producto")),
    )


def label_candidates(products: DataFrame, *keys: Column | str) -> DataFrame:
    """Per product id (and ``keys``) the description with most samples, and those samples. Foldable:
    those of finer keys give those of coarser ones, so that a date that is loaded again can be taken
    back by folding its month anew."""
    described = products.where(F.col("id_producto").isNotNull() & F.col("descripcion_producto").isNotNull())
    best = F.max(F.struct("cantidad_muestras", "descripcion_producto")).alias("_best")
    grouped = described.groupBy(*keys, "id_producto").agg(best)
    return grouped.select(*(c for c in grouped.columns if c != "_best"), "_best.*")


def product_labels(products: DataFrame) -> DataFrame:
    """One display description per product id."""
    return (
        products.where(F.col("id_producto").isNotNull())
        .groupBy("id_producto")
        .agg(label().alias("descripcion_producto"))
    )


def chain_rollup(stores: DataFrame) -> DataFrame:
    """Per chain: stores, products reported, plain mean of the store averages."""
    return (
        stores.where(F.col("nombre_comercio").isNotNull())
        .groupBy("nombre_comercio")
        .agg(
            F.count_distinct("nombre_sucursal").alias("sucursales"),
            F.sum("productos_reportados").alias("productos"),
            F.avg("precio_promedio_general").alias("precio_promedio"),
        )
        .orderBy("precio_promedio", "nombre_comercio")
    )


def province_rollup(stores: DataFrame) -> DataFrame:
    """Per province: stores and plain mean of the store averages, dearest first."""
    return (
        stores.where(F.col("provincia").isNotNull())
        .groupBy("provincia")
        .agg(
            F.count_distinct("nombre_sucursal").alias("sucursales"),
            F.avg("precio_promedio_general").alias("precio_promedio"),
        )
        .orderBy(F.desc("precio_promedio"), "provincia")
    )


def date_bounds(*tables: DataFrame) -> DataFrame:
    """First and last date over all tables: one row, nulls when there are none."""
    # Bounds per table first, so only one row per table is united.
    bounds = [
        t.agg(F.min("fecha").alias("desde"), F.max("fecha").alias("hasta")) for t in tables
    ]
    return reduce(DataFrame.unionByName, bounds).agg(
        F.min("desde").alias("desde"), F.max("hasta").alias("hasta")
    )
