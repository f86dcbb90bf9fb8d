"""Price-shaped views of the test tables, in Spark and as SQL common table expressions."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.operators import shopping as shop
from gondola.operators.aggregates import (
    PRODUCT_KEYS,
    PROVINCE_KEYS,
    STORE_KEYS,
    daily_product_prices,
    price_partials,
    province_product_prices,
    store_stats,
)

# Four parts share an id, so that one id has several descriptions.
PARTS_PER_ID = 4


# Declared, so that reading a table starts no job to look at its files.
_COLUMNS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
    " value double, props string",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def prices(spark: SparkSession, sf_dir: str, grain: str = "month") -> DataFrame:
    """Silver-shaped facts; ``grain`` is the length of a "day": month or year."""
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part")
    suppliers = table(spark, sf_dir, "supplier")
    nations = table(spark, sf_dir, "nation")
    stores = suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    chain = (F.col("l_suppkey") % 10).cast("string")
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(stores, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.trunc("l_shipdate", grain).alias("fecha"),
            F.floor(F.col("l_partkey") / PARTS_PER_ID).cast("string").alias("id_producto"),
            F.col("p_name").alias("descripcion_producto"),
            F.col("p_brand").alias("marca"),
            chain.alias("id_comercio"),
            F.concat(F.lit("Chain "), chain).alias("nombre_comercio"),
            F.lit("1").alias("id_bandera"),
            F.col("l_suppkey").cast("string").alias("id_sucursal"),
            F.col("s_name").alias("nombre_sucursal"),
            F.col("n_name").alias("provincia"),
            (F.col("p_retailprice") * (1 - F.col("l_discount"))).alias("precio_lista"),
            "l_orderkey",
            "l_linenumber",
        )
    )


def products(spark: SparkSession, sf_dir: str, grain: str = "month") -> DataFrame:
    return daily_product_prices(price_partials(prices(spark, sf_dir, grain), PRODUCT_KEYS))


def last_date(spark: SparkSession, sf_dir: str, grain: str = "year") -> Column:
    """Last date of the facts, of their own table alone: no dimension is joined to learn it."""
    return shop.latest_date(_fact_dates(spark, sf_dir, grain))


def previous_date(spark: SparkSession, sf_dir: str, grain: str = "year") -> Column:
    return shop.previous_date(_fact_dates(spark, sf_dir, grain))


def _fact_dates(spark: SparkSession, sf_dir: str, grain: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.trunc("l_shipdate", grain).alias("fecha"))


def stores(spark: SparkSession, sf_dir: str, grain: str = "year") -> DataFrame:
    return store_stats(price_partials(prices(spark, sf_dir, grain), STORE_KEYS))


def provinces(spark: SparkSession, sf_dir: str, grain: str = "year") -> DataFrame:
    facts = prices(spark, sf_dir, grain)
    return province_product_prices(price_partials(facts, PROVINCE_KEYS))


@cache
def sql_views(grain: str) -> str:
    """The same views and the index as CTEs; put a SELECT behind them."""
    return f"""
WITH precios AS (
  SELECT CAST(date_trunc('{grain}', l_shipdate) AS DATE) AS fecha,
         CAST(l_partkey // {PARTS_PER_ID} AS VARCHAR) AS id_producto,
         p_name AS descripcion_producto, p_brand AS marca,
         CAST(l_suppkey % 10 AS VARCHAR) AS id_comercio,
         'Chain ' || CAST(l_suppkey % 10 AS VARCHAR) AS nombre_comercio,
         '1' AS id_bandera, CAST(l_suppkey AS VARCHAR) AS id_sucursal,
         s_name AS nombre_sucursal, n_name AS provincia,
         p_retailprice * (1 - l_discount) AS precio_lista, l_orderkey, l_linenumber
  FROM lineitem JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
productos AS (
  SELECT fecha, id_producto, descripcion_producto, marca,
         min(precio_lista) AS precio_minimo, max(precio_lista) AS precio_maximo,
         count(precio_lista) AS cantidad_muestras, avg(precio_lista) AS precio_promedio
  FROM precios GROUP BY ALL),
tiendas AS (
  SELECT fecha, id_comercio, nombre_comercio, nombre_sucursal, provincia,
         count(precio_lista) AS productos_reportados,
         avg(precio_lista) AS precio_promedio_general
  FROM precios GROUP BY ALL),
provincias AS (
  SELECT fecha, provincia, id_producto,
         min(precio_lista) AS precio_minimo, max(precio_lista) AS precio_maximo,
         count(precio_lista) AS cantidad_muestras, avg(precio_lista) AS precio_promedio
  FROM precios WHERE provincia IS NOT NULL GROUP BY ALL),
ponderado AS (
  SELECT fecha, id_producto, CAST(sum(cantidad_muestras) AS BIGINT) AS cantidad_muestras,
         min(precio_minimo) AS precio_minimo, max(precio_maximo) AS precio_maximo,
         sum(precio_promedio * cantidad_muestras) / sum(cantidad_muestras) AS precio_promedio
  FROM productos GROUP BY ALL),
simple AS (
  SELECT fecha, id_producto, avg(precio_promedio) AS precio FROM productos GROUP BY ALL),
totales AS (
  SELECT fecha, CAST(sum(cantidad_muestras) AS BIGINT) AS muestras,
         count(DISTINCT id_producto) AS productos_distintos,
         sum(precio_promedio * cantidad_muestras) / sum(cantidad_muestras)
           AS indice_precio_global
  FROM productos GROUP BY ALL),
fechas AS (SELECT fecha, lag(fecha) OVER (ORDER BY fecha) AS fecha_previa FROM totales),
pares AS (
  SELECT a.fecha, fecha_previa, a.id_producto, b.precio AS precio_previo,
         a.precio AS precio_actual, a.precio / b.precio AS relativo
  FROM simple a JOIN fechas USING (fecha)
  JOIN simple b ON b.fecha = fecha_previa AND b.id_producto = a.id_producto
  WHERE b.precio > 0),
cortes AS (
  SELECT fecha, count(*) AS n, quantile_cont(relativo, 0.05) AS bajo,
         quantile_cont(relativo, 0.95) AS alto, quantile_cont(relativo, 0.5) AS mediana
  FROM pares GROUP BY ALL),
relativos AS (
  SELECT fecha,
         avg(relativo) FILTER (WHERE n < 20 OR relativo BETWEEN bajo AND alto)
           AS relativo_recortado,
         avg(relativo) AS relativo_medio, any_value(mediana) AS relativo_mediano,
         count(*) AS productos_comparables,
         100.0 * count(*) FILTER (WHERE NOT relativo BETWEEN 0.999 AND 1.001) / count(*)
           AS pct_productos_con_cambio
  FROM pares JOIN cortes USING (fecha) GROUP BY fecha),
indice AS (
  SELECT fecha, muestras, productos_distintos, indice_precio_global,
         (coalesce(relativo_recortado, 1) - 1) * 100 AS variacion_matched_pct,
         (coalesce(relativo_mediano, 1) - 1) * 100 AS variacion_mediana_pct,
         (coalesce(relativo_medio, 1) - 1) * 100 AS variacion_media_pct,
         coalesce(productos_comparables, 0) AS productos_comparables,
         coalesce(pct_productos_con_cambio, 0) AS pct_productos_con_cambio,
         100 * product(coalesce(relativo_recortado, 1)) OVER (ORDER BY fecha)
           AS indice_matched_base100,
         indice_precio_global / first_value(indice_precio_global) OVER (ORDER BY fecha) * 100
           AS indice_global_base100,
         (indice_precio_global / lag(indice_precio_global) OVER (ORDER BY fecha) - 1) * 100
           AS variacion_diaria_pct
  FROM totales LEFT JOIN relativos USING (fecha)),
etiquetas AS (
  SELECT id_producto, arg_max(descripcion_producto, (cantidad_muestras, descripcion_producto))
           AS descripcion_producto
  FROM productos GROUP BY ALL)
"""


# Averages of a power of two of samples can end in an exact 5 after the last digit kept. The
# engines' summation orders would decide such ties, so both sides are moved off them.
DIGITS, NUDGE = 6, 1e-9


def comparable(df: DataFrame) -> DataFrame:
    """Floating-point columns rounded for comparison with SQL."""
    names = [f.name for f in df.schema if f.dataType.typeName() == "double"]
    return df.withColumns({n: F.round(F.col(n) + NUDGE, DIGITS) for n in names})


def r(expression: str) -> str:
    """The same rounding in SQL."""
    return f"round({expression} + {NUDGE}, {DIGITS})"


def rounded_sql(columns: str, exact: str = "") -> str:
    """SELECT list: the exact columns, then the others rounded."""
    return ", ".join(exact.split() + [f"{r(c)} AS {c}" for c in columns.split()])
