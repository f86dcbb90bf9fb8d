"""Gold tables, index and shopper questions over the price view."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.operators import aggregates as agg
from gondola.operators import distinct_sets, postings
from gondola.operators import index as idx
from gondola.operators import report
from gondola.operators import shopping as shop
from gondola.workload.views import (
    comparable,
    last_date,
    previous_date,
    prices,
    products,
    provinces,
    rounded_sql,
    sql_views,
    stores,
    table,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

BASKET = ("1", "2", "3")
QUANTITIES = {"1": 2.0, "3": 3.0}
TERM, BRAND = "RING", "Brand#2"
PRESET = ("ring ", "SMALL", "widget", "no such thing", "ring")

_PRICES = "precio_minimo precio_maximo precio_promedio"
_PRODUCT = rounded_sql(
    _PRICES, "fecha id_producto descripcion_producto marca cantidad_muestras"
)
_COST = "sum(precio_promedio * CASE id_producto WHEN '1' THEN 2 WHEN '3' THEN 3 ELSE 1 END)"


def _query(sql: str, grain: str = "month"):
    """Register a query and its SQL (behind the views of a grain) under the function's name."""

    def register(build: Query) -> Query:
        name = build.__name__
        QUERIES[name] = lambda spark, sf_dir: comparable(build(spark, sf_dir))
        SQL[name] = sql_views(grain) + sql
        return build

    return register


# --- aggregates ---------------------------------------------------------------------------


@_query(
    "SELECT fecha, provincia, id_producto, round(sum(precio_lista) + 1e-9, 6) AS suma,"
    " round(min(precio_lista) + 1e-9, 6) AS minimo, round(max(precio_lista) + 1e-9, 6) AS maximo,"
    " count(precio_lista) AS muestras FROM precios GROUP BY ALL"
)
def price_partials(spark, sf_dir):
    return agg.price_partials(prices(spark, sf_dir), agg.PROVINCE_KEYS)


@_query(
    "SELECT fecha, provincia, id_producto, round(sum(precio_lista) + 1e-9, 6) AS suma,"
    " round(min(precio_lista) + 1e-9, 6) AS minimo, round(max(precio_lista) + 1e-9, 6) AS maximo,"
    " count(precio_lista) AS muestras FROM precios GROUP BY ALL"
)
def merge_partials(spark, sf_dir):
    """Two loads of the same dates, folded: odd and even orders arrive separately."""
    facts = prices(spark, sf_dir)
    loads = [
        agg.price_partials(facts.where(F.col("l_orderkey") % 2 == half), agg.PROVINCE_KEYS)
        for half in (0, 1)
    ]
    # Counted in the files' footers: there are no more partials than lines.
    lines = table(spark, sf_dir, "lineitem").count()
    return agg.merge_partials(loads, agg.PROVINCE_KEYS, -(-lines // agg.FACTS_PER_PART) or 1)


@_query(f"SELECT {_PRODUCT} FROM productos")
def daily_product_prices(spark, sf_dir):
    return products(spark, sf_dir)


@_query(
    "SELECT "
    + rounded_sql(
        "precio_promedio_general",
        "fecha id_comercio nombre_comercio nombre_sucursal provincia productos_reportados",
    )
    + " FROM tiendas",
    "year",
)
def store_stats(spark, sf_dir):
    return stores(spark, sf_dir)


@_query(
    f"SELECT {rounded_sql(_PRICES, 'fecha provincia id_producto cantidad_muestras')}"
    " FROM provincias"
)
def province_product_prices(spark, sf_dir):
    return provinces(spark, sf_dir, "month")


@_query("SELECT fecha, id_producto, round(precio + 1e-9, 6) AS precio_promedio FROM simple")
def product_day_mean(spark, sf_dir):
    return agg.product_day_mean(products(spark, sf_dir))


@_query(f"SELECT {rounded_sql(_PRICES, 'fecha id_producto cantidad_muestras')} FROM ponderado")
def product_day_weighted(spark, sf_dir):
    return agg.product_day_weighted(products(spark, sf_dir))


@_query("SELECT * FROM etiquetas")
def product_labels(spark, sf_dir):
    return agg.product_labels(products(spark, sf_dir))


@_query(
    "SELECT nombre_comercio, count(DISTINCT nombre_sucursal) AS sucursales,"
    " CAST(sum(productos_reportados) AS BIGINT) AS productos,"
    " round(avg(precio_promedio_general) + 1e-9, 6) AS precio_promedio FROM tiendas"
    " WHERE fecha = (SELECT max(fecha) FROM precios) GROUP BY ALL",
    "year",
)
def chain_rollup(spark, sf_dir):
    return agg.chain_rollup(_on_last_date(stores(spark, sf_dir), spark, sf_dir))


@_query(
    "SELECT provincia, count(DISTINCT nombre_sucursal) AS sucursales,"
    " round(avg(precio_promedio_general) + 1e-9, 6) AS precio_promedio FROM tiendas"
    " WHERE fecha = (SELECT max(fecha) FROM precios) GROUP BY ALL",
    "year",
)
def province_rollup(spark, sf_dir):
    return agg.province_rollup(_on_last_date(stores(spark, sf_dir), spark, sf_dir))


def _on_last_date(df: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    return df.where(F.col("fecha") == last_date(spark, sf_dir))


# --- index -----------------------------------------------------------------------------


_INDEX = rounded_sql(
    "indice_precio_global variacion_matched_pct variacion_mediana_pct variacion_media_pct"
    " pct_productos_con_cambio indice_matched_base100 indice_global_base100"
    " variacion_diaria_pct",
    "fecha muestras productos_distintos productos_comparables",
)


@_query(
    f"SELECT {rounded_sql('indice_precio_global', 'fecha muestras productos_distintos')}"
    " FROM totales"
)
def global_index(spark, sf_dir):
    return idx.global_index(products(spark, sf_dir))


@_query(
    "SELECT "
    + rounded_sql("precio_previo precio_actual relativo", "fecha fecha_previa id_producto")
    + " FROM pares"
)
def matched_pairs(spark, sf_dir):
    return idx.matched_pairs(products(spark, sf_dir))


@_query(
    "SELECT "
    + rounded_sql(
        "relativo_recortado relativo_medio relativo_mediano pct_productos_con_cambio",
        "fecha productos_comparables",
    )
    + " FROM relativos"
)
def trimmed_relatives(spark, sf_dir):
    return idx.trimmed_relatives(products(spark, sf_dir))


@_query("SELECT fecha, round(pct_productos_con_cambio + 1e-9, 6) AS pct_productos_con_cambio FROM indice")
def repricing_share(spark, sf_dir):
    return index_table(spark, sf_dir).select("fecha", "pct_productos_con_cambio")


@_query(f"SELECT {_INDEX} FROM indice")
def inflation_index(spark, sf_dir):
    return index_table(spark, sf_dir)


def index_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idx.inflation_index(products(spark, sf_dir))


@_query(
    "SELECT fecha, round(variacion_matched_pct + 1e-9, 6) AS variacion_matched_pct,"
    " CASE WHEN variacion_matched_pct > 0 THEN 'sube' ELSE 'baja' END AS sentido FROM indice"
    " WHERE fecha > (SELECT min(fecha) FROM indice)"
)
def index_moves(spark, sf_dir):
    return idx.index_moves(index_table(spark, sf_dir))


@_query(
    f"SELECT {rounded_sql('pct_productos_con_cambio', 'fecha productos_comparables')}"
    " FROM indice WHERE productos_comparables > 0"
)
def repricing_activity(spark, sf_dir):
    return idx.repricing_activity(index_table(spark, sf_dir))


@_query(
    "SELECT fecha, 'Productos comparables' AS serie, round(indice_matched_base100 + 1e-9, 6) AS valor"
    " FROM indice UNION ALL SELECT fecha, 'Promedio simple',"
    " round(indice_global_base100 + 1e-9, 6) FROM indice"
)
def index_long(spark, sf_dir):
    return idx.index_long(index_table(spark, sf_dir))


@_query(
    f"SELECT {_INDEX} FROM indice WHERE fecha BETWEEN"
    " DATE '1997-03-01' AND DATE '1998-02-01'"
)
def date_range_filter(spark, sf_dir):
    return shop.date_range_filter(index_table(spark, sf_dir), "1997-03-01", "1998-02-01")


_MONTHS = "['ene','feb','mar','abr','may','jun','jul','ago','sep','oct','nov','dic']"


def _es(text: str) -> str:
    return f"translate({text}, ',.', '.,')"


@_query(
    "SELECT fecha,"
    f" day(fecha) || ' ' || {_MONTHS}[month(fecha)] || ' ' || year(fecha) AS dia,"
    f" day(fecha) || ' ' || {_MONTHS}[month(fecha)] AS dia_corto,"
    f" '$' || {_es("format('{:,.0f}', indice_precio_global)")} AS precio_promedio,"
    f" {_es("format('{:,.1f}', indice_matched_base100)")} AS indice,"
    f" {_es("format('{:+.2f}', variacion_matched_pct)")} || '%' AS variacion,"
    f" {_es("format('{:.1f}', pct_productos_con_cambio)")} || '%' AS remarcados,"
    f" {_es("format('{:,}', productos_comparables)")} AS comparables FROM indice"
)
def localised_report(spark, sf_dir):
    return report.localised_index(index_table(spark, sf_dir))


@_query(
    "SELECT fecha, muestras, productos_distintos, productos_comparables, "
    + ", ".join(
        f"round_even({c} * 100, 0) / 100 AS {c}"
        for c in (
            "indice_precio_global",
            "variacion_matched_pct",
            "variacion_mediana_pct",
            "variacion_media_pct",
            "pct_productos_con_cambio",
            "indice_matched_base100",
            "indice_global_base100",
            "variacion_diaria_pct",
        )
    )
    + " FROM indice"
)
def rounded_export(spark, sf_dir):
    return report.rounded(index_table(spark, sf_dir))


# --- search, movers, savings ----------------------------------------------------------------


@_query("SELECT DISTINCT marca FROM productos WHERE marca IS NOT NULL")
def distinct_brands(spark, sf_dir):
    return shop.distinct_values(products(spark, sf_dir), "marca")


@_query(
    f"SELECT {_PRODUCT} FROM productos WHERE contains(upper(descripcion_producto), '{TERM}')"
    f" AND marca = '{BRAND}'"
)
def search_products(spark, sf_dir):
    return shop.search_products(products(spark, sf_dir), TERM, BRAND)


@_query(
    "SELECT count(DISTINCT id_producto) AS productos FROM productos"
    f" WHERE contains(upper(descripcion_producto), '{TERM}')"
)
def search_summary(spark, sf_dir):
    return shop.search_summary(shop.search_products(products(spark, sf_dir), TERM))


@_query(f"SELECT {_PRODUCT} FROM productos WHERE contains(upper(descripcion_producto), '{TERM}')")
def search_by_postings(spark, sf_dir):
    rows = products(spark, sf_dir)
    return postings.search_by_postings(rows, postings.description_postings(rows), rows, TERM)


@_query(
    "SELECT desde, hasta, (SELECT count(DISTINCT id_producto) FROM productos WHERE fecha BETWEEN desde AND hasta)"
    " AS productos_distintos FROM (SELECT CAST(fecha - INTERVAL 5 MONTH AS DATE) AS desde, fecha AS hasta FROM fechas)"
)
def range_distinct_products(spark, sf_dir):
    """Different products of the six months up to each month, from sets of each month."""
    rows = products(spark, sf_dir)
    sets = distinct_sets.id_sets(rows, distinct_sets.number_ids(rows))
    months = rows.select(F.add_months("fecha", -5).alias("desde"), F.col("fecha").alias("hasta")).distinct()
    return distinct_sets.distinct_in_ranges(sets, months)


_FOUND = f"(SELECT * FROM productos WHERE contains(upper(descripcion_producto), '{TERM}'))"


@_query(
    f"SELECT {_PRODUCT} FROM {_FOUND} WHERE id_producto IN (SELECT id_producto FROM {_FOUND}"
    " GROUP BY 1 ORDER BY sum(cantidad_muestras) DESC, id_producto LIMIT 4)"
)
def search_top4(spark, sf_dir):
    return shop.search_top(shop.search_products(products(spark, sf_dir), TERM))


@_query(
    f"SELECT {_PRODUCT} FROM (SELECT * FROM {_FOUND} ORDER BY fecha DESC,"
    " round(precio_promedio + 1e-9, 6), id_producto, descripcion_producto, marca LIMIT 300)"
)
def search_table(spark, sf_dir):
    found = shop.search_products(products(spark, sf_dir), TERM)
    return shop.search_table(comparable(found))


_MOVERS = """
(SELECT id_producto, a.precio_promedio AS precio_anterior, b.precio_promedio AS precio_actual,
        b.cantidad_muestras AS muestras, descripcion_producto,
        (b.precio_promedio - a.precio_promedio) / a.precio_promedio * 100 AS variacion_pct
 FROM ponderado a JOIN ponderado b USING (id_producto) JOIN etiquetas USING (id_producto)
 WHERE b.fecha = (SELECT max(fecha) FROM fechas)
   AND a.fecha = (SELECT max_by(fecha_previa, fecha) FROM fechas)
   AND a.precio_promedio > 0 AND b.cantidad_muestras >= 2)"""
_MOVER = rounded_sql(
    "precio_anterior precio_actual variacion_pct", "id_producto muestras descripcion_producto"
)


@_query(f"SELECT {_MOVER} FROM {_MOVERS}", "year")
def price_movers(spark, sf_dir):
    return _movers(spark, sf_dir)


def _movers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = products(spark, sf_dir, "year")
    return shop.price_movers(rows, previous_date(spark, sf_dir), last_date(spark, sf_dir))


@_query(
    f"(SELECT {_MOVER}, 'aumentos' AS sentido FROM {_MOVERS}"
    " ORDER BY round(variacion_pct + 1e-9, 6) DESC, id_producto LIMIT 10) UNION ALL"
    f" (SELECT {_MOVER}, 'bajas' AS sentido FROM {_MOVERS}"
    " ORDER BY round(variacion_pct + 1e-9, 6), id_producto DESC LIMIT 10)",
    "year",
)
def top_movers(spark, sf_dir):
    return shop.top_movers(comparable(_movers(spark, sf_dir)))


@_query(
    f"SELECT {_PRODUCT}, round(precio_maximo / precio_minimo + 1e-9, 6) AS ratio,"
    " round((precio_maximo - precio_minimo) / precio_maximo * 100 + 1e-9, 6) AS ahorro_pct,"
    " round(precio_maximo - precio_minimo + 1e-9, 6) AS ahorro_abs FROM productos"
    " WHERE fecha = (SELECT max(fecha) FROM fechas) AND cantidad_muestras >= 5"
    " AND precio_minimo > 0 AND precio_maximo / precio_minimo <= 3"
    " ORDER BY (precio_maximo - precio_minimo) / precio_maximo * 100 DESC,"
    " id_producto, descripcion_producto, marca LIMIT 15",
    "year",
)
def savings(spark, sf_dir):
    rows = products(spark, sf_dir, "year")
    return shop.savings_opportunities(rows, last_date(spark, sf_dir))


# --- baskets --------------------------------------------------------------------------------


_SERIES = f"""
(SELECT fecha, {_COST} AS costo_total, count(*) AS items FROM ponderado
 WHERE id_producto IN {BASKET} GROUP BY fecha HAVING count(*) = {len(BASKET)})"""


def _series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shop.basket_series(products(spark, sf_dir, "year"), BASKET, QUANTITIES)


@_query(f"SELECT {rounded_sql('costo_total', 'fecha items')} FROM {_SERIES}", "year")
def basket_series(spark, sf_dir):
    return _series(spark, sf_dir)


@_query(
    "SELECT min(fecha) AS desde, max(fecha) AS hasta,"
    " round(min_by(costo_total, fecha) + 1e-9, 6) AS costo_inicial,"
    " round(max_by(costo_total, fecha) + 1e-9, 6) AS costo_final, count(*) AS dias,"
    " round((max_by(costo_total, fecha) - min_by(costo_total, fecha))"
    f" / min_by(costo_total, fecha) * 100 + 1e-9, 6) AS variacion_pct FROM {_SERIES}",
    "year",
)
def basket_change(spark, sf_dir):
    return shop.basket_change(_series(spark, sf_dir))


_BY_PROVINCE = f"""
(SELECT provincia, {_COST} AS costo_total, count(DISTINCT id_producto) AS items,
        count(DISTINCT id_producto) / {float(len(BASKET))} AS cobertura FROM provincias
 WHERE id_producto IN {BASKET} AND fecha = (SELECT max(fecha) FROM provincias)
 GROUP BY provincia"""


def _by_province(spark: SparkSession, sf_dir: str, coverage: float) -> DataFrame:
    rows = provinces(spark, sf_dir)
    return shop.basket_by_province(rows, BASKET, last_date(spark, sf_dir), QUANTITIES, coverage)


@_query(
    f"SELECT {rounded_sql('costo_total cobertura', 'provincia items')} FROM {_BY_PROVINCE}"
    " HAVING count(DISTINCT id_producto) >= 2)",
    "year",
)
def basket_by_province(spark, sf_dir):
    return _by_province(spark, sf_dir, 0.6)


@_query(
    "SELECT min_by(provincia, (costo_total, provincia)) AS mas_barata,"
    " round(min(costo_total) + 1e-9, 6) AS costo_minimo,"
    " max_by(provincia, (costo_total, provincia)) AS mas_cara,"
    " round(max(costo_total) + 1e-9, 6) AS costo_maximo,"
    " round(max(costo_total) - min(costo_total) + 1e-9, 6) AS diferencia,"
    " round((max(costo_total) - min(costo_total)) / max(costo_total) * 100 + 1e-9, 6)"
    f" AS diferencia_pct FROM {_BY_PROVINCE} HAVING count(DISTINCT id_producto) = 3)"
    " HAVING count(*) > 0",
    "year",
)
def basket_spread(spark, sf_dir):
    return shop.basket_spread(_by_province(spark, sf_dir, 1.0))


@_query(
    "SELECT posicion, id_producto, descripcion_producto AS producto,"
    " CAST(CASE id_producto WHEN '1' THEN 2 WHEN '3' THEN 3 ELSE 1 END AS DOUBLE) AS cantidad,"
    " round(precio_promedio + 1e-9, 6) AS precio_unitario"
    " FROM (VALUES (0, '1'), (1, '2'), (2, '3')) AS elegidos(posicion, id_producto)"
    " LEFT JOIN etiquetas USING (id_producto) LEFT JOIN (SELECT * FROM ponderado"
    " WHERE fecha = (SELECT max(fecha) FROM fechas)) USING (id_producto)",
    "year",
)
def basket_sheet(spark, sf_dir):
    rows = products(spark, sf_dir, "year")
    return shop.basket_sheet(rows, BASKET, last_date(spark, sf_dir), QUANTITIES)


_TERMS = ", ".join(f"({i}, '{t.strip()}')" for i, t in enumerate(PRESET))


@_query(
    f""", terminos(posicion, termino) AS (VALUES {_TERMS}),
candidatos AS (
  SELECT posicion, termino, id_producto, row_number() OVER (
    PARTITION BY posicion
    ORDER BY starts_with(upper(descripcion_producto), upper(termino)) DESC,
             cantidad_muestras DESC, id_producto) AS n
  FROM productos JOIN terminos
    ON contains(upper(descripcion_producto), upper(termino))
  WHERE fecha = (SELECT max(fecha) FROM fechas))
SELECT min(posicion) AS posicion, min_by(termino, posicion) AS termino, id_producto
FROM candidatos WHERE n = 1 GROUP BY id_producto""",
    "year",
)
def resolve_preset(spark, sf_dir):
    rows = products(spark, sf_dir, "year")
    return shop.resolve_preset(rows, PRESET, last_date(spark, sf_dir))


PRESETS = {"circular": ("ring", "widget"), "mixed": ("SMALL", "no such thing", "ring ", "gear")}
_NAMED = ", ".join(
    f"('{name}', {i}, '{t.strip()}')" for name, terms in PRESETS.items() for i, t in enumerate(terms)
)


@_query(
    f""", terminos(canasta, posicion, termino) AS (VALUES {_NAMED}),
candidatos AS (
  SELECT canasta, posicion, termino, id_producto, row_number() OVER (
    PARTITION BY canasta, posicion
    ORDER BY starts_with(upper(descripcion_producto), upper(termino)) DESC,
             cantidad_muestras DESC, id_producto) AS n
  FROM productos JOIN terminos
    ON contains(upper(descripcion_producto), upper(termino))
  WHERE fecha = (SELECT max(fecha) FROM fechas))
SELECT canasta, min(posicion) AS posicion, min_by(termino, posicion) AS termino, id_producto
FROM candidatos WHERE n = 1 GROUP BY canasta, id_producto""",
    "year",
)
def preset_baskets(spark, sf_dir):
    return shop.resolve_presets(products(spark, sf_dir, "year"), last_date(spark, sf_dir), PRESETS)


# --- stores and provinces ---------------------------------------------------------------------


@_query(
    "SELECT fecha, id_comercio, nombre_comercio, nombre_sucursal, provincia,"
    " productos_reportados, round(precio_promedio_general + 1e-9, 6) AS precio_promedio_general"
    " FROM tiendas WHERE fecha = (SELECT max(fecha) FROM fechas) AND productos_reportados >= 50"
    " ORDER BY round(precio_promedio_general + 1e-9, 6), id_comercio, nombre_sucursal, provincia"
    " LIMIT 12",
    "year",
)
def cheapest_stores(spark, sf_dir):
    rows = comparable(stores(spark, sf_dir))
    return shop.cheapest_stores(rows, last_date(spark, sf_dir))


@_query(
    "SELECT id_producto, left(descripcion_producto, 42) AS etiqueta FROM (SELECT * FROM productos"
    " WHERE fecha = (SELECT max(fecha) FROM fechas) AND cantidad_muestras >= 5"
    " AND precio_minimo > 0 AND precio_maximo / precio_minimo <= 3"
    " ORDER BY (precio_maximo - precio_minimo) / precio_maximo * 100 DESC,"
    " id_producto, descripcion_producto, marca LIMIT 15)",
    "year",
)
def savings_labels(spark, sf_dir):
    return shop.savings_labels(savings(spark, sf_dir)).select("id_producto", "etiqueta")


@_query(f"SELECT id_producto, left(descripcion_producto, 38) AS etiqueta FROM {_MOVERS}", "year")
def movers_labels(spark, sf_dir):
    return shop.movers_labels(_movers(spark, sf_dir)).select("id_producto", "etiqueta")


@_query(
    "SELECT nombre_comercio, left(nombre_comercio, 40) AS etiqueta FROM tiendas"
    " WHERE fecha = (SELECT max(fecha) FROM precios) GROUP BY ALL",
    "year",
)
def chain_labels(spark, sf_dir):
    chains = agg.chain_rollup(_on_last_date(stores(spark, sf_dir), spark, sf_dir))
    return shop.chain_labels(chains).select("nombre_comercio", "etiqueta")


@_query(
    "SELECT fecha, id_comercio, left(coalesce(nombre_sucursal, '—'), 34) || '  ·  '"
    " || coalesce(provincia, '—') AS etiqueta FROM tiendas",
    "year",
)
def store_labels(spark, sf_dir):
    return shop.store_labels(stores(spark, sf_dir)).select("fecha", "id_comercio", "etiqueta")


@_query(
    f"SELECT {rounded_sql(_PRICES, 'fecha provincia id_producto cantidad_muestras')},"
    " descripcion_producto, CAST(NULL AS VARCHAR) AS marca FROM provincias"
    " JOIN etiquetas USING (id_producto) WHERE provincia = 'NATION_3'",
    "year",
)
def province_scoped_products(spark, sf_dir):
    rows = products(spark, sf_dir, "year")
    return shop.province_scoped_products(rows, provinces(spark, sf_dir), "NATION_3")
