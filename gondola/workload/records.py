"""Cleaning, enrichment and quality over raw records derived from the test tables.

The raw view spoils the price view in known ways: footer and blank keys, unreadable and
out-of-band prices, placeholders, padding. Prices are whole cents, so that both engines write
the same digits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.operators import cleaning, enrich, quality, report
from gondola.settings import CHAIN_COLUMNS, PRODUCT_COLUMNS, PROVINCE_NAMES, STORE_COLUMNS
from gondola.sources.lake import silver_scan as scan
from gondola.workload.views import comparable, prices, sql_views, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

KEYS = "l_orderkey l_linenumber"
KEYWORDS = ("WIDGET", "ríng")


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw product records in the publisher's retail layout, plus a column nobody maps."""
    order = F.col("l_orderkey")

    def every(n: int):
        return order % n == 0

    cents = F.floor(F.col("p_retailprice") * (1 - F.col("l_discount")) * 100).cast("string")
    chain = (F.col("l_suppkey") % 10).cast("string")
    joined = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    return joined.select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_linestatus") == "O", "minorista").otherwise("mayorista").alias("tipo"),
        F.trunc("l_shipdate", "year").alias("fecha"),
        F.when(every(23), "vacio").otherwise(chain).alias("archivo"),
        F.when(every(23), "  Última Actualización: 2026-03-04T05:06:07-03:00")
        .when(every(29), " ")
        .otherwise(F.concat(F.lit(" "), chain))
        .alias("ID_COMERCIO "),
        F.lit("1").alias("id_bandera"),
        F.when(every(37), F.lit(None))
        .otherwise(F.concat(F.col("l_suppkey").cast("string"), F.lit(" ")))
        .alias("id_sucursal"),
        F.when(every(41), "s/d")
        .otherwise(F.floor(F.col("l_partkey") / 4).cast("string"))
        .alias("id_producto"),
        F.lit("1").alias("productos_ean"),
        F.col("p_name").alias("productos_descripcion"),
        F.when(every(7), " Sin marca ")
        .when(every(11), "-")
        .otherwise(F.concat(F.lit(" "), "p_brand", F.lit(" ")))
        .alias("productos_marca"),
        F.when(every(17), "N/D")
        .when(every(19), "-99.00")
        .when(every(31), "10d")
        .when(every(43), "1e12")
        .otherwise(cents)
        .alias("productos_precio_lista"),
        F.lit("7").alias("precio_unitario_bulto_por_unidad_venta_con_iva"),
        F.col("p_type").alias("columna_desconocida"),
    )


_RAW = """
WITH crudos AS (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_linestatus = 'O' THEN 'minorista' ELSE 'mayorista' END AS tipo,
         CAST(date_trunc('year', l_shipdate) AS DATE) AS fecha,
         CASE WHEN l_orderkey % 23 = 0 THEN 'vacio'
              ELSE CAST(l_suppkey % 10 AS VARCHAR) END AS archivo,
         CASE WHEN l_orderkey % 23 = 0 THEN '  Última Actualización: 2026-03-04T05:06:07-03:00'
              WHEN l_orderkey % 29 = 0 THEN ' '
              ELSE ' ' || CAST(l_suppkey % 10 AS VARCHAR) END AS id_comercio,
         '1' AS id_bandera,
         CASE WHEN l_orderkey % 37 <> 0 THEN CAST(l_suppkey AS VARCHAR) || ' ' END
           AS id_sucursal,
         CASE WHEN l_orderkey % 41 = 0 THEN 's/d'
              ELSE CAST(l_partkey // 4 AS VARCHAR) END AS id_producto,
         p_name AS descripcion_producto,
         CASE WHEN l_orderkey % 7 = 0 THEN ' Sin marca ' WHEN l_orderkey % 11 = 0 THEN '-'
              ELSE ' ' || p_brand || ' ' END AS marca,
         CASE WHEN l_orderkey % 17 = 0 THEN 'N/D' WHEN l_orderkey % 19 = 0 THEN '-99.00'
              WHEN l_orderkey % 31 = 0 THEN '10d' WHEN l_orderkey % 43 = 0 THEN '1e12'
              ELSE CAST(CAST(floor(p_retailprice * (1 - l_discount) * 100) AS BIGINT)
                        AS VARCHAR) END AS precio_lista
  FROM lineitem JOIN part ON l_partkey = p_partkey),
leidos AS (
  SELECT * FROM crudos WHERE trim(id_comercio) <> ''
    AND NOT starts_with(lower(strip_accents(trim(id_comercio))), 'ultima actualizacion')),
limpios AS (
  SELECT l_orderkey, l_linenumber, tipo, fecha, archivo, trim(id_comercio) AS id_comercio,
         id_bandera, trim(id_sucursal) AS id_sucursal, descripcion_producto,
         CASE WHEN id_producto <> 's/d' THEN id_producto END AS id_producto,
         CASE WHEN lower(trim(marca)) NOT IN ('sin marca', '-') THEN trim(marca) END AS marca,
         CASE WHEN precio_lista <> '10d' THEN try_cast(precio_lista AS DOUBLE) END
           AS precio_lista
  FROM leidos),
validos AS (SELECT * FROM limpios WHERE precio_lista BETWEEN 0.01 AND 5e7)
"""


def _query(sql: str):
    def register(build: Query) -> Query:
        name = build.__name__
        QUERIES[name] = lambda spark, sf_dir: comparable(build(spark, sf_dir))
        SQL[name] = sql
        return build

    return register


def _normalized(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """Canonical columns with the record's own keys carried along."""
    carried = [*KEYS.split(), *keep]
    mapping = [*PRODUCT_COLUMNS, *[(c, c) for c in carried]]
    return cleaning.normalize_columns(raw(spark, sf_dir), mapping)


def _read(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = _normalized(spark, sf_dir, "tipo", "fecha", "archivo")
    return cleaning.trim_keys(cleaning.strip_footer(columns))


@_query(
    _RAW + "SELECT id_comercio, id_bandera, id_sucursal, id_producto, descripcion_producto,"
    " marca, precio_lista, l_orderkey, l_linenumber FROM crudos"
)
def normalize_columns(spark, sf_dir):
    return _normalized(spark, sf_dir)


_RETAIL = (
    "\ufeffid_comercio", "ID_BANDERA ", "id_sucursal", "id_producto",
    "productos_descripcion", "productos_marca", "productos_precio_lista",
)
_WHOLESALE = (
    "id_comercio", "id_bandera", "id_sucursal", "id_producto",
    "productos_descripcion", "unidad_venta", "precio_unitario_bulto_por_unidad_venta_con_iva",
)


def line_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches as the archive source makes them, one per order line, in the layout of its tipo: the
    whole record, the record with a field too many, and one that ends before its price."""
    retail = F.col("l_linestatus") == "O"
    brand = F.when(F.col("l_orderkey") % 7 == 0, "NA").otherwise(F.col("p_brand"))
    cents = F.floor(F.col("p_retailprice") * (1 - F.col("l_discount")) * 100).cast("string")
    head = [
        (F.col("l_suppkey") % 10).cast("string"), F.lit("1"), F.col("l_suppkey").cast("string"),
        F.floor(F.col("l_partkey") / 4).cast("string"), F.col("p_name"),
    ]
    whole = F.array(*head, F.when(retail, brand).otherwise("BULTO"), cents)
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    return lines.select(
        *KEYS.split(),
        F.when(retail, F.array(*map(F.lit, _RETAIL)))
        .otherwise(F.array(*map(F.lit, _WHOLESALE)))
        .alias("encabezado"),
        F.array(whole, F.array_append(whole, F.lit("x")), F.array(*head)).alias("lineas"),
        F.lit(1).alias("primera_linea"),
    )


@_query(
    "SELECT l_orderkey, l_linenumber, linea, CAST(l_suppkey % 10 AS VARCHAR) AS id_comercio,"
    " '1' AS id_bandera, CAST(l_suppkey AS VARCHAR) AS id_sucursal,"
    " CAST(l_partkey // 4 AS VARCHAR) AS id_producto, p_name AS descripcion_producto,"
    " CASE WHEN linea = 1 AND l_linestatus = 'O' AND l_orderkey % 7 <> 0 THEN p_brand END AS marca,"
    " CASE WHEN linea = 1 AND l_linestatus <> 'O' THEN 'BULTO' END AS unidad_medida,"
    " CASE WHEN linea = 1 THEN CAST(CAST(floor(p_retailprice * (1 - l_discount) * 100) AS BIGINT)"
    " AS VARCHAR) END AS precio_lista FROM lineitem JOIN part ON l_partkey = p_partkey"
    " CROSS JOIN (VALUES (1), (3)) AS n(linea)"
)
def resolve_layout(spark, sf_dir):
    """The header lookup of the Silver job: two layouts, surplus and missing fields, NA tokens."""
    records = cleaning.resolve_layout(line_batches(spark, sf_dir), PRODUCT_COLUMNS)
    return records.select(
        *KEYS.split(), "linea", "id_comercio", "id_bandera", "id_sucursal", "id_producto",
        "descripcion_producto", "marca", "unidad_medida", "precio_lista",
    )


@_query(_RAW + "SELECT l_orderkey, l_linenumber, id_comercio FROM leidos")
def strip_footer(spark, sf_dir):
    return cleaning.strip_footer(_normalized(spark, sf_dir)).select(
        *KEYS.split(), "id_comercio"
    )


@_query(
    _RAW + "SELECT l_orderkey, l_linenumber, try_cast(precio_lista AS DOUBLE) AS precio_lista"
    " FROM crudos WHERE precio_lista <> '10d'"
    " AND try_cast(precio_lista AS DOUBLE) BETWEEN 0.01 AND 5e7"
)
def clean_prices(spark, sf_dir):
    return cleaning.clean_prices(_normalized(spark, sf_dir)).select(
        *KEYS.split(), "precio_lista"
    )


@_query(
    _RAW + "SELECT l_orderkey, l_linenumber, id_producto, marca, id_sucursal FROM limpios"
)
def clean_strings(spark, sf_dir):
    return cleaning.clean_strings(_read(spark, sf_dir)).select(
        *KEYS.split(), "id_producto", "marca", "id_sucursal"
    )


@_query(
    _RAW + "SELECT l_orderkey, l_linenumber, descripcion_producto FROM crudos"
    " WHERE contains(descripcion_producto, 'widget') OR contains(descripcion_producto, 'ring')"
)
def category_filter(spark, sf_dir):
    return cleaning.category_filter(_normalized(spark, sf_dir), KEYWORDS).select(
        *KEYS.split(), "descripcion_producto"
    )


_NULLS = {
    "unidad_medida nombre_comercio razon_social nombre_sucursal tipo_sucursal calle numero"
    " localidad provincia": "VARCHAR",
    "cantidad_presentacion latitud longitud precio_referencia precio_promocion": "DOUBLE",
}


@_query(
    _RAW + "SELECT id_producto, descripcion_producto, marca, id_comercio, id_bandera,"
    " id_sucursal, precio_lista, fecha, "
    + ", ".join(
        f"CAST(NULL AS {kind}) AS {name}"
        for names, kind in _NULLS.items()
        for name in names.split()
    )
    + " FROM validos"
)
def conform_silver(spark, sf_dir):
    cleaned = cleaning.clean_strings(cleaning.clean_prices(_read(spark, sf_dir)))
    return cleaning.conform_silver(cleaned)


_CASES = "SELECT l_orderkey, l_linenumber, '{0}' AS columna, '{1}' AS regla, {2} AS valor"


@_query(
    _RAW
    + " UNION ALL ".join(
        _CASES.format(column, "not_nullable", "NULL")
        + f" FROM limpios WHERE {column} IS NULL"
        for column in ("id_producto", "id_comercio", "id_sucursal", "precio_lista")
    )
    + " UNION ALL "
    + _CASES.format("precio_lista", "min_price", "'-99.0'")
    + " FROM limpios WHERE precio_lista < 0.01 UNION ALL "
    + _CASES.format("precio_lista", "max_price", "'1.0E12'")
    + " FROM limpios WHERE precio_lista > 5e7"
)
def contract_failures(spark, sf_dir):
    """Before the price filter, so that every rule has failures."""
    cleaned = cleaning.clean_strings(cleaning.parse_prices(_read(spark, sf_dir)))
    return quality.contract_failures(cleaned, keep=KEYS.split())


def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = cleaning.clean_strings(cleaning.parse_prices(_read(spark, sf_dir)))
    return quality.quality_report(
        cleaned,
        raw(spark, sf_dir).select("tipo", "fecha", "archivo"),
        cleaning.price_in_band(F.col("precio_lista")),
        quality.failure_count(),
    )


REPORT_VIEWS = (
    _RAW
    + """,
archivos AS (SELECT DISTINCT tipo, fecha, archivo FROM crudos),
leidas AS (SELECT tipo, fecha, count(*) AS rows_read FROM limpios GROUP BY ALL),
escritas AS (
  SELECT tipo, fecha, count(*) AS rows_written, count(DISTINCT archivo) AS retailers,
         count(*) FILTER (WHERE id_producto IS NULL)
         + count(*) FILTER (WHERE id_comercio IS NULL)
         + count(*) FILTER (WHERE id_sucursal IS NULL) AS validation_failures
  FROM validos GROUP BY ALL),
listados AS (SELECT tipo, fecha, count(*) AS n FROM archivos GROUP BY ALL),
informe AS (
  SELECT strftime(fecha, '%Y-%m-%d') AS date, tipo, rows_read, rows_written,
         rows_read - rows_written AS rows_dropped, validation_failures, retailers,
         n - retailers AS retailers_empty,
         round_even(100.0 * rows_written / greatest(rows_read, 1), 2) AS completeness_pct, fecha
  FROM listados JOIN leidas USING (tipo, fecha) JOIN escritas USING (tipo, fecha))
"""
)


@_query(REPORT_VIEWS + "SELECT * EXCLUDE (fecha) FROM informe")
def quality_report(spark, sf_dir):
    return run_report(spark, sf_dir)


@_query(REPORT_VIEWS + "SELECT * FROM informe")
def quality_history(spark, sf_dir):
    return report.quality_history(run_report(spark, sf_dir))


@_query(
    sql_views("month")
    + "SELECT fecha, id_producto, descripcion_producto, marca, id_comercio, nombre_comercio,"
    " nombre_sucursal, provincia, round(precio_lista + 1e-9, 6) AS precio_lista FROM precios"
    " WHERE l_orderkey % 13 <> 0"
)
def silver_scan(spark, sf_dir):
    facts = prices(spark, sf_dir)
    gaps = facts.withColumn(
        "precio_lista", F.when(F.col("l_orderkey") % 13 != 0, F.col("precio_lista"))
    )
    return scan(gaps).select(
        "fecha",
        "id_producto",
        "descripcion_producto",
        "marca",
        "id_comercio",
        "nombre_comercio",
        "nombre_sucursal",
        "provincia",
        "precio_lista",
    )


# --- enrichment -----------------------------------------------------------------------------


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        *KEYS.split(),
        # One chain has no line in the chain file.
        F.when(F.col("l_suppkey") % 10 == 4, "x")
        .otherwise((F.col("l_suppkey") % 10).cast("string"))
        .alias("id_comercio"),
        F.lit("1").alias("id_bandera"),
        # Every 7th store has no line in the store file.
        F.when(F.col("l_suppkey") % 7 == 0, F.concat(F.lit("x"), F.col("l_suppkey").cast("string")))
        .otherwise(F.col("l_suppkey").cast("string"))
        .alias("id_sucursal"),
    )


def _store_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store file lines: each store twice, the first line right."""
    suppliers = table(spark, sf_dir, "supplier")
    copies = suppliers.withColumn("linea", F.explode(F.array(F.lit(1), F.lit(2))))
    name = F.when(F.col("linea") == 1, F.col("s_name")).otherwise("copia")
    return cleaning.normalize_columns(
        copies.select(
            F.concat(
                F.when(F.col("s_suppkey") % 10 == 4, "x").otherwise(
                    (F.col("s_suppkey") % 10).cast("string")
                ),
                F.lit(" "),
            ).alias("id_comercio"),
            F.lit("1").alias("id_bandera"),
            F.col("s_suppkey").cast("string").alias("id_sucursal"),
            name.alias("sucursales_nombre"),
            F.concat(F.lit(" ar-"), F.char(F.col("s_nationkey") % 26 + 65)).alias(
                "sucursales_provincia"
            ),
            "linea",
        ),
        [*STORE_COLUMNS, ("linea", "linea")],
    )


_FACTS = (
    "(SELECT l_orderkey, l_linenumber, CASE WHEN l_suppkey % 10 = 4 THEN 'x' ELSE"
    " CAST(l_suppkey % 10 AS VARCHAR) END AS id_comercio, '1' AS id_bandera, CASE WHEN"
    " l_suppkey % 7 = 0 THEN 'x' ELSE '' END || CAST(l_suppkey AS VARCHAR) AS id_sucursal"
    " FROM lineitem)"
)
_STORES = (
    "(SELECT CAST(s_suppkey AS VARCHAR) AS id_sucursal, s_name AS nombre_sucursal,"
    " ' ar-' || chr(s_nationkey % 26 + 65) AS provincia_codigo FROM supplier)"
)


@_query(f"SELECT * FROM {_FACTS} LEFT JOIN {_STORES} USING (id_sucursal)")
def enrich_stores(spark, sf_dir):
    stores = enrich.prepare_dimension(_store_rows(spark, sf_dir)).drop("linea")
    return enrich.enrich_stores(_facts(spark, sf_dir), stores)


@_query(
    f"SELECT * FROM {_FACTS} LEFT JOIN (SELECT DISTINCT CAST(s_suppkey % 10 AS VARCHAR)"
    " AS id_comercio, 'Razon ' || CAST(s_suppkey % 10 AS VARCHAR) AS razon_social,"
    " 'Chain ' || CAST(s_suppkey % 10 AS VARCHAR) AS nombre_comercio FROM supplier)"
    " USING (id_comercio)"
)
def enrich_chains(spark, sf_dir):
    chain = (F.col("s_suppkey") % 10).cast("string")
    lines = table(spark, sf_dir, "supplier")
    chains = cleaning.normalize_columns(
        lines.select(
            chain.alias("id_comercio"),
            F.lit("1").alias("id_bandera"),
            F.concat(F.lit("Razon "), chain).alias("comercio_razon_social"),
            F.concat(F.lit("Chain "), chain).alias("comercio_bandera_nombre"),
            F.col("s_suppkey").alias("linea"),
        ),
        [*CHAIN_COLUMNS, ("linea", "linea")],
    )
    unique = enrich.prepare_dimension(chains).drop("linea")
    return enrich.enrich_chains(_facts(spark, sf_dir), unique)


_NAMES = ", ".join(f"('{code}', '{name}')" for code, name in PROVINCE_NAMES.items())


@_query(
    f"SELECT l_orderkey, l_linenumber, id_sucursal, coalesce(nombre, upper(trim("
    f"provincia_codigo))) AS provincia FROM {_FACTS} LEFT JOIN {_STORES} USING (id_sucursal)"
    f" LEFT JOIN (VALUES {_NAMES}) AS nombres(codigo, nombre)"
    " ON codigo = upper(trim(provincia_codigo))"
)
def decode_province(spark, sf_dir):
    stores = enrich.prepare_dimension(_store_rows(spark, sf_dir)).drop("linea")
    facts = enrich.enrich_stores(_facts(spark, sf_dir), stores)
    return enrich.decode_province(facts).select(*KEYS.split(), "id_sucursal", "provincia")
