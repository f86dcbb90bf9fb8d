"""Catalogue and lake-state questions over the event, order and page tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.functions.dates import weekday_slug
from gondola.operators import aggregates, lake_state, report
from gondola.settings import WEEKDAY_SLUGS
from gondola.sources import catalogue
from gondola.sources.files import list_names, rename_new, scratch_folder, write_by_date
from gondola.sources.lake import Lake, load_quality, read_silver, write_quality
from gondola.workload.prices import index_table
from gondola.workload.records import REPORT_VIEWS, run_report
from gondola.workload.views import comparable, prices, sql_views, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _query(sql: str):
    def register(build: Query) -> Query:
        name = build.__name__
        QUERIES[name] = lambda spark, sf_dir: comparable(build(spark, sf_dir))
        SQL[name] = sql
        return build

    return register


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("fecha", F.to_date("o_orderdate"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("tipo"), F.to_date("ts").alias("fecha"), "ts", "value"
    )


_EVENTS = "(SELECT event_type AS tipo, CAST(ts AS DATE) AS fecha, ts, value FROM events)"
_ORDERS = "(SELECT *, CAST(o_orderdate AS DATE) AS fecha FROM orders)"


# --- catalogue ----------------------------------------------------------------------------


def packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON package per event type: a slot per weekday with its newest event, plus a PDF."""
    newest = (
        _events(spark, sf_dir)
        .groupBy("tipo", F.weekday("fecha").alias("dia"), weekday_slug(F.col("fecha")).alias("slug"))
        .agg(F.max("ts").alias("ts"))
    )
    resource = F.struct(
        F.initcap("slug").alias("name"),
        F.lit("ZIP").alias("format"),
        F.concat(
            F.lit("https://example.test/"), "tipo", F.lit("/SEPA_"), "slug", F.lit(".zip")
        ).alias("url"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("last_modified"),
    )
    annex = F.struct(
        F.lit("Guia de campos").alias("name"),
        F.lit("PDF").alias("format"),
        F.lit("https://example.test/guia.pdf").alias("url"),
        F.lit("2025-01-02T03:04:05.060708").alias("last_modified"),
    )
    # At most seven rows per tipo reach the list.
    slots = newest.groupBy("tipo").agg(
        F.sort_array(F.collect_list(F.struct("dia", resource.alias("r")))).alias("slots")
    )
    listed = F.concat(F.array(annex), F.transform("slots", lambda s: s["r"]))
    package = F.struct(
        F.lit(True).alias("success"), F.struct(listed.alias("resources")).alias("result")
    )
    return slots.select("tipo", F.to_json(package).alias("paquete"))


_SLUGS = "[" + ", ".join(f"'{s}'" for s in WEEKDAY_SLUGS) + "]"
_RESOURCES = f"""
(SELECT tipo, CAST(row_number() OVER (PARTITION BY tipo ORDER BY dia) AS INT) AS posicion, slug,
        'https://example.test/' || tipo || '/SEPA_' || slug || '.zip' AS url, ts,
        upper(slug[1]) || slug[2:] AS name
 FROM (SELECT tipo, isodow(fecha) AS dia, {_SLUGS}[isodow(fecha)] AS slug, max(ts) AS ts
       FROM {_EVENTS} GROUP BY ALL))"""


@_query(
    "SELECT tipo, posicion, slug, url, name,"
    f" strftime(ts, '%Y-%m-%d %H:%M:%S') AS last_modified FROM {_RESOURCES}"
)
def catalogue_resources(spark, sf_dir):
    found = catalogue.catalogue_resources(packages(spark, sf_dir))
    return found.withColumn(
        "last_modified", F.date_format("last_modified", "yyyy-MM-dd HH:mm:ss")
    )


@_query(
    f"""
WITH recursos AS (SELECT tipo, slug, url, CAST(ts AS DATE) AS publicado FROM {_RESOURCES}),
pedidos AS (
  SELECT DISTINCT tipo, fecha FROM {_EVENTS}
  UNION SELECT DISTINCT 'otro', fecha FROM {_EVENTS})
SELECT p.tipo, p.fecha, {_SLUGS}[isodow(p.fecha)] AS slug, publicado,
       CASE WHEN p.tipo NOT IN (SELECT tipo FROM recursos) THEN 'sin_recursos'
            WHEN r.slug IS NULL THEN 'sin_slot'
            WHEN publicado = p.fecha THEN 'ok'
            WHEN p.fecha < (SELECT max(CAST(ts AS DATE)) FROM events) - 7
              THEN 'fuera_de_retencion'
            ELSE 'desactualizado' END AS estado,
       CASE WHEN publicado = p.fecha THEN url END AS url
FROM pedidos p LEFT JOIN recursos r
  ON r.tipo = p.tipo AND r.slug = {_SLUGS}[isodow(p.fecha)]"""
)
def resolve_dates(spark, sf_dir):
    """Every event date of every type, and all dates of a type nobody publishes."""
    events = _events(spark, sf_dir)
    asked = events.select("tipo", "fecha").distinct()
    unknown = asked.select(F.lit("otro").alias("tipo"), "fecha").distinct()
    resources = catalogue.catalogue_resources(packages(spark, sf_dir))
    today = events.agg(F.max("fecha")).scalar()
    return lake_state.resolve_dates(asked.unionByName(unknown), resources, today)


# The pages write all their links one way; other ways are tested on pages of their own.
_LINK = r"""<a href="([^"]*)\""""


@_query(
    "SELECT page_id, CAST(len(enlaces) AS INT) AS enlaces, CASE WHEN starts_with(primero, '/')"
    " THEN regexp_extract(url, '^https?://[^/]+') || primero ELSE primero END AS primero"
    " FROM (SELECT page_id, url, enlaces, list_filter(enlaces,"
    " lambda x: regexp_matches(x, '(?i)^/t'))[1] AS primero FROM"
    f" (SELECT page_id, url, regexp_extract_all(html, '{_LINK}', 1) AS enlaces FROM pages))"
)
def page_links(spark, sf_dir):
    html = F.col("html")
    base = F.regexp_extract("url", "^https?://[^/]+", 0)
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.size(catalogue.page_links(html)).alias("enlaces"),
        catalogue.first_link(html, "(?i)^/t", base).alias("primero"),
    )


_SLUG_OF_PAGE = f"{_SLUGS}[page_id % 7 + 1]"


@_query(
    f"""SELECT page_id, CASE WHEN page_id % 3 = 0 THEN NULL
  WHEN page_id % 3 = 1 THEN regexp_extract(url, '^https?://[^/]+') || '/datos/SEPA_' || {_SLUG_OF_PAGE} || '.zip'
  ELSE 'https://archivo.test/sepa_' || {_SLUG_OF_PAGE} || '.ZIP' END AS enlace FROM pages"""
)
def archive_links(spark, sf_dir):
    """Each page asks for one weekday. A list of archive links is put behind its html: for a third
    of the pages only other weekdays' and near misses, else the right one after those."""
    dates = F.date_add(F.lit("2026-07-20").cast("date"), (F.col("page_id") % 7).cast("int"))  # from a Monday
    slug = weekday_slug(dates)
    other = weekday_slug(F.date_add(dates, 1))
    link = lambda *parts: F.concat(F.lit("<a class='x' href='"), *parts, F.lit("'>zip</a>"))
    wrong = F.concat(link(F.lit("/datos/sepa_"), other, F.lit(".zip")), link(F.lit("/datos/sepa_"), slug, F.lit(".zip.html")))
    right = F.when(F.col("page_id") % 3 == 1, link(F.lit("/datos/SEPA_"), slug, F.lit(".zip"))).when(
        F.col("page_id") % 3 == 2, link(F.lit("https://archivo.test/sepa_"), slug, F.lit(".ZIP"))
    )
    html = F.concat("html", wrong, F.coalesce(right, F.lit("")))
    base = F.regexp_extract("url", "^https?://[^/]+", 0)
    return table(spark, sf_dir, "pages").select("page_id", catalogue.archive_link(html, dates, base).alias("enlace"))


# --- lake state ---------------------------------------------------------------------------------


@_query(f"SELECT DISTINCT fecha FROM {_ORDERS}")
def partition_inventory(spark, sf_dir):
    return lake_state.partition_inventory(_orders(spark, sf_dir))


@_query(
    "SELECT CAST(d AS DATE) AS fecha, CAST(d AS DATE) IN"
    f" (SELECT fecha FROM {_ORDERS} WHERE o_orderstatus = 'P') AS presente"
    f" FROM generate_series((SELECT min(fecha) FROM {_ORDERS}),"
    f" (SELECT max(fecha) FROM {_ORDERS}), INTERVAL 1 DAY) AS s(d)"
)
def coverage_calendar(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    loaded = orders.where(F.col("o_orderstatus") == "P")
    return lake_state.coverage_calendar(
        loaded, orders.agg(F.min("fecha")).scalar(), orders.agg(F.max("fecha")).scalar()
    )


_HELD = f"(SELECT DISTINCT tipo, fecha FROM {_EVENTS} WHERE hour(ts) = 1)"
_GAPS = """
WITH dias AS (SELECT CAST(d AS DATE) AS fecha FROM generate_series({desde}, {hasta}, INTERVAL 1 DAY) AS s(d)),
faltan AS (
  SELECT tipo, d.fecha FROM (SELECT tipo, min(fecha) AS a, max(fecha) AS z FROM {held} GROUP BY tipo) t
  JOIN dias d ON {inside} EXCEPT SELECT tipo, fecha FROM {held}),
islas AS (SELECT *, fecha - CAST(row_number() OVER (PARTITION BY tipo ORDER BY fecha) AS INT) AS isla FROM faltan),
huecos AS (SELECT tipo, min(fecha) AS desde, max(fecha) AS hasta, CAST(count(*) AS INT) AS dias FROM islas GROUP BY tipo, isla)
"""
_EVENT_ENDS = {"desde": f"(SELECT min(fecha) FROM {_EVENTS})", "hasta": f"(SELECT max(fecha) FROM {_EVENTS})", "held": _HELD}


@_query(_GAPS.format(**_EVENT_ENDS, inside="true") + "SELECT * FROM huecos")
def coverage_gaps(spark, sf_dir):
    """Dates with an event after 1 am are in the lake; gaps of each type over all events' dates."""
    events = _events(spark, sf_dir)
    ends = [events.agg(f("fecha")).scalar() for f in (F.min, F.max)]
    return lake_state.coverage_gaps(events.where(F.hour("ts") == 1), *ends)


@_query(
    _GAPS.format(**_EVENT_ENDS, inside="d.fecha BETWEEN a AND z")
    + f"""SELECT tipo, desde, hasta, presentes, CAST(hasta - desde + 1 - presentes AS BIGINT) AS faltantes,
  (SELECT count(*) FROM huecos WHERE huecos.tipo = t.tipo) AS huecos,
  coalesce((SELECT max(dias) FROM huecos WHERE huecos.tipo = t.tipo), 0) AS hueco_mayor
FROM (SELECT tipo, min(fecha) AS desde, max(fecha) AS hasta, count(*) AS presentes FROM {_HELD} GROUP BY tipo) t"""
)
def coverage_counts(spark, sf_dir):
    return lake_state.coverage_counts(_events(spark, sf_dir).where(F.hour("ts") == 1))


@_query(
    f"WITH p AS (SELECT DISTINCT tipo, fecha FROM {_EVENTS}), n AS (SELECT *, row_number()"
    " OVER (PARTITION BY tipo ORDER BY fecha DESC) AS edad FROM p)"
    " SELECT tipo, fecha FROM n WHERE edad <= 20 AND (tipo, fecha) NOT IN"
    f" (SELECT (tipo, fecha) FROM {_EVENTS} WHERE hour(ts) = 1)"
)
def missing_dates(spark, sf_dir):
    """Dates with events are published; those with an event after 1 am are in the lake."""
    events = _events(spark, sf_dir)
    return lake_state.missing_dates(events, events.where(F.hour("ts") == 1), newest=20)


@_query(
    "SELECT CAST(d AS DATE) AS fecha FROM"
    f" generate_series((SELECT min(fecha) FROM {_ORDERS}),"
    f" (SELECT max(fecha) FROM {_ORDERS}), INTERVAL 1 DAY) AS s(d) WHERE CAST(d AS DATE)"
    f" NOT IN (SELECT fecha FROM {_ORDERS} WHERE o_orderpriority = '1-URGENT')"
)
def backfill_plan(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    archived = orders.where(F.col("o_orderpriority") == "1-URGENT")
    return lake_state.backfill_plan(
        archived, orders.agg(F.min("fecha")).scalar(), orders.agg(F.max("fecha")).scalar()
    )


@_query(
    "SELECT tipo, fecha FROM (SELECT tipo, fecha, row_number() OVER (PARTITION BY tipo"
    " ORDER BY fecha DESC) AS edad FROM (SELECT DISTINCT o_orderpriority AS tipo, fecha"
    f" FROM {_ORDERS})) WHERE edad > 7"
)
def retention_plan(spark, sf_dir):
    archived = _orders(spark, sf_dir).withColumnRenamed("o_orderpriority", "tipo")
    return lake_state.retention_plan(archived, 7)


@_query(
    "SELECT tipo, count(*) AS total, count(*) FILTER (WHERE value < 150) AS exitosas,"
    " count(*) FILTER (WHERE value >= 150) AS fallidas, count(*) FILTER (WHERE value >= 150)"
    f" = 0 AS ok FROM {_EVENTS} GROUP BY tipo"
)
def run_outcomes(spark, sf_dir):
    """Every event is an attempt; large values are errors."""
    error = F.when(F.col("value") >= 150, "boom")
    return lake_state.run_outcomes(_events(spark, sf_dir).withColumn("error", error))


@_query(
    "SELECT min(fecha) AS desde, max(fecha) AS hasta FROM (SELECT fecha FROM"
    f" {_ORDERS} UNION ALL SELECT fecha FROM {_EVENTS} UNION ALL"
    " SELECT CAST(l_shipdate AS DATE) FROM lineitem)"
)
def date_bounds(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("fecha"))
    return aggregates.date_bounds(_orders(spark, sf_dir), _events(spark, sf_dir), lines)


@_query(REPORT_VIEWS + "SELECT * EXCLUDE (fecha) FROM informe WHERE tipo = 'minorista'")
def quality_load(spark, sf_dir):
    """The reports of all dates, stored as the jobs store them, beside files of reports cut short."""
    place = Lake(scratch_folder(spark, "reports"))
    reports = run_report(spark, sf_dir)
    write_quality(reports, place, "minorista")
    cut = f"{place.quality('minorista')}/cortados"
    reports.select(F.substring(F.to_json(F.struct("*")), 1, 20).alias("value")).write.text(cut)
    for name in list_names(spark, cut):
        rename_new(spark, f"{cut}/{name}", f"{cut}/{name.removesuffix('.txt')}.json")
    return load_quality(spark, place, "minorista")


@_query(
    sql_views("year")
    + "SELECT fecha, id_producto, CASE WHEN year(fecha) % 3 <> 1 THEN marca END AS marca,"
    " provincia, round(precio_lista + 1e-9, 6) AS precio_lista FROM precios"
)
def drifted_scan(spark, sf_dir):
    """Facts stored in three ways: as declared, with prices as text and no brands, with a column
    more."""
    place = Lake(scratch_folder(spark, "silver"))
    facts = prices(spark, sf_dir, "year").select("fecha", "id_producto", "marca", "provincia", "precio_lista")
    way = F.year("fecha") % 3
    as_text = facts.where(way == 1).withColumn("precio_lista", F.col("precio_lista").cast("string"))
    for part in (facts.where(way == 0), as_text.drop("marca"), facts.where(way == 2).withColumn("fecha_carga", F.col("fecha"))):
        write_by_date(part, place.silver("minorista"))
    read = read_silver(spark, place, "minorista")
    return read.select("fecha", "id_producto", "marca", "provincia", "precio_lista")


# --- headline -----------------------------------------------------------------------------------


_DIRECTION = (
    "CASE WHEN {0} IS NULL THEN NULL WHEN abs({0}) < 0.005 THEN 'flat' WHEN {0} > 0 THEN 'up'"
    " ELSE 'down' END"
)


@_query(
    sql_views("month")
    + REPORT_VIEWS.replace("\nWITH crudos", ", crudos", 1)
    + """SELECT i.fecha, fecha_previa, n AS dias,
  round(indice_matched_base100 + 1e-9, 6) AS indice_matched_base100,
  round(variacion_matched_pct + 1e-9, 6) AS variacion_matched_pct,
  """
    + _DIRECTION.format("variacion_matched_pct")
    + """ AS sentido_matched, round(indice_precio_global + 1e-9, 6) AS indice_precio_global,
  round(variacion_diaria_pct + 1e-9, 6) AS variacion_promedio_pct,
  """
    + _DIRECTION.format("variacion_diaria_pct")
    + """ AS sentido_promedio,
  round(pct_productos_con_cambio + 1e-9, 6) AS pct_productos_con_cambio, productos_comparables,
  (SELECT max_by(completeness_pct, fecha) FROM informe WHERE tipo = 'minorista')
    AS calidad_pct,
  (SELECT max_by(validation_failures, fecha) FROM informe WHERE tipo = 'minorista')
    AS fallas_validacion
FROM (SELECT *, lag(fecha) OVER (ORDER BY fecha) AS fecha_previa,
             row_number() OVER (ORDER BY fecha) AS n FROM indice) i
ORDER BY i.fecha DESC LIMIT 1"""
)
def headline_kpis(spark, sf_dir):
    reports = report.quality_history(run_report(spark, sf_dir))
    return report.headline_kpis(
        index_table(spark, sf_dir), reports.where(F.col("tipo") == "minorista")
    )
