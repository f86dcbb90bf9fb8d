from support import rows
from pyspark.sql import functions as F

from gondola import Settings
from gondola.functions.numbers import direction, to_number
from gondola.functions.text import strip
from gondola.operators import cleaning as c
from gondola.operators.enrich import (
    decode_province,
    enrich_chains,
    enrich_stores,
    prepare_dimension,
)
from gondola.operators.joins import first_per_key
from gondola.operators.quality import contract_failures, quality_report
from gondola.schemas import SILVER_COLUMNS
from gondola.settings import PRODUCT_COLUMNS, PROVINCE_NAMES


def test_header_is_cleaned_and_unmapped_columns_go(frame):
    df = frame("a string, b string, c string", ("4", "9.5", "x")).toDF(
        "﻿ID_COMERCIO ", "productos_precio_lista", "columna_desconocida"
    )
    out = c.normalize_columns(df, PRODUCT_COLUMNS)
    assert out.columns == ["id_comercio", "precio_lista"]
    assert rows(out) == [("4", "9.5")]


def test_first_existing_source_wins_even_when_null(frame):
    df = frame(
        "precio_unitario_bulto_por_unidad_venta_con_iva string, productos_precio_lista string",
        ("7", None),
    )
    out = c.normalize_columns(df, PRODUCT_COLUMNS)
    assert out.columns == ["precio_lista"] and rows(out) == [(None,)]


def test_flag_column_never_becomes_the_product_id(frame):
    df = frame("productos_ean string, id_producto string", ("1", "779"))
    assert rows(c.normalize_columns(df, PRODUCT_COLUMNS)) == [("779",)]


def test_repeated_headers_keep_the_first(frame):
    df = frame("a string, b string", ("1", "2")).toDF("id_producto", "ID_PRODUCTO")
    assert rows(c.normalize_columns(df, PRODUCT_COLUMNS)) == [("1",)]


def test_layout_is_resolved_per_batch(spark):
    batches = spark.createDataFrame(
        [
            (1, ["﻿ID_Producto", "productos_precio_lista"], [["a", "1"], ["b"], ["c", "2", "3"]]),
            (1, ["precio_unitario_bulto_por_unidad_venta_con_iva", "id_producto"], [["9", "NA"]]),
        ],
        "primera_linea bigint, encabezado array<string>, lineas array<array<string>>",
    )
    out = c.resolve_layout(batches, PRODUCT_COLUMNS)
    assert sorted(rows(out, "linea", "id_producto", "precio_lista"), key=str) == [
        (1, "a", "1"),
        (1, None, "9"),
        (2, "b", None),
    ]


def test_footers_and_blank_keys_are_dropped(frame):
    keys = ["4", " ", "nan", None, "Ultima actualizacion: x", " última actualización: y"]
    # The same accents as separate combining marks.
    keys.append("última actualización: z")
    df = frame("id_comercio string", *[(k,) for k in keys])
    assert rows(c.strip_footer(df)) == [("4",)]
    assert c.strip_footer(frame("otra string", ("a",))).count() == 1


def test_strip_removes_all_white_space(frame):
    df = frame("t string", ("\t a b  \n",))
    assert rows(df.select(strip(F.col("t")))) == [("a b",)]


def test_numbers_are_parsed_like_numbers_only(frame):
    cases = {"10.5": 10.5, " 7 ": 7.0, "1e3": 1000.0, "+5": 5.0, ".5": 0.5, "5.": 5.0}
    cases |= {"N/D": None, "10d": None, "10f": None, "0x1p3": None, "": None, "1,5": None}
    df = frame("t string", *[(t,) for t in cases])
    assert dict(rows(df.select("t", to_number(F.col("t"))))) == cases


def test_prices_outside_the_band_are_dropped(frame):
    df = frame("precio_lista string", ("10.5",), ("N/D",), ("-99",), ("0",), ("1e12",), ("inf",))
    assert rows(c.clean_prices(df)) == [(10.5,)]
    assert c.clean_prices(frame("id_producto string", ("1",))).count() == 0


def test_placeholders_become_null(frame):
    df = frame("marca string", (" MARCA DOS ",), (" ",), ("Sin marca",), ("nan",), ("S/D",))
    assert rows(c.clean_strings(df)) == [("MARCA DOS",)] + [(None,)] * 4


def test_category_filter_ignores_accents_and_prefers_rubro(frame):
    df = frame("descripcion_producto string", ("PANADERÍA fina",), ("JABON",), (None,))
    assert rows(c.category_filter(df, ("panaderia",))) == [("PANADERÍA fina",)]
    both = frame("rubro string, descripcion_producto string", ("x", "leche"), ("LECHE", "y"))
    assert rows(c.category_filter(both, ("leche",))) == [("LECHE", "y")]


def test_conform_gives_the_whole_contract(frame):
    out = c.conform_silver(frame("precio_lista string, latitud string", ("9", "x")))
    assert tuple(out.columns) == SILVER_COLUMNS
    assert rows(out, "precio_lista", "latitud", "marca") == [(9.0, None, None)]


# --- joins -----------------------------------------------------------------------------------


def _fact(frame):
    return frame(
        "id_comercio string, id_bandera string, id_sucursal string, n int",
        *[("4", "1", "289", i) for i in range(6)],
        ("5", "1", "1", 6),
    )


def test_enrichment_decodes_and_never_fans_out(frame):
    stores = frame(
        "id_comercio string, id_bandera string, id_sucursal string, nombre_sucursal string,"
        " provincia_codigo string, linea int",
        ("4 ", "1", "289", "COPIA", "AR-B", 9),
        ("4", "1", "289", "CENTRO", " ar-c", 2),
        ("Ultima actualizacion: x y z", None, None, None, None, 10),
    )
    chains = frame(
        "id_comercio string, id_bandera string, nombre_comercio string, linea int",
        ("4", "1", "ESTACION", 1),
    )
    facts = enrich_stores(_fact(frame), prepare_dimension(stores).drop("linea"))
    out = decode_province(enrich_chains(facts, prepare_dimension(chains).drop("linea")))
    got = rows(out.orderBy("n"), "n", "nombre_sucursal", "nombre_comercio", "provincia")
    known = PROVINCE_NAMES["AR-C"]
    assert got == [(i, "CENTRO", "ESTACION", known) for i in range(6)] + [(6, None, None, None)]


def test_fact_column_wins_over_dimension_column(frame):
    facts = frame("id_comercio string, id_bandera string, nombre_comercio string", ("4", "1", "F"))
    chains = frame("id_comercio string, id_bandera string, nombre_comercio string", ("4", "1", "D"))
    assert rows(enrich_chains(facts, chains), "nombre_comercio") == [("F",)]


def test_unknown_province_codes_pass_through(frame):
    df = frame("provincia_codigo string", ("xx-1",), (" ",), (None,), ("nan",))
    assert rows(decode_province(df), "provincia") == [("XX-1",), (None,), (None,), (None,)]


def test_stores_join_without_a_job_and_without_fan_out(spark, frame):
    facts = _fact(frame)
    stores = frame(
        "id_comercio string, id_bandera string, id_sucursal string, nombre_sucursal string",
        ("4", "1", "289", "A"),
        ("5", "1", "1", "B"),
    )
    spark.sparkContext.setJobGroup("plan only", "building the join runs nothing")
    out = enrich_stores(facts, stores)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("plan only")
    assert sorted(rows(out, "n", "nombre_sucursal")) == [(i, "A") for i in range(6)] + [(6, "B")]


def test_first_per_key_without_other_columns(frame):
    assert rows(first_per_key(frame("k string", ("a",), ("a",)), ["k"], ["k"])) == [("a",)]


# --- contract and report ------------------------------------------------------------------------


def test_contract_failures_one_row_per_rule(frame):
    df = frame(
        "id_producto string, id_comercio string, id_sucursal string, precio_lista double",
        ("1", "1", "1", 10.0),
        (None, "1", None, 10.0),
        ("1", "1", "1", 1e9),
        ("1", "1", "1", None),
    )
    assert sorted(rows(contract_failures(df), "columna", "regla")) == [
        ("id_producto", "not_nullable"),
        ("id_sucursal", "not_nullable"),
        ("precio_lista", "max_price"),
        ("precio_lista", "not_nullable"),
    ]


def test_quality_report_counts_empty_retailers(frame):
    prepared = frame(
        "tipo string, fecha date, archivo string, ok boolean, bad bigint",
        ("m", "2026-07-21", "a", True, 1),
        ("m", "2026-07-21", "a", True, 0),
        ("m", "2026-07-21", "b", False, 5),
    )
    listed = frame(
        "tipo string, fecha date, archivo string",
        *[("m", "2026-07-21", a) for a in "abc"],
    )
    report = quality_report(prepared, listed, F.col("ok"), F.col("bad"))
    assert rows(report) == [("2026-07-21", "m", 3, 2, 1, 1, 1, 2, 66.67)]


def test_direction_classes(frame):
    df = frame("d double", (0.004,), (-0.004,), (1.0,), (-1.0,), (None,))
    assert [r[0] for r in rows(df.select(direction(F.col("d"))))] == [
        "flat",
        "flat",
        "up",
        "down",
        None,
    ]
