import datetime as dt
from pathlib import Path

import pytest
from support import (
    CHAINS,
    DATE,
    PRODUCTS,
    STORES,
    WHOLESALE_PRODUCTS,
    WHOLESALE_STORES,
    inner_zip,
    retail_archive,
    rows,
    write_archive,
)

from gondola import Settings
from gondola.operators.lake_state import run_outcomes
from gondola.plans import daily
from gondola.plans import silver as plan
from gondola.plans.daily import prune_raw, run_daily
from gondola.plans.gold import NoSilverData, catch_up_plan, refresh_gold
from gondola.sources import archive
from gondola.sources.archive import archive_status, read_archives, read_entries
from gondola.sources.lake import (
    Lake,
    load_gold,
    load_quality,
    read_silver,
    stored_dates,
    write_quality,
)
from gondola.sources.published import Draft

DAY = dt.date.fromisoformat(DATE)


@pytest.fixture
def place(tmp_path):
    return Lake(str(tmp_path / "lake"))


def test_lines_of_readable_retailers_only(spark, tmp_path):
    retail_archive(tmp_path)
    raw = read_archives(spark, str(tmp_path))
    place = f"sepa_minorista_{DATE}.zip/{DATE}"
    assert {r[0] for r in rows(raw, "archivo")} == {f"{place}/a_retail", f"{place}/d_no_products"}
    found = raw.where("miembro = 'productos'").collect()
    assert len(found) == 1 and found[0].fecha == DAY and found[0].tipo == "minorista"
    # A quoted delimiter does not split a field.
    assert found[0].lineas[1][5] == "CREMA | 60 G"


def test_every_retailer_is_read_once_whatever_the_split(spark, tmp_path):
    many = {f"r{i:02}": inner_zip(productos=PRODUCTS * (i % 3 + 1)) for i in range(9)}
    write_archive(tmp_path, "minorista", DATE, **many)
    size = write_archive(tmp_path, "minorista", DATE, **many).stat().st_size
    for tasks in (1, 4, 20):
        raw = read_archives(spark, str(tmp_path), taskBytes=-(-size // tasks))
        assert raw.rdd.getNumPartitions() == tasks
        marks = rows(raw.where("miembro is null"), "archivo")
        assert sorted(m[0].rpartition("/")[2] for m in marks) == sorted(many)


def test_dates_list_only_their_folders(spark, tmp_path):
    write_archive(tmp_path, "minorista", DATE, b=inner_zip(productos=PRODUCTS), a=b"")
    write_archive(tmp_path, "minorista", "2026-07-22", c=inner_zip(productos=PRODUCTS))
    for root in (tmp_path, tmp_path / "minorista"):
        later = read_archives(spark, str(root), dates="2026-07-22")
        assert {r[0].rpartition("/")[2] for r in rows(later, "archivo")} == {"c"}
    reader = archive._EntriesReader({"path": str(tmp_path), "dates": f"2026-07-22,{DATE}"})
    folders = list(reader.folders(*archive._open_fs(str(tmp_path))))
    assert all(f.endswith((DATE, "2026-07-22")) for f in folders)


def test_paths_open_what_spark_opens(monkeypatch):
    made = []
    monkeypatch.setattr(archive.fs, "S3FileSystem", lambda **kw: made.append(kw) or "s3")
    for scheme in ("s3", "s3a", "s3n"):
        assert archive._open_fs(f"{scheme}://bucket/lake/x", {"access_key": "k"}) == ("s3", "bucket/lake/x")
    assert made == [{"access_key": "k"}] * 3
    for path in ("/a/b", "file:/a/b", "file:///a/b"):
        assert archive._open_fs(path)[1] == "/a/b"
    options = {"path": "s3a://bucket/x", "s3.endpoint_override": "h:9", "taskBytes": "5"}
    assert archive._EntriesReader(options).s3 == {"endpoint_override": "h:9"}


def test_equal_names_in_two_raw_files_stay_apart(spark, place):
    def named(text):
        return inner_zip(productos=PRODUCTS, sucursales=STORES.replace("CENTRO", text))

    first = write_archive(f"{place.root}/bronze", "minorista", DATE, a=named("UNO"))
    first.rename(first.with_name("otra.zip"))
    write_archive(f"{place.root}/bronze", "minorista", DATE, a=named("DOS"))
    plan.publish_silver(spark, place, "minorista", [DATE])
    got = read_silver(spark, place, "minorista").groupBy("nombre_sucursal").count()
    assert sorted(rows(got)) == [("DOS", 3), ("UNO", 3)]
    assert load_quality(spark, place, "minorista").first().retailers == 2


def test_latin1_member_is_decoded_as_a_whole(spark, tmp_path):
    text = "id_comercio|sucursales_nombre\n" + "".join(f"{i}|plain\n" for i in range(5000))
    text += "9|Córdoba\n"
    write_archive(
        tmp_path, "minorista", DATE, a=inner_zip("latin-1", productos=text), b=inner_zip(productos="")
    )
    raw = read_archives(spark, str(tmp_path)).where("miembro = 'productos'")
    lines = plan.resolve_layout(
        raw, [("id_comercio", "id_comercio"), ("sucursales_nombre", "nombre")]
    ).orderBy("linea")
    assert lines.count() == 5001
    assert lines.tail(1)[0].asDict() | {"linea": 0} == {
        "tipo": "minorista",
        "fecha": DAY,
        "archivo": f"sepa_minorista_{DATE}.zip/{DATE}/a",
        "miembro": "productos",
        "linea": 0,
        "id_comercio": "9",
        "nombre": "Córdoba",
    }


def test_archive_status(spark, tmp_path):
    def put(day, data):
        path = write_archive(tmp_path, "minorista", day)
        if data is not None:
            path.write_bytes(data)

    retail_archive(tmp_path)
    write_archive(tmp_path, "minorista", "2026-07-14", folder=DATE, a=b"x")
    write_archive(tmp_path, "minorista", "2026-07-15", folder="carpeta", a=b"x")
    put("2026-07-16", b"")
    put("2026-07-17", b"this is not a zip file")
    put("2026-07-18", b"PK\x05\x06" + bytes(18))
    entries = read_entries(spark, str(tmp_path))
    strict = {str(r.fecha): (r.estado, r.aceptado) for r in archive_status(entries).collect()}
    assert strict == {
        DATE: ("ok", True),
        "2026-07-14": ("otra_fecha", False),
        "2026-07-15": ("sin_fecha", True),
        "2026-07-16": ("vacio", False),
        "2026-07-17": ("no_es_zip", False),
        "2026-07-18": ("sin_entradas", False),
    }
    lenient = {str(r.fecha): r.aceptado for r in archive_status(entries, strict=False).collect()}
    assert lenient["2026-07-14"] and not lenient["2026-07-17"]


def test_retail_archive_end_to_end(spark, place):
    retail_archive(f"{place.root}/bronze")
    outcomes = plan.publish_silver(spark, place, "minorista", [DATE])
    plan.require_ok(outcomes)
    got = read_silver(spark, place, "minorista").orderBy("id_producto")
    assert rows(got, "id_producto", "precio_lista", "marca", "nombre_sucursal", "provincia") == [
        ("101", 3700.0, None, "CENTRO", "Ciudad Autónoma de Buenos Aires"),
        ("102", 12250.0, "MARCA UNO", "CENTRO", "Ciudad Autónoma de Buenos Aires"),
        ("103", 960.25, "MARCA DOS", "CENTRO", "Ciudad Autónoma de Buenos Aires"),
    ]
    assert rows(got, "nombre_comercio", "razon_social", "id_comercio")[0] == (
        "TIENDA SUR",
        "RAZON SUR",
        "4",
    )
    report = load_quality(spark, place, "minorista").first()
    assert (report.rows_read, report.rows_written, report.validation_failures) == (5, 3, 0)
    assert (report.retailers, report.retailers_empty, report.completeness_pct) == (1, 1, 60.0)


def test_wholesale_layout(spark, place):
    inner = inner_zip(productos=WHOLESALE_PRODUCTS, sucursales=WHOLESALE_STORES)
    write_archive(f"{place.root}/bronze", "mayorista", DATE, a=inner)
    plan.require_ok(plan.publish_silver(spark, place, "mayorista", [DATE]))
    got = read_silver(spark, place, "mayorista").orderBy("precio_lista")
    assert rows(got, "precio_lista", "unidad_medida", "provincia") == [
        (733.25, "BULTO", "San Juan"),
        (1988.5, "BULTO", "San Juan"),
    ]


def test_dimensions_stay_within_their_archive(spark, place):
    def named(text):
        return inner_zip(productos=PRODUCTS, sucursales=STORES.replace("CENTRO", text))

    write_archive(f"{place.root}/bronze", "minorista", DATE, a=named("UNO"), b=named("DOS"))
    plan.publish_silver(spark, place, "minorista", [DATE])
    got = read_silver(spark, place, "minorista").groupBy("nombre_sucursal").count()
    assert sorted(rows(got)) == [("DOS", 3), ("UNO", 3)]


def test_nothing_of_an_earlier_run_is_left(spark, place):
    bronze = f"{place.root}/bronze"
    inner = {"productos": PRODUCTS, "sucursales": STORES, "comercio": CHAINS}
    write_archive(bronze, "minorista", DATE, a=inner_zip(**inner))
    plan.publish_silver(spark, place, "minorista", [DATE])
    # The same archive comes again without stores and chains.
    write_archive(bronze, "minorista", DATE, a=inner_zip(productos=PRODUCTS))
    plan.publish_silver(spark, place, "minorista", [DATE])
    got = read_silver(spark, place, "minorista").select("nombre_sucursal", "razon_social")
    assert set(rows(got)) == {(None, None)}
    assert not list(Path(place.root, "_staging").glob("*"))


def test_full_gold_drops_dates_silver_lost(spark, place):
    bronze = f"{place.root}/bronze"
    for day in ("2026-07-20", DATE):
        write_archive(bronze, "minorista", day, a=inner_zip(productos=PRODUCTS))
    plan.publish_silver(spark, place, "minorista", ["2026-07-20", DATE])
    refresh_gold(spark, place, "minorista")
    draft = Draft(spark, place.silver_root("minorista"))
    draft.drop_dates("precios", [dt.date(2026, 7, 20)])
    draft.publish()
    tables = refresh_gold(spark, place, "minorista")
    for name in ("daily_product_prices", "store_stats", "daily_inflation_index"):
        assert {str(r.fecha) for r in tables[name].select("fecha").collect()} == {DATE}


def test_violations_and_empty_dates_are_not_published(spark, place):
    bronze = f"{place.root}/bronze"
    bad = PRODUCTS.replace("|101|", "||")
    write_archive(bronze, "minorista", DATE, a=inner_zip(productos=bad))
    write_archive(bronze, "minorista", "2026-07-22", a=inner_zip(sucursales=STORES))
    write_archive(bronze, "minorista", "2026-07-23", a=inner_zip(productos=PRODUCTS))
    days = [DATE, "2026-07-22", "2026-07-23", "2026-07-24"]
    outcomes = plan.publish_silver(spark, place, "minorista", days)
    errors = {str(o.fecha): o.error for o in outcomes}
    assert errors[DATE] == "1 contract violations"
    assert errors["2026-07-22"].startswith("no rows") and errors["2026-07-23"] is None
    assert errors["2026-07-24"].startswith("no rows")
    published = read_silver(spark, place, "minorista").select("fecha").distinct()
    assert [str(r.fecha) for r in published.collect()] == ["2026-07-23"]
    with pytest.raises(plan.ValidationFailed):
        plan.require_ok(outcomes)
    with pytest.raises(plan.NoRows):
        plan.require_ok(outcomes[1:])
    allowed = plan.publish_silver(spark, place, "minorista", [DATE], allow_violations=True)
    plan.require_ok(allowed)
    assert read_silver(spark, place, "minorista").count() == 6


def test_category_filter_setting(spark, place):
    retail_archive(f"{place.root}/bronze")
    only = Settings(category_filter=True, food_keywords=("leché",))
    plan.require_ok(plan.publish_silver(spark, place, "minorista", [DATE], only))
    assert rows(read_silver(spark, place, "minorista"), "id_producto") == [("103",)]


def test_rerun_replaces_and_gold_follows(spark, place, frame):
    bronze = f"{place.root}/bronze"
    inner = {"sucursales": STORES, "comercio": CHAINS}
    with pytest.raises(NoSilverData):
        refresh_gold(spark, place, "minorista")
    for day, price in (("2026-07-20", "3700.00"), (DATE, "4070.00")):
        text = PRODUCTS.replace("3700.00", price)
        write_archive(bronze, "minorista", day, a=inner_zip(productos=text, **inner))
    plan.publish_silver(spark, place, "minorista", ["2026-07-20"])
    refresh_gold(spark, place, "minorista")
    plan.publish_silver(spark, place, "minorista", [DATE, "2026-07-20"])
    plan.publish_silver(spark, place, "minorista", [DATE])
    assert read_silver(spark, place, "minorista").count() == 6
    partial = refresh_gold(spark, place, "minorista", dates=[DAY])
    assert {n: df.count() for n, df in partial.items()} == {
        "daily_product_prices": 6,
        "store_stats": 2,
        "province_product_prices": 6,
        "daily_inflation_index": 2,
    }
    # A middle date comes late: its own row and its successor's are made anew.
    write_archive(bronze, "minorista", "2026-07-19", a=inner_zip(productos=PRODUCTS.replace("3700.00", "4000.00"), **inner))
    plan.publish_silver(spark, place, "minorista", ["2026-07-19"])
    partial = refresh_gold(spark, place, "minorista", dates=[dt.date(2026, 7, 19)])
    before = {name: sorted(rows(df), key=str) for name, df in partial.items()}
    full = refresh_gold(spark, place, "minorista")
    for name, df in full.items():
        assert sorted(rows(df), key=str) == before[name]
    last = full["daily_inflation_index"].orderBy("fecha").tail(1)[0]
    assert last.variacion_matched_pct == pytest.approx(10 / 3)

    offered = frame(
        "tipo string, last_modified string",
        ("minorista", "2026-07-20"),
        ("minorista", DATE),
        ("minorista", "2026-07-22"),
        ("mayorista", "2026-07-23"),
    )
    todo = catch_up_plan(spark, place, "minorista", offered)
    assert [str(r.fecha) for r in todo.collect()] == ["2026-07-22"]


def test_daily_run_catches_up_reports_and_prunes(spark, place):
    bronze = f"{place.root}/bronze"
    for day in ("2026-07-20", DATE):
        write_archive(bronze, "minorista", day, a=inner_zip(productos=PRODUCTS))
    write_archive(bronze, "minorista", "2026-07-19", a=inner_zip(sucursales=STORES))
    # Filed under the 18th, dated otherwise.
    write_archive(bronze, "minorista", "2026-07-18", folder=DATE, a=inner_zip(productos=PRODUCTS))
    outcomes = run_daily(spark, place)
    assert {r[0]: tuple(r[1:]) for r in run_outcomes(outcomes).collect()} == {
        "minorista": (4, 2, 2, False),
        "mayorista": (0, 0, 0, True),
    }
    told = {(r.paso, str(r.fecha)): r.error for r in outcomes.where("tipo = 'minorista'").collect()}
    assert told["silver", "2026-07-18"] == "archive: otra_fecha"
    assert told["silver", "2026-07-19"].startswith("no rows")
    assert told["silver", DATE] is None and told["gold", "None"] is None
    assert load_gold(spark, place, "minorista")["daily_inflation_index"].count() == 2
    assert prune_raw(spark, place, "minorista", Settings(raw_keep_days=0)) == []
    # Only what Silver holds is retired; refused and failed dates keep their only copy.
    last = run_daily(spark, place, ["minorista"], Settings(raw_keep_days=1), prune=True)
    gone = [str(r.fecha) for r in last.where("paso = 'retirada'").collect()]
    assert gone == ["2026-07-20"]
    assert [str(r.fecha) for r in stored_dates(spark, place.bronze("minorista")).collect()] == ["2026-07-18", "2026-07-19", DATE]
    assert read_silver(spark, place, "minorista").count() == 6
    lenient = run_daily(spark, place, ["minorista"], strict=False)
    assert lenient.where("paso = 'silver' and error is null").count() == 1


def test_all_pending_dates_are_ingested(spark, place):
    days = [f"2026-07-{d:02}" for d in range(11, 21)]
    for day in days:
        write_archive(f"{place.root}/bronze", "minorista", day, a=inner_zip(productos=PRODUCTS))
    done = run_daily(spark, place, ["minorista"]).where("paso = 'silver' and error is null")
    assert sorted(str(r.fecha) for r in done.collect()) == days
    assert rows(run_daily(spark, place, ["minorista"])) == [("minorista", "corrida", None, None)]


def test_a_failed_gold_refresh_is_made_up_for(spark, place, monkeypatch):
    write_archive(f"{place.root}/bronze", "minorista", DATE, a=inner_zip(productos=PRODUCTS))

    def fail(*args):
        raise RuntimeError("no Gold today")

    monkeypatch.setattr(daily, "refresh_gold", fail)
    told = {(r.paso, str(r.fecha)): r.error for r in run_daily(spark, place, ["minorista"]).collect()}
    assert told == {("silver", DATE): None, ("gold", "None"): "no Gold today"}
    monkeypatch.undo()
    assert [r[1] for r in rows(run_daily(spark, place, ["minorista"]))] == ["gold"]
    assert load_gold(spark, place, "minorista")["daily_product_prices"].count() == 3


def test_stored_dates_are_folder_names(spark, tmp_path):
    assert stored_dates(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "fecha=2026-07-02").mkdir()
    (tmp_path / "_temporary").mkdir()
    (tmp_path / "fecha=other").mkdir()
    assert [str(r.fecha) for r in stored_dates(spark, str(tmp_path)).collect()] == ["2026-07-02"]


def test_unwritable_report_does_not_raise(spark, frame, tmp_path):
    (tmp_path / "silver").write_text("a file where a folder should be")
    report = frame("date string, tipo string", (DATE, "m"))
    assert write_quality(report, Lake(str(tmp_path)), "m") is False
