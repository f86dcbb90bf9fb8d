import json

import pytest
from support import rows
from pyspark.sql import functions as F

from gondola.operators import lake_state as lake
from gondola.operators.report import quality_history
from gondola.sources import catalogue as cat
from gondola.sources.files import write_by_date
from gondola.sources.lake import (
    Lake,
    drop_dates,
    load_gold,
    load_quality,
    read_silver,
    stored_dates,
    write_csv,
)


def _package(**slots):
    resources = [
        {"name": slug, "format": "ZIP", "url": f"https://x.test/SEPA_{slug}.zip", **when}
        for slug, when in slots.items()
    ]
    resources.append({"name": "Guia", "format": "PDF", "url": "https://x.test/guia.pdf"})
    return json.dumps({"success": True, "result": {"resources": resources}})


@pytest.fixture
def resources(spark):
    package = _package(
        martes={"last_modified": "2026-07-21T05:06:07.080910"},
        miercoles={"last_modified": "2026-07-15T01:02:03.040506"},
        feriado={"last_modified": "2026-07-15T01:02:03"},
    )
    df = spark.createDataFrame([("minorista", package)], "tipo string, paquete string")
    return cat.catalogue_resources(df)


def test_only_weekday_archives_are_listed(resources):
    assert rows(resources.orderBy("posicion"), "slug", "posicion") == [("martes", 0), ("miercoles", 1)]
    dates = rows(cat.available_dates(resources).orderBy("fecha"), "fecha")
    assert [str(d) for (d,) in dates] == ["2026-07-15", "2026-07-21"]


def test_timestamps_naive_zoned_created_and_bad(spark):
    package = _package(
        lunes={"last_modified": "2026-07-21T05:06:07Z"},
        martes={"last_modified": "", "created": "2026-07-01T00:00:00"},
        jueves={"last_modified": "nonsense"},
        viernes={"last_modified": "2026-07-21T23:00:00-03:00"},
    )
    df = spark.createDataFrame([("m", package), ("bad", "{}")], "tipo string, paquete string")
    got = cat.catalogue_resources(df).select("slug", F.col("last_modified").cast("string"))
    assert dict(rows(got)) == {
        "lunes": "2026-07-21 05:06:07",
        "martes": "2026-07-01 00:00:00",
        "jueves": None,
        "viernes": "2026-07-22 02:00:00",
    }


@pytest.mark.parametrize(
    ("day", "strict", "status", "slug"),
    [
        ("2026-07-21", True, "ok", "martes"),
        ("2026-07-22", True, "desactualizado", "miercoles"),
        ("2026-07-22", False, "aceptado", "miercoles"),
        ("2026-04-22", True, "fuera_de_retencion", "miercoles"),
        ("2026-04-22", False, "fuera_de_retencion", "miercoles"),
        ("2026-07-23", True, "sin_slot", "jueves"),
    ],
)
def test_date_resolution(frame, resources, day, strict, status, slug):
    asked = frame("tipo string, fecha date", ("minorista", day))
    row = lake.resolve_dates(asked, resources, "2026-07-23", strict).first()
    assert (row.estado, row.slug) == (status, slug)
    assert (row.url is not None) == (status in ("ok", "aceptado"))


def test_dataset_without_slots(frame, resources):
    asked = frame("tipo string, fecha date", ("mayorista", "2026-07-21"))
    assert lake.resolve_dates(asked, resources, "2026-07-23").first().estado == "sin_recursos"


def test_page_links(spark):
    import datetime as dt

    html = (
        '<a href="/f/guia.pdf">x</a> <a data-href="/no/sepa_martes.zip">n</a>'
        "<A class='b' HREF='/q/sepa_martes.zip'></a><a href=https://y.test/sepa_martes.zip>z</a>"
        "<a target=_blank href=\"/a?b=1&amp;c='2'\">e</a><area href='/no'><a\nhref = x>b</a>"
    )
    links = rows(spark.createDataFrame([(html,)], "html string").select(cat.page_links(F.col("html"))))
    assert links[0][0] == ["/f/guia.pdf", "/q/sepa_martes.zip", "https://y.test/sepa_martes.zip", "/a?b=1&c='2'", "x"]
    df = spark.createDataFrame([(html,), ("<html></html>",)], "html string")
    link = cat.archive_link(F.col("html"), dt.date(2026, 7, 21), "https://p.test")
    assert rows(df.select(link)) == [("https://p.test/q/sepa_martes.zip",), (None,)]
    other = cat.archive_link(F.col("html"), dt.date(2026, 7, 22), "https://p.test")
    assert rows(df.select(other)) == [(None,), (None,)]


def _days(frame, *days, tipo=None):
    if tipo:
        return frame("tipo string, fecha date", *[(tipo, d) for d in days])
    return frame("fecha date", *[(d,) for d in days])


def _texts(df):
    return [str(r.fecha) for r in df.collect()]


def test_missing_dates(frame):
    published = _days(frame, "2026-07-21", "2026-07-19", "2026-07-20", "2026-07-20")
    have = _days(frame, "2026-07-21")
    assert _texts(lake.missing_dates(published, have)) == ["2026-07-19", "2026-07-20"]
    assert _texts(lake.missing_dates(published, published)) == []
    nothing = published.limit(0)
    assert _texts(lake.missing_dates(published, nothing, 2)) == ["2026-07-20", "2026-07-21"]
    assert _texts(lake.missing_dates(published, have, 1)) == []
    assert len(_texts(lake.missing_dates(published, nothing, 0))) == 3


def test_retention(frame):
    held = _days(frame, *[f"2026-07-{d}" for d in (14, 15, 16, 17)], tipo="m")
    assert _texts(lake.retention_plan(held, 2)) == ["2026-07-14", "2026-07-15"]
    assert _texts(lake.retention_plan(held, 7)) == []
    assert _texts(lake.retention_plan(held, 0)) == []


def test_backfill_and_calendar(frame):
    have = _days(frame, "2026-07-20", "2026-07-21")
    plan = lake.backfill_plan(have, "2026-07-20", "2026-07-23")
    assert _texts(plan) == ["2026-07-22", "2026-07-23"]
    assert len(_texts(lake.backfill_plan(have, "2026-07-20", "2026-07-23", overwrite=True))) == 4
    calendar = lake.coverage_calendar(have, "2026-07-20", "2026-07-23")
    assert [r.presente for r in calendar.collect()] == [True, True, False, False]
    assert lake.coverage_calendar(have, "2026-07-23", "2026-07-20").isEmpty()


def test_run_outcomes(frame):
    outcomes = frame(
        "tipo string, fecha date, error string",
        ("good", "2026-07-20", None),
        ("bad", "2026-07-20", "boom"),
        ("bad", "2026-07-21", None),
        ("idle", None, None),
        ("down", None, "portal down"),
    )
    got = {r[0]: r[1:] for r in rows(lake.run_outcomes(outcomes))}
    assert got == {
        "good": (1, 1, 0, True),
        "bad": (2, 1, 1, False),
        "idle": (0, 0, 0, True),
        "down": (0, 0, 0, False),
    }
    assert rows(lake.failed_dates(outcomes), "tipo", "error") == [("bad", "boom")]


# --- tables ---------------------------------------------------------------------------------------


def test_absent_tables_are_empty_frames(spark, tmp_path):
    nowhere = Lake(str(tmp_path / "lake"))
    assert all(df.isEmpty() for df in load_gold(spark, nowhere, "minorista").values())
    assert load_quality(spark, nowhere, "minorista").isEmpty()
    assert read_silver(spark, nowhere, "minorista").isEmpty()
    assert stored_dates(spark, nowhere.silver("minorista")).isEmpty()


def test_silver_drift_and_partition_rewrite(spark, frame, tmp_path):
    place = Lake(str(tmp_path))
    path = place.silver("minorista")
    first = frame(
        "fecha date, id_producto string, precio_lista double",
        ("2026-07-20", "a", 1.0),
        ("2026-07-20", "b", None),
        ("2026-07-21", "a", 2.0),
    )
    write_by_date(first, path)
    write_by_date(frame("fecha date, id_producto string", ("2026-07-22", "a")), path)
    write_by_date(
        frame("fecha date, id_producto string, precio_lista double", ("2026-07-21", "z", 9.0)), path
    )
    silver = read_silver(spark, place, "minorista").orderBy("fecha")
    assert rows(silver, "id_producto", "precio_lista", "marca") == [
        ("a", 1.0, None),
        ("z", 9.0, None),
    ]
    listed = stored_dates(spark, path)
    assert _texts(listed) == ["2026-07-20", "2026-07-21", "2026-07-22"]


def test_listing_dates_opens_no_file(spark, tmp_path):
    folder = tmp_path / "fecha=2026-07-20"
    folder.mkdir()
    (folder / "x.parquet").write_bytes(b"not parquet at all")
    assert _texts(stored_dates(spark, str(tmp_path))) == ["2026-07-20"]


def test_quality_files_bad_ones_are_skipped(spark, tmp_path):
    place = Lake(str(tmp_path))
    for day, text in (
        ("2026-07-21", '{"date": "2026-07-21", "tipo": "m", "rows_read": 5}'),
        ("2026-07-20", '{"date": "2026-07-20", "tipo": "m", "rows_read": 4}'),
        ("2026-07-19", "broken {"),
    ):
        folder = tmp_path / "silver" / "m" / "_quality" / f"fecha={day}"
        folder.mkdir(parents=True)
        (folder / "report.json").write_text(text)
    history = quality_history(load_quality(spark, place, "m"))
    assert rows(history, "date", "rows_read") == [("2026-07-20", 4), ("2026-07-21", 5)]


def test_csv_export_is_rounded(spark, frame, tmp_path):
    write_csv(frame("a string, b double", ("x", 1.2345)), str(tmp_path / "out"))
    files = [p.read_text().splitlines() for p in (tmp_path / "out").glob("*.csv")]
    assert ["a,b", "x,1.23"] in files


def test_drop_dates_removes_only_listed_folders(spark, tmp_path):
    import datetime as dt

    for day in (14, 15):
        (tmp_path / f"fecha=2026-07-{day}").mkdir()
    gone = drop_dates(spark, str(tmp_path), [dt.date(2026, 7, 14), dt.date(2026, 7, 1)])
    assert gone == [dt.date(2026, 7, 14)]
    assert [p.name for p in tmp_path.iterdir()] == ["fecha=2026-07-15"]
