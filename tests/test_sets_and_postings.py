"""Foldable distinct sets, search by postings, gaps, drifted files, pushed filters."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F
from support import DATE, PRODUCTS, STORES, inner_zip, retail_archive, rows, write_archive

from gondola.operators import distinct_sets as ds
from gondola.operators.lake_state import coverage_counts, coverage_gaps
from gondola.operators.postings import description_postings, matching_descriptions, search_by_postings
from gondola.operators.shopping import search_products
from gondola.schemas import SILVER
from gondola.sources.archive import read_archives, read_entries
from gondola.sources.drift import read_drifted
from gondola.sources.files import write_by_date
from gondola.sources.lake import Lake, read_silver

DAYS = [f"2026-07-{d:02}" for d in range(1, 9)]


def test_sets_of_any_range_count_like_the_ids(frame, spark):
    rng = random.Random(4)
    held = [(rng.choice(DAYS), None if rng.random() < 0.1 else f"p{rng.randint(0, 60)}") for _ in range(400)]
    days = frame("fecha date, id_producto string", *held)
    sets = ds.id_sets(days, ds.number_ids(days))
    ranges = frame("desde date, hasta date", *[(a, b) for a in DAYS for b in DAYS], ("2020-01-01", "2020-02-01"))
    got = {(str(a), str(b)): n for a, b, n in rows(ds.distinct_in_ranges(sets, ranges))}
    for (a, b), n in got.items():
        assert n == len({i for d, i in held if i and a <= d <= b})
    assert len(got) == 65
    assert rows(ds.count_sets(ds.fold_sets(sets))) == [(len({i for _, i in held if i}),)]
    # No ids, no sets.
    none = ds.id_sets(days.limit(0), ds.number_ids(days.limit(0)))
    assert rows(ds.count_sets(ds.fold_sets(none))) == [(0,)]


def test_numbers_stay_when_ids_come_later(frame, spark, tmp_path):
    first = frame("fecha date, id_producto string", *[(DAYS[0], f"a{i}") for i in range(50)])
    ds.number_ids(first).write.parquet(f"{tmp_path}/n1")
    known = spark.read.parquet(f"{tmp_path}/n1")
    second = frame("fecha date, id_producto string", *[(DAYS[1], f"a{i}") for i in range(40, 90)])
    both = known.unionByName(ds.number_ids(second, known))
    found = rows(both)
    assert len({n for _, n in found}) == len({i for i, _ in found}) == len(found) == 90
    sets = ds.id_sets(first, known).unionByName(ds.id_sets(second, both))
    assert rows(ds.count_sets(ds.fold_sets(sets))) == [(90,)]
    assert dict(rows(ds.count_sets(sets, "fecha"))) == {dt.date.fromisoformat(DAYS[0]): 50, dt.date.fromisoformat(DAYS[1]): 50}


@pytest.mark.parametrize("term", ["LECHE", "leche 1", "é", "ch", "", "zzz", "%_", "a b", "ñandú", "LECHELECHE"])
def test_postings_find_what_the_scan_finds(frame, term):
    names = ["Leche 1L", "LECHE en polvo", "Crema", "Té verde", None, "", "Ñandú", "a b c", "100%_x", "lechelech"]
    table = frame("fecha date, id_producto string, descripcion_producto string, marca string", *[(DAYS[k % 3], str(k), n, "m" if k % 2 else None) for k, n in enumerate(names * 2)])
    postings = description_postings(table)
    for brand in (None, "m"):
        got = search_by_postings(table, postings, table, term, brand)
        assert got.columns == table.columns
        assert sorted(rows(got), key=str) == sorted(rows(search_products(table, term, brand)), key=str)


def test_search_reads_the_postings_of_its_grams_only(frame, spark, tmp_path):
    table = frame("descripcion_producto string", *[(f"item {i} {'leche' if i % 50 == 0 else 'pan'}",) for i in range(500)])
    description_postings(table).repartitionByRange(8, "grama").write.partitionBy("grama").parquet(f"{tmp_path}/p")
    stored = spark.read.option("basePath", f"{tmp_path}/p").parquet(f"{tmp_path}/p")
    found = matching_descriptions(stored, table, "leche")
    assert found.count() == 10
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*grama#\d+ IN \(.*che.*ech.*lec", plan)
    assert stored.where(F.col("grama").isin("lec", "ech", "che")).count() == 30  # rows read


def test_gaps_by_hand(frame):
    held = frame("tipo string, fecha date", ("a", "2026-07-01"), ("a", "2026-07-01"), ("a", "2026-07-02"), ("a", "2026-07-06"), ("a", None), ("b", "2026-07-03"), (None, "2026-07-03"), ("c", "2026-08-01"))
    assert [(t, str(a), str(b), n) for t, a, b, n in rows(coverage_gaps(held))] == [("a", "2026-07-03", "2026-07-05", 3)]
    got = [(t, str(a)[5:], str(b)[5:], n) for t, a, b, n in rows(coverage_gaps(held, "2026-07-02", "2026-07-07"))]
    assert got == [("a", "07-03", "07-05", 3), ("a", "07-07", "07-07", 1), ("b", "07-02", "07-02", 1), ("b", "07-04", "07-07", 4), ("c", "07-02", "07-07", 6)]
    assert rows(coverage_gaps(held, "2026-07-09", "2026-07-07")) == []
    counts = [(t, n, missing, gaps, longest) for t, _, _, n, missing, gaps, longest in rows(coverage_counts(held))]
    assert counts == [("a", 3, 3, 1, 3), ("b", 1, 0, 0, 0), ("c", 1, 0, 0, 0)]
    assert rows(coverage_gaps(held.limit(0))) == [] == rows(coverage_counts(held.limit(0)))


def test_files_of_other_types_are_cast(frame, spark, tmp_path):
    place = Lake(str(tmp_path))
    path = place.silver("m")
    for table in (
        frame("fecha date, id_producto string, precio_lista double", (DAYS[0], "1", 1.5)),
        frame("fecha date, id_producto bigint, precio_lista string", (DAYS[1], 2, "2.25"), (DAYS[1], 3, "n/a")),
        frame("fecha date, id_producto string, precio_lista float, otra int", (DAYS[2], "4", 0.5, 9)),
        frame("fecha date, id_producto string", (DAYS[3], "5")),
    ):
        write_by_date(table, path)
    got = read_silver(spark, place, "m")
    assert got.schema == read_silver(spark, Lake(f"{tmp_path}/none"), "m").schema
    found = sorted((str(r.fecha), r.id_producto, r.precio_lista) for r in got.collect())
    assert found == [(DAYS[0], "1", 1.5), (DAYS[1], "2", 2.25), (DAYS[2], "4", 0.5)]  # others have no price
    whole = read_drifted(spark, path, SILVER, basePath=path)
    assert whole.count() == 5 and len(whole.inputFiles()) == 4
    some = read_silver(spark, place, "m", [dt.date.fromisoformat(DAYS[1])])
    assert [r.precio_lista for r in some.collect()] == [2.25]
    assert read_drifted(spark, f"{tmp_path}/none", SILVER).isEmpty()


def test_filters_reach_the_archive_source(spark, tmp_path):
    retail_archive(tmp_path)
    for tipo, day in (("minorista", "2026-07-22"), ("mayorista", DATE)):
        write_archive(tmp_path, tipo, day, a=inner_zip(productos=PRODUCTS, sucursales=STORES))
    raw = read_archives(spark, str(tmp_path))
    day = dt.date.fromisoformat(DATE)
    everything = raw.collect()
    cases = {
        "fecha = DATE'2026-07-21'": (lambda r: r.fecha == day, 2),
        "fecha > DATE'2026-07-21' AND tipo = 'minorista'": (lambda r: r.fecha > day and r.tipo == "minorista", 1),
        "tipo IN ('mayorista', 'x')": (lambda r: r.tipo == "mayorista", 1),
        "miembro = 'sucursales'": (lambda r: r.miembro == "sucursales", 3),
        "miembro IS NULL AND fecha <= DATE'2026-07-21'": (lambda r: r.miembro is None and r.fecha <= day, 2),
        "miembro IS NOT NULL": (lambda r: r.miembro is not None, 3),
        "miembro <> 'productos' OR tipo = 'x'": (lambda r: r.miembro is not None and r.miembro != "productos", 3),
    }
    for test, (holds, tasks) in cases.items():
        found = raw.where(test)
        assert sorted(map(str, found.collect())) == sorted(str(r) for r in everything if holds(r))
        assert found.rdd.getNumPartitions() == tasks, test
    assert raw.where("fecha = DATE'2030-01-01'").count() == 0
    assert read_archives(spark, str(tmp_path), dates=DATE).where("fecha = DATE'2026-07-22'").count() == 0
    assert {r.tipo for r in read_entries(spark, str(tmp_path)).where("tipo = 'mayorista'").collect()} == {"mayorista"}


def test_members_not_asked_for_are_not_unpacked(spark, tmp_path):
    """Their bytes may be broken."""
    payload = bytearray(inner_zip(sucursales=STORES, productos=PRODUCTS * 50))
    at = payload.index(b"Productos.csv") + len(b"Productos.csv")
    payload[at + 5 : at + 40] = b"\xff" * 35
    write_archive(tmp_path, "minorista", DATE, a=bytes(payload))
    raw = read_archives(spark, str(tmp_path))
    assert raw.where("miembro = 'sucursales'").count() == 1
    with pytest.raises(Exception, match="(?i)error|crc|block|invalid"):
        raw.where("miembro = 'productos'").collect()
