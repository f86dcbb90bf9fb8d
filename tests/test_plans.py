"""Plans stay what they should be: no pairings, filters and columns reach the scan."""

import datetime as dt
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gondola.operators import shopping as shop
from gondola.operators.aggregates import label_candidates
from gondola.operators.index import daily_relatives, matched_pairs, stale_after
from gondola.sources.files import write_by_date
from gondola.sources.lake import Lake, load_gold
from gondola.workload import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")
def test_no_query_pairs_rows(spark):
    for name, query in QUERIES.items():
        text = plan_text(query(spark, SF_DIR))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
        assert "PythonUDF" not in text and "ArrowEvalPython" not in text, name


@pytest.fixture
def gold(spark, frame, tmp_path):
    lake = Lake(str(tmp_path))
    rows = [
        (day, pid, "t", None, 1.0, 1.0, 5, 1.0)
        for day in ("2026-07-20", "2026-07-21")
        for pid in "ab"
    ]
    table = frame(
        "fecha date, id_producto string, descripcion_producto string, marca string,"
        " precio_minimo double, precio_maximo double, cantidad_muestras bigint,"
        " precio_promedio double",
        *rows,
    )
    write_by_date(table, lake.gold("minorista", "daily_product_prices"))
    return load_gold(spark, lake, "minorista")["daily_product_prices"]


def test_day_filters_prune_partitions(gold):
    text = plan_text(shop.savings_opportunities(gold, "2026-07-21"))
    assert re.search(r"PartitionFilters: \[[^\]]*fecha#\d+ = 2026-07-21", text)
    assert "GreaterThanOrEqual(cantidad_muestras,5)" in text


def test_baskets_push_ids_and_read_few_columns(gold):
    text = plan_text(shop.basket_series(gold, ["a", "b"]))
    assert "In(id_producto, [a,b])" in text
    assert "descripcion_producto" not in re.search(r"ReadSchema: struct<([^>]*)>", text)[1]


def test_movers_are_one_scan_and_one_shuffle_before_the_sort(gold):
    text = plan_text(shop.price_movers(gold, "2026-07-20", "2026-07-21"))
    assert text.count("FileScan") == 1 and "Join" not in text
    assert text.count("Exchange hashpartitioning") == 1


def test_pairs_use_windows_per_product_only(gold):
    text = plan_text(matched_pairs(gold))
    assert "SortMergeJoin" not in text


def test_movers_with_stored_labels_read_two_partitions(gold):
    labels = label_candidates(gold)
    text = plan_text(shop.price_movers(gold, "2026-07-20", "2026-07-21", labels=labels.limit(10)))
    assert "PartitionFilters: [fecha#" in text and "fecha#" in text
    first = re.search(r"FileScan[^\n]*PartitionFilters: \[([^\]]*)\]", text)[1]
    assert "2026-07-20" in first and "2026-07-21" in first


def test_pairs_of_the_index_are_worked_out_once(gold):
    """The windows over products run once, for the cuts of the slices and for the ranks."""
    found = daily_relatives(gold)
    found.collect()
    text = found._jdf.queryExecution().executedPlan().toString()
    final = text.split("== Initial Plan ==")[0]
    of_products = re.findall(r"Window \[lag\(fecha#\d+, -1, null\) windowspecdefinition\(id_producto", final)
    assert len(of_products) == 1 and "ReusedExchange" in final


def test_index_of_some_dates_reads_their_partitions(gold):
    stale, read = stale_after([dt.date(2026, 7, 20), dt.date(2026, 7, 21)], [dt.date(2026, 7, 21)])
    text = plan_text(daily_relatives(gold.where(F.col("fecha").isin(read))).where(F.col("fecha").isin(stale)))
    scans = re.findall(r"PartitionFilters: \[([^\]]*)\]", text)
    assert scans and all("2026-07-2" in s for s in scans)
    assert "Checkpoint" not in text and "ExistingRDD" not in text
