import datetime as dt
import math
import random
import statistics

import numpy as np
import pytest
from support import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gondola.operators import aggregates as agg
from gondola.operators import index as idx
from gondola.operators.ranks import date_quantiles, ranked_values
from gondola.plans.gold import gold_tables
from gondola.workload import QUERIES

FACTS = (
    "fecha date, id_producto string, descripcion_producto string, marca string,"
    " id_comercio string, nombre_comercio string, nombre_sucursal string, provincia string,"
    " precio_lista double"
)
D1, D2, D3 = "2026-07-20", "2026-07-21", "2026-07-23"


def fact(fecha, pid, price, province="Córdoba", store="S1", text="t"):
    return (fecha, pid, text, None, "4", "C", store, province, price)


def products(frame, *items):
    """(fecha, id, price[, samples[, description]]) product rows."""
    full = [(*i, *(1, "t")[len(i) - 3 :]) for i in items]
    return frame(
        "fecha date, id_producto string, precio_promedio double, cantidad_muestras bigint,"
        " descripcion_producto string",
        *full,
    )


def test_partials_fold_to_the_one_shot_result(frame):
    facts = [fact(D1, "a", 10.0), fact(D1, "a", 15.0), fact(D1, "a", 20.0), fact(D1, None, 3.0)]
    whole = agg.price_partials(frame(FACTS, *facts), agg.PRODUCT_KEYS)
    parts = [
        agg.price_partials(frame(FACTS, *facts[:2]), agg.PRODUCT_KEYS),
        agg.price_partials(frame(FACTS, *facts[2:]), agg.PRODUCT_KEYS),
    ]
    folded = agg.daily_product_prices(agg.merge_partials(parts, agg.PRODUCT_KEYS))
    columns = ["id_producto", "precio_promedio", "precio_minimo", "precio_maximo", "cantidad_muestras"]
    want = [(None, 3.0, 3.0, 3.0, 1), ("a", 15.0, 10.0, 20.0, 3)]
    assert rows(folded.orderBy("id_producto"), *columns) == want
    assert rows(agg.daily_product_prices(whole).orderBy("id_producto"), *columns) == want


def test_loads_are_folded_in_as_many_partitions_as_asked(frame):
    """In tasks of the size that adaptive execution gives, the groups of two loads took 1.8 GB."""
    facts = [fact(D1, str(i % 600), float(i), province=None if i % 5 else "Salta") for i in range(3000)]
    finer = agg.price_partials(frame(FACTS, *facts[::2]), agg.PRODUCT_PROVINCE_KEYS)
    loads = [finer, agg.price_partials(frame(FACTS, *facts[1::2]), agg.PROVINCE_KEYS)]
    folded = agg.merge_partials(loads, agg.PROVINCE_KEYS, 9)
    where = [r[0] for r in folded.select(F.spark_partition_id()).collect()]
    assert len(set(where)) == 9 and max(where.count(p) for p in set(where)) < 2 * len(where) / 9
    want = agg.price_partials(frame(FACTS, *facts), agg.PROVINCE_KEYS)
    assert sorted(map(str, folded.collect())) == sorted(map(str, want.collect()))
    assert agg.merge_partials(loads, agg.PROVINCE_KEYS).count() == want.count()


def test_folding_two_loads_takes_more_partitions_for_more_lines(spark, tmp_path, monkeypatch):
    tables = {
        "lineitem": spark.range(4000).selectExpr(
            "id AS l_orderkey", "id % 1000 AS l_partkey", "1L AS l_suppkey", "0D AS l_discount",
            "timestamp_ntz'1997-03-05 00:00:00' AS l_shipdate",
        ),
        "part": spark.range(1000).selectExpr("id AS p_partkey", "1D AS p_retailprice"),
        "supplier": spark.sql("SELECT 1L AS s_suppkey, 2 AS s_nationkey"),
        "nation": spark.sql("SELECT 2 AS n_nationkey, 'X' AS n_name"),
    }
    for name, table in tables.items():
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    monkeypatch.setattr(agg, "FACTS_PER_PART", 500)
    folded = QUERIES["merge_partials"](spark, str(tmp_path))
    assert len({r[0] for r in folded.select(F.spark_partition_id()).collect()}) == 8
    assert folded.agg(F.count("*"), F.sum("muestras")).first() == (250, 4000)


def test_finer_partials_serve_both_tables(frame):
    facts = frame(
        FACTS,
        fact(D1, "a", 100.0),
        fact(D1, "a", 120.0),
        fact(D1, "a", 200.0, province="Salta"),
        fact(D1, "a", 500.0, province=None),
    )
    tables = gold_tables(facts)
    by_province = tables["province_product_prices"].orderBy("provincia")
    assert rows(by_province, "provincia", "precio_promedio", "cantidad_muestras") == [
        ("Córdoba", 110.0, 2),
        ("Salta", 200.0, 1),
    ]
    assert rows(tables["daily_product_prices"], "precio_promedio", "cantidad_muestras") == [
        (230.0, 4)
    ]
    assert rows(
        tables["store_stats"].where("provincia = 'Córdoba'"),
        "productos_reportados",
        "precio_promedio_general",
    ) == [(2, 110.0)]


def test_newcomers_move_the_average_but_not_the_matched_index(frame):
    index = idx.inflation_index(
        products(frame, (D1, "a", 100.0), (D2, "a", 100.0), (D2, "b", 10_000.0))
    ).orderBy("fecha")
    first, second = rows(
        index, "indice_global_base100", "variacion_matched_pct", "indice_matched_base100"
    )
    assert first == (100.0, 0.0, 100.0)
    assert second[0] > 3000 and second[1:] == (0.0, 100.0)


def test_matched_rise_is_chained(frame):
    index = idx.inflation_index(
        products(frame, (D1, "a", 100.0), (D1, "b", 200.0), (D2, "a", 110.0), (D2, "b", 220.0))
    ).orderBy("fecha")
    last = rows(index, "variacion_matched_pct", "indice_matched_base100")[1]
    assert last == pytest.approx((10.0, 110.0))


def test_share_median_and_trimmed_mean(frame):
    items = [(D1, p, 100.0) for p in "abcd"]
    items += [(D2, p, 100.0) for p in "abc"] + [(D2, "d", 150.0)]
    row = rows(
        idx.inflation_index(products(frame, *items)).where(F.col("fecha") == D2),
        "variacion_mediana_pct",
        "variacion_matched_pct",
        "pct_productos_con_cambio",
        "productos_comparables",
    )[0]
    assert row == pytest.approx((0.0, 12.5, 25.0, 4))


def test_single_date_and_empty_table(frame):
    one = rows(idx.inflation_index(products(frame, (D1, "a", 5.0))))
    assert one[0][4:] == (0.0, 0.0, 0.0, 0, 0.0, 100.0, 100.0, None)
    assert rows(idx.inflation_index(products(frame))) == []


def test_several_descriptions_make_one_pair(frame):
    table = products(
        frame,
        (D1, "a", 100.0, 90, "x"),
        (D1, "a", 300.0, 10, "y"),
        (D2, "a", 110.0, 1, "x"),
        (D2, "a", 330.0, 99, "y"),
    )
    # Plain means: 200 and 220, weights ignored.
    pair = rows(idx.matched_pairs(table), "precio_previo", "precio_actual", "relativo")
    assert pair == [pytest.approx((200.0, 220.0, 1.1))]


def test_previous_date_is_the_loaded_one_and_gaps_do_not_match(frame):
    table = products(
        frame,
        (D1, "a", 100.0),
        (D2, "b", 1.0),
        (D3, "a", 200.0),  # seen last on D1, which is not the date before D3
        (D3, "b", 2.0),  # D2 -> D3 although a calendar day lies between
    )
    assert rows(idx.matched_pairs(table), "id_producto", "relativo") == [("b", 2.0)]


def test_dates_without_overlap_keep_the_level(frame):
    index = idx.inflation_index(products(frame, (D1, "a", 1.0), (D2, "b", 9.0))).orderBy("fecha")
    assert rows(index, "indice_matched_base100", "productos_comparables")[1] == (100.0, 0)


def _summary(frame, ratios):
    pairs = frame("fecha date, relativo double", *[(D1, float(x)) for x in ratios])
    return idx.relatives_summary(pairs).collect()


def test_trimmed_mean_of_known_samples(frame):
    spread = _summary(frame, [0.9] * 30 + [1.0] * 40 + [1.25] * 30)[0]
    assert spread.relativo_mediano == 1.0 and spread.relativo_recortado > 1.02
    outlier = _summary(frame, [1.01] * 100 + [100.0])[0]
    assert outlier.relativo_recortado == pytest.approx(1.01, abs=1e-3)
    assert _summary(frame, [1.5, 2.5])[0].relativo_recortado == 2.0
    assert _summary(frame, []) == []


def _quantile(values, share):
    return float(np.quantile(values, share))


def _trimmed(values):
    if len(values) < 20:
        return statistics.fmean(values)
    low, high = _quantile(values, 0.05), _quantile(values, 0.95)
    return statistics.fmean([v for v in values if low <= v <= high])


# Includes neighbouring floats, onto which an interpolated quantile can round.
_RELATIVES = [0.9, math.nextafter(0.9, 1), 0.95, 1.0, 1.0, 1.05, 1.5, math.nextafter(1.5, 2), 7.0]


def test_neighbouring_floats_at_the_quantiles(frame):
    above = math.nextafter(0.9, 1)
    for low_block in ([0.5, 0.9, above], [0.5, above, 0.9], [0.5, 0.6, 0.9]):
        for high_block in ([2.0, math.nextafter(2.0, 3), 9.0], [2.0, 3.0, 9.0]):
            ratios = low_block + [1.0 + i / 100 for i in range(20)] + high_block
            row = _summary(frame, ratios)[0]
            assert row.relativo_recortado == pytest.approx(_trimmed(ratios), rel=1e-12)


@settings(
    max_examples=6,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
    derandomize=True,
)
@given(
    st.lists(st.sampled_from(_RELATIVES), min_size=15, max_size=90)
)
def test_summary_equals_brute_force(frame, ratios):
    row = _summary(frame, ratios)[0]
    assert row.relativo_recortado == pytest.approx(_trimmed(ratios), rel=1e-12)
    assert row.relativo_mediano == pytest.approx(statistics.median(ratios), rel=1e-12)
    assert row.productos_comparables == len(ratios)


def test_ranks_are_exact_with_a_hot_value_and_a_hot_date(spark):
    rng = random.Random(7)
    values = [(D1, 1.0)] * 3_000 + [(D1, rng.random()) for _ in range(5_000)]
    values += [(D2, rng.random()) for _ in range(30)]
    df = spark.createDataFrame(values, "fecha string, v double").withColumn(
        "fecha", F.to_date("fecha")
    )
    got = {
        str(r.fecha): (r.a, r.b)
        for r in date_quantiles(df, "v", {"a": 0.05, "b": 0.5}).collect()
    }
    for day in (D1, D2):
        own = [v for d, v in values if d == day]
        assert got[day] == pytest.approx((_quantile(own, 0.05), _quantile(own, 0.5)), rel=1e-12)
    # No slice of the hot date holds more than a few percent of its distinct values.
    hot = ranked_values(df, "v").where(F.col("fecha") == D1)
    assert hot.agg(F.sum("veces"), F.max("hasta"), F.min("desde")).first() == (8_000, 8_000, 0)


def test_index_series_views(frame):
    index = idx.inflation_index(
        products(frame, (D1, "a", 100.0), (D2, "a", 100.0), (D3, "a", 120.0))
    )
    assert rows(idx.index_moves(index).orderBy("fecha"), "sentido") == [("baja",), ("sube",)]
    assert idx.repricing_activity(index).count() == 2
    assert {r[0] for r in rows(idx.index_long(index), "serie")} == {
        "Productos comparables",
        "Promedio simple",
    }


def test_rollups_and_bounds(frame):
    stores = frame(
        "nombre_comercio string, nombre_sucursal string, provincia string,"
        " productos_reportados bigint, precio_promedio_general double",
        ("A", "s1", "X", 10, 100.0),
        ("A", "s2", "Y", 30, 200.0),
        (None, "s3", None, 5, 1.0),
        ("B", "s4", "X", 1, 50.0),
    )
    assert rows(agg.chain_rollup(stores)) == [("B", 1, 1, 50.0), ("A", 2, 40, 150.0)]
    assert rows(agg.province_rollup(stores)) == [("Y", 1, 200.0), ("X", 2, 75.0)]
    dates = frame("fecha date", (D1,), (D3,))
    empty = frame("fecha date")
    assert [str(v) for v in agg.date_bounds(dates, empty).first()] == [D1, D3]
    assert tuple(agg.date_bounds(empty).first()) == (None, None)


def test_stale_dates_of_a_refresh():
    a, b, c, d = (dt.date(2026, 7, n) for n in (1, 2, 4, 9))
    assert idx.stale_after([a, b, c, d], [b]) == ([b, c], [a, b, c])
    assert idx.stale_after([a, b, c, d], [d]) == ([d], [c, d])
    assert idx.stale_after([a, b, c, d], [a]) == ([a, b], [a, b])
    # The 2nd is gone from the table: the 4th now follows the 1st.
    assert idx.stale_after([a, c, d], [b]) == ([c], [a, c])
    assert idx.stale_after([], [a]) == ([], [])


def test_stored_labels_fold_over_loads(frame):
    table = products(frame, (D1, "a", 1.0), (D2, "a", 2.0), (D2, "b", 3.0))
    whole = agg.label_candidates(table)
    parts = [agg.label_candidates(table.where(F.col("fecha") == day)) for day in (D1, D2)]
    assert sorted(rows(agg.label_candidates(parts[0].unionByName(parts[1])))) == sorted(rows(whole))
