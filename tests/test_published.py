"""Tables that change together: states, faults between any two steps, sweeping."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from support import rows

from gondola.operators.aggregates import label_candidates
from gondola.operators.distinct_sets import count_sets, fold_sets
from gondola.plans.gold import refresh_gold
from gondola.schemas import GOLD, SILVER
from gondola.sources import published
from gondola.sources.files import write_by_date
from gondola.sources.lake import Lake, load_gold, load_labels, load_sets, read_silver
from gondola.sources.published import Conflict, Draft, Published, load_state, manifests, sweep

SCHEMA = "fecha date, v long"


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "tables")


def _schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def _put(spark, frame, root, *values, whole=False, **tables):
    draft = Draft(spark, root)
    draft.put_dates("a", frame(SCHEMA, *values), whole=whole)
    for name, n in tables.items():
        draft.put(name, spark.range(n).selectExpr("id AS v"))
    draft.publish()


def _read(spark, root, dates=None):
    found = Published(spark, root).read("a", _schema(spark), dates)
    return sorted((str(r.fecha), r.v) for r in found.collect())


def test_dates_are_replaced_and_others_stay(spark, frame, root):
    assert _read(spark, root) == [] and Published(spark, root).dates("a") == []
    _put(spark, frame, root, ("2026-07-01", 1), ("2026-07-02", 2), ("2026-07-02", 3))
    _put(spark, frame, root, ("2026-07-02", 4), ("2026-07-05", 5))
    assert _read(spark, root) == [("2026-07-01", 1), ("2026-07-02", 4), ("2026-07-05", 5)]
    assert _read(spark, root, [dt.date(2026, 7, 5), dt.date(2026, 7, 9)]) == [("2026-07-05", 5)]
    _put(spark, frame, root, ("2026-07-03", 6), whole=True)
    assert _read(spark, root) == [("2026-07-03", 6)]
    _put(spark, frame, root, whole=True)
    assert _read(spark, root) == []


def test_plain_folders_are_read_until_published(spark, frame, root):
    write_by_date(frame(SCHEMA, ("2026-07-01", 1), ("2026-07-02", 2)), f"{root}/a")
    assert _read(spark, root) == [("2026-07-01", 1), ("2026-07-02", 2)]
    _put(spark, frame, root, ("2026-07-02", 3))
    assert _read(spark, root) == [("2026-07-01", 1), ("2026-07-02", 3)]
    # The plain folder that was replaced is swept once no kept state names it.
    for n in range(3):
        _put(spark, frame, root, ("2026-07-03", n))
        sweep(spark, root)
    assert _read(spark, root) == [("2026-07-01", 1), ("2026-07-02", 3), ("2026-07-03", 2)]
    assert not Path(root, "a", "fecha=2026-07-02").exists() and Path(root, "a", "fecha=2026-07-01").exists()


def test_what_was_not_published_is_not_seen(spark, frame, root):
    draft = Draft(spark, root)
    draft.put_dates("a", frame(SCHEMA, ("2026-07-01", 1)))
    draft.put("b", spark.range(3))
    assert _read(spark, root) == [] and Published(spark, root).read("b", spark.range(1).schema).count() == 0
    assert draft.read("b", spark.range(1).schema).count() == 3  # but by the run itself
    draft.discard()
    assert not list(Path(root).rglob("*.parquet"))


def test_two_runs_at_once_do_not_mix(spark, frame, root):
    one, two = Draft(spark, root), Draft(spark, root)
    for k, draft in enumerate((one, two)):
        draft.put_dates("a", frame(SCHEMA, ("2026-07-01", k)))
    two.publish()
    with pytest.raises(Conflict):
        one.publish()
    assert _read(spark, root) == [("2026-07-01", 1)]


def test_readers_keep_their_state_for_two_more(spark, frame, root):
    _put(spark, frame, root, ("2026-07-01", 0), b=1)
    first = Published(spark, root)
    for n in (1, 2):
        _put(spark, frame, root, ("2026-07-01", n), b=n)
        sweep(spark, root)
        assert first.read("a", _schema(spark)).first().v == 0
    _put(spark, frame, root, ("2026-07-01", 3))
    gone = sweep(spark, root)
    assert len(gone) == 2 and manifests(spark, root) == [2, 3, 4]
    assert load_state(spark, root, 2).number == 2 and _read(spark, root) == [("2026-07-01", 3)]
    assert sweep(spark, root) == []


# --- Gold -----------------------------------------------------------------------------------------

_FACTS = "fecha date, id_producto string, descripcion_producto string, provincia string, precio_lista double"


def _silver(spark, frame, lake, *facts):
    table = frame(_FACTS, *facts)
    missing = [f for f in SILVER if f.name not in table.columns]
    table = table.selectExpr("*", *(f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in missing))
    draft = Draft(spark, lake.silver_root("m"))
    draft.put_dates("precios", table.select(*SILVER.names))
    draft.publish()


def _tables(spark, lake):
    found = {**load_gold(spark, lake, "m"), "labels": load_labels(spark, lake, "m")}
    return {name: sorted(rows(df), key=str) for name, df in found.items()}


DAYS = ("2026-06-29", "2026-06-30", "2026-07-01", "2026-07-02")


def _facts(day, *names, price=10.0):
    """Product ``a`` under one name a row."""
    return [(day, "a", n, "X", price) for n in names] + [(day, "b", "BREAD", "X", price)]


def test_a_killed_refresh_leaves_the_old_state(spark, frame, tmp_path, monkeypatch):
    """A fault at every single write, and at the rename; then without one."""
    lake = Lake(str(tmp_path))
    _silver(spark, frame, lake, *(f for d in DAYS[:3] for f in _facts(d, "MILK", "MILK")))
    refresh_gold(spark, lake, "m")
    before = _tables(spark, lake)
    _silver(spark, frame, lake, *_facts(DAYS[1], "CREAM", price=20.0), *_facts(DAYS[3], "WATER", "WATER", "WATER", price=30.0))
    days = [dt.date.fromisoformat(DAYS[1]), dt.date.fromisoformat(DAYS[3])]

    class Killed(BaseException):
        pass

    steps = {"n": 0, "at": None}

    def counted(name, original):
        def step(*args, **kwargs):
            steps["n"] += 1
            if steps["at"] == steps["n"]:
                raise Killed(name)
            out = original(*args, **kwargs)
            if steps["at"] == -steps["n"]:
                raise Killed(f"after {name}")
            return out
        return step

    # Nothing is tidied up by a run that is killed.
    monkeypatch.setattr(Draft, "discard", lambda self: None)
    monkeypatch.setattr(Draft, "put_dates", counted("put_dates", Draft.put_dates))
    monkeypatch.setattr(Draft, "put", counted("put", Draft.put))
    monkeypatch.setattr(published, "write_text", counted("write_text", published.write_text))
    for at in range(1, 13):
        for sign in (1, -1):
            steps.update(n=0, at=sign * at)
            with pytest.raises(Killed):
                refresh_gold(spark, lake, "m", days)
            assert steps["n"] == at
            assert _tables(spark, lake) == before
    steps.update(n=0, at=None)
    refresh_gold(spark, lake, "m", days)
    assert steps["n"] == 12
    after = _tables(spark, lake)
    assert all(after[name] != before[name] for name in (*GOLD, "labels"))
    refresh_gold(spark, lake, "m")
    assert _tables(spark, lake) == after


def test_labels_after_any_sequence_of_loads_equal_a_full_rebuild(spark, frame, tmp_path):
    lake = Lake(str(tmp_path))
    loads = [
        _facts(DAYS[0], "OLD", "OLD", "OLD"), _facts(DAYS[1], "MID", "MID"), _facts(DAYS[2], "NEW"),
        _facts(DAYS[0], "MID"),  # OLD is gone with the date's first load
        _facts(DAYS[3], "LAST", "LAST", "LAST", "LAST"), _facts(DAYS[3]),  # and LAST, which was the label
        _facts(DAYS[1], "ZZ", "AA"),
    ]
    shown = []
    for facts in loads:
        _silver(spark, frame, lake, *facts)
        refresh_gold(spark, lake, "m", [dt.date.fromisoformat(facts[0][0])])
        stored = _tables(spark, lake)["labels"]
        products = load_gold(spark, lake, "m")["daily_product_prices"]
        assert stored == sorted(rows(label_candidates(products)), key=str)
        sets = load_sets(spark, lake, "m")
        assert dict(rows(count_sets(sets, "fecha"))) == dict(rows(products.groupBy("fecha").agg(F.count_distinct("id_producto"))))
        assert rows(count_sets(fold_sets(sets))) == rows(products.agg(F.count_distinct("id_producto")))
        shown.append({r[0]: r[2] for r in stored}["a"])
    assert shown == ["OLD", "OLD", "OLD", "MID", "LAST", "MID", "ZZ"]
    before = _tables(spark, lake)
    refresh_gold(spark, lake, "m")
    assert _tables(spark, lake) == before


def test_dates_that_silver_lost_leave_gold(spark, frame, tmp_path):
    lake = Lake(str(tmp_path))
    _silver(spark, frame, lake, *(f for d in DAYS for f in _facts(d, d)))
    refresh_gold(spark, lake, "m")
    draft = Draft(spark, lake.silver_root("m"))
    draft.drop_dates("precios", [dt.date.fromisoformat(DAYS[2])])
    draft.publish()
    assert {str(r.fecha) for r in read_silver(spark, lake, "m").select("fecha").collect()} == {DAYS[0], DAYS[1], DAYS[3]}
    refresh_gold(spark, lake, "m", [dt.date.fromisoformat(d) for d in DAYS[2:]])
    some = _tables(spark, lake)
    refresh_gold(spark, lake, "m")
    assert _tables(spark, lake) == some and {str(r[0]) for r in some["store_stats"]} == {DAYS[0], DAYS[1], DAYS[3]}
