from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import RUN, T0, T1, T2, plan, raw, rows
from ledgermill.operators import history_changes, scd2_check
from ledgermill.plans import silver
from ledgermill.plans.jobs import open_warehouse
from ledgermill.plans.tables import HISTORY

SCHEMA = "k int, a string, b string, note string"
CHECKS = ("a", "b")


def state(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def step(previous, current, ts, **options):
    return scd2_check(previous, current, "k", CHECKS, ts, **options)


def versions(df):
    return rows(df, "k", "a", "note", "valid_from", "valid_to")


def test_first_run_opens_a_version_per_key(spark):
    out = step(None, state(spark, (1, "x", None, "n")), T0)
    assert versions(out) == [(1, "x", "n", T0, None)]
    assert rows(out, "scd_updated_at") == [(T0,)]
    assert len(out.first()["scd_id"]) == 32


def test_no_change_and_rerun_are_no_ops(spark):
    current = state(spark, (1, "x", None, "n"), (2, None, "y", "n"))
    first = step(None, current, T0)
    assert rows(step(first, current, T1)) == rows(first)


def test_columns_outside_the_check_keep_the_old_value(spark):
    first = step(None, state(spark, (1, "x", "y", "old")), T0)
    assert versions(step(first, state(spark, (1, "x", "y", "new")), T1)) == [(1, "x", "old", T0, None)]


def test_change_closes_and_opens_also_to_and_from_null(spark):
    history = step(None, state(spark, (1, None, "y", "n"), (2, "v", "y", "n")), T0)
    history = step(history, state(spark, (1, "v", "y", "m"), (2, None, "y", "m")), T1)
    assert versions(history) == [
        (1, "v", "m", T1, None),
        (1, None, "n", T0, T1),
        (2, "v", "n", T0, T1),
        (2, None, "m", T1, None),
    ]
    assert history.select("scd_id").distinct().count() == 4


def test_deleted_key_is_closed_and_may_return(spark):
    current = state(spark, (1, "x", "y", "n"))
    history = step(None, current, T0)
    history = step(history, state(spark), T1)
    assert versions(history) == [(1, "x", "n", T0, T1)]
    history = step(history, current, T2)
    assert versions(history) == [(1, "x", "n", T0, T1), (1, "x", "n", T2, None)]


def test_deleted_key_stays_open_if_asked(spark):
    first = step(None, state(spark, (1, "x", "y", "n")), T0)
    assert versions(step(first, state(spark), T1, close_deleted=False)) == [(1, "x", "n", T0, None)]


def test_one_join_decides(spark):
    first = step(None, state(spark, (1, "x", "y", "n")), T0)
    assert plan(history_changes(first, state(spark, (1, "x", "y", "n")), "k", CHECKS, T1)).count("FullOuter") == 1


def brute_force(states):
    out, opened = [], {}
    for ts, current in states:
        for k in list(opened):
            if current.get(k) != opened[k][0]:
                out.append((k, opened[k][0], opened.pop(k)[1], ts))
        for k, a in current.items():
            if k not in opened:
                opened[k] = (a, ts)
    return sorted(out + [(k, a, since, None) for k, (a, since) in opened.items()], key=str)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dictionaries(st.integers(0, 4), st.sampled_from(["x", "y"])), min_size=2, max_size=4))
def test_against_brute_force(spark, states):
    timed = [(datetime(2024, 1, 1) + timedelta(i), s) for i, s in enumerate(states)]
    history = None
    for ts, current in timed:
        history = step(history, state(spark, *[(k, a, None, None) for k, a in current.items()]), ts)
    got = rows(history, "k", "a", "valid_from", "valid_to")
    assert got == brute_force(timed)
    by_key = defaultdict(list)
    for k, _, since, until in got:
        by_key[k].append((since, until or datetime.max))
    for spans in by_key.values():
        spans.sort()
        assert all(end <= start for (_, end), (start, _) in zip(spans, spans[1:]))


def snapshot(warehouse, run_ts, *customers):
    current = silver.dim_customer(raw(warehouse.spark, "crm_customers", *customers), run_ts)
    warehouse.lake.replace(current, "silver.dim_customer")
    warehouse.snapshot(run_ts)


def spans(warehouse):
    return rows(warehouse.read(HISTORY), "customer_id", "segment", "valid_from", "valid_to")


def test_stored_history_does_not_rewrite_closed_versions(spark, tmp_path):
    warehouse = open_warehouse(spark, str(tmp_path))
    snapshot(warehouse, T0, {"segment": "a"}, {"customer_id": 2, "segment": "a"})
    snapshot(warehouse, T1, {"segment": "b"}, {"customer_id": 2, "segment": "a"})
    snapshot(warehouse, T2, {"segment": "b"})
    assert spans(warehouse) == [(1, "a", T0, T1), (1, "b", T1, None), (2, "a", T0, T2)]
    last = warehouse.lake.versions(HISTORY)[-1]
    assert spark.read.parquet(last + "/is_open=false").count() == 1

    snapshot(warehouse, RUN)  # every customer gone: nothing stays open
    assert spans(warehouse) == [(1, "a", T0, T1), (1, "b", T1, RUN), (2, "a", T0, T2)]
    snapshot(warehouse, RUN + timedelta(1), {"segment": "c"})
    assert (1, "c", RUN + timedelta(1), None) in spans(warehouse) and len(spans(warehouse)) == 4


def test_ambiguous_customers_are_refused(spark, tmp_path):
    warehouse = open_warehouse(spark, str(tmp_path))
    snapshot(warehouse, T0, {"segment": "a"})
    with pytest.raises(ValueError, match="several rows per customer_id"):
        snapshot(warehouse, T1, {"segment": "a"}, {"segment": "b", "source_system": "two"})
    assert spans(warehouse) == [(1, "a", T0, None)]


def test_many_runs_keep_two_open_copies_and_few_closed_folders(spark, tmp_path):
    warehouse, expected = open_warehouse(spark, str(tmp_path)), []
    for i in range(24):
        snapshot(warehouse, T0 + timedelta(i), {"segment": f"s{i % 7}"}, {"customer_id": 2, "segment": "same"})
        open_copies = list((tmp_path / "silver" / "customer_scd2").glob("v=*/is_open=true"))
        assert len(open_copies) <= 2
    assert len(list((tmp_path / "silver" / "customer_scd2").glob("v=*/is_open=false"))) <= 12
    expected = [(1, f"s{i % 7}", T0 + timedelta(i), T0 + timedelta(i + 1) if i < 23 else None) for i in range(24)]
    assert sorted(spans(warehouse), key=str) == sorted([*expected, (2, "same", T0, None)], key=str)


def test_interrupted_snapshot_leaves_the_last_one(spark, tmp_path):
    warehouse = open_warehouse(spark, str(tmp_path))
    snapshot(warehouse, T0, {"segment": "a"})
    before = spans(warehouse)
    dead = tmp_path / "silver" / "customer_scd2" / "v=00000002"
    dead.mkdir()
    (dead / "part-0.parquet").write_bytes(b"half a file")
    assert spans(warehouse) == before
    snapshot(warehouse, T1, {"segment": "b"})
    assert spans(warehouse) == [(1, "a", T0, T1), (1, "b", T1, None)]
