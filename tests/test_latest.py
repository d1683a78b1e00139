from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import plan, rows
from ledgermill.operators import latest, latest_of_repeated, latest_per_key
from ledgermill.operators.filters import by_filter, key_filter

SCHEMA = "k int, s string, v timestamp_ntz, x int"
BASE = datetime(2024, 1, 1)


def test_newest_wins_whatever_the_arrival_order(spark):
    df = spark.createDataFrame([(1, "a", BASE + timedelta(1), 1), (1, "a", BASE, 2)], SCHEMA)
    assert rows(latest_per_key(df, ["k", "s"], "v"), "x") == [(1,)]


def test_source_systems_are_kept_apart(spark):
    df = spark.createDataFrame([(1, "a", BASE, 1), (1, "b", BASE, 2)], SCHEMA)
    assert rows(latest_per_key(df, ["k", "s"], "v"), "x") == [(1,), (2,)]


def test_ties_do_not_depend_on_partitioning(spark):
    data = [(1, "a", BASE, x) for x in (None, 3, 9, 4)]
    for parts in (1, 2, 4):
        df = spark.createDataFrame(data, SCHEMA).repartition(parts)
        assert rows(latest_per_key(df, ["k", "s"], "v"), "x") == [(9,)]


def test_rows_are_cut_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "current_timestamp() AS v")
    limits = plan(latest_per_key(df.repartition(4), ["k"], "v")).count("WindowGroupLimit")
    assert limits == 2


def test_one_key_with_a_third_of_the_rows(spark):
    df = spark.range(90_000).selectExpr(
        "if(id < 30000, -1, id) AS k", "cast(id AS int) AS x", "TIMESTAMP_NTZ '2024-01-01' AS v"
    )
    got = latest_per_key(df.repartition(8), ["k"], "v")
    assert got.count() == 60_001
    assert got.filter("k = -1").first()["x"] == 29_999


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.integers(0, 3), st.sampled_from("ab"), st.integers(0, 2), st.integers(0, 50)),
        min_size=1,
        max_size=30,
    )
)
def test_against_brute_force(spark, data):
    df = spark.createDataFrame([(k, s, BASE + timedelta(d), x) for k, s, d, x in data], SCHEMA)
    best = {}
    for k, s, d, x in data:
        best[k, s] = max(best.get((k, s), (d, x)), (d, x))
    got = latest_per_key(df, ["k", "s"], "v").select("k", "s", F.datediff("v", F.lit(BASE)).alias("d"), "x")
    assert {(r.k, r.s): (r.d, r.x) for r in got.collect()} == best


def test_of_repeated_keys_the_same_rows_stay(spark):
    days = [BASE + timedelta(d) for d in (0, 1)]
    data = [(k, s, days[i % 2], x) for k in (1, 2, None) for s in ("a", "b", None) for i, x in enumerate((3, 9, None, 9)[: 1 + (k or 0)])]
    data += [(k, "a", BASE, k) for k in range(10, 400)]
    for parts in (1, 5):
        df = spark.createDataFrame(data, SCHEMA).repartition(parts)
        assert rows(latest_of_repeated(df, ["k", "s"], "v")) == rows(latest_per_key(df, ["k", "s"], "v"))
    assert rows(latest_of_repeated(df.limit(0), ["k", "s"], "v")) == []


def test_rows_of_keys_that_occur_once_are_not_ranked(spark, monkeypatch):
    """Whatever a table holds of them, a few at most are shuffled in whole rows."""
    ranked = []
    monkeypatch.setattr(latest, "latest_per_key", lambda df, *rest: ranked.append(df.count()) or latest_per_key(df, *rest))
    df = spark.range(20_000).selectExpr("cast(id % 19000 AS int) AS k", "'a' AS s", "timestamp_ntz '2024-01-01' + make_interval(0, 0, 0, cast(id div 19000 AS int)) AS v", "cast(id AS int) AS x")
    found = latest_of_repeated(df, ["k", "s"], "v")
    assert found.count() == 19_000 and found.filter("x < 1000").isEmpty()
    assert 2_000 <= ranked[0] < 2_500


def test_a_full_filter_still_passes_all_its_keys(spark, monkeypatch):
    monkeypatch.setattr("ledgermill.operators.filters.MOST_BITS", 1 << 8)
    df = spark.range(5_000).selectExpr("cast(id AS int) AS k", "cast(nullif(id % 7, 0) AS string) AS s")
    keys = df.filter("k % 3 = 0")
    words, n = key_filter(keys, 5_000)
    assert by_filter(df, ["k", "s"], words, n).filter("k % 3 = 0").count() == keys.count()
    assert by_filter(df, ["k", "s"], words, n, passing=False).filter("k % 3 = 0").isEmpty()
