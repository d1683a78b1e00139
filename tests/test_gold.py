from collections import Counter
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import DAY, RUN, T0, T1, audit, frame, plan, raw, rows
from ledgermill import schemas
from ledgermill.operators import lookup
from ledgermill.plans import gold, silver
from ledgermill.sources import risk_mcc_codes


def money(text):
    return Decimal(text)


def build_360(spark, customers=(), accounts=(), cards=(), trx=(), sessions=(), events=(), **options):
    return gold.customer_360(
        silver.dim_customer(raw(spark, "crm_customers", *customers), RUN),
        silver.dim_account(raw(spark, "core_accounts", *accounts), RUN),
        silver.dim_card(raw(spark, "cards", *cards), RUN),
        silver.fact_transaction(raw(spark, "transactions", *trx), RUN),
        silver.fact_app_session(raw(spark, "mobile_sessions", *sessions), RUN),
        silver.fact_app_event(raw(spark, "mobile_events", *events), RUN),
        RUN,
        **options,
    )


def test_customer_without_anything(spark):
    row = build_360(spark, [{}]).first()
    assert (row.account_count, row.card_count, row.trx_count, row.session_count) == (0, 0, 0, 0)
    assert (row.total_balance, row.trx_amount_total, row.trx_amount_max) == (money("0.00"),) * 3
    assert (row.last_trx_datetime, row.last_login_time, row.refreshed_at) == (None, None, RUN)


def test_ids_outside_the_dimension_are_dropped(spark):
    out = build_360(spark, [{}], accounts=[{"customer_id": 99}], trx=[{"customer_id": 98, "posting_date": DAY}])
    assert rows(out, "customer_id") == [(1,)]


ACCOUNTS = [{"account_id": a, "balance": money(b)} for a, b in (("A0", "1.00"), ("A1", "10.00"), ("A2", "100.00"))]
CARDS = [{"card_id": 1, "account_id": "A1"}, {"card_id": 2, "account_id": "A2"}, {"card_id": 3, "account_id": "A2"}]


def test_accounts_fan_out_by_their_cards(spark):
    row = build_360(spark, [{}], ACCOUNTS, CARDS).first()
    assert (row.account_count, row.total_balance, row.card_count) == (4, money("211.00"), 3)


def test_per_account_counts_each_account_once(spark):
    row = build_360(spark, [{}], ACCOUNTS, CARDS, per_account=True).first()
    assert (row.account_count, row.total_balance, row.card_count) == (3, money("111.00"), 3)


def test_a_card_known_to_two_systems_counts_once_but_fans_out_twice(spark):
    cards = [{"account_id": "A1"}, {"account_id": "A1", "source_system": "two"}]
    row = build_360(spark, [{}], [{"balance": money("10.00")}], cards).first()
    assert (row.account_count, row.total_balance, row.card_count) == (2, money("20.00"), 1)


@pytest.mark.parametrize("cards", [[], [{"account_id": "A1"}]])
def test_negative_balance_survives_with_accounts_only(spark, cards):
    row = build_360(spark, [{}], [{"balance": money("-5.00")}], cards).first()
    assert row.total_balance == money("-5.00")


@pytest.mark.parametrize(
    "other",
    [{"trx": [{"posting_date": DAY}]}, {"sessions": [{}]}, {"events": [{}]}],
)
def test_negative_balance_is_lifted_once_another_branch_knows_the_customer(spark, other):
    row = build_360(spark, [{}], [{"balance": money("-5.00")}], **other).first()
    assert row.total_balance == money("0.00")


def test_activity_metrics(spark):
    row = build_360(
        spark,
        [{}],
        trx=[
            {"trx_id": 1, "trx_datetime": T0, "amount": money("2.50")},
            {"trx_id": 2, "trx_datetime": T1, "amount": money("4.00")},
        ],
        sessions=[
            {"session_id": "a", "login_time": T0, "is_new_device": True},
            {"session_id": "b", "login_time": T1},
            {"session_id": "c"},
        ],
        events=[{"event_id": 1, "is_successful": False}, {"event_id": 2}],
    ).first()
    assert (row.trx_count, row.trx_amount_total, row.trx_amount_max, row.last_trx_datetime) == (
        2, money("6.50"), money("4.00"), T1,
    )
    assert (row.session_count, row.last_login_time, row.new_device_session_count) == (3, T1, 1)
    assert row.failed_event_count == 1


def by_hand(accounts, cards, amounts, sessions, events):
    """Zero-padded branches merged by max, computed row by row."""
    branches = []
    for customer in {c for c, _ in accounts.values()}:
        owned = [(b, [k for k, at in cards if at == a] or [None]) for (a, _), (c, b) in accounts.items() if c == customer]
        joined = [(b, k) for b, ks in owned for k in ks]
        seen = {k for _, k in joined if k is not None}
        branches.append((customer, (len(joined), len(seen), sum(b for b, _ in joined), 0, 0, 0, 0)))
    for customer in {c for c, _ in amounts}:
        own = [a for c, a in amounts if c == customer]
        branches.append((customer, (0, 0, 0, len(own), sum(own), 0, 0)))
    for customer in set(sessions):
        branches.append((customer, (0, 0, 0, 0, 0, sessions.count(customer), 0)))
    for customer in {c for c, _ in events}:
        branches.append((customer, (0, 0, 0, 0, 0, 0, sum(1 for c, good in events if c == customer and not good))))
    merged = {}
    for customer, metrics in branches:
        merged[customer] = tuple(map(max, merged.get(customer, metrics), metrics))
    return merged


ids = st.integers(1, 3)
cents = st.integers(-3, 3)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    accounts=st.dictionaries(st.tuples(st.sampled_from("ABC"), st.sampled_from("xy")), st.tuples(ids, cents), max_size=5),
    cards=st.lists(st.tuples(st.integers(1, 4), st.sampled_from("ABCD")), max_size=6),
    amounts=st.lists(st.tuples(ids, cents), max_size=4),
    sessions=st.lists(ids, max_size=4),
    events=st.lists(st.tuples(ids, st.booleans()), max_size=4),
)
def test_metrics_against_brute_force(spark, accounts, cards, amounts, sessions, events):
    def small(rows, schema):
        return spark.createDataFrame(rows, schema)

    out = gold.customer_metrics(
        small([(a, c, Decimal(b)) for (a, _), (c, b) in accounts.items()], "account_id string, customer_id int, balance decimal(18,2)"),
        small(cards, "card_id bigint, account_id string"),
        small([(c, Decimal(a), T0) for c, a in amounts], "customer_id int, amount decimal(18,2), trx_datetime timestamp_ntz"),
        small([(c, T0, True) for c in sessions], "customer_id int, login_time timestamp_ntz, is_new_device boolean"),
        small(events, "customer_id int, is_successful boolean"),
    )
    columns = ("account_count", "card_count", "total_balance", "trx_count", "trx_amount_total")
    columns += ("session_count", "failed_event_count")
    got = {r.customer_id: tuple(r[c] for c in columns) for r in out.collect()}
    assert got == by_hand(accounts, cards, amounts, sessions, events)


def stored(spark, tmp_path, name, df):
    df.write.parquet(str(tmp_path / name))
    return spark.read.parquet(str(tmp_path / name))


def test_merge_adds_no_exchange(spark, tmp_path):
    facts = stored(spark, tmp_path, "f", silver.fact_transaction(raw(spark, "transactions", {"posting_date": DAY}), RUN))
    sessions = stored(spark, tmp_path, "s", silver.fact_app_session(raw(spark, "mobile_sessions", {}), RUN))
    events = stored(spark, tmp_path, "e", silver.fact_app_event(raw(spark, "mobile_events", {}), RUN))
    accounts = stored(spark, tmp_path, "a", silver.dim_account(raw(spark, "core_accounts", {}), RUN))
    cards = stored(spark, tmp_path, "c", silver.dim_card(raw(spark, "cards", {}), RUN))
    joined = plan(gold.customer_metrics(accounts, cards, facts, sessions, events))
    above_union = joined[: joined.index("Union")]
    assert "Exchange" not in above_union


def test_accounts_and_cards_are_scanned_once(spark, tmp_path):
    accounts = stored(spark, tmp_path, "a", silver.dim_account(raw(spark, "core_accounts", {}), RUN))
    cards = stored(spark, tmp_path, "c", silver.dim_card(raw(spark, "cards", {}), RUN))
    metrics = plan(gold.holdings_by_customer(accounts, cards))
    assert metrics.count("FileScan") == 2 and "Expand" not in metrics
    assert "ReadSchema: struct<card_id:bigint,account_id:string>" in metrics


def test_a_hot_account_is_split(spark, tmp_path):
    """One account holds a third of the cards, in a join that nothing but their salt splits: no task has much more than its share."""
    owners = spark.range(20_000).selectExpr("concat('A', id) AS account_id", "id % 90 AS customer_id", "cast(1 AS decimal(18,2)) AS balance")
    accounts = stored(spark, tmp_path, "a", owners)
    owned = spark.range(0, 300_000, 1, 8).selectExpr("id AS card_id", "concat('A', if(id % 3 = 0, 7, id % 20000)) AS account_id")
    cards = stored(spark, tmp_path, "c", owned)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        by_task = gold.holdings(accounts, cards).groupBy(F.spark_partition_id()).count()
        assert by_task.agg(F.max("count")).first()[0] < 2 * 300_000 / 8
        out = gold.holdings_by_customer(accounts, cards)
        got = {r.customer_id: (r.card_count, r.account_count, r.total_balance) for r in out.collect()}
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    cards_of = Counter(7 if i % 3 == 0 else i % 20_000 for i in range(300_000))
    expected = Counter()
    for account, n in cards_of.items():
        expected[account % 90] += n
    without = Counter(a % 90 for a in range(20_000) if a not in cards_of)
    assert got == {c: (expected[c], expected[c] + without[c], expected[c] + without[c]) for c in range(90)}


def test_daily_summary(spark):
    df = raw(
        spark,
        "transactions",
        {"trx_id": 1, "posting_date": DAY, "channel": "pos", "merchant_category_code": "1", "status": "pending"},
        {"trx_id": 2, "posting_date": DAY, "channel": "web", "merchant_category_code": "1"},
        {"trx_id": 3, "posting_date": DAY, "channel": " ", "merchant_category_code": None},
        {"trx_id": 4, "posting_date": DAY, "customer_id": 2},
    )
    out = gold.daily_transaction_summary(silver.fact_transaction(df, RUN), RUN)
    got = rows(out, "customer_id", "trx_count", "trx_amount_total", "unique_channels", "unique_mcc")
    assert got == [(1, 3, money("15.00"), 2, 1), (2, 1, money("5.00"), 0, 0)]


def test_daily_summary_with_one_hot_day(spark):
    df = spark.range(30_000).selectExpr(
        "if(id < 10000, 1, cast(id AS int)) AS customer_id",
        "DATE '2024-01-05' AS trx_date",
        "cast(1 AS decimal(18,2)) AS amount",
        "cast(id % 700 AS string) AS channel",
        "cast(id % 300 AS string) AS merchant_category_code",
    )
    out = gold.daily_transaction_summary(df, RUN)
    hot = out.filter("customer_id = 1").first()
    assert (hot.trx_count, hot.unique_channels, hot.unique_mcc) == (10_000, 700, 300)
    assert out.count() == 20_001
    # a thousand values in all: they are spread by value, not gathered in the group's task
    assert "hashpartitioning(customer_id#" in plan(out) and plan(out).count("Exchange hashpartitioning") == 2


def test_daily_summary_expands_no_rows(spark, tmp_path):
    given = [{"trx_id": i, "posting_date": DAY, "customer_id": i, "channel": f"c{i % 3}"} for i in range(1, 40)]
    facts = stored(spark, tmp_path, "f", silver.fact_transaction(raw(spark, "transactions", *given), RUN))
    daily = plan(gold.daily_transaction_summary(facts, RUN))
    assert "Expand" not in daily and daily.count("Exchange hashpartitioning") == 1


MCC = [("5411", "Grocery", 15, 0.75), ("5999", "Unknown", 30, 1.5), ("0742", "Unknown", 30, 1.5)]
MCC += [("5411 ", "Unknown", 30, 1.5), (None, "Unknown", 30, 1.5)]


def test_risk_codes_match_as_untrimmed_text(spark):
    given = [
        {"trx_id": i, "posting_date": DAY, "merchant_category_code": code} for i, (code, *_) in enumerate(MCC, 1)
    ]
    fact = silver.fact_transaction(raw(spark, "transactions", *given), RUN)
    out = gold.mcc_risk_enriched(fact, risk_mcc_codes(spark), RUN).orderBy("trx_id")
    columns = ("merchant_category_code", "mcc_category", "mcc_risk_weight", "risk_weighted_amount")
    assert [tuple(r) for r in out.select(*columns).collect()] == MCC


def test_reference_beyond_the_bound_is_not_broadcast(spark, monkeypatch):
    fact = silver.fact_transaction(raw(spark, "transactions", {"posting_date": DAY}), RUN)
    codes = risk_mcc_codes(spark)
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")  # leave the choice to the hint
    try:
        small = gold.mcc_risk_enriched(fact, codes, RUN)
        monkeypatch.setattr(lookup, "BROADCAST_BYTES", 3)
        large = gold.mcc_risk_enriched(fact, codes, RUN)
        assert "BroadcastHashJoin" in plan(small) and "SortMergeJoin" in plan(large)
        assert "SortMergeJoin" in plan(gold.mcc_risk_enriched(fact, codes, RUN, broadcast=False))
        assert rows(small) == rows(large)
    finally:
        spark.conf.set(setting, before)


def test_a_large_reference_is_cut_to_the_codes_of_the_facts(spark, monkeypatch):
    seen, spread = [], lookup.spread_join
    monkeypatch.setattr(lookup, "spread_join", lambda facts, reference, *how: seen.append(rows(reference)) or spread(facts, reference, *how))
    given = [{"trx_id": i, "posting_date": DAY, "merchant_category_code": code} for i, (code, *_) in enumerate(MCC, 1)]
    fact = silver.fact_transaction(raw(spark, "transactions", *given), RUN)
    out = gold.mcc_risk_enriched(fact, risk_mcc_codes(spark), RUN, broadcast=False).orderBy("trx_id")
    columns = ("merchant_category_code", "mcc_category", "mcc_risk_weight", "risk_weighted_amount")
    assert [tuple(r) for r in out.select(*columns).collect()] == MCC
    assert seen == [[("5411", "Grocery", 15)]]
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 3)  # as many codes as may not be broadcast
    assert rows(gold.mcc_risk_enriched(fact, risk_mcc_codes(spark), RUN, broadcast=False)) == rows(out)
    assert len(seen[1]) == risk_mcc_codes(spark).count()


def test_a_hot_code_is_split(spark, tmp_path, monkeypatch):
    """A third of the transactions has one code and a third none: no task of the join has much more than its share."""
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 3)
    code = F.when(F.col("trx_id") % 3 == 0, "5411").when(F.col("trx_id") % 3 == 1, F.concat(F.lit("x"), "trx_id"))
    fact = silver.fact_transaction(raw(spark, "transactions", {"posting_date": DAY}), RUN).drop("trx_id", "merchant_category_code")
    ids = spark.range(30_000).withColumnRenamed("id", "trx_id").withColumn("merchant_category_code", code)
    fact = stored(spark, tmp_path, "f", fact.join(ids, F.lit(True)))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        out = gold.mcc_risk_enriched(fact, risk_mcc_codes(spark), RUN)
        assert out.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 2 * 30_000 / 8
        assert rows(out.groupBy("mcc_category").count()) == [("Grocery", 10_000), ("Unknown", 20_000)]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def runs(*entries):
    return [
        {"mapping_name": m, "status": s, "started_at": RUN - age, "rows_loaded": n, "run_id": str(i)}
        for i, (m, s, age, n) in enumerate(entries)
    ]


def test_dashboard_window_and_health(spark):
    hour = timedelta(hours=1)
    df = audit(
        spark,
        *runs(
            ("good", "failed", 5 * hour, 0),
            ("good", "success", hour, 7),
            ("bad", "success", 5 * hour, 7),
            ("bad", "failed", hour, 0),
            ("edge", "success", timedelta(days=7), 3),
            ("gone", "success", timedelta(days=7, microseconds=1), 3),
        ),
    )
    out = gold.operations_dashboard(df, RUN)
    got = rows(out, "mapping_name", "last_status", "last_rows_loaded", "failed_runs_7d", "pipeline_health")
    assert got == [
        ("bad", "failed", 0, 1, "degraded"),
        ("edge", "success", 3, 0, "healthy"),
        ("good", "success", 7, 1, "healthy"),
    ]
    assert rows(out, "layer") == [("bronze",)] * 3


def test_dashboard_skips_null_values(spark):
    schema = schemas.LOAD_AUDIT
    entries = runs(("m", "success", timedelta(hours=2), 5), ("m", "success", timedelta(hours=1), None))
    out = gold.operations_dashboard(frame(spark, schema, entries), RUN)
    assert rows(out, "last_rows_loaded", "last_run_at") == [(5, datetime(2024, 1, 30, 23))]
