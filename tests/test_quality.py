from datetime import timedelta
from decimal import Decimal

import pytest

from helpers import DAY, RUN, T0, T1, audit, raw, rows
from ledgermill.operators import quality
from ledgermill.plans import silver


def test_duplicates_and_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert rows(quality.duplicates(df, "k")) == [("a", 2)]
    assert quality.nulls(df, "k").count() == 2


def test_negative_amounts(spark):
    given = [{"trx_id": 1, "posting_date": DAY, "amount": Decimal("-0.01")}, {"trx_id": 2, "posting_date": DAY}]
    fact = silver.fact_transaction(raw(spark, "transactions", *given), RUN)
    assert rows(quality.negative_amounts(fact)) == [(1, Decimal("-0.01"))]


def test_empty_and_not_empty(spark):
    for n, filled in ((0, False), (3, True)):
        assert quality.not_empty(spark.range(n)).first()["ok"] is filled
        assert quality.is_empty(spark.range(n)).first()["ok"] is not filled


def test_hash_shape(spark):
    good = "0" * 64
    df = spark.createDataFrame([(good, None), (None, None), ("x", good), (good, "")], "phone_hash string, email_hash string")
    assert quality.malformed_hashes(df).count() == 2


def test_failing_mappings_look_at_the_latest_run_only(spark):
    df = audit(
        spark,
        {"mapping_name": "a", "status": "failed", "started_at": T0},
        {"mapping_name": "a", "status": "success", "started_at": T1},
        {"mapping_name": "b", "status": "success", "started_at": T0 - timedelta(100)},
        {"mapping_name": "b", "status": "failed", "started_at": T0 - timedelta(99)},
    )
    assert rows(quality.failing_mappings(df)) == [("b", "failed")]


@pytest.mark.parametrize(
    ("age", "status"),
    [
        (timedelta(hours=1), "pass"),
        (timedelta(hours=36), "pass"),
        (timedelta(hours=36, seconds=1), "warn"),
        (timedelta(hours=72), "warn"),
        (timedelta(hours=72, seconds=1), "error"),
    ],
)
def test_freshness(spark, age, status):
    df = raw(spark, "cards", {"load_dttm": RUN - age}, {"load_dttm": RUN - age - timedelta(9)})
    assert tuple(quality.freshness(df, RUN).first()) == (RUN - age, status)


def test_an_empty_table_is_not_fresh(spark):
    assert tuple(quality.freshness(raw(spark, "cards"), RUN).first()) == (None, "error")


def test_runner_reports_all_and_raises(spark):
    def broken():
        raise RuntimeError("boom")

    checks = {"good": lambda: True, "bad": lambda: False, "broken": broken, "after": lambda: True}
    with pytest.raises(quality.ChecksFailed, match="bad, broken") as caught:
        quality.run_checks(spark, checks)
    report = [("good", True, None), ("bad", False, None), ("broken", False, "boom"), ("after", True, None)]
    assert [tuple(r) for r in caught.value.report.collect()] == report
    assert quality.run_checks(spark, checks, raise_on_failure=False).count() == 4
    assert quality.run_checks(spark, {"good": lambda: True}).columns == ["check", "ok", "detail"]
