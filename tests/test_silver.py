from datetime import date, datetime
from decimal import Decimal

import pytest

from helpers import DAY, RUN, T0, T1, T2, raw, rows
from ledgermill import schemas
from ledgermill.plans import silver
from ledgermill.plans.tables import GOLD, SILVER
from ledgermill.testing.bindings import TestTables
from ledgermill.testing.queries import QUERIES

MODELS = [t.name.split(".")[1] for t in (*SILVER, *GOLD)] + ["customer_scd2", "pipeline_operations_dashboard"]


@pytest.mark.parametrize("name", MODELS)
def test_output_contract(spark, name):
    declared = getattr(schemas, name.upper())
    assert QUERIES[name](spark, "/root/testdata/sf0.001").dtypes == [(f.name, f.dataType.simpleString()) for f in declared]


def test_customer_cleansing_and_hashing(spark):
    df = raw(
        spark,
        "crm_customers",
        {"full_name": "  Ann ", "phone": " 1 ", "email": "  ", "city": " X ", "segment": "", "status": None},
        {"customer_id": 2, "full_name": "  ", "phone": "1", "email": None},
        {"customer_id": 0},
        {"customer_id": -1},
        {"customer_id": None},
    )
    out = {r.customer_id: r for r in silver.dim_customer(df, RUN).collect()}
    assert set(out) == {1, 2}
    assert out[1].full_name == "Ann" and out[2].full_name == ""
    assert out[1].phone_hash == out[2].phone_hash and len(out[1].phone_hash) == 64
    assert out[1].email_hash is None and out[2].email_hash is None
    assert (out[1].city, out[1].segment, out[1].status) == ("X", None, None)
    assert out[1].updated_at == RUN and out[1].bronze_loaded_at == T0


def test_late_older_row_loses_and_systems_stay_apart(spark):
    df = raw(
        spark,
        "crm_customers",
        {"city": "new", "load_dttm": T2},
        {"city": "old", "load_dttm": T1},
        {"city": "other", "source_system": "two"},
    )
    assert rows(silver.dim_customer(df, RUN), "source_system", "city") == [("one", "new"), ("two", "other")]


def test_rejected_row_does_not_hide_an_accepted_one(spark):
    df = raw(spark, "core_accounts", {"load_dttm": T2, "customer_id": 0}, {"load_dttm": T1, "customer_id": 7})
    assert rows(silver.dim_account(df, RUN), "customer_id") == [(7,)]


def test_blank_key_passes_empty_key_does_not(spark):
    df = raw(spark, "core_accounts", {"account_id": "  "}, {"account_id": ""}, {"account_id": None})
    assert rows(silver.dim_account(df, RUN), "account_id") == [("  ",)]


def test_card_passes_the_pan_hash_through(spark):
    df = raw(spark, "cards", {"card_pan_hash": " h ", "card_product": " p ", "embossed_name": " "}, {"card_id": 0})
    assert rows(silver.dim_card(df, RUN), "card_pan_hash", "card_product", "embossed_name") == [(" h ", "p", None)]


def test_transaction_time_falls_back_or_drops(spark):
    moment = datetime(2024, 1, 3, 23, 59)
    df = raw(
        spark,
        "transactions",
        {"trx_id": 1, "trx_datetime": moment, "posting_date": DAY},
        {"trx_id": 2, "posting_date": DAY},
        {"trx_id": 3},
    )
    assert rows(silver.fact_transaction(df, RUN), "trx_id", "trx_datetime", "trx_date") == [
        (1, moment, date(2024, 1, 3)),
        (2, datetime(2024, 1, 5), DAY),
    ]


def test_transaction_text_columns(spark):
    df = raw(
        spark,
        "transactions",
        {"posting_date": DAY, "merchant_category_code": "5411 ", "channel": " pos ", "currency": "", "status": " "},
    )
    got = rows(silver.fact_transaction(df, RUN), "merchant_category_code", "channel", "currency", "status", "card_id")
    assert got == [("5411 ", "pos", None, None, None)]


def test_session_and_event_dates_fall_back_to_the_load(spark):
    sessions = raw(spark, "mobile_sessions", {"load_dttm": T1}, {"session_id": "S2", "login_time": T0})
    assert rows(silver.fact_app_session(sessions, RUN), "session_id", "session_date", "login_time") == [
        ("S1", date(2024, 1, 2), None),
        ("S2", date(2024, 1, 1), T0),
    ]
    events = raw(
        spark,
        "mobile_events",
        {"load_dttm": T1, "error_message": " e ", "event_data_raw": ' {"a":1} '},
        {"event_id": 0},
        {"event_id": 2, "session_id": ""},
        {"event_id": 3, "customer_id": 0},
    )
    got = rows(silver.fact_app_event(events, RUN), "event_id", "event_date", "error_message", "event_data_raw")
    assert got == [(1, date(2024, 1, 2), "e", ' {"a":1} ')]


def test_loading_in_slices_equals_loading_once(spark):
    tables = TestTables(spark, "/root/testdata/sf0.001")
    whole = tables.raw("payments_transactions_raw")
    again = whole.unionByName(whole.filter("trx_id > 3000"))
    once, twice = (rows(silver.fact_transaction(df, RUN)) for df in (whole, again))
    assert once == twice
    keys = [r[0] for r in once]
    assert len(keys) == len(set(keys))


def test_daily_totals_add_up_to_the_fact(spark):
    folder = "/root/testdata/sf0.001"
    fact = QUERIES["fact_transaction"](spark, folder).agg({"amount": "sum"}).first()[0]
    daily = QUERIES["daily_transaction_summary"](spark, folder).agg({"trx_amount_total": "sum"}).first()[0]
    assert fact == daily and isinstance(daily, Decimal)
