"""Cleaned, deduplicated dimensions and facts, one builder per raw table."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import blank_to_null, has_text, hash_pii, ntz, positive
from ledgermill.operators import latest_of_repeated, latest_per_key, scd2_check

CUSTOMER_CHECK_COLUMNS = ("full_name", "segment", "status", "city")


def _cleaned(raw: DataFrame, keep: Column, key: str, columns: Mapping[str, Column | None], run_ts: datetime, large: bool):
    """Filter, project, keep the newest row of each key and source system, stamp the run time.

    ``columns`` lists the output in order; ``None`` passes a raw column through. The filter comes
    before the dedup, so a rejected row never hides an accepted one. Of a ``large`` table only rows of
    keys that occur again are shuffled for it, which takes jobs of its own.
    """
    body = [F.col(name) if value is None else value.alias(name) for name, value in columns.items()]
    rows = raw.filter(keep).select(*body, "source_system", F.col("load_dttm").alias("bronze_loaded_at"))
    newest = (latest_of_repeated if large else latest_per_key)(rows, (key, "source_system"), "bronze_loaded_at")
    return newest.withColumn("updated_at", ntz(run_ts))


def dim_customer(raw: DataFrame, run_ts: datetime, large: bool = False) -> DataFrame:
    columns = {
        "customer_id": None,
        "full_name": F.trim("full_name"),
        "phone_hash": hash_pii(blank_to_null("phone")),
        "email_hash": hash_pii(blank_to_null("email")),
        "birth_date": None,
        "city": blank_to_null("city"),
        "segment": blank_to_null("segment"),
        "registration_date": None,
        "status": blank_to_null("status"),
    }
    return _cleaned(raw, positive("customer_id"), "customer_id", columns, run_ts, large)


def dim_account(raw: DataFrame, run_ts: datetime, large: bool = False) -> DataFrame:
    columns = {
        "account_id": None,
        "customer_id": None,
        "product_type": blank_to_null("product_type"),
        "currency": blank_to_null("currency"),
        "balance": None,
        "opened_date": None,
        "closed_date": None,
        "status": blank_to_null("status"),
    }
    return _cleaned(raw, has_text("account_id") & positive("customer_id"), "account_id", columns, run_ts, large)


def dim_card(raw: DataFrame, run_ts: datetime, large: bool = False) -> DataFrame:
    columns = {
        "card_id": None,
        "account_id": None,
        "card_pan_hash": None,
        "card_product": blank_to_null("card_product"),
        "expiry_date": None,
        "embossed_name": blank_to_null("embossed_name"),
        "card_status": blank_to_null("card_status"),
        "issue_date": None,
    }
    return _cleaned(raw, positive("card_id") & has_text("account_id"), "card_id", columns, run_ts, large)


def fact_transaction(raw: DataFrame, run_ts: datetime, large: bool = False) -> DataFrame:
    """The time falls back to the posting date; a row with neither is dropped."""
    moment = F.coalesce("trx_datetime", F.col("posting_date").cast("timestamp_ntz"))
    columns = {
        "trx_id": None,
        "account_id": None,
        "customer_id": None,
        "card_id": None,
        "trx_datetime": moment,
        "trx_date": moment.cast("date"),
        "trx_type": blank_to_null("trx_type"),
        "amount": None,
        "currency": blank_to_null("currency"),
        "channel": blank_to_null("channel"),
        "merchant_category_code": None,
        "counterparty_name": blank_to_null("counterparty_name"),
        "status": blank_to_null("status"),
        "posting_date": None,
    }
    keep = positive("trx_id") & positive("customer_id") & has_text("account_id") & moment.isNotNull()
    return _cleaned(raw, keep, "trx_id", columns, run_ts, large)


def fact_app_session(raw: DataFrame, run_ts: datetime, large: bool = False) -> DataFrame:
    """The session date falls back to the load time, so no row is lost."""
    columns = {
        "session_id": None,
        "customer_id": None,
        "login_time": None,
        "logout_time": None,
        "session_date": F.coalesce("login_time", "load_dttm").cast("date"),
        "device_type": blank_to_null("device_type"),
        "app_version": blank_to_null("app_version"),
        "ip_address": blank_to_null("ip_address"),
        "os_version": blank_to_null("os_version"),
        "is_new_device": None,
    }
    return _cleaned(raw, has_text("session_id") & positive("customer_id"), "session_id", columns, run_ts, large)


def fact_app_event(raw: DataFrame, run_ts: datetime, large: bool = False) -> DataFrame:
    columns = {
        "event_id": None,
        "session_id": None,
        "customer_id": None,
        "event_time": None,
        "event_date": F.coalesce("event_time", "load_dttm").cast("date"),
        "event_type": blank_to_null("event_type"),
        "event_data_raw": None,
        "is_successful": None,
        "error_message": blank_to_null("error_message"),
    }
    keep = positive("event_id") & has_text("session_id") & positive("customer_id")
    return _cleaned(raw, keep, "event_id", columns, run_ts, large)


def customer_scd2(previous: DataFrame | None, customers: DataFrame, run_ts: datetime) -> DataFrame:
    """Customer history; keys missing from ``customers`` are closed."""
    return scd2_check(previous, customers, "customer_id", CUSTOMER_CHECK_COLUMNS, run_ts)
