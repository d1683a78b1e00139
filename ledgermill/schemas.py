"""Declared schemas of the source extracts, the raw tables and the control tables.

Fixed values: the column names, order, types and constant source names below are the data contract.
"""

from __future__ import annotations

from pyspark.sql import types as T

INT, LONG, TEXT = T.IntegerType(), T.LongType(), T.StringType()
DATE, TS, FLAG, MONEY = T.DateType(), T.TimestampNTZType(), T.BooleanType(), T.DecimalType(18, 2)


def _struct(*fields: tuple) -> T.StructType:
    """Fields are ``(name, type)`` for optional and ``(name, type, False)`` for required columns."""
    return T.StructType([T.StructField(f[0], f[1], *f[2:]) for f in fields])


CUSTOMERS = _struct(
    ("customer_id", INT, False),
    ("full_name", TEXT, False),
    ("phone", TEXT),
    ("email", TEXT),
    ("birth_date", DATE),
    ("city", TEXT),
    ("segment", TEXT),
    ("registration_date", DATE),
    ("status", TEXT),
)

ACCOUNTS = _struct(
    ("account_id", TEXT, False),
    ("customer_id", INT, False),
    ("product_type", TEXT),
    ("currency", TEXT),
    ("balance", MONEY, False),
    ("opened_date", DATE),
    ("closed_date", DATE),
    ("status", TEXT),
)

CARDS = _struct(
    ("card_id", LONG, False),
    ("account_id", TEXT, False),
    ("card_pan_hash", TEXT),
    ("card_product", TEXT),
    ("expiry_date", DATE),
    ("embossed_name", TEXT),
    ("card_status", TEXT),
    ("issue_date", DATE),
)

TRANSACTIONS = _struct(
    ("trx_id", LONG, False),
    ("account_id", TEXT, False),
    ("customer_id", INT, False),
    ("card_id", LONG),
    ("trx_datetime", TS),
    ("trx_type", TEXT),
    ("amount", MONEY, False),
    ("currency", TEXT),
    ("channel", TEXT),
    ("merchant_category_code", TEXT),
    ("counterparty_name", TEXT),
    ("status", TEXT),
    ("posting_date", DATE),
)

APP_SESSIONS = _struct(
    ("session_id", TEXT, False),
    ("customer_id", INT, False),
    ("login_time", TS),
    ("logout_time", TS),
    ("device_type", TEXT),
    ("app_version", TEXT),
    ("ip_address", TEXT),
    ("os_version", TEXT),
    ("is_new_device", FLAG, False),
)

APP_EVENTS = _struct(
    ("event_id", LONG, False),
    ("session_id", TEXT, False),
    ("customer_id", INT, False),
    ("event_time", TS),
    ("event_type", TEXT),
    ("event_data", TEXT),
    ("is_successful", FLAG, False),
    ("error_message", TEXT),
)

PROVENANCE = _struct(("source_system", TEXT, False), ("load_dttm", TS, False))

LOAD_STATE = _struct(
    ("mapping_name", TEXT, False),
    ("watermark_value", TEXT, False),
    ("watermark_type", TEXT, False),
    ("updated_at", TS, False),
)

LOAD_AUDIT = _struct(
    ("run_id", TEXT, False),
    ("mapping_name", TEXT, False),
    ("target_table", TEXT, False),
    ("load_mode", TEXT, False),
    ("status", TEXT, False),
    ("rows_loaded", LONG, False),
    ("last_watermark", TEXT),
    ("new_watermark", TEXT),
    ("started_at", TS, False),
    ("finished_at", TS, False),
    ("duration_ms", LONG, False),
    ("error_message", TEXT),
)

RISK_MCC_CODES = _struct(("mcc_code", INT), ("mcc_category", TEXT), ("risk_weight", INT))


def raw_schema(source: T.StructType, renames: dict[str, str]) -> T.StructType:
    """Raw table = source columns (renamed where the mapping says so) + provenance."""
    fields = [T.StructField(renames.get(f.name, f.name), f.dataType, f.nullable) for f in source]
    return T.StructType(fields + PROVENANCE.fields)


# Output columns of the silver and gold tables, in contract order.

LINEAGE = (("source_system", TEXT), ("bronze_loaded_at", TS), ("updated_at", TS))
WIDE_MONEY = T.DecimalType(38, 2)

DIM_CUSTOMER = _struct(
    ("customer_id", INT),
    ("full_name", TEXT),
    ("phone_hash", TEXT),
    ("email_hash", TEXT),
    ("birth_date", DATE),
    ("city", TEXT),
    ("segment", TEXT),
    ("registration_date", DATE),
    ("status", TEXT),
    *LINEAGE,
)

DIM_ACCOUNT = _struct(
    ("account_id", TEXT),
    ("customer_id", INT),
    ("product_type", TEXT),
    ("currency", TEXT),
    ("balance", MONEY),
    ("opened_date", DATE),
    ("closed_date", DATE),
    ("status", TEXT),
    *LINEAGE,
)

DIM_CARD = _struct(
    ("card_id", LONG),
    ("account_id", TEXT),
    ("card_pan_hash", TEXT),
    ("card_product", TEXT),
    ("expiry_date", DATE),
    ("embossed_name", TEXT),
    ("card_status", TEXT),
    ("issue_date", DATE),
    *LINEAGE,
)

FACT_TRANSACTION = _struct(
    ("trx_id", LONG),
    ("account_id", TEXT),
    ("customer_id", INT),
    ("card_id", LONG),
    ("trx_datetime", TS),
    ("trx_date", DATE),
    ("trx_type", TEXT),
    ("amount", MONEY),
    ("currency", TEXT),
    ("channel", TEXT),
    ("merchant_category_code", TEXT),
    ("counterparty_name", TEXT),
    ("status", TEXT),
    ("posting_date", DATE),
    *LINEAGE,
)

FACT_APP_SESSION = _struct(
    ("session_id", TEXT),
    ("customer_id", INT),
    ("login_time", TS),
    ("logout_time", TS),
    ("session_date", DATE),
    ("device_type", TEXT),
    ("app_version", TEXT),
    ("ip_address", TEXT),
    ("os_version", TEXT),
    ("is_new_device", FLAG),
    *LINEAGE,
)

FACT_APP_EVENT = _struct(
    ("event_id", LONG),
    ("session_id", TEXT),
    ("customer_id", INT),
    ("event_time", TS),
    ("event_date", DATE),
    ("event_type", TEXT),
    ("event_data_raw", TEXT),
    ("is_successful", FLAG),
    ("error_message", TEXT),
    *LINEAGE,
)

CUSTOMER_SCD2 = T.StructType(
    DIM_CUSTOMER.fields
    + _struct(("scd_id", TEXT), ("scd_updated_at", TS), ("valid_from", TS), ("valid_to", TS)).fields
)

CUSTOMER_360 = _struct(
    ("customer_id", INT),
    ("full_name", TEXT),
    ("segment", TEXT),
    ("city", TEXT),
    ("status", TEXT),
    ("account_count", LONG),
    ("card_count", LONG),
    ("total_balance", WIDE_MONEY),
    ("trx_count", LONG),
    ("trx_amount_total", WIDE_MONEY),
    ("trx_amount_max", MONEY),
    ("last_trx_datetime", TS),
    ("session_count", LONG),
    ("last_login_time", TS),
    ("new_device_session_count", LONG),
    ("failed_event_count", LONG),
    ("refreshed_at", TS),
)

DAILY_TRANSACTION_SUMMARY = _struct(
    ("customer_id", INT),
    ("trx_date", DATE),
    ("trx_count", LONG),
    ("trx_amount_total", WIDE_MONEY),
    ("trx_amount_max", MONEY),
    ("unique_channels", LONG),
    ("unique_mcc", LONG),
    ("refreshed_at", TS),
)

MCC_RISK_ENRICHED_TRANSACTIONS = _struct(
    ("trx_id", LONG),
    ("customer_id", INT),
    ("trx_date", DATE),
    ("trx_datetime", TS),
    ("amount", MONEY),
    ("currency", TEXT),
    ("channel", TEXT),
    ("merchant_category_code", TEXT),
    ("mcc_category", TEXT),
    ("mcc_risk_weight", INT),
    ("risk_weighted_amount", T.DoubleType()),
    ("refreshed_at", TS),
)

PIPELINE_OPERATIONS_DASHBOARD = _struct(
    ("layer", TEXT),
    ("mapping_name", TEXT),
    ("last_status", TEXT),
    ("last_rows_loaded", LONG),
    ("last_run_at", TS),
    ("failed_runs_7d", LONG),
    ("pipeline_health", TEXT),
    ("refreshed_at", TS),
)
