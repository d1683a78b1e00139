"""Marts over the silver layer."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import ntz
from ledgermill.operators import count_few_values, fits_broadcast, join_reference, merge_metrics, spread_join

UNKNOWN_MCC_CATEGORY, UNKNOWN_MCC_WEIGHT = "Unknown", 30
DASHBOARD_DAYS = 7

WIDE_MONEY = "decimal(38,2)"


def _rows() -> Column:
    return F.count(F.lit(1))


def holdings(dim_account: DataFrame, dim_card: DataFrame) -> DataFrame:
    """customer_id, balance, card_id: one row for each account and card of it, and for an account without cards.

    One join serves every metric of accounts and cards. Cards of an account that holds a large part of all
    cards are dealt over many tasks by their own key, and the account's row goes to each of them.
    """
    cards = dim_card.select("account_id", "card_id")
    accounts = dim_account.select("account_id", "customer_id", "balance")
    joined = spread_join(cards, accounts, "account_id", ["card_id"], "right")
    return joined.select("customer_id", "balance", "card_id")


def holdings_by_customer(dim_account: DataFrame, dim_card: DataFrame, per_account: bool = False) -> DataFrame:
    """Count and balance of accounts, and distinct cards.

    The contract counts the joined rows: an account with two cards counts twice and so does its balance.
    ``per_account=True`` counts each account once, from the accounts alone.
    """
    owned = holdings(dim_account, dim_card)
    cards = F.count_distinct("card_id").alias("card_count")
    counts = (_rows().alias("account_count"), F.sum(F.col("balance").cast(WIDE_MONEY)).cast(WIDE_MONEY).alias("total_balance"))
    if not per_account:
        return owned.groupBy("customer_id").agg(*counts, cards)
    accounts = dim_account.groupBy("customer_id").agg(*counts)
    return accounts.join(owned.groupBy("customer_id").agg(cards), "customer_id")


def transactions_by_customer(fact_transaction: DataFrame) -> DataFrame:
    return fact_transaction.groupBy("customer_id").agg(
        _rows().alias("trx_count"),
        F.sum("amount").cast(WIDE_MONEY).alias("trx_amount_total"),
        F.max("amount").alias("trx_amount_max"),
        F.max("trx_datetime").alias("last_trx_datetime"),
    )


def sessions_by_customer(fact_app_session: DataFrame) -> DataFrame:
    return fact_app_session.groupBy("customer_id").agg(
        _rows().alias("session_count"),
        F.max("login_time").alias("last_login_time"),
        F.count_if("is_new_device").alias("new_device_session_count"),
    )


def events_by_customer(fact_app_event: DataFrame) -> DataFrame:
    return fact_app_event.groupBy("customer_id").agg(
        F.count_if(~F.col("is_successful")).alias("failed_event_count")
    )


def customer_metrics(
    dim_account: DataFrame,
    dim_card: DataFrame,
    fact_transaction: DataFrame,
    fact_app_session: DataFrame,
    fact_app_event: DataFrame,
    per_account: bool = False,
) -> DataFrame:
    """One row per customer id that occurs in any table.

    The metrics are merged by max over zero-padded branches, so a negative total is lifted to zero
    unless the customer occurs in accounts only.
    """
    zero, none = F.lit(0), F.lit(None)
    kinds = {
        "account_count": ("bigint", zero),
        "card_count": ("bigint", zero),
        "total_balance": (WIDE_MONEY, zero),
        "trx_count": ("bigint", zero),
        "trx_amount_total": (WIDE_MONEY, zero),
        "trx_amount_max": ("decimal(18,2)", zero),
        "last_trx_datetime": ("timestamp_ntz", none),
        "session_count": ("bigint", zero),
        "last_login_time": ("timestamp_ntz", none),
        "new_device_session_count": ("bigint", zero),
        "failed_event_count": ("bigint", zero),
    }
    defaults = {name: value.cast(kind) for name, (kind, value) in kinds.items()}
    return merge_metrics(
        "customer_id",
        defaults,
        [
            holdings_by_customer(dim_account, dim_card, per_account),
            transactions_by_customer(fact_transaction),
            sessions_by_customer(fact_app_session),
            events_by_customer(fact_app_event),
        ],
    )


def customer_360(
    dim_customer: DataFrame,
    dim_account: DataFrame,
    dim_card: DataFrame,
    fact_transaction: DataFrame,
    fact_app_session: DataFrame,
    fact_app_event: DataFrame,
    run_ts: datetime,
    per_account: bool = False,
) -> DataFrame:
    """Every customer of the dimension with its metrics; ids the dimension lacks are dropped."""
    metrics = customer_metrics(
        dim_account, dim_card, fact_transaction, fact_app_session, fact_app_event, per_account
    )
    profile = ("customer_id", "full_name", "segment", "city", "status")
    may_be_null = ("last_trx_datetime", "last_login_time")

    def shown(field) -> Column:
        value = F.col(field.name)
        if field.name not in may_be_null:
            value = F.coalesce(value, F.lit(0).cast(field.dataType))
        return value.alias(field.name)

    return (
        dim_customer.select(*profile)
        .join(metrics, "customer_id", "left")
        .select(
            *profile,
            *[shown(f) for f in metrics.schema if f.name != "customer_id"],
            ntz(run_ts).alias("refreshed_at"),
        )
    )


def daily_transaction_summary(fact_transaction: DataFrame, run_ts: datetime) -> DataFrame:
    """Transactions of a customer and day, with the distinct channels and merchant codes."""
    coded, distinct = count_few_values(fact_transaction, {"channel": "unique_channels", "merchant_category_code": "unique_mcc"})
    return (
        coded.groupBy("customer_id", "trx_date")
        .agg(
            _rows().alias("trx_count"),
            F.sum("amount").cast(WIDE_MONEY).alias("trx_amount_total"),
            F.max("amount").alias("trx_amount_max"),
            *distinct,
        )
        .withColumn("refreshed_at", ntz(run_ts))
    )


def risk_lookup(risk_codes: DataFrame) -> DataFrame:
    code = F.col("mcc_code").cast("string").alias("merchant_category_code")
    return risk_codes.select(code, "mcc_category", "risk_weight")


def mcc_keeps_months(fact_transaction: DataFrame, risk_codes: DataFrame) -> bool:
    """Whether the enriched transactions are built without a shuffle, task by task from the month folders."""
    return fits_broadcast(risk_lookup(risk_codes))


def mcc_risk_enriched(
    fact_transaction: DataFrame, risk_codes: DataFrame, run_ts: datetime, broadcast: bool | None = None
) -> DataFrame:
    """Transactions with the risk class of their merchant code, matched as text without trimming.

    ``broadcast`` says what is known of the reference's size; unknown, it is measured.
    """
    codes = risk_lookup(risk_codes)
    weight = F.coalesce("risk_weight", F.lit(UNKNOWN_MCC_WEIGHT))
    if broadcast is None:
        broadcast = fits_broadcast(codes)
    joined = join_reference(fact_transaction, codes, "merchant_category_code", ["trx_id"], broadcast)
    return joined.select(
        "trx_id",
        "customer_id",
        "trx_date",
        "trx_datetime",
        "amount",
        "currency",
        "channel",
        "merchant_category_code",
        F.coalesce("mcc_category", F.lit(UNKNOWN_MCC_CATEGORY)).alias("mcc_category"),
        weight.alias("mcc_risk_weight"),
        (F.col("amount").cast("double") * (weight / F.lit(100.0))).alias("risk_weighted_amount"),
        ntz(run_ts).alias("refreshed_at"),
    )


def last_by_start(value: str) -> Column:
    """The non-null value of the run that started last; the run id settles a tie."""
    order = F.when(F.col(value).isNotNull(), F.struct("started_at", "run_id"))
    return F.max_by(value, order)


def operations_dashboard(load_audit: DataFrame, as_of: datetime) -> DataFrame:
    """Health per mapping over the last seven days; a mapping without a run in them is not listed."""
    recent = load_audit.filter(F.col("started_at") >= ntz(as_of) - F.expr(f"INTERVAL {DASHBOARD_DAYS} DAYS"))
    health = F.when(F.col("last_status") == "success", F.lit("healthy")).otherwise(F.lit("degraded"))
    by_mapping = recent.groupBy("mapping_name").agg(
        last_by_start("status").alias("last_status"),
        last_by_start("rows_loaded").alias("last_rows_loaded"),
        F.max("started_at").alias("last_run_at"),
        F.count_if(F.col("status") == "failed").alias("failed_runs_7d"),
    )
    return by_mapping.select(
        F.lit("bronze").alias("layer"), "*", health.alias("pipeline_health"), ntz(as_of).alias("refreshed_at")
    )


def dashboard_sql(load_audit: str) -> str:
    """``operations_dashboard`` as the text of a stored view, whose clock runs when it is read."""
    now = "CAST(date_trunc('second', localtimestamp()) AS TIMESTAMP_NTZ)"
    last = lambda value: f"max_by({value}, CASE WHEN {value} IS NOT NULL THEN struct(started_at, run_id) END)"
    return f"""
        SELECT 'bronze' AS layer, *, CASE WHEN last_status = 'success' THEN 'healthy' ELSE 'degraded' END AS pipeline_health,
               {now} AS refreshed_at
        FROM (SELECT mapping_name, {last("status")} AS last_status, {last("rows_loaded")} AS last_rows_loaded,
                     max(started_at) AS last_run_at, count_if(status = 'failed') AS failed_runs_7d
              FROM {load_audit} WHERE started_at >= {now} - INTERVAL {DASHBOARD_DAYS} DAYS GROUP BY mapping_name)"""
