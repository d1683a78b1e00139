"""The tables built from the raw layer: what each reads, how it is stored and what must hold for it."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill import schemas
from ledgermill.functions import ntz
from ledgermill.operators import quality
from ledgermill.plans import gold, silver


@dataclass(frozen=True)
class Table:
    name: str
    schema: T.StructType
    build: Callable[..., DataFrame]
    """Called with the frames of ``reads`` in order, then the run time; in the silver layer also with ``large``,
    whether it reads more than a task's share."""
    reads: tuple[str, ...]
    sort: tuple[str, ...]
    month_of: str | None = None
    by_month: Callable[..., bool] | None = None
    """Called with the frames of ``reads``: whether the rows come from an input's month folders without a shuffle.
    ``build`` gets the answer as ``broadcast``, since it is a broadcast that avoids the shuffle."""
    slice_by: str | None = None
    """Column whose hash cuts a build that is too large for one shuffle; see ``owned`` for inputs without it."""
    owned: tuple[tuple[str, str, str], ...] = ()
    """Inputs that belong to a slice through another input: (input, column they share, input that has ``slice_by``).
    Inputs that have neither are read whole by every slice."""
    told: Callable[[datetime], dict[str, Column]] = lambda run_ts: {}
    """Columns that the run time or other columns tell, by name: rows that are shuffled to be stored go without them."""
    key: str | None = None
    """Column that must be unique and not null."""
    rules: tuple[tuple[str, Callable[[], Column]], ...] = ()
    """What no row may be, by title."""

    @property
    def layer(self) -> str:
        return self.name.split(".")[0]

    def row_rules(self) -> dict[str, Column]:
        """Conditions that no row may meet; all of them take one pass."""
        rules = {title: rule() for title, rule in self.rules}
        if self.key:
            rules[f"{self.key} not null"] = F.col(self.key).isNull()
        return rules


# Inputs, sort keys and month columns are the storage contract.
SILVER: tuple[Table, ...] = (
    Table(
        "silver.dim_customer",
        schemas.DIM_CUSTOMER,
        silver.dim_customer,
        ("bronze.crm_customers_raw",),
        ("customer_id",),
        key="customer_id",
        slice_by="customer_id",
    ),
    Table(
        "silver.dim_account",
        schemas.DIM_ACCOUNT,
        silver.dim_account,
        ("bronze.core_accounts_raw",),
        ("account_id",),
        key="account_id",
        slice_by="account_id",
    ),
    Table(
        "silver.dim_card",
        schemas.DIM_CARD,
        silver.dim_card,
        ("bronze.card_cards_raw",),
        ("card_id",),
        key="card_id",
        slice_by="card_id",
    ),
    Table(
        "silver.fact_transaction",
        schemas.FACT_TRANSACTION,
        silver.fact_transaction,
        ("bronze.payments_transactions_raw",),
        ("trx_date", "customer_id", "trx_id"),
        month_of="trx_date",
        told=lambda run_ts: {"trx_date": F.col("trx_datetime").cast("date"), "updated_at": ntz(run_ts)},
        key="trx_id",
        slice_by="trx_id",
        rules=(("without negative amounts", quality.negative_amount),),
    ),
    Table(
        "silver.fact_app_session",
        schemas.FACT_APP_SESSION,
        silver.fact_app_session,
        ("bronze.mobile_app_sessions_raw",),
        ("session_date", "customer_id", "session_id"),
        month_of="session_date",
        told=lambda run_ts: {"session_date": F.coalesce("login_time", "bronze_loaded_at").cast("date"), "updated_at": ntz(run_ts)},
        key="session_id",
        slice_by="session_id",
    ),
    Table(
        "silver.fact_app_event",
        schemas.FACT_APP_EVENT,
        silver.fact_app_event,
        ("bronze.mobile_app_events_raw",),
        ("event_date", "customer_id", "event_id"),
        month_of="event_date",
        told=lambda run_ts: {"event_date": F.coalesce("event_time", "bronze_loaded_at").cast("date"), "updated_at": ntz(run_ts)},
        key="event_id",
        slice_by="event_id",
    ),
)

GOLD: tuple[Table, ...] = (
    Table(
        "gold.customer_360",
        schemas.CUSTOMER_360,
        gold.customer_360,
        (
            "silver.dim_customer",
            "silver.dim_account",
            "silver.dim_card",
            "silver.fact_transaction",
            "silver.fact_app_session",
            "silver.fact_app_event",
        ),
        ("customer_id",),
        key="customer_id",
        slice_by="customer_id",
        owned=(("silver.dim_card", "account_id", "silver.dim_account"),),
    ),
    Table(
        "gold.daily_transaction_summary",
        schemas.DAILY_TRANSACTION_SUMMARY,
        gold.daily_transaction_summary,
        ("silver.fact_transaction",),
        ("customer_id", "trx_date"),
        month_of="trx_date",
        told=lambda run_ts: {"refreshed_at": ntz(run_ts)},
        slice_by="customer_id",
    ),
    Table(
        "gold.mcc_risk_enriched_transactions",
        schemas.MCC_RISK_ENRICHED_TRANSACTIONS,
        gold.mcc_risk_enriched,
        ("silver.fact_transaction", "reference.risk_mcc_codes"),
        ("trx_date", "customer_id", "trx_id"),
        month_of="trx_date",
        told=lambda run_ts: {"refreshed_at": ntz(run_ts)},
        by_month=gold.mcc_keeps_months,
        slice_by="trx_id",
    ),
)

VIEW = "gold.pipeline_operations_dashboard"
HISTORY = "silver.customer_scd2"
SEED = "reference.risk_mcc_codes"
SCHEMAS = {t.name: t.schema for t in (*SILVER, *GOLD)} | {SEED: schemas.RISK_MCC_CODES}


def select_tables(select: Iterable[str] | None = None) -> list[Table]:
    """All tables in build order, or those named by ``tag:<layer>``, ``layer.table`` or ``table``."""
    tables = [*SILVER, *GOLD]
    if not select:
        return tables
    chosen: set[str] = set()
    for term in select:
        tag = term.removeprefix("tag:")
        names = {t.name for t in tables if term in (t.name, t.name.split(".")[1]) or (tag != term and tag == t.layer)}
        if not names and term not in (VIEW, VIEW.split(".")[1]):
            raise ValueError(f"nothing matches {term!r}")
        chosen |= names
    return [t for t in tables if t.name in chosen]
