"""Which source table feeds which raw table, and by which key it is loaded incrementally."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

from ledgermill import schemas


STRATEGIES = ("watermark", "anti_join")


@dataclass(frozen=True)
class Mapping:
    name: str
    system: str
    source_table: str
    target: str
    source_schema: T.StructType
    source_system: str
    watermark: str
    sort: tuple[str, ...]
    renames: dict[str, str] = field(default_factory=dict)
    strategy: str = "watermark"
    """``watermark`` reads keys above the last one loaded. ``anti_join`` reads every key the raw table
    lacks; choose it (``with_strategy``, ``--strategy``) for string keys that do not grow with time."""

    @property
    def target_table(self) -> str:
        return f"bronze.{self.target}"

    @property
    def raw_schema(self) -> T.StructType:
        return schemas.raw_schema(self.source_schema, self.renames)

    @property
    def key_type(self) -> T.DataType:
        return self.source_schema[self.watermark].dataType

    @property
    def watermark_type(self) -> str:
        """The kind of mark as the load state names it."""
        kinds = {T.IntegerType: "int", T.LongType: "int", T.TimestampNTZType: "datetime"}
        return kinds.get(type(self.key_type), "str")


# Names, source systems, watermark keys and sort orders are the load contract.
MAPPINGS: tuple[Mapping, ...] = (
    Mapping(
        "crm_customers", "crm", "customers", "crm_customers_raw",
        schemas.CUSTOMERS, "crm_db", "customer_id", ("customer_id",),
    ),
    Mapping(
        "core_accounts", "core", "accounts", "core_accounts_raw",
        schemas.ACCOUNTS, "core_banking_db", "account_id", ("customer_id", "account_id"),
    ),
    Mapping(
        "cards", "cards", "cards", "card_cards_raw",
        schemas.CARDS, "card_processing_db", "card_id", ("account_id", "card_id"),
    ),
    Mapping(
        "transactions", "transactions", "transactions", "payments_transactions_raw",
        schemas.TRANSACTIONS, "transactions_db", "trx_id", ("customer_id", "trx_id"),
    ),
    Mapping(
        "mobile_sessions", "mobile", "app_sessions", "mobile_app_sessions_raw",
        schemas.APP_SESSIONS, "mobile_app_db", "session_id", ("customer_id", "session_id"),
    ),
    Mapping(
        "mobile_events", "mobile", "app_events", "mobile_app_events_raw",
        schemas.APP_EVENTS, "mobile_app_db", "event_id", ("customer_id", "event_id"),
        renames={"event_data": "event_data_raw"},
    ),
)


def with_strategy(strategies: dict[str, str], mappings: Iterable[Mapping] = MAPPINGS) -> tuple[Mapping, ...]:
    """``mappings`` with another strategy for those named."""
    for mapping in select_mappings(list(strategies), mappings) if strategies else ():
        if strategies.get(mapping.name, strategies.get(mapping.target_table)) not in STRATEGIES:
            raise ValueError(f"{mapping.name}: strategy must be one of {', '.join(STRATEGIES)}")
    return tuple(
        replace(m, strategy=strategies.get(m.name, strategies.get(m.target_table, m.strategy))) for m in mappings
    )


def select_mappings(names: Iterable[str] | None = None, mappings: Iterable[Mapping] = MAPPINGS) -> list[Mapping]:
    """All mappings, or those asked for by mapping name or target table; one named twice is loaded once."""
    known: dict[str, Mapping] = {}
    for mapping in mappings:
        known[mapping.name] = known[mapping.target_table] = mapping
    if not names:
        return list(mappings)
    unknown = [n for n in names if n not in known]
    if unknown:
        raise ValueError(f"unknown mapping {unknown[0]!r}; valid: {', '.join(sorted(known))}")
    return list({known[n].name: known[n] for n in names}.values())
