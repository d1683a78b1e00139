"""The test tables in the shape of the banking sources and raw tables.

Values are derived row by row from whole tables; ``testing.duckdb_sql`` states the same shapes in SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill import schemas
from ledgermill.functions import ntz
from ledgermill.sources.mappings import MAPPINGS, Mapping
from ledgermill.sources.seeds import RISK_MCC_ROWS

T0, T1, AS_OF = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 31)
UNLISTED_MCC = (5999, 5541, 4900)
BINDING_MCC = [str(row[0]) for row in RISK_MCC_ROWS] + [str(code) for code in UNLISTED_MCC]

BY_TARGET = {m.target: m for m in MAPPINGS}


class TestTables:
    """Raw tables by name, built from the Parquet files of one folder."""

    __test__ = False

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._files: dict[str, DataFrame] = {}

    def parquet(self, name: str) -> DataFrame:
        """Each file's schema is looked up once."""
        if name not in self._files:
            self._files[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._files[name]

    def raw(self, target: str) -> DataFrame:
        return _SHAPES[target](self)


def _shaped(df: DataFrame, schema: T.StructType, columns: dict[str, str]) -> DataFrame:
    """Project SQL expressions onto a schema; a column not given is NULL."""
    return df.selectExpr(
        *[f"CAST({columns.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema]
    )


def _raw(df: DataFrame, target: str, loaded: str, **columns: str) -> DataFrame:
    mapping = BY_TARGET[target]
    provenance = {"source_system": f"'{mapping.source_system}'", "load_dttm": loaded}
    return _shaped(df, mapping.raw_schema, {**columns, **provenance})


def _at(moment: datetime) -> str:
    return f"TIMESTAMP_NTZ '{moment:%Y-%m-%d %H:%M:%S}'"


def _customers(t: TestTables) -> DataFrame:
    people = t.parquet("customer").join(
        t.parquet("nation").select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    columns = dict(
        customer_id="c_custkey",
        full_name="concat(' ', c_name, ' ')",
        phone="CASE WHEN c_custkey % 10 = 0 THEN '  ' WHEN c_custkey % 7 = 0 THEN NULL "
        "ELSE concat(' 77', lpad(cast(c_custkey AS string), 9, '0')) END",
        email="CASE WHEN c_custkey % 9 = 0 THEN '' WHEN c_custkey % 8 = 0 THEN NULL "
        "ELSE concat('u', cast(c_custkey AS string), '@example.com ') END",
        birth_date="DATE '1980-01-01'",
        city="n_name",
        registration_date="DATE '2020-01-01'",
        status="CASE WHEN c_custkey % 5 = 0 THEN 'blocked' ELSE 'active' END",
    )
    target = "crm_customers_raw"
    first = _raw(people, target, _at(T0), segment="c_mktsegment", **columns)
    # customers in debt arrive a second time, a day later, with another segment
    again = _raw(people.filter("c_acctbal < 0"), target, _at(T1), segment="'PREMIUM'", **columns)
    return first.unionByName(again)


def _accounts(t: TestTables) -> DataFrame:
    return _raw(
        t.parquet("orders"),
        "core_accounts_raw",
        _at(T0),
        account_id="concat('ACC', cast(o_orderkey AS string))",
        customer_id="o_custkey",
        product_type="o_orderpriority",
        currency="CASE o_orderstatus WHEN 'F' THEN 'KZT' WHEN 'O' THEN 'USD' ELSE 'EUR' END",
        balance="cast(o_totalprice AS decimal(18,2)) * CASE WHEN o_orderkey % 11 = 0 THEN -1 ELSE 1 END",
        opened_date="cast(o_orderdate AS date)",
        status="'active'",
    )


def _cards(t: TestTables) -> DataFrame:
    return _raw(
        t.parquet("lineitem"),
        "card_cards_raw",
        "l_shipdate",
        card_id="l_orderkey * 10 + l_linenumber",
        account_id="concat('ACC', cast(l_orderkey AS string))",
        card_product="l_returnflag",
        card_status="l_linestatus",
        issue_date="cast(l_shipdate AS date)",
    )


def _transactions(t: TestTables) -> DataFrame:
    owners = t.parquet("orders").select("o_orderkey", "o_custkey")
    codes = ", ".join(f"'{code}'" for code in BINDING_MCC)
    return _raw(
        t.parquet("lineitem").join(owners, F.col("l_orderkey") == F.col("o_orderkey")),
        "payments_transactions_raw",
        "l_shipdate",
        trx_id="l_orderkey * 10 + l_linenumber",
        account_id="concat('ACC', cast(l_orderkey AS string))",
        customer_id="o_custkey",
        card_id="l_orderkey * 10 + l_linenumber",
        trx_datetime="CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE l_shipdate END",
        trx_type="'debit'",
        amount="cast(l_extendedprice AS decimal(18,2))",
        currency="'KZT'",
        channel="l_returnflag",
        merchant_category_code=f"element_at(array({codes}), cast(l_partkey % {len(BINDING_MCC)} AS int) + 1)",
        counterparty_name="concat(' S', cast(l_suppkey AS string))",
        status="l_linestatus",
        posting_date="CASE WHEN l_partkey % 34 = 0 THEN NULL ELSE cast(l_shipdate AS date) END",
    )


SESSION_ID = "concat(cast(user_id AS string), '-', cast(cast(ts AS date) AS string))"


def _sessions(t: TestTables) -> DataFrame:
    visits = t.parquet("events").groupBy("user_id", F.expr("cast(ts AS date)").alias("day"))
    visits = visits.agg(F.min("ts").alias("first"), F.max("ts").alias("last"), F.min("event_id").alias("opener"))
    return _raw(
        visits,
        "mobile_app_sessions_raw",
        _at(T1),
        session_id="concat(cast(user_id AS string), '-', cast(day AS string))",
        customer_id="user_id",
        login_time="first",
        logout_time="last",
        device_type="' ios '",
        app_version="''",
        is_new_device="opener % 4 = 0",
    )


def _events(t: TestTables) -> DataFrame:
    return _raw(
        t.parquet("events"),
        "mobile_app_events_raw",
        _at(T1),
        event_id="event_id",
        session_id=SESSION_ID,
        customer_id="user_id",
        event_time="CASE WHEN event_id % 50 = 0 THEN NULL ELSE ts END",
        event_type="event_type",
        event_data_raw="props",
        is_successful="event_type <> 'error'",
        error_message="CASE WHEN event_type = 'error' THEN ' declined ' ELSE '' END",
    )


_SHAPES: dict[str, Callable[[TestTables], DataFrame]] = {
    "crm_customers_raw": _customers,
    "core_accounts_raw": _accounts,
    "card_cards_raw": _cards,
    "payments_transactions_raw": _transactions,
    "mobile_app_sessions_raw": _sessions,
    "mobile_app_events_raw": _events,
}


def load_audit(t: TestTables) -> DataFrame:
    given = dict(
        run_id="cast(event_id AS string)",
        mapping_name="event_type",
        target_table="event_type",
        load_mode="'incremental'",
        status="CASE WHEN event_id % 9 = 0 THEN 'failed' ELSE 'success' END",
        rows_loaded="event_id % 1000",
        started_at="ts",
        finished_at="ts",
        duration_ms="0",
    )
    return _shaped(t.parquet("events"), schemas.LOAD_AUDIT, given)


def load_state(t: TestTables) -> DataFrame:
    """Every order moves the mark of the mapping named by its priority to its key."""
    given = dict(
        mapping_name="o_orderpriority",
        watermark_value="cast(o_orderkey AS string)",
        watermark_type="'int'",
        updated_at="o_orderdate",
    )
    return _shaped(t.parquet("orders"), schemas.LOAD_STATE, given)


class BoundSource:
    """The raw shapes as sources: raw columns without the provenance, under their source names."""

    def __init__(self, tables: TestTables):
        self.tables = tables

    def table(self, mapping: Mapping, watermark: object = None) -> DataFrame:
        back = {target: source for source, target in mapping.renames.items()}
        raw = self.tables.raw(mapping.target).drop("source_system", "load_dttm")
        return raw.withColumnsRenamed(back)


def customer_snapshots(t: TestTables) -> list[tuple[datetime, DataFrame]]:
    """Three states of the raw customers: some arrive late, some change, some leave and come back."""
    raw = t.raw("crm_customers_raw")
    first = raw.filter(F.col("load_dttm") == ntz(T0)).filter("city <> 'NATION_7'")
    second = raw.filter("city <> 'NATION_3'")
    return [(T0, first), (T1, second), (AS_OF, raw)]
