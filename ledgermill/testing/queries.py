"""Registered queries: every operator and model of the warehouse over the test tables."""

from __future__ import annotations

import atexit
import contextlib
from collections.abc import Callable
from datetime import timedelta
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgermill.functions import ntz
from ledgermill.operators import latest_per_key, quality
from ledgermill.plans import bronze, gold, silver
from ledgermill.plans.jobs import Warehouse, open_warehouse
from ledgermill.operators.quality import ChecksFailed
from ledgermill.plans.tables import GOLD, HISTORY, SEED, SILVER
from ledgermill.session import SHUFFLE_TASKS, own_session
from ledgermill.sources import MAPPINGS, CsvSource, Lake, Mapping, risk_mcc_codes, select_mappings, shared_dir
from ledgermill.testing.bindings import (
    AS_OF,
    BoundSource,
    TestTables,
    customer_snapshots,
    load_audit,
    load_state,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
STATE_MAPPING = "1-URGENT"


def _register(query: Callable[[TestTables], DataFrame]) -> Callable[[TestTables], DataFrame]:
    QUERIES[query.__name__] = lambda spark, folder: query(TestTables(spark, folder))
    return query


def _scratch(t: TestTables, **sizes: int) -> Warehouse:
    """A new, empty warehouse in the folder the executors share."""
    return open_warehouse(t.spark, _scratch_folder(t.spark), **sizes)


def _scratch_folder(spark: SparkSession) -> str:
    """A new folder, removed when the application ends: results are read from it until then."""
    folder = f"{shared_dir(spark)}/ledgermill-{uuid4().hex}"
    atexit.register(_remove, spark, folder)
    return folder


def _remove(spark: SparkSession, folder: str) -> None:
    with contextlib.suppress(Exception):  # the application may have been stopped before
        Lake(spark, folder).drop()


# -- silver --------------------------------------------------------------------------------------


@_register
def dim_customer(t: TestTables) -> DataFrame:
    return silver.dim_customer(t.raw("crm_customers_raw"), AS_OF)


@_register
def dim_account(t: TestTables) -> DataFrame:
    return silver.dim_account(t.raw("core_accounts_raw"), AS_OF)


@_register
def dim_card(t: TestTables) -> DataFrame:
    return silver.dim_card(t.raw("card_cards_raw"), AS_OF)


@_register
def fact_transaction(t: TestTables) -> DataFrame:
    return silver.fact_transaction(t.raw("payments_transactions_raw"), AS_OF)


@_register
def fact_app_session(t: TestTables) -> DataFrame:
    return silver.fact_app_session(t.raw("mobile_app_sessions_raw"), AS_OF)


@_register
def fact_app_event(t: TestTables) -> DataFrame:
    return silver.fact_app_event(t.raw("mobile_app_events_raw"), AS_OF)


@_register
def customer_scd2(t: TestTables) -> DataFrame:
    history = None
    for run_ts, raw in customer_snapshots(t):
        history = silver.customer_scd2(history, silver.dim_customer(raw, run_ts), run_ts)
    return history


@_register
def replacing_collapse(t: TestTables) -> DataFrame:
    return latest_per_key(t.raw("crm_customers_raw"), ["customer_id"], "load_dttm")


# -- gold ----------------------------------------------------------------------------------------


def _silver_inputs(t: TestTables) -> list[DataFrame]:
    return [dim_account(t), dim_card(t), fact_transaction(t), fact_app_session(t), fact_app_event(t)]


@_register
def account_metrics(t: TestTables) -> DataFrame:
    return gold.holdings_by_customer(dim_account(t), dim_card(t))


@_register
def customer_metrics(t: TestTables) -> DataFrame:
    return gold.customer_metrics(*_silver_inputs(t))


@_register
def customer_360(t: TestTables) -> DataFrame:
    return gold.customer_360(dim_customer(t), *_silver_inputs(t), AS_OF)


@_register
def customer_360_per_account(t: TestTables) -> DataFrame:
    return gold.customer_360(dim_customer(t), *_silver_inputs(t), AS_OF, per_account=True)


@_register
def daily_transaction_summary(t: TestTables) -> DataFrame:
    return gold.daily_transaction_summary(fact_transaction(t), AS_OF)


@_register
def mcc_risk_enriched_transactions(t: TestTables) -> DataFrame:
    return gold.mcc_risk_enriched(fact_transaction(t), risk_mcc_codes(t.spark), AS_OF)


@_register
def pipeline_operations_dashboard(t: TestTables) -> DataFrame:
    return gold.operations_dashboard(load_audit(t), AS_OF)


# -- loads ---------------------------------------------------------------------------------------


@_register
def latest_watermark(t: TestTables) -> DataFrame:
    return latest_per_key(load_state(t), ["mapping_name"], "updated_at")


@_register
def newest_state_row(t: TestTables) -> DataFrame:
    return bronze.latest_state(load_state(t), STATE_MAPPING)


@_register
def incremental_slice(t: TestTables) -> DataFrame:
    """Rows above the stored mark; the mark itself is read first, as a load does."""
    mark = int(newest_state_row(t).first()["watermark_value"])
    return bronze.above(t.raw("payments_transactions_raw"), "trx_id", mark)


@_register
def anti_join_slice(t: TestTables) -> DataFrame:
    """Source accounts whose key is not among the keys seen on cards."""
    accounts = t.raw("core_accounts_raw").drop("source_system", "load_dttm")
    return bronze.not_loaded(accounts, "account_id", t.raw("card_cards_raw"))


@_register
def load_observation(t: TestTables) -> DataFrame:
    """The audit trail of a first load, a load that finds nothing new, and a full refresh."""
    warehouse, source = _scratch(t), BoundSource(t)
    for full_refresh in (False, False, True):
        warehouse.run_bronze(source, ["transactions"], full_refresh)
    order = Window.partitionBy("mapping_name").orderBy("started_at")
    return warehouse.read(bronze.AUDIT).select(
        F.row_number().over(order).alias("attempt"),
        "mapping_name",
        "target_table",
        "load_mode",
        "status",
        "rows_loaded",
        "last_watermark",
        "new_watermark",
    )


@_register
def bronze_load(t: TestTables) -> DataFrame:
    warehouse = _scratch(t)
    warehouse.run_bronze(BoundSource(t), ["bronze.mobile_app_events_raw"])
    return warehouse.read("bronze.mobile_app_events_raw").drop("load_dttm")


class _Earlier:
    """A source as it was when its highest key was ``mark``."""

    def __init__(self, source: BoundSource, mark: int):
        self.source, self.mark = source, mark

    def table(self, mapping: Mapping, watermark: object = None) -> DataFrame:
        return self.source.table(mapping).filter(F.col(mapping.watermark) <= self.mark)


@_register
def incremental_load(t: TestTables) -> DataFrame:
    """A first load up to the stored mark and a second of what came after it: together every row once."""
    warehouse, source = _scratch(t), BoundSource(t)
    mark = int(newest_state_row(t).first()["watermark_value"])
    for state in (_Earlier(source, mark), source):
        warehouse.run_bronze(state, ["transactions"])
    return warehouse.read("bronze.payments_transactions_raw").drop("load_dttm")


@_register
def csv_extract_load(t: TestTables) -> DataFrame:
    """Events as a CSV extract, with JSON in a quoted column, loaded into the raw table."""
    (events,) = select_mappings(["mobile_events"])
    folder = _scratch_folder(t.spark)
    as_extract = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    BoundSource(t).table(events).write.options(**as_extract).csv(f"{folder}/{events.source_table}.csv")
    warehouse = _scratch(t)
    warehouse.run_bronze(CsvSource(t.spark, folder), [events.name])
    return warehouse.read(events.target_table).drop("load_dttm")


@_register
def stored_fact_transaction(t: TestTables) -> DataFrame:
    """Written in month folders, sorted, and read back over its whole date range."""
    lake, table = _scratch(t).lake, SILVER[3]
    lake.replace(fact_transaction(t), table.name, table.sort, table.month_of)
    span = lake.read(table.name, table.schema).agg(F.min("trx_date"), F.max("trx_date")).first()
    return lake.read_days(table.name, table.schema, "trx_date", *span)


@_register
def stored_customer_history(t: TestTables) -> DataFrame:
    """The three snapshots through stored tables, each reading only what the last one left open."""
    warehouse = _scratch(t)
    for run_ts, raw in customer_snapshots(t):
        warehouse.lake.replace(silver.dim_customer(raw, run_ts), "silver.dim_customer")
        warehouse.snapshot(run_ts)
    return warehouse.read(HISTORY)


@_register
def warehouse_build(t: TestTables) -> DataFrame:
    """The whole pipeline into a new warehouse, then the row count of every stored table."""
    warehouse = _scratch(t)
    warehouse.run_pipeline(BoundSource(t), AS_OF)
    names = [m.target_table for m in MAPPINGS] + [table.name for table in (*SILVER, *GOLD)] + [HISTORY]
    counts = [
        warehouse.read(name).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name in names
    ]
    stacked = counts[0]
    for count in counts[1:]:
        stacked = stacked.unionByName(count)
    return stacked


# -- quality -------------------------------------------------------------------------------------


@_register
def dq_unique(t: TestTables) -> DataFrame:
    return quality.duplicates(t.raw("card_cards_raw"), "card_id")


@_register
def dq_not_null(t: TestTables) -> DataFrame:
    return quality.nulls(t.raw("payments_transactions_raw"), "trx_datetime").select("trx_id", "account_id", "amount")


@_register
def dq_negative_amounts(t: TestTables) -> DataFrame:
    """Test amounts are positive; lowered by a constant, some break the rule."""
    lowered = fact_transaction(t).withColumn("amount", (F.col("amount") - F.lit(50000)).cast("decimal(18,2)"))
    return quality.negative_amounts(lowered)


@_register
def dq_table_not_empty(t: TestTables) -> DataFrame:
    return quality.not_empty(dim_customer(t))


@_register
def dq_pii_hash_shape(t: TestTables) -> DataFrame:
    return quality.is_empty(quality.malformed_hashes(dim_customer(t)))


@_register
def dq_audit_healthy(t: TestTables) -> DataFrame:
    return quality.is_empty(quality.failing_mappings(load_audit(t)))


@_register
def failing_mappings(t: TestTables) -> DataFrame:
    return quality.failing_mappings(load_audit(t))


@_register
def verification_report(t: TestTables) -> DataFrame:
    """The warehouse's own report where one load failed and no mart was built."""
    warehouse, source = _scratch(t), BoundSource(t)
    warehouse.run_bronze(source, ["crm_customers"])
    with contextlib.suppress(OSError):
        warehouse.run_bronze(_Broken(source, "transactions"), ["transactions"])
    warehouse.build([SILVER[0]], AS_OF)
    return warehouse.verify(raise_on_failure=False).drop("detail")


@_register
def failed_load_audit(t: TestTables) -> DataFrame:
    """A load that fails beside one that works: both end, each with its audit row."""
    warehouse = _scratch(t)
    with contextlib.suppress(OSError):
        warehouse.run_bronze(_Broken(BoundSource(t), "transactions"), ["transactions", "cards"])
    return warehouse.read(bronze.AUDIT).select("mapping_name", "status", "rows_loaded", "new_watermark", "error_message")


class _Broken:
    """A source that cannot read one table."""

    def __init__(self, source: BoundSource, name: str):
        self.source, self.name = source, name

    def table(self, mapping: Mapping, watermark: object = None) -> DataFrame:
        if mapping.name == self.name:
            raise OSError("source is down: " + "no answer, " * 200)
        return self.source.table(mapping)


LOADED_HOURS_AGO = (12, 48, 100)


@_register
def source_freshness(t: TestTables) -> DataFrame:
    """Raw tables loaded 12, 48 and 100 hours before: two each pass, warn and are an error."""
    warehouse = _scratch(t)
    for i, mapping in enumerate(MAPPINGS):
        loaded = AS_OF - timedelta(hours=LOADED_HOURS_AGO[i % 3])
        raw = t.raw(mapping.target).withColumn("load_dttm", ntz(loaded))
        warehouse.lake.replace(raw, mapping.target_table)
    return warehouse.freshness(AS_OF)


# -- runs ----------------------------------------------------------------------------------------


@_register
def mapping_named_twice(t: TestTables) -> DataFrame:
    """By name and by target at once: one load, one audit row, every card once."""
    warehouse = _scratch(t)
    warehouse.run_bronze(BoundSource(t), ["cards", "bronze.card_cards_raw"])
    cards, audit = (warehouse.read(name).agg(F.count(F.lit(1)).alias("n")) for name in ("bronze.card_cards_raw", bronze.AUDIT))
    return cards.select(F.col("n").alias("n_rows")).crossJoin(audit.select(F.col("n").alias("n_loads")))


def _stored(warehouse: Warehouse) -> DataFrame:
    """Which tables exist, with their number of rows."""
    stacked = None
    for name in [table.name for table in (*SILVER, *GOLD)] + [HISTORY, SEED]:
        if warehouse.lake.exists(name):
            one = warehouse.read(name).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
            stacked = one if stacked is None else stacked.unionByName(one)
    return stacked


@_register
def selected_build(t: TestTables) -> DataFrame:
    """Two tables selected: they, the seed and the history are stored, and nothing else."""
    warehouse = _scratch(t)
    warehouse.run_bronze(BoundSource(t), ["crm_customers", "cards", "core_accounts"])
    warehouse.run_transform(AS_OF, ["dim_customer", "silver.dim_card"])
    return _stored(warehouse)


class _Negative(_Broken):
    """A source whose amounts are negative."""

    def table(self, mapping: Mapping, watermark: object = None) -> DataFrame:
        rows = self.source.table(mapping)
        return rows.withColumn("amount", -F.col("amount")) if mapping.name == self.name else rows


@_register
def gate_before_gold(t: TestTables) -> DataFrame:
    """A failing silver test: silver and history are stored, no mart is."""
    warehouse = _scratch(t)
    with contextlib.suppress(ChecksFailed):
        warehouse.run_pipeline(_Negative(BoundSource(t), "transactions"), AS_OF)
    return _stored(warehouse)


@_register
def stored_customer_360(t: TestTables) -> DataFrame:
    """The mart's rows as the pipeline stores them."""
    warehouse = _scratch(t)
    warehouse.run_pipeline(BoundSource(t), AS_OF)
    return warehouse.read("gold.customer_360")


@_register
def sliced_daily_summary(t: TestTables) -> DataFrame:
    """Built in several slices, as a table too large for one shuffle is."""
    warehouse = _scratch(t, task_bytes=1 << 14, shuffle_tasks_at_once=64)
    warehouse.lake.replace(fact_transaction(t), "silver.fact_transaction", month_of="trx_date")
    (table,) = [g for g in GOLD if g.name == "gold.daily_transaction_summary"]
    warehouse.build([table], AS_OF)
    return warehouse.read(table.name)


def _in_slices(t: TestTables) -> Warehouse:
    """A warehouse whose larger tables are built, tested and matched in several slices."""
    return _scratch(t, task_bytes=1 << 17, shuffle_tasks_at_once=8)


def _store_silver(warehouse: Warehouse, t: TestTables) -> None:
    frames = [dim_customer(t), *_silver_inputs(t)]
    for table, frame in zip(SILVER, frames):
        warehouse.lake.replace(frame, table.name)


@_register
def sliced_customer_360(t: TestTables) -> DataFrame:
    """Built in slices of customers; cards go to the slices of their accounts' owners."""
    warehouse = _in_slices(t)
    _store_silver(warehouse, t)
    (table,) = [g for g in GOLD if g.name == "gold.customer_360"]
    warehouse.build([table], AS_OF)
    return warehouse.read(table.name)


@_register
def sliced_customer_history(t: TestTables) -> DataFrame:
    """Snapshots whose customers and open versions are matched slice by slice."""
    warehouse = _scratch(t, task_bytes=1 << 14, shuffle_tasks_at_once=4)
    for run_ts, raw in customer_snapshots(t):
        warehouse.lake.replace(silver.dim_customer(raw, run_ts), "silver.dim_customer")
        warehouse.snapshot(run_ts)
    return warehouse.read(HISTORY)


@_register
def sliced_tests(t: TestTables) -> DataFrame:
    """The tests of the silver layer, keys in slices, over cards of which some are stored twice and lowered amounts."""
    warehouse = _in_slices(t)
    _store_silver(warehouse, t)
    twice = dim_card(t).unionByName(dim_card(t).filter("card_id % 7 = 0"))
    warehouse.lake.replace(twice, "silver.dim_card")
    lowered = fact_transaction(t).withColumn("amount", (F.col("amount") - F.lit(50000)).cast("decimal(18,2)"))
    warehouse.lake.replace(lowered, "silver.fact_transaction")
    return warehouse.test(SILVER, raise_on_failure=False).drop("detail")


@_register
def stored_day_order(t: TestTables) -> DataFrame:
    """Transactions of a large build: rows out of order within a file, and the most files of which one day is read."""
    warehouse, table = _scratch(t, task_bytes=1 << 18), SILVER[3]
    warehouse.lake.replace(t.raw("payments_transactions_raw"), "bronze.payments_transactions_raw")
    warehouse.build([table], AS_OF)
    stored = t.spark.read.schema(table.schema).parquet(warehouse.lake.current(table.name))
    rows = stored.select(*table.sort, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("i"))
    place = Window.partitionBy("file").orderBy("i")
    late = F.lag(F.struct(*table.sort)).over(place) > F.struct(*table.sort)
    files = rows.withColumn("late", late).groupBy("file").agg(
        F.count_if("late").alias("late"), F.min("trx_date").alias("first"), F.max("trx_date").alias("last")
    )
    days = rows.select("trx_date").distinct()
    opened = days.join(files, F.col("trx_date").between(F.col("first"), F.col("last"))).groupBy("trx_date").agg(F.count("*").alias("n"))
    worst = opened.agg((F.max("n") <= 2).alias("a_day_is_in_two_files_at_most"))
    return files.agg(F.sum("late").alias("n_out_of_order")).join(worst)


def _hot_facts(t: TestTables) -> DataFrame:
    """A third of all transactions has one merchant code, a tenth none."""
    code = F.when(F.col("trx_id") % 3 == 0, "5411").when(F.col("trx_id") % 10 == 1, F.lit(None)).otherwise(F.col("merchant_category_code"))
    return fact_transaction(t).withColumn("merchant_category_code", code)


def _large_reference(t: TestTables) -> DataFrame:
    """The seed, and a code that no merchant has for every line item."""
    fillers = t.parquet("lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber") + 100_000).cast("int").alias("mcc_code"),
        F.repeat(F.lit("no merchant "), F.lit(100)).alias("mcc_category"),
        F.lit(1).alias("risk_weight"),
    )
    return risk_mcc_codes(t.spark).unionByName(fillers)


CODES_IN_FILE = 200_000
"""A compressed file is read by one task."""


def _enriched_by_large_reference(t: TestTables, facts: DataFrame) -> DataFrame:
    """The extract is compressed, and freed once it is loaded."""
    folder = _scratch_folder(t.spark)
    as_extract = {"header": True, "compression": "gzip", "maxRecordsPerFile": CODES_IN_FILE}
    _large_reference(t).write.options(**as_extract).csv(f"{folder}/codes")
    warehouse = _scratch(t)
    warehouse.load_seed(f"{folder}/codes")
    Lake(t.spark, folder).drop()
    warehouse.lake.replace(facts, "silver.fact_transaction", month_of="trx_date")
    (table,) = [g for g in GOLD if g.name == "gold.mcc_risk_enriched_transactions"]
    warehouse.build([table], AS_OF)
    return warehouse.read(table.name)


@_register
def mcc_risk_large_reference(t: TestTables) -> DataFrame:
    """A reference past the broadcast bound, loaded from a CSV."""
    return _enriched_by_large_reference(t, fact_transaction(t))


@_register
def mcc_risk_hot_code(t: TestTables) -> DataFrame:
    """A reference past the broadcast bound, and a code that a third of the transactions has."""
    return _enriched_by_large_reference(t, _hot_facts(t))


def _with_line_breaks(t: TestTables) -> DataFrame:
    (customers,) = select_mappings(["crm_customers"])
    source = BoundSource(t).table(customers)
    return source.withColumn("full_name", F.concat(F.col("full_name"), F.lit('\n"the, second"\nline')))


AS_EXTRACT = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "emptyValue": '""'}


def _load_line_breaks(t: TestTables, spark: SparkSession, extract: DataFrame) -> DataFrame:
    (customers,) = select_mappings(["crm_customers"])
    folder = _scratch_folder(t.spark)
    extract.write.options(**AS_EXTRACT).csv(f"{folder}/{customers.source_table}.csv")
    warehouse = open_warehouse(spark, _scratch_folder(t.spark))
    warehouse.run_bronze(CsvSource(spark, folder, [customers.source_table]), [customers.name])
    return warehouse.read(customers.target_table).select("customer_id", "full_name", "segment", "city", "status")


@_register
def csv_line_breaks(t: TestTables) -> DataFrame:
    """Customers whose names hold line breaks and quotes, through a CSV extract of several files."""
    return _load_line_breaks(t, t.spark, _with_line_breaks(t))


@_register
def csv_line_breaks_in_one_file(t: TestTables) -> DataFrame:
    """The same in one file, which many tasks read: blocks are small here, as a large file's are to it."""
    session = own_session(t.spark, int(t.spark.conf.get(SHUFFLE_TASKS)), **{"spark.sql.files.maxPartitionBytes": "16k", "spark.sql.files.openCostInBytes": "0"})
    return _load_line_breaks(t, session, _with_line_breaks(t).coalesce(1))


@_register
def tied_marks(t: TestTables) -> DataFrame:
    """Marks of one moment: the highest number wins, not the last text."""
    state = load_state(t).withColumn("updated_at", F.date_trunc("year", "updated_at").cast("timestamp_ntz"))
    return bronze.latest_state(state, STATE_MAPPING)
