"""The runs: raw layer only, transformation only, or everything; one Spark application each."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill import schemas
from ledgermill.operators import history_changes, quality, spread_join
from ledgermill.plans import bronze, gold
from ledgermill.plans.silver import CUSTOMER_CHECK_COLUMNS
from ledgermill.plans.tables import HISTORY, SCHEMAS, SEED, SILVER, VIEW, Table, select_tables
from ledgermill.session import SHUFFLE_TASKS, TASK_BYTES, own_session, tasks_for
from ledgermill.sources.files import read_csv
from ledgermill.sources.lake import Lake
from ledgermill.sources.mappings import MAPPINGS, Mapping
from ledgermill.sources.slices import MOST_SLICES, Cutter, cut_settings
from ledgermill.sources.seeds import risk_mcc_codes

SHUFFLE_TASKS_AT_ONCE = 50_000
PARALLEL_JOBS = 4


def _side_by_side(work: Callable[[Table], object], tables: list[Table]) -> None:
    """Independent tables as concurrent Spark jobs: one job's tail no longer leaves the cluster idle."""
    if tables:
        with ThreadPoolExecutor(PARALLEL_JOBS) as pool:
            running = [pool.submit(work, table) for table in tables]
        for job in running:
            job.result()


class Warehouse:
    """A warehouse under one folder.

    Shuffles are sized for tasks of about ``task_bytes``. A build that would need more than
    ``shuffle_tasks_at_once`` of them, which is more than a shuffle service handles well, runs as several
    slices of its key's hash, one after the other, each with tasks of the same size. So do tests of a key
    and snapshots. The inputs are copied once, cut by slice; each slice then reads its own part only.
    There are at most ``MOST_SLICES``: of an input that would need more, the tasks grow with it instead.
    """

    def __init__(
        self,
        lake: Lake,
        registry: Iterable[Mapping] = MAPPINGS,
        task_bytes: int = TASK_BYTES,
        shuffle_tasks_at_once: int = SHUFFLE_TASKS_AT_ONCE,
    ):
        self.lake, self.spark = lake, lake.spark
        self.registry = tuple(registry)
        self.task_bytes, self.shuffle_tasks_at_once = task_bytes, shuffle_tasks_at_once
        self.control = bronze.ControlTables(lake)

    # -- reading -------------------------------------------------------------------------------

    def read(self, table: str) -> DataFrame:
        """Any table by ``layer.name``; raw and control tables never loaded read as empty."""
        if table in (bronze.STATE, bronze.AUDIT):
            return self.control.read(table)
        if table == HISTORY:
            return self.lake.read_history(table, schemas.CUSTOMER_SCD2)
        for mapping in self.registry:
            if table == mapping.target_table:
                return self.lake.read(table, mapping.raw_schema, or_empty=True)
        return self.lake.read(table, SCHEMAS[table])

    def read_days(self, table: str, first: date, last: date) -> DataFrame:
        """Rows of a month-partitioned table by date range; other months are not opened."""
        (known,) = [t for t in select_tables([table]) if t.month_of]
        return self.lake.read_days(known.name, known.schema, known.month_of, first, last)

    def dashboard(self, as_of: datetime | None = None) -> DataFrame:
        """The operations view, computed on read."""
        as_of = as_of or bronze.utc_now().replace(microsecond=0)
        view = gold.operations_dashboard(self.control.read(bronze.AUDIT), as_of)
        view.createOrReplaceTempView(VIEW.split(".")[1])
        return view

    def store_view(self, database: str = "gold") -> str:
        """Keep the operations view in the session's catalog, for every program that shares that catalog.

        It reads the audit files where they are stored, and its clock runs when it is read.
        """
        folder = self.lake.path(bronze.AUDIT)
        if not self.lake.holds(folder):
            raise FileNotFoundError(f"no load has run under {self.lake.root}: there is no audit to show")
        name = f"{database}.{VIEW.split('.')[1]}"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS {gold.dashboard_sql(f'parquet.`{folder}`')}")
        return name

    # -- building ------------------------------------------------------------------------------

    def sized_for(self, tables: Iterable[str]) -> tuple[Warehouse, int]:
        """This warehouse in a session of its own, whose shuffles fit the largest stored input, and the slices to build in.

        Adaptive execution merges small shuffle partitions but never raises their number, and too few
        would spill at any size of cluster. Other queries and builds keep their settings. A slice costs some
        jobs whatever it holds, and each task that cuts writes a file for it: were there more with every larger
        input, the jobs would grow with it and the files with its square.
        """
        size = max((self.lake.size_in_bytes(t) for t in tables), default=0)
        tasks = tasks_for(self.spark, size, self.task_bytes)
        slices = min(-(-tasks // self.shuffle_tasks_at_once), MOST_SLICES)
        session = own_session(self.spark, min(-(-tasks // slices), self.shuffle_tasks_at_once), **(cut_settings(slices) if slices > 1 else {}))
        lake = type(self.lake)(session, self.lake.root)
        return Warehouse(lake, self.registry, self.task_bytes, self.shuffle_tasks_at_once), slices

    def cut_inputs(self, table: Table, cutter: Cutter) -> list[list[DataFrame]]:
        """The inputs of each slice of a build, in the order of ``table.reads``."""
        via = {name: (column, owner) for name, column, owner in table.owned}
        inputs = []
        for name in table.reads:
            rows = self.read(name)
            if table.slice_by in rows.columns:
                inputs.append(cutter.by(rows, name, table.slice_by).parts())
            elif name in via:
                column, owner = via[name]
                spread = [c for c in rows.columns if c != column]

                def owned(part: DataFrame, owners: DataFrame, column=column, spread=spread) -> DataFrame:
                    return spread_join(part, owners, column, spread)

                inputs.append(cutter.by_owner(rows, name, column, self.read(owner), table.slice_by, owned).parts())
            else:
                inputs.append([rows] * cutter.n)
        return [list(parts) for parts in zip(*inputs)]

    def build(self, tables: Iterable[Table], run_ts: datetime) -> None:
        """Build tables that do not read one another."""
        tables = list(tables)
        sized, slices = self.sized_for({name for t in tables for name in t.reads})
        large = sized.spark.conf.get(SHUFFLE_TASKS) != self.spark.conf.get(SHUFFLE_TASKS)

        def write(table: Table, slices_of_inputs: list[list[DataFrame]], by_month: bool) -> None:
            known = {"broadcast": by_month} if table.by_month else {}
            if table.layer == "silver":
                known["large"] = sum(self.lake.size_in_bytes(t) for t in table.reads) > self.task_bytes
            parts = [table.build(*inputs, run_ts, **known) for inputs in slices_of_inputs]
            in_ranges = large and not by_month
            sized.lake.replace(parts, table.name, table.sort, table.month_of, by_month, in_ranges, table.told(run_ts))
            sized.lake.drop_old_versions(table.name)

        def one(table: Table) -> None:
            inputs = [sized.read(t) for t in table.reads]
            by_month = table.by_month is not None and table.by_month(*inputs)
            if slices == 1 or not table.slice_by or by_month:  # by month, nothing is shuffled
                write(table, [inputs], by_month)
                return
            with Cutter(sized.lake, slices) as cutter:
                write(table, sized.cut_inputs(table, cutter), False)

        _side_by_side(one, tables)

    def load_seed(self, csv_path: str | None = None) -> None:
        codes = read_csv(self.spark, csv_path, schemas.RISK_MCC_CODES) if csv_path else risk_mcc_codes(self.spark)
        self.lake.replace(codes, SEED)
        self.lake.drop_old_versions(SEED)

    def snapshot(self, run_ts: datetime) -> None:
        """Record customer history; only the open versions of the last run are read.

        A customer id that two source systems share would open two versions, and more with every
        run: such a dimension is refused.
        """
        sized, slices = self.sized_for(["silver.dim_customer", HISTORY])
        customers, before = sized.read("silver.dim_customer"), None
        if sized.lake.exists(HISTORY):
            before = sized.lake.read_history(HISTORY, schemas.CUSTOMER_SCD2, only_open=True)
        with Cutter(sized.lake, slices) as cutter:
            parts = [(before, customers)]
            if slices > 1:
                new = cutter.by(customers, "customers", "customer_id").parts()
                old = cutter.by(before, "history", "customer_id").parts() if before is not None else [None] * slices
                parts = list(zip(old, new))
            if not all(quality.duplicates(new, "customer_id").isEmpty() for _, new in parts):
                raise ValueError("silver.dim_customer holds several rows per customer_id; no snapshot taken")
            changes = [history_changes(old, new, "customer_id", CUSTOMER_CHECK_COLUMNS, run_ts) for old, new in parts]
            sized.lake.write_history(changes, HISTORY, ("customer_id",))

    # -- checking ------------------------------------------------------------------------------

    def test(self, tables: Iterable[Table], raise_on_failure: bool = True) -> DataFrame:
        """All rules about single rows of a table in one scan of it; keys are counted, in slices if need be."""
        tables = list(tables)
        sized, slices = self.sized_for(t.name for t in tables)
        checks: dict[str, Callable[[], bool]] = {}

        def unique(table: Table) -> bool:
            keys = sized.read(table.name).select(table.key)
            if slices == 1:
                return quality.duplicates(keys, table.key).isEmpty()
            with Cutter(sized.lake, slices) as cutter:
                return all(quality.duplicates(part, table.key).isEmpty() for part in cutter.by(keys, table.name, table.key).parts())

        for table in tables:
            rules = table.row_rules()
            broken = quality.once(lambda table=table, rules=rules: quality.broken_rules(sized.read(table.name), rules))
            for title in rules:
                checks[f"{table.name} {title}"] = lambda title=title, broken=broken: title not in broken()
            if table.key:
                checks[f"{table.name} {table.key} unique"] = lambda table=table: unique(table)
        return quality.run_checks(self.spark, checks, raise_on_failure)

    def verify(self, raise_on_failure: bool = True) -> DataFrame:
        """Health of the stored warehouse after a run."""
        filled = ("bronze.crm_customers_raw", "silver.dim_customer", "gold.customer_360")
        checks = {f"{t} not empty": (lambda t=t: not self.read(t).isEmpty()) for t in filled}
        checks["PII hashing"] = lambda: quality.malformed_hashes(self.read("silver.dim_customer")).isEmpty()
        checks["bronze audit healthy"] = lambda: quality.failing_mappings(self.read(bronze.AUDIT)).isEmpty()
        return quality.run_checks(self.spark, checks, raise_on_failure)

    def freshness(self, as_of: datetime) -> DataFrame:
        """Freshness of the raw tables, one row each."""
        rows = None
        for mapping in self.registry:
            one = quality.freshness(self.read(mapping.target_table), as_of)
            one = one.select(F.lit(mapping.target).alias("table_name"), "*")
            rows = one if rows is None else rows.unionByName(one)
        return rows

    # -- runs ----------------------------------------------------------------------------------

    def run_bronze(self, source, mappings: Iterable[str] | None = None, full_refresh: bool = False) -> dict[str, int]:
        return bronze.run_bronze(self.lake, source, mappings, full_refresh, self.registry)

    def run_transform(
        self,
        run_ts: datetime | None = None,
        select: Iterable[str] | None = None,
        skip_test: bool = False,
        seed_csv: str | None = None,
        test_before_snapshot: bool = False,
    ) -> None:
        """Seed, silver, snapshot, silver tests, gold, gold tests.

        ``select`` narrows the tables built and tested; seed and snapshot always run. The snapshot
        precedes the tests unless ``test_before_snapshot`` keeps untested rows out of the history.
        """
        run_ts = run_ts or bronze.utc_now().replace(microsecond=0)
        chosen = select_tables(select)
        silver_tables = [t for t in chosen if t in SILVER]
        gold_tables = [t for t in chosen if t not in SILVER]

        self.load_seed(seed_csv)
        self.build(silver_tables, run_ts)
        if test_before_snapshot and not skip_test:
            self.test(silver_tables)
        self.snapshot(run_ts)
        if not test_before_snapshot and not skip_test:
            self.test(silver_tables)
        self.build(gold_tables, run_ts)
        if not skip_test:
            self.test(gold_tables)

    def run_pipeline(
        self,
        source,
        run_ts: datetime | None = None,
        full_refresh: bool = False,
        skip_bronze: bool = False,
        skip_test: bool = False,
        seed_csv: str | None = None,
        test_before_snapshot: bool = False,
    ) -> DataFrame:
        """Everything, and the health report at the end."""
        if not skip_bronze:
            self.run_bronze(source, full_refresh=full_refresh)
        self.run_transform(run_ts, None, skip_test, seed_csv, test_before_snapshot)
        return self.verify()


def open_warehouse(spark: SparkSession, root: str, registry: Iterable[Mapping] = MAPPINGS, **sizes: int) -> Warehouse:
    return Warehouse(Lake(spark, root), registry, **sizes)
