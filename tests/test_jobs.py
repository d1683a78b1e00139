from datetime import date, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import RUN, T0, T1, plan, raw, rows
from ledgermill.__main__ import main
from ledgermill.operators import lookup, quality
from ledgermill.operators.quality import ChecksFailed
from ledgermill.plans import bronze, gold, silver
from ledgermill.plans.jobs import open_warehouse
from ledgermill.plans.tables import GOLD, HISTORY, SEED, SILVER, VIEW, select_tables
from ledgermill.session import SHUFFLE_TASKS
from ledgermill.sources import Lake
from ledgermill.sources.lake import shared_dir
from ledgermill.sources.slices import MOST_SLICES, Cutter
from ledgermill.testing import queries
from ledgermill.testing.bindings import BoundSource, TestTables
from test_bronze import write_extracts

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    warehouse = open_warehouse(spark, str(tmp_path_factory.mktemp("lake")))
    source = BoundSource(TestTables(spark, FOLDER))
    report = warehouse.run_pipeline(source, RUN)
    return warehouse, source, report


def test_pipeline_builds_every_table_and_verifies(built):
    warehouse, _, report = built
    assert report.count() == 5 and report.filter("NOT ok").isEmpty()
    for table in (*SILVER, *GOLD):
        assert not warehouse.read(table.name).isEmpty(), table.name
        assert "ym" not in warehouse.read(table.name).columns


def test_second_run_loads_nothing_and_keeps_history(built):
    warehouse, source, _ = built
    before = {t.name: warehouse.read(t.name).drop("updated_at", "refreshed_at") for t in (*SILVER, *GOLD)}
    before = {name: rows(df) for name, df in before.items()}
    history, states = rows(warehouse.read(HISTORY)), warehouse.read(bronze.STATE).count()

    warehouse.run_pipeline(source, RUN + timedelta(1))
    loads = warehouse.read(bronze.AUDIT).orderBy("started_at").collect()[6:]
    assert [(r.status, r.rows_loaded) for r in loads] == [("success", 0)] * 6
    assert warehouse.read(bronze.STATE).count() == states
    assert rows(warehouse.read(HISTORY)) == history
    for name, seen in before.items():
        assert rows(warehouse.read(name).drop("updated_at", "refreshed_at")) == seen, name


def test_dashboard_is_a_view(built):
    warehouse, _, _ = built
    view = warehouse.dashboard()
    assert rows(view, "last_status") == [("success",)] * 6
    assert warehouse.spark.table(VIEW.split(".")[1]).count() == 6


def test_stored_view_is_the_dashboard(built):
    """Another session of the catalog reads it by name; a second session of the same program stands for one here."""
    warehouse, _, _ = built
    name = warehouse.store_view("ops")
    other = warehouse.spark.newSession().table(name)
    now = warehouse.dashboard()
    assert other.dtypes == now.dtypes
    columns = [c for c in now.columns if c != "refreshed_at"]
    assert rows(other, *columns) == rows(now, *columns)
    with pytest.raises(FileNotFoundError, match="no load has run"):
        open_warehouse(warehouse.spark, warehouse.lake.root + "-none").store_view()


def test_freshness_of_all_raw_tables(built):
    warehouse, _, _ = built
    out = warehouse.freshness(bronze.utc_now())
    assert rows(out, "freshness_status") == [("pass",)] * 6


def test_month_folders_are_pruned(built):
    warehouse, _, _ = built
    table = "silver.fact_transaction"
    first, last = date(1998, 1, 10), date(1998, 2, 20)
    part = warehouse.read_days(table, first, last)
    assert rows(part) == rows(warehouse.read(table).filter(f"trx_date BETWEEN '{first}' AND '{last}'"))
    assert "ym#" in plan(part).split("PartitionFilters")[1].split("]")[0]


def test_filters_and_columns_reach_the_scan(built):
    warehouse, _, _ = built
    build = plan(silver.fact_transaction(warehouse.read("bronze.payments_transactions_raw"), RUN))
    for pushed in ("GreaterThan(trx_id,0)", "GreaterThan(customer_id,0)", "Not(EqualTo(account_id,"):
        assert pushed in build
    daily = warehouse.read("silver.fact_transaction").groupBy("customer_id", "trx_date").agg({"amount": "sum"})
    assert "ReadSchema: struct<customer_id:int,trx_date:date,amount:decimal(18,2)>" in plan(daily)


def test_widening_mart_is_written_without_a_shuffle(built):
    warehouse, _, _ = built
    mart = gold.mcc_risk_enriched(warehouse.read("silver.fact_transaction"), warehouse.read(SEED), RUN)
    assert "hashpartitioning" not in plan(mart)
    assert [t.name for t in GOLD if t.by_month] == ["gold.mcc_risk_enriched_transactions"]


def test_selection():
    assert [t.name for t in select_tables(["tag:gold"])] == [t.name for t in GOLD]
    assert [t.name for t in select_tables(["gold.customer_360", "dim_card"])] == ["silver.dim_card", "gold.customer_360"]
    assert select_tables([VIEW]) == []
    assert len(select_tables()) == 9
    with pytest.raises(ValueError, match="nothing matches 'tag:bronze'"):
        select_tables(["tag:bronze"])


def test_transform_builds_the_selection_only(built):
    warehouse, _, _ = built
    before = {t.name: warehouse.lake.current(t.name) for t in (*SILVER, *GOLD)}
    warehouse.run_transform(RUN + timedelta(2), select=["daily_transaction_summary"])
    after = {t.name: warehouse.lake.current(t.name) for t in (*SILVER, *GOLD)}
    assert all(len(warehouse.lake.versions(name)) <= 2 for name in after)
    assert [n for n in after if after[n] != before[n]] == ["gold.daily_transaction_summary"]


class Slip:
    """A source with one negative amount."""

    def __init__(self, source):
        self.source = source

    def table(self, mapping, watermark=None):
        df = self.source.table(mapping)
        return df.withColumn("amount", -df.amount) if mapping.name == "transactions" else df


def test_failing_test_stops_before_gold(spark, tmp_path):
    source = Slip(BoundSource(TestTables(spark, FOLDER)))
    warehouse = open_warehouse(spark, str(tmp_path))
    with pytest.raises(ChecksFailed, match="fact_transaction without negative amounts"):
        warehouse.run_pipeline(source, RUN)
    assert warehouse.lake.exists(HISTORY) and not warehouse.lake.exists("gold.customer_360")
    with pytest.raises(ChecksFailed):
        warehouse.run_transform(RUN + timedelta(1), test_before_snapshot=True)
    assert len(warehouse.lake.versions(HISTORY)) == 1
    warehouse.run_transform(RUN + timedelta(1), skip_test=True)
    assert warehouse.lake.exists("gold.customer_360")


def test_verify_fails_on_an_empty_warehouse(spark, tmp_path):
    report = open_warehouse(spark, str(tmp_path)).verify(raise_on_failure=False)
    assert [r.ok for r in report.collect()] == [False, False, False, False, True]


IDS = T.StructType([T.StructField("id", T.LongType())])


def test_replace_keeps_the_old_version_until_committed(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.replace(spark.range(3), "silver.t")
    lake.replace(lake.read("silver.t", IDS).filter("id > 0"), "silver.t")  # reads what it replaces
    assert lake.read("silver.t", IDS).count() == 2
    half = tmp_path / "silver" / "t" / "v=00000003"
    half.mkdir()
    (half / "part-0.parquet").write_bytes(b"half a file")
    assert lake.read("silver.t", IDS).count() == 2
    lake.replace(spark.range(9), "silver.t")
    assert lake.read("silver.t", IDS).count() == 9
    lake.drop_old_versions("silver.t", keep=1)
    assert [p.name for p in (tmp_path / "silver" / "t").iterdir()] == ["v=00000004"]
    assert lake.read("silver.t", IDS).count() == 9


def test_tables_without_rows(spark, tmp_path):
    """Nobody used the app: month folders do not even exist, and the marts are built all the same."""

    class Quiet(BoundSource):
        def table(self, mapping, watermark=None):
            df = super().table(mapping)
            return df.limit(0) if mapping.system == "mobile" else df

    warehouse = open_warehouse(spark, str(tmp_path))
    warehouse.run_pipeline(Quiet(TestTables(spark, FOLDER)), RUN)
    assert warehouse.read("silver.fact_app_event").isEmpty()
    assert warehouse.read("gold.customer_360").agg({"session_count": "max"}).first()[0] == 0


def test_unbuilt_tables_are_an_error(spark, tmp_path):
    warehouse = open_warehouse(spark, str(tmp_path))
    for name in ("silver.dim_card", HISTORY):
        with pytest.raises(FileNotFoundError, match=name):
            warehouse.read(name)


def test_one_large_month_is_split_into_files(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    df = spark.range(0, 300_000, 1, 8).selectExpr(
        "if(id % 3 = 0, DATE '2024-01-05', date_add(DATE '2024-02-01', cast(id % 300 AS int))) AS d", "uuid() AS u"
    )
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "512k")
    try:
        lake.replace(df, "silver.t", ("d", "u"), month_of="d")
    finally:
        spark.conf.set(setting, before)
    files = list((tmp_path / "silver" / "t" / "v=00000001" / "ym=202401").glob("*.parquet"))
    assert len(files) > 3
    assert spark.read.parquet(lake.current("silver.t")).count() == 300_000
    values = [r.u for r in spark.read.parquet(str(files[0])).collect()]
    assert values == sorted(values)


def test_tasks_follow_the_stored_size(spark, tmp_path):
    warehouse = open_warehouse(spark, str(tmp_path))
    warehouse.lake.replace(silver.dim_customer(raw(spark, "crm_customers", {}), RUN), "silver.dim_customer")
    size = warehouse.lake.size_in_bytes("silver.dim_customer")
    before = int(spark.conf.get(SHUFFLE_TASKS))

    def tasks(**sizes):
        sized, slices = open_warehouse(spark, str(tmp_path), **sizes).sized_for(["silver.dim_customer"])
        assert sized.spark.conf.get("spark.sql.session.timeZone") == "UTC"
        return int(sized.spark.conf.get(SHUFFLE_TASKS)), slices

    assert tasks() == (before, 1)  # small: as configured
    wanted = -(-2 * size // 64)
    assert tasks(task_bytes=64) == (wanted, 1) and wanted > before  # large: more partitions
    n, slices = tasks(task_bytes=64, shuffle_tasks_at_once=50)  # huge: slices of as large tasks
    assert n <= 50 and slices == -(-wanted // 50) and n * slices >= wanted
    assert int(spark.conf.get(SHUFFLE_TASKS)) == before


def test_tests_are_sized_too(spark, tmp_path, monkeypatch):
    warehouse = open_warehouse(spark, str(tmp_path), task_bytes=64)
    warehouse.lake.replace(silver.dim_customer(raw(spark, "crm_customers", {}), RUN), "silver.dim_customer")
    seen = []
    monkeypatch.setattr(quality, "duplicates", lambda df, c: seen.append(df.sparkSession.conf.get(SHUFFLE_TASKS)) or df.limit(0))
    warehouse.test([SILVER[0]])
    assert int(seen[0]) == -(-2 * warehouse.lake.size_in_bytes("silver.dim_customer") // 64)


def test_slices_build_the_same_rows(built, spark, tmp_path):
    warehouse, _, _ = built
    cut = open_warehouse(spark, str(tmp_path), task_bytes=1 << 14, shuffle_tasks_at_once=8)
    for name in {n for t in (*SILVER, *GOLD) for n in t.reads}:
        cut.lake.replace(warehouse.read(name), name)
    assert cut.sized_for(["silver.fact_transaction"])[1] > 2
    for table in (*SILVER[2:4], *GOLD):
        cut.build([table], RUN)
        dropped = ("updated_at", "refreshed_at")
        assert rows(cut.read(table.name).drop(*dropped)) == rows(warehouse.read(table.name).drop(*dropped)), table.name


def test_no_slice_reads_more_than_its_share(built, spark, tmp_path, monkeypatch):
    """Every input of a sliced build, also one without the slice column, is read in parts that fit the tasks."""
    warehouse, _, _ = built
    (table,) = [t for t in GOLD if t.name == "gold.customer_360"]
    cut = open_warehouse(spark, str(tmp_path), task_bytes=1 << 13, shuffle_tasks_at_once=16)
    for name in table.reads:
        cut.lake.replace(warehouse.read(name), name)
    sized, n = cut.sized_for(table.reads)
    assert n > 2
    largest = max(cut.lake.size_in_bytes(name) for name in table.reads)
    with Cutter(sized.lake, n) as cutter:
        slices_of_inputs = sized.cut_inputs(table, cutter)
        for made in cutter.made.values():
            assert max(made.bytes(i) for i in range(n)) < 2 * largest / n + (1 << 14)
        cards = table.reads.index("silver.dim_card")
        owned = warehouse.read("silver.dim_card").join(warehouse.read("silver.dim_account"), "account_id", "left_semi")
        assert sum(inputs[cards].count() for inputs in slices_of_inputs) == owned.count()
        staged = Path(cutter.folder)
        assert staged.exists()
    assert not staged.exists()


def test_tests_and_snapshots_run_in_slices(built, spark, tmp_path, monkeypatch):
    warehouse, _, _ = built
    cut = open_warehouse(spark, str(tmp_path), task_bytes=1 << 10, shuffle_tasks_at_once=4)
    customers = warehouse.read("silver.dim_customer")
    cut.lake.replace(customers, "silver.dim_customer")
    _, n = cut.sized_for(["silver.dim_customer"])
    seen = []
    counted = quality.duplicates
    monkeypatch.setattr(quality, "duplicates", lambda df, c: seen.append(df.count()) or counted(df, c))
    cut.test([SILVER[0]])
    assert len(seen) == n > 2 and sum(seen) == customers.count() and max(seen) < customers.count() / 2
    seen.clear()
    cut.snapshot(RUN)
    cut.lake.replace(customers.filter("customer_id % 3 <> 0"), "silver.dim_customer")
    cut.snapshot(RUN + timedelta(1))
    assert len(seen) > 2 * 2 and max(seen) < customers.count() / 2
    history = cut.read(HISTORY)
    assert history.count() == customers.count()
    assert history.filter("valid_to IS NOT NULL").count() == customers.filter("customer_id % 3 = 0").count()
    cut.lake.replace(customers.union(customers), "silver.dim_customer")
    with pytest.raises(ValueError, match="several rows per customer_id"):
        cut.snapshot(RUN + timedelta(2))
    with pytest.raises(ChecksFailed, match="customer_id unique"):
        cut.test([SILVER[0]])


def test_every_stored_file_is_compressed_by_the_lakes_codec(built, spark, tmp_path):
    warehouse, _, _ = built
    control = (bronze.STATE, bronze.AUDIT)
    files = [f for f in Path(warehouse.lake.root).rglob("*.parquet") if not any(str(f).startswith(warehouse.lake.path(c)) for c in control)]
    assert len(files) > 15 and all(f.name.endswith(".zstd.parquet") for f in files)
    with Cutter(Lake(spark, str(tmp_path)), 2) as cutter:
        cutter.by(spark.range(20), "ids", "id")
        cut = list(tmp_path.rglob("*.parquet"))
        assert cut and all(f.name.endswith(".zstd.parquet") for f in cut)


def test_slices_do_not_grow_with_the_input(spark, tmp_path):
    """Past their bound tasks grow, never the shuffle; every row is still in one slice."""
    cut = open_warehouse(spark, str(tmp_path), task_bytes=1 << 4, shuffle_tasks_at_once=2)
    given = [{"customer_id": i, "source_system": "two" if i % 10 else "one"} for i in range(1, 301)]
    cut.lake.replace(silver.dim_customer(raw(spark, "crm_customers", *given), RUN), "silver.dim_customer")
    sized, n = cut.sized_for(["silver.dim_customer"])
    assert n == MOST_SLICES and sized.spark.conf.get(SHUFFLE_TASKS) == "2"
    cut.test([SILVER[0]])
    cut.snapshot(RUN)
    assert sorted(r.customer_id for r in cut.read(HISTORY).select("customer_id").collect()) == list(range(1, 301))


def test_extract_of_a_large_reference_is_compressed_and_freed(spark, tmp_path, monkeypatch):
    spark.range(50).selectExpr("id AS l_orderkey", "1 AS l_linenumber").write.parquet(str(tmp_path / "lineitem.parquet"))
    folders = (str(tmp_path / f"scratch-{i}") for i in range(9))
    monkeypatch.setattr(queries, "_scratch_folder", lambda spark: next(folders))
    load, seen = queries.Warehouse.load_seed, []
    monkeypatch.setattr(queries.Warehouse, "load_seed", lambda self, path: seen.extend(f.name for f in Path(path).glob("part-*")) or load(self, path))
    given = [{"trx_id": i, "posting_date": date(2024, 1, 1 + i % 28), "merchant_category_code": "5411"} for i in range(1, 40)]
    out = queries._enriched_by_large_reference(TestTables(spark, str(tmp_path)), silver.fact_transaction(raw(spark, "transactions", *given), RUN))
    assert rows(out.select("mcc_category").distinct()) == [("Grocery",)] and out.count() == 39
    assert seen and all(name.endswith(".csv.gz") for name in seen)
    assert not list(tmp_path.glob("scratch-*/codes"))


def test_row_rules_take_one_scan_per_table(built, monkeypatch):
    warehouse, _, _ = built
    scans, rules = [], quality.broken_rules
    monkeypatch.setattr(quality, "broken_rules", lambda df, r: scans.append(set(r)) or rules(df, r))
    report = warehouse.test([SILVER[3]])
    assert scans == [{"without negative amounts", "trx_id not null"}]
    assert {r.check for r in report.collect()} == {f"silver.fact_transaction {t}" for t in ("without negative amounts", "trx_id not null", "trx_id unique")}


def test_large_builds_lay_days_out_in_ranges(built, spark, tmp_path):
    warehouse, _, _ = built
    large = open_warehouse(spark, str(tmp_path), task_bytes=1 << 13)
    name = "bronze.payments_transactions_raw"
    large.lake.replace(warehouse.read(name), name)
    large.build([SILVER[3]], RUN)
    files = spark.read.parquet(large.lake.current(SILVER[3].name)).selectExpr("trx_date", "_metadata.file_path AS f").groupBy("f")
    spans = sorted(tuple(r) for r in files.agg({"trx_date": "min"}).withColumnRenamed("min(trx_date)", "a").join(files.agg({"trx_date": "max"}), "f").select("a", "max(trx_date)").collect())
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))  # ranges meet in one day at most
    assert rows(large.read(SILVER[3].name).drop("updated_at")) == rows(warehouse.read(SILVER[3].name).drop("updated_at"))


def test_large_silver_tables_shuffle_repeated_keys_only(spark, tmp_path, monkeypatch):
    """Whole rows are ranked for keys that occur again; what is stored is what a small build stores."""
    ranked, of_repeated = [], silver.latest_of_repeated
    monkeypatch.setattr(silver, "latest_of_repeated", lambda df, keys, *rest: ranked.append(keys[0]) or of_repeated(df, keys, *rest))
    made = {
        "crm_customers": [dict(customer_id=i % 40, city=f"c{i}", load_dttm=T0 if i < 40 else T1) for i in range(1, 60)],
        "core_accounts": [dict(account_id=f"A{i % 50}", customer_id=i, load_dttm=T1 if i % 2 else T0) for i in range(1, 70)],
        "cards": [dict(card_id=i % 50, account_id=f"A{i}") for i in range(1, 70)],
        "transactions": [dict(trx_id=i % 90, trx_datetime=T0 + timedelta(i), posting_date=date(2024, 1, 1 + i % 30), amount=Decimal(i)) for i in range(1, 130)],
        "mobile_sessions": [dict(session_id=f"S{i % 50}", login_time=T0 + timedelta(i) if i % 3 else None) for i in range(1, 70)],
        "mobile_events": [dict(event_id=i % 50, session_id="S1", event_time=T0 + timedelta(i) if i % 3 else None) for i in range(1, 70)],
    }
    stored = []
    for name, task_bytes in (("small", 1 << 27), ("large", 1 << 10)):
        warehouse = open_warehouse(spark, str(tmp_path / name), task_bytes=task_bytes)
        for mapping in warehouse.registry:
            warehouse.lake.replace(raw(spark, mapping.name, *made[mapping.name]), mapping.target_table)
        warehouse.build(SILVER, RUN)
        stored.append([rows(warehouse.read(t.name)) for t in SILVER])
        assert sorted(ranked) == ([] if name == "small" else sorted(t.key for t in SILVER))
    assert stored[0] == stored[1] and all(stored[0])


def test_columns_that_others_tell_are_made_after_the_shuffle(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    df = spark.range(90).selectExpr("id", "date '2024-01-01' + cast(id AS int) AS day", "'sent' AS at", "id AS n")
    for in_ranges in (False, True):
        lake.replace(df, "silver.t", ("day", "id"), "day", False, in_ranges, {"at": F.lit("made"), "day": F.date_add(F.lit(date(2024, 1, 1)), F.col("n").cast("int"))})
        got = lake.read("silver.t", df.schema)
        assert got.columns == df.columns and rows(got) == rows(df.withColumn("at", F.lit("made")))
    for table in (*SILVER, *GOLD):
        assert set(table.told(RUN)) <= {f.name for f in table.schema}


def test_large_reference_is_laid_out_by_month(built, spark, tmp_path, monkeypatch):
    """Beyond the broadcast bound the join shuffles; files per month stay as few as tables by month have."""
    warehouse, _, _ = built
    (table,) = [t for t in GOLD if t.name == "gold.mcc_risk_enriched_transactions"]
    other = open_warehouse(spark, str(tmp_path))
    for name in table.reads:
        other.lake.replace(warehouse.read(name), name, month_of="trx_date" if "fact" in name else None)
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 10)
    other.build([table], RUN)
    months = list(Path(other.lake.current(table.name)).glob("ym=*"))
    assert len(months) > 50 and all(len(list(m.glob("*.parquet"))) == 1 for m in months)
    assert rows(other.read(table.name).drop("refreshed_at")) == rows(warehouse.read(table.name).drop("refreshed_at"))


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_command_line(spark, tmp_path, capsys):
    write_extracts(tmp_path)
    sources, root = str(tmp_path / "sources"), str(tmp_path / "lake")
    assert main(["load-sources", "--data-dir", str(tmp_path), "--root", sources]) == 0
    assert main(["bronze", "--root", root, "--source", "parquet", "--source-dir", sources, "--mapping", "cards"]) == 0
    assert "cards: 1 rows" in capsys.readouterr().out
    assert main(["verify", "--root", root]) == 1
    given = ["--source", "csv", "--source-dir", str(tmp_path)]
    assert main(["pipeline", "--root", root, *given, "--full-refresh"]) == 0
    assert main(["transform", "--root", root, "--select", "tag:gold", "--skip-test", "--full-refresh"]) == 0
    assert main(["seed", "--root", root]) == 0 and main(["snapshot", "--root", root]) == 0
    assert main(["test", "--root", root, "--select", "tag:silver"]) == 0
    assert "card_id unique" in capsys.readouterr().out
    assert main(["bronze", "--root", root, *given, "--mapping", "mobile_sessions", "--strategy", "mobile_sessions=anti_join"]) == 0
    assert "mobile_sessions: 0 rows" in capsys.readouterr().out
    assert main(["transform", "--root", root]) == 0
    assert "bronze audit healthy" in capsys.readouterr().out
    assert main(["verify", "--root", root]) == 0
    assert main(["freshness", "--root", root]) == 0
    assert capsys.readouterr().out.count("pass") == 6
    assert main(["freshness", "--root", str(tmp_path / "none")]) == 1
    assert main(["dashboard", "--root", root, "--store", "ops_cli"]) == 0
    assert "ops_cli.pipeline_operations_dashboard" in capsys.readouterr().out
    assert spark.table("ops_cli.pipeline_operations_dashboard").count() == 6
    assert main(["dashboard", "--root", root]) == 0
    assert "healthy" in capsys.readouterr().out
    warehouse = open_warehouse(spark, root)
    assert warehouse.read("gold.customer_360").first()["total_balance"] == Decimal("12.50")
