import re
from dataclasses import replace
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import BY_NAME, rows, source
from ledgermill.plans import bronze, silver
from ledgermill.plans.jobs import open_warehouse
from ledgermill.sources import MAPPINGS, CsvSource, ParquetSource, select_mappings
from ledgermill.sources.mappings import with_strategy
from ledgermill.sources.relational import JdbcSource, connection_options, cut_points, range_predicates


class Fixed:
    """A source that hands out one frame."""

    def __init__(self, df):
        self.df = df

    def table(self, mapping, watermark=None):
        return self.df


@pytest.fixture
def warehouse(spark, tmp_path):
    return open_warehouse(spark, str(tmp_path / "lake"))


def trx(spark, *ids, **columns):
    return Fixed(source(spark, "transactions", *[{"trx_id": i, **columns} for i in ids]))


def load(warehouse, src, name="transactions", **options):
    return warehouse.run_bronze(src, [name], **options)[name]


def target(warehouse, name="transactions"):
    return warehouse.read(BY_NAME[name].target_table)


def trail(warehouse):
    audit = warehouse.read(bronze.AUDIT).orderBy("started_at")
    columns = ("load_mode", "status", "rows_loaded", "last_watermark", "new_watermark")
    return [tuple(r) for r in audit.select(*columns).collect()]


def test_unloaded_tables_read_as_empty(warehouse):
    for mapping in MAPPINGS:
        df = warehouse.read(mapping.target_table)
        assert df.columns == [f.name for f in mapping.raw_schema] and df.isEmpty()
    assert warehouse.read(bronze.STATE).isEmpty() and warehouse.read(bronze.AUDIT).isEmpty()


def test_incremental_load_takes_only_higher_keys(spark, warehouse):
    assert load(warehouse, trx(spark, 1, 2, 3)) == 3
    assert load(warehouse, trx(spark, 1, 2, 3, 7, 5)) == 2
    assert load(warehouse, trx(spark, 1, 2, 3, 7, 5)) == 0
    assert sorted(r.trx_id for r in target(warehouse).collect()) == [1, 2, 3, 5, 7]
    assert trail(warehouse) == [
        ("incremental", "success", 3, None, "3"),
        ("incremental", "success", 2, "3", "7"),
        ("incremental", "success", 0, "7", "7"),
    ]
    assert warehouse.read(bronze.STATE).count() == 2  # an unmoved mark is not written again


def test_empty_source(spark, warehouse):
    assert load(warehouse, trx(spark)) == 0
    assert trail(warehouse) == [("incremental", "success", 0, None, None)]
    assert warehouse.read(bronze.STATE).isEmpty()


def test_full_refresh_replaces_rows_and_ignores_the_mark(spark, warehouse):
    load(warehouse, trx(spark, 1, 2, 9))
    assert load(warehouse, trx(spark, 1, 4), full_refresh=True) == 2
    assert sorted(r.trx_id for r in target(warehouse).collect()) == [1, 4]
    assert trail(warehouse)[-1] == ("full_refresh", "success", 2, None, "4")
    assert load(warehouse, trx(spark, 1, 4, 5)) == 1
    assert trail(warehouse)[-1] == ("incremental", "success", 1, "4", "5")


def test_rows_are_stamped_and_cut_to_seconds(spark, warehouse):
    load(warehouse, trx(spark, 1, trx_datetime=datetime(2024, 1, 1, 1, 2, 3, 999999)))
    row = target(warehouse).first()
    assert row.trx_datetime == datetime(2024, 1, 1, 1, 2, 3)
    assert row.source_system == "transactions_db"
    assert row.load_dttm.microsecond == 0
    assert target(warehouse).dtypes == [(f.name, f.dataType.simpleString()) for f in BY_NAME["transactions"].raw_schema]


def test_event_data_is_renamed(spark, warehouse):
    events = Fixed(source(spark, "mobile_events", {"event_data": '{"a": 1}'}))
    load(warehouse, events, "mobile_events")
    assert target(warehouse, "mobile_events").first()["event_data_raw"] == '{"a": 1}'


def test_null_in_a_required_column_fails_the_load(spark, warehouse):
    load(warehouse, trx(spark, 1))
    with pytest.raises(Exception, match="amount must not be null"):
        load(warehouse, trx(spark, 2, amount=None))
    assert [r.trx_id for r in target(warehouse).collect()] == [1]
    last = warehouse.read(bronze.AUDIT).orderBy(F.desc("started_at")).first()
    assert (last.status, last.rows_loaded, last.last_watermark, last.new_watermark) == ("failed", 0, "1", "1")
    assert "amount must not be null" in last.error_message and len(last.error_message) <= 1000
    assert load(warehouse, trx(spark, 1, 2)) == 1


def test_a_crash_between_data_and_state_is_repaired_by_the_next_run(spark, warehouse, monkeypatch):
    given = trx(spark, 1, 2, 3, posting_date=datetime(2024, 1, 5).date())
    with monkeypatch.context() as broken:
        broken.setattr(bronze.ControlTables, "write_watermark", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load(warehouse, given)
    assert trail(warehouse)[-1][1:3] == ("failed", 3)
    assert load(warehouse, given) == 3
    assert target(warehouse).count() == 6
    assert silver.fact_transaction(target(warehouse), datetime(2024, 1, 31)).count() == 3


def test_one_failure_does_not_stop_the_other_loads(spark, warehouse):
    class Mixed:
        def table(self, mapping, watermark=None):
            if mapping.name == "cards":
                raise ConnectionError("x" * 5000)
            return source(spark, mapping.name, {})

    with pytest.raises(ConnectionError):
        warehouse.run_bronze(Mixed())
    status = {r.mapping_name: (r.status, r.error_message) for r in warehouse.read(bronze.AUDIT).collect()}
    assert status.pop("cards") == ("failed", "x" * 1000)
    assert len(status) == 5 and set(status.values()) == {("success", None)}


def sessions(spark, *ids):
    return Fixed(source(spark, "mobile_sessions", *[{"session_id": i} for i in ids]))


def test_string_keys_compare_as_text(spark, warehouse):
    load(warehouse, sessions(spark, "ACC9", "ACC10"), "mobile_sessions")
    assert trail(warehouse)[-1][-1] == "ACC9"
    assert load(warehouse, sessions(spark, "ACC9", "ACC10", "ACC11"), "mobile_sessions") == 0


def test_anti_join_finds_keys_below_the_mark(spark, tmp_path):
    by_key = [replace(m, strategy="anti_join") if m.name == "mobile_sessions" else m for m in MAPPINGS]
    warehouse = open_warehouse(spark, str(tmp_path / "lake"), by_key)
    assert load(warehouse, sessions(spark, "f", "f", "c"), "mobile_sessions") == 3
    assert load(warehouse, sessions(spark, "a", "c", "f", "g"), "mobile_sessions") == 2
    assert load(warehouse, sessions(spark, "a", "c", "f", "g"), "mobile_sessions") == 0
    assert trail(warehouse)[-1] == ("incremental", "success", 0, "g", "g")


def test_mark_is_pushed_to_the_scan(spark, tmp_path):
    source(spark, "transactions", {}).write.parquet(str(tmp_path / "transactions"))
    rows = ParquetSource(spark, str(tmp_path)).table(BY_NAME["transactions"])
    plan = bronze.above(rows, "trx_id", 5)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(trx_id,5)" in plan


def test_selection():
    assert [m.name for m in select_mappings(["cards", "bronze.crm_customers_raw"])] == ["cards", "crm_customers"]
    assert [m.name for m in select_mappings(["cards", "bronze.card_cards_raw", "cards"])] == ["cards"]
    assert len(select_mappings()) == 6
    with pytest.raises(ValueError, match="unknown mapping 'nope'.*bronze.card_cards_raw"):
        select_mappings(["nope"])


@pytest.mark.parametrize(
    ("name", "key", "value", "text"),
    [
        ("cards", "card_id", 7, "7"),
        ("core_accounts", "account_id", "ACC9", "ACC9"),
        ("transactions", "trx_datetime", datetime(2024, 1, 2, 3, 4, 5), "2024-01-02 03:04:05"),
    ],
)
def test_watermark_text(warehouse, name, key, value, text):
    mapping = replace(BY_NAME[name], watermark=key)
    warehouse.control.write_watermark(mapping, value)
    assert warehouse.read(bronze.STATE).first()["watermark_value"] == text
    assert warehouse.control.last_watermark(mapping) == value


def test_strategies_are_chosen_by_name():
    chosen = {m.name: m.strategy for m in with_strategy({"mobile_sessions": "anti_join", "bronze.core_accounts_raw": "anti_join"})}
    assert [n for n, s in chosen.items() if s == "anti_join"] == ["core_accounts", "mobile_sessions"]
    with pytest.raises(ValueError, match="strategy must be"):
        with_strategy({"cards": "guess"})
    with pytest.raises(ValueError, match="unknown mapping"):
        with_strategy({"nope": "anti_join"})


def test_anti_join_is_sized_to_the_stored_table(spark):
    new = bronze.not_loaded(spark.range(9), "id", spark.range(4), 13)
    assert rows(new) == [(4,), (5,), (6,), (7,), (8,)]
    final = new._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("hashpartitioning(id") == len(re.findall(r"hashpartitioning\(id#\d+L, 13\)", final)) == 2


def test_watermark_types():
    assert [m.watermark_type for m in MAPPINGS] == ["int", "str", "int", "int", "str", "int"]


def test_newest_state_wins_ties_settled(spark):
    at = datetime(2024, 1, 1)
    schema = "mapping_name string, watermark_value string, watermark_type string, updated_at timestamp_ntz"
    state = spark.createDataFrame(
        [("m", "1", "int", at.replace(day=2)), ("m", "9", "int", at), ("n", "9", "int", at), ("n", "10", "int", at)],
        schema,
    )
    assert bronze.latest_state(state, "m").first()["watermark_value"] == "1"
    assert bronze.latest_state(state, "n").first()["watermark_value"] == "10"
    plan = bronze.latest_state(state, "m")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


HEADERS = {m.source_table: ",".join(f.name for f in m.source_schema) for m in MAPPINGS}
LINES = {
    "customers": '1,"Ann, B",,a@x.y,1990-01-02,Rome,mass,2020-01-01,active',
    "accounts": "ACC1,1,debit,KZT,12.50,2020-01-01,,active",
    "cards": "4000000000000001,ACC1,abc,gold,2027-01-01,ANN B,active,2024-01-01",
    "transactions": "1,ACC1,1,,2024-01-01 10:00:00,debit,99.90,KZT,pos,5411,Shop,posted,2024-01-01",
    "app_sessions": "s1,1,2024-01-01 10:00:00,,ios,1.0,,17,true",
    "app_events": '1,s1,1,2024-01-01 10:00:01,login,"{""to"": ""a,b"", ""n"": 1}",false,',
}


def write_extracts(folder):
    for name, header in HEADERS.items():
        (folder / f"{name}.csv").write_text(f"{header}\n{LINES[name]}\n", encoding="utf-8")


def test_csv_extracts(spark, tmp_path, warehouse):
    write_extracts(tmp_path)
    assert set(warehouse.run_bronze(CsvSource(spark, str(tmp_path))).values()) == {1}
    event = target(warehouse, "mobile_events").first()
    assert event.event_data_raw == '{"to": "a,b", "n": 1}'
    assert (event.is_successful, event.error_message) == (False, None)
    customer = target(warehouse, "crm_customers").first()
    assert (customer.full_name, customer.phone) == ("Ann, B", None)
    assert target(warehouse, "core_accounts").first()["balance"] == Decimal("12.50")


def test_csv_tells_empty_text_from_null(spark, tmp_path, warehouse):
    write_extracts(tmp_path)
    lines = ['1,"",,"  ",,,x,,', "2,Bob,,,,,,,"]
    (tmp_path / "customers.csv").write_text("\n".join([HEADERS["customers"], *lines]) + "\n", encoding="utf-8")
    load(warehouse, CsvSource(spark, str(tmp_path)), "crm_customers")
    out = target(warehouse, "crm_customers").select("customer_id", "full_name", "phone", "email", "city", "segment")
    assert rows(out) == [(1, "", None, "  ", None, "x"), (2, "Bob", None, None, None, None)]


def test_load_sources_replaces_and_feeds_a_load(spark, tmp_path, warehouse):
    write_extracts(tmp_path)
    for _ in range(2):
        bronze.load_sources(spark, str(tmp_path), str(tmp_path / "sources"))
    assert set(warehouse.run_bronze(ParquetSource(spark, str(tmp_path / "sources"))).values()) == {1}


def test_missing_extract_is_an_error(spark, tmp_path):
    write_extracts(tmp_path)
    (tmp_path / "cards.csv").unlink()
    with pytest.raises(FileNotFoundError, match="cards.csv"):
        bronze.load_sources(spark, str(tmp_path), str(tmp_path / "sources"))


def test_malformed_extract_fails(spark, tmp_path, warehouse):
    write_extracts(tmp_path)
    (tmp_path / "cards.csv").write_text(HEADERS["cards"] + "\nnot-a-number,ACC1,a,b,2027-01-01,c,d,2024-01-01\n")
    with pytest.raises(Exception):
        load(warehouse, CsvSource(spark, str(tmp_path)), "cards")


def test_connection_options_and_overrides():
    plain = connection_options("crm", env={})
    assert plain["url"] == "jdbc:postgresql://localhost:5433/crm_db"
    env = {"MOBILE_DB_HOST": "h", "MOBILE_DB_PORT": "1", "MOBILE_DB_NAME": "d"}
    assert connection_options("mobile", env=env)["url"] == "jdbc:postgresql://h:1/d"


@pytest.mark.parametrize("high", [None, "zz"])
def test_key_ranges_cover_every_row_once(spark, high):
    words = spark.createDataFrame([(w,) for w in ["a", "b", "b'c", "c", "zz", None]], "k string")
    numbers = spark.range(20).selectExpr("id AS k")
    for df, bounds, top in ((words, ["b", "b'c", "x"], high), (numbers, [3, 11], high and 19), (numbers, [], high and 19)):
        # Spark SQL writes a quote inside a literal with a backslash
        parts = [p.replace("''", "\\'") for p in range_predicates("k", bounds, top)]
        assert len(parts) == len(bounds) + 1
        assert sum(df.filter(p).count() for p in parts) == df.count()


def test_rows_above_the_highest_key_wait_for_the_next_load(spark):
    parts = range_predicates("id", [3], 7)
    assert [spark.range(20).filter(p).count() for p in parts] == [4, 4]


def test_cut_points_are_evenly_spread():
    assert cut_points(range(1, 11), 5) == [2, 4, 6, 8]
    assert cut_points([1, 1, 1, 1], 4) == [1] and cut_points([], 3) == [] and cut_points([5], 1) == []


class ViewSource(JdbcSource):
    """Answers the split queries from a temporary view instead of a database; the sample is every key."""

    def _query(self, system, sql):
        return self.spark.sql(sql).collect()

    def _rows(self, mapping):
        return self.spark.table(mapping.source_table).count()

    def _sample(self, mapping, where, percent):
        keys = self.spark.table(mapping.source_table).filter(where).select(mapping.watermark)
        return [r[0] for r in keys.orderBy(mapping.watermark).collect()]


@pytest.mark.parametrize(("mark", "expected"), [(None, 10), (400, 10)])
def test_splits_hold_equal_numbers_of_rows(spark, mark, expected):
    keys = spark.range(1, 1001).selectExpr("if(id <= 500, id, id * 1000) AS trx_id")  # half the keys far apart
    keys.createOrReplaceTempView("transactions")
    parts = ViewSource(spark, rows_per_split=100)._splits(BY_NAME["transactions"], mark)
    assert len(parts) == expected
    new = bronze.above(keys, "trx_id", mark)
    counts = [new.filter(p).count() for p in parts]
    assert sum(counts) == new.count() and set(counts) == {new.count() // expected}


class NoEstimate(ViewSource):
    """A table of a thousand pages that was never analysed."""

    def _rows(self, mapping):
        return 0

    def _pages(self, mapping):
        return 1_000


def test_tables_without_statistics_are_read_by_pages(spark):
    """Pages stand in a column of their own here, as no other table knows a row's place."""
    rows = spark.range(1, 5_001).selectExpr("if(id % 10 = 0, null, id) AS trx_id", "id % 1003 AS page")
    rows.createOrReplaceTempView("transactions")
    parts = NoEstimate(spark, rows_per_split=6_400)._splits(BY_NAME["transactions"], None)
    assert parts[0] == "ctid < '(100,0)'::tid AND (trx_id <= 4999 OR trx_id IS NULL)" and len(parts) == 10
    assert parts[4] == "ctid >= '(400,0)'::tid AND ctid < '(500,0)'::tid AND (trx_id <= 4999 OR trx_id IS NULL)"
    local = [re.sub(r"ctid (\S+) '\((\d+),0\)'::tid", r"page \1 \2", p) for p in parts]
    counts = [rows.filter(p).count() for p in local]
    assert sum(counts) == 5_000 and max(counts) < 600
    assert NoEstimate(spark)._splits(BY_NAME["transactions"], None) == ["trx_id <= 4999 OR trx_id IS NULL"]
    assert len(NoEstimate(spark, rows_per_split=1, max_splits=7)._splits(BY_NAME["transactions"], 3)) == 7


def test_small_and_huge_tables_bound_the_number_of_splits(spark):
    spark.range(1000).selectExpr("cast(id AS string) AS session_id").createOrReplaceTempView("app_sessions")
    sessions = BY_NAME["mobile_sessions"]
    assert ViewSource(spark)._splits(sessions, None) == ["session_id <= '999' OR session_id IS NULL"]
    assert len(ViewSource(spark, rows_per_split=1, max_splits=4)._splits(sessions, "100")) <= 5
    spark.range(0).selectExpr("cast(id AS string) AS session_id").createOrReplaceTempView("app_sessions")
    assert ViewSource(spark)._splits(sessions, None) == ["1 = 1"]


def test_staged_source_is_copied_and_laid_out_again(spark, warehouse, tmp_path):
    class Few(CsvSource):
        staged = True

        def table(self, mapping, watermark=None):
            return super().table(mapping, watermark).coalesce(1)

    write_extracts(tmp_path)
    assert warehouse.run_bronze(Few(spark, str(tmp_path)), ["transactions"]) == {"transactions": 1}
    assert list((Path(warehouse.lake.root) / "_staged").iterdir()) == []


def test_bad_extract_leaves_the_old_copy(spark, tmp_path):
    write_extracts(tmp_path)
    target = str(tmp_path / "sources")
    bronze.load_sources(spark, str(tmp_path), target)
    (tmp_path / "cards.csv").write_text(HEADERS["cards"] + "\nnot-a-number,ACC1,a,b,2027-01-01,c,d,2024-01-01\n")
    with pytest.raises(Exception):
        bronze.load_sources(spark, str(tmp_path), target)
    assert ParquetSource(spark, target).table(BY_NAME["cards"]).count() == 1


def test_line_breaks_in_quoted_fields(spark, tmp_path, warehouse):
    write_extracts(tmp_path)
    (tmp_path / "customers.csv").write_text(HEADERS["customers"] + '\n1,"Ann\n""B""",,,,,x,,\n', encoding="utf-8")
    assert warehouse.run_bronze(CsvSource(spark, str(tmp_path), ["customers"]), ["crm_customers"]) == {"crm_customers": 1}
    assert target(warehouse, "crm_customers").first().full_name == 'Ann\n"B"'


def test_unwritten_audit_does_not_hide_the_failure(spark, warehouse, monkeypatch):
    class Down:
        def table(self, mapping, watermark=None):
            raise OSError("source is down")

    def unwritable(self, row):
        raise OSError("disk full")

    monkeypatch.setattr(bronze.ControlTables, "write_audit", unwritable)
    with pytest.raises(OSError, match="source is down") as caught:
        warehouse.run_bronze(Down(), ["cards"])
    assert "disk full" in caught.value.__notes__[0]
