"""Loads from the sources into the raw tables, with high-water marks and an audit trail."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from typing import Any
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill import schemas
from ledgermill.functions import empty_frame, literal_frame, ntz, required, to_seconds
from ledgermill.session import tasks_for
from ledgermill.sources.files import CsvSource
from ledgermill.sources.lake import Lake, SourceLake, path_exists
from ledgermill.sources.mappings import (
    MAPPINGS,
    Mapping,
    select_mappings,
)

STATE, AUDIT = "bronze.load_state", "bronze.load_audit"
MAX_ERROR_TEXT = 1000


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


# -- rows --------------------------------------------------------------------------------------


def above(source: DataFrame, key: str, watermark: Any) -> DataFrame:
    """Rows whose key is above the mark; the predicate reaches the Parquet or JDBC scan."""
    if watermark is None:
        return source
    literal = ntz(watermark) if isinstance(watermark, datetime) else F.lit(watermark)
    return source.filter(F.col(key) > literal)


def not_loaded(source: DataFrame, key: str, loaded: DataFrame, tasks: int | None = None) -> DataFrame:
    """Rows whose key the raw table lacks.

    With ``tasks``, both sides are dealt to so many tasks; else repeated keys collapse before a shuffle
    of the session's size.
    """
    if tasks is None:
        return source.join(loaded.select(key).distinct(), key, "left_anti")
    return source.repartition(tasks, key).join(loaded.select(key).repartition(tasks, key), key, "left_anti")


def stamped(source: DataFrame, mapping: Mapping, load_ts: datetime) -> DataFrame:
    """Source columns in raw shape, plus where and when they were loaded."""
    columns = []
    for f in mapping.source_schema:
        value = to_seconds(f.name) if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name)
        value = value.cast(f.dataType)
        if not f.nullable:
            value = required(value, f.name)
        columns.append(value.alias(mapping.renames.get(f.name, f.name)))
    return source.select(
        *columns,
        F.lit(mapping.source_system).alias("source_system"),
        ntz(load_ts.replace(microsecond=0)).alias("load_dttm"),
    )


# -- control tables ----------------------------------------------------------------------------


class ControlTables:
    """Load state and load audit: one folder per mapping, so parallel loads never share a commit."""

    def __init__(self, lake: Lake):
        self.lake, self.spark = lake, lake.spark

    def _append(self, table: str, schema: T.StructType, row: dict) -> None:
        stored = T.StructType([f for f in schema if f.name != "mapping_name"])
        values = [row.get(f.name) for f in stored]
        folder = f"{self.lake.path(table)}/mapping_name={row['mapping_name']}"
        literal_frame(self.spark, [values], stored).write.mode("append").parquet(folder)

    def read(self, table: str) -> DataFrame:
        schema = schemas.LOAD_STATE if table == STATE else schemas.LOAD_AUDIT
        if not path_exists(self.spark, self.lake.path(table)):
            return empty_frame(self.spark, schema)
        rows = self.spark.read.schema(schema).parquet(self.lake.path(table))
        return rows.select(*[f.name for f in schema])

    def last_watermark(self, mapping: Mapping) -> Any:
        row = latest_state(self.read(STATE), mapping.name).select(F.col("watermark_value").cast(mapping.key_type)).first()
        return None if row is None else row[0]

    def write_watermark(self, mapping: Mapping, value: Any) -> None:
        """The mark is stored as text, as Spark casts it."""
        self._append(
            STATE,
            schemas.LOAD_STATE,
            {
                "mapping_name": mapping.name,
                "watermark_value": value,
                "watermark_type": mapping.watermark_type,
                "updated_at": utc_now(),
            },
        )

    def write_audit(self, row: dict) -> None:
        self._append(AUDIT, schemas.LOAD_AUDIT, row)


def typed_marks() -> list[Column]:
    """Marks in the order of their type: numbers and times by value, other text as text."""
    kind, mark = F.col("watermark_type"), F.col("watermark_value")
    return [
        F.when(kind == "int", mark.cast("decimal(38,0)")),
        F.when(kind == "datetime", mark.cast("timestamp_ntz")),
        mark,
    ]


def latest_state(state: DataFrame, mapping_name: str) -> DataFrame:
    """The newest state row of a mapping: a top-1, not a sort of the table. Of one moment, the highest mark."""
    newest_first = [c.desc_nulls_last() for c in (F.col("updated_at"), *typed_marks())]
    return state.filter(F.col("mapping_name") == mapping_name).orderBy(*newest_first).limit(1)


# -- loads -------------------------------------------------------------------------------------


def load_mapping(lake: Lake, source, mapping: Mapping, full_refresh: bool = False) -> int:
    """Load one mapping and return the number of rows written.

    One job reads, stamps, counts, takes the highest key and writes. A source that bounds its readers
    (``staged``) is first copied as it comes, and the copy is read by as many tasks as it fills. The order
    is data, then state, then audit: after a crash in between, the next run reads the rows again and the
    silver layer drops the copies.
    """
    control = ControlTables(lake)
    started = utc_now()
    last = new = staging = None
    rows = 0

    def audit(status: str, error: str | None = None) -> None:
        finished = utc_now()
        control.write_audit(
            {
                "run_id": str(uuid4()),
                "mapping_name": mapping.name,
                "target_table": mapping.target_table,
                "load_mode": "full_refresh" if full_refresh else "incremental",
                "status": status,
                "rows_loaded": rows,
                "last_watermark": last,
                "new_watermark": new,
                "started_at": started,
                "finished_at": finished,
                "duration_ms": int((finished - started).total_seconds() * 1000),
                "error_message": error,
            }
        )

    try:
        last = new = None if full_refresh else control.last_watermark(mapping)
        by_key = mapping.strategy == "anti_join" and not full_refresh
        source_rows = source.table(mapping, None if by_key else last)
        if by_key:
            loaded = lake.read(mapping.target_table, mapping.raw_schema, or_empty=True)
            tasks = tasks_for(lake.spark, lake.size_in_bytes(mapping.target_table))
            source_rows = not_loaded(source_rows, mapping.watermark, loaded, tasks)
        else:
            source_rows = above(source_rows, mapping.watermark, last)
        if getattr(source, "staged", False):
            staging = lake.stage(source_rows, mapping.target_table)
            source_rows = lake.spark.read.schema(source_rows.schema).parquet(staging)

        key = mapping.renames.get(mapping.watermark, mapping.watermark)
        seen = Observation()
        # sort first: the metrics must sit in the stage that writes, where each task counts once
        out = stamped(source_rows, mapping, started).sortWithinPartitions(*mapping.sort)
        out = out.observe(seen, F.count(F.lit(1)).alias("rows"), F.max(key).alias("high"))
        (lake.replace if full_refresh else lake.append)(out, mapping.target_table)

        rows = seen.get["rows"]
        new = max((mark for mark in (last, seen.get["high"]) if mark is not None), default=None)
        if new != last:
            control.write_watermark(mapping, new)
        if full_refresh:
            lake.drop_old_versions(mapping.target_table)
    except Exception as error:
        try:
            audit("failed", str(error)[:MAX_ERROR_TEXT])
        except Exception as unwritten:
            error.add_note(f"and its audit row was not written: {unwritten}")
        raise
    finally:
        if staging:
            lake.drop_staged(staging)
    audit("success")
    return rows


def run_bronze(
    lake: Lake,
    source,
    mappings: Iterable[str] | None = None,
    full_refresh: bool = False,
    registry: Iterable[Mapping] = MAPPINGS,
) -> dict[str, int]:
    """Load the selected mappings side by side; every load ends before the first error is raised."""
    selected = select_mappings(mappings, registry)
    with ThreadPoolExecutor(len(selected)) as pool:
        running = [(m.name, pool.submit(load_mapping, lake, source, m, full_refresh)) for m in selected]
    return {name: done.result() for name, done in running}


def load_sources(spark: SparkSession, csv_folder: str, target_folder: str, multi_line: Iterable[str] = ()) -> None:
    """Replace the Parquet copies of the six source tables by the CSV extracts.

    Each table gets a new version, which counts once all of it is written: a bad extract leaves the old one.
    """
    source, lake = CsvSource(spark, csv_folder, multi_line), SourceLake(spark, target_folder)
    extracts = [(m.source_table, source.table(m)) for m in MAPPINGS]
    for name, rows in extracts:
        lake.replace(rows, name)
        lake.drop_old_versions(name)
