"""Layered Parquet tables: ``<root>/<layer>/<table>/v=<n>/``.

Every replace is written to a folder of its own and counts once Spark has committed it (the
``_SUCCESS`` marker). A run that dies half-way leaves the previous version in place, and no plan ever
overwrites files it reads. One writer per table at a time.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator, Mapping, Sequence
from datetime import date
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.functions import empty_frame, month_key

MONTH = "ym"
OPEN = "is_open"
BASE = "_BASE"
"""Marks a version of a history table that holds all closed rows, not only those its run closed."""
COMPACT_AFTER = 10
"""Closed rows of so many runs are written together by the next one."""
STAGED_FILE_ROWS = 5_000_000
CODEC = "zstd"
"""Of everything written, copies in slices too: a third less than by Spark's default."""


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _fs(spark, path)
    return fs.exists(hadoop_path)


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, hadoop_path = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(hadoop_path)] if fs.exists(hadoop_path) else []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named by the session; a local one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return tempfile.mkdtemp(prefix="ledgermill-")


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # -- versions ------------------------------------------------------------------------------

    def path(self, table: str) -> str:
        """``layer.name`` -> folder."""
        layer, name = table.split(".")
        return f"{self.root}/{layer}/{name}"

    def _numbers(self, table: str) -> list[int]:
        names = list_names(self.spark, self.path(table))
        return [int(n[2:]) for n in names if n.startswith("v=")]

    def _folder(self, table: str, number: int) -> str:
        return f"{self.path(table)}/v={number:08d}"

    def _committed(self, table: str, newest_first: bool = False) -> Iterator[str]:
        for number in sorted(self._numbers(table), reverse=newest_first):
            folder = self._folder(table, number)
            if path_exists(self.spark, folder + "/_SUCCESS"):
                yield folder

    def versions(self, table: str) -> list[str]:
        """Folders of the committed versions, oldest first."""
        return list(self._committed(table))

    def current(self, table: str) -> str | None:
        return next(self._committed(table, newest_first=True), None)

    def exists(self, table: str) -> bool:
        return self.current(table) is not None

    def _next(self, table: str) -> str:
        return self._folder(table, max(self._numbers(table), default=0) + 1)

    def size_in_bytes(self, table: str) -> int:
        """Bytes of the current version, from the file listing."""
        folder = self.current(table)
        return self.bytes_under(folder) if folder else 0

    def holds(self, folder: str) -> bool:
        return path_exists(self.spark, folder)

    def bytes_under(self, folder: str) -> int:
        fs, hadoop_path = _fs(self.spark, folder)
        return fs.getContentSummary(hadoop_path).getLength() if fs.exists(hadoop_path) else 0

    # -- reads ---------------------------------------------------------------------------------

    # Schemas are declared: nothing is inferred from files, and a folder without any is an empty table.

    def read(self, table: str, schema: T.StructType, or_empty: bool = False) -> DataFrame:
        """The current version; with ``or_empty``, a table never written reads as empty."""
        folder = self.current(table)
        if folder:
            return self.spark.read.schema(schema).parquet(folder).drop(MONTH)
        if or_empty:
            return empty_frame(self.spark, schema)
        raise FileNotFoundError(f"table {table} does not exist under {self.root}")

    def read_days(self, table: str, schema: T.StructType, day: str, first: date, last: date) -> DataFrame:
        """Rows of a month-partitioned table by date range; opens the folders of those months only."""
        schema = T.StructType([*schema, T.StructField(MONTH, T.IntegerType())])
        months = F.col(MONTH).between(first.year * 100 + first.month, last.year * 100 + last.month)
        days = F.col(day).between(F.lit(first), F.lit(last))
        return self.spark.read.schema(schema).parquet(self.current(table)).filter(months & days).drop(MONTH)

    def read_history(self, table: str, schema: T.StructType, only_open: bool = False) -> DataFrame:
        """Open versions of the last run, and all versions closed by it or by an earlier run."""
        versions = self.versions(table)
        if not versions:
            raise FileNotFoundError(f"table {table} does not exist under {self.root}")
        folders = [f"{versions[-1]}/{OPEN}=true"]
        if not only_open:
            folders += self._closed(versions)
        present = [f for f in folders if path_exists(self.spark, f)]
        return self.spark.read.schema(schema).parquet(*present) if present else empty_frame(self.spark, schema)

    def _closed(self, versions: Sequence[str]) -> list[str]:
        """Folders that together hold all closed rows, newest first."""
        folders = []
        for version in reversed(versions):
            folders.append(f"{version}/{OPEN}=false")
            if path_exists(self.spark, f"{version}/{BASE}"):
                break
        return folders

    # -- writes --------------------------------------------------------------------------------

    def _write(self, df: DataFrame, folder: str, partition: str | None = None, last: bool = True) -> None:
        """Only the ``last`` write into a folder makes it count."""
        mark = "true" if last else "false"
        writer = df.write.mode("append").option("compression", CODEC).option("mapreduce.fileoutputcommitter.marksuccessfuljobs", mark)
        (writer.partitionBy(partition) if partition else writer).parquet(folder)

    def staging_folder(self, name: str) -> str:
        return f"{self.root}/_staged/{name}-{uuid4().hex}"

    def stage(self, df: DataFrame, table: str) -> str:
        """A copy of rows as they come, beside the table: for sources that few tasks may read at a time."""
        folder = self.staging_folder(table)
        df.write.option("compression", CODEC).option("maxRecordsPerFile", STAGED_FILE_ROWS).parquet(folder)
        return folder

    def drop(self) -> None:
        """Everything under the root."""
        self._delete(self.root)

    def drop_staged(self, folder: str) -> None:
        self._delete(folder)

    def _delete(self, folder: str) -> None:
        fs, hadoop_path = _fs(self.spark, folder)
        fs.delete(hadoop_path, True)

    def replace(
        self,
        df: DataFrame | Sequence[DataFrame],
        table: str,
        sort: Sequence[str] = (),
        month_of: str | None = None,
        by_month: bool = False,
        in_ranges: bool = False,
        told: Mapping[str, Column] | None = None,
    ) -> None:
        """A new version, sorted inside each file and, with ``month_of``, split into month folders.

        ``rebalance`` brings the rows of a month together and lets adaptive execution cut a large
        month into files of the advisory size; hashing by month alone would give it to one task.
        ``by_month`` says that the tasks hold rows of few months already, so no shuffle is needed.
        ``in_ranges`` deals rows by ranges of month and sort key instead: each file of a large month then
        holds a few days, which its statistics show, and a read of one day opens one or two files of it.
        It samples the rows first, which a table of small months would not repay.
        ``told`` says which columns are the same for every row or follow from others, and how: they are made
        after the shuffle and not sent through it.
        Several frames are written one after the other into one version, which counts after the last.
        """
        parts, folder = [df] if isinstance(df, DataFrame) else list(df), self._next(table)
        for i, part in enumerate(parts):
            if month_of:
                part = part.withColumn(MONTH, month_key(month_of))
                columns, later = part.columns, {} if by_month else {c: v for c, v in (told or {}).items() if not (in_ranges and c in sort)}
                part = part.drop(*later)
                if in_ranges:
                    part = part.repartitionByRange(MONTH, *sort)
                elif not by_month:
                    part = part.hint("rebalance", F.col(MONTH))
                part = part.withColumns(later).select(*columns).sortWithinPartitions(MONTH, *sort)
            elif sort:
                part = part.sortWithinPartitions(*sort)
            self._write(part, folder, MONTH if month_of else None, last=i == len(parts) - 1)

    def append(self, df: DataFrame, table: str, sort: Sequence[str] = ()) -> None:
        """Add rows to the current version, or start the first one."""
        if sort:
            df = df.sortWithinPartitions(*sort)
        self._write(df, self.current(table) or self._next(table))

    def write_history(self, changes: DataFrame | Sequence[DataFrame], table: str, sort: Sequence[str] = ()) -> None:
        """One run's open and newly closed versions, in one frame or several that are written one after the other.

        What earlier runs closed stays where it is, and is written together once in ``COMPACT_AFTER`` runs.
        Open rows of runs before the last two are freed.
        """
        parts = [changes] if isinstance(changes, DataFrame) else list(changes)
        versions, folder = self.versions(table), self._next(table)
        closed = self._closed(versions)
        if len(closed) >= COMPACT_AFTER:
            present = [f for f in closed if path_exists(self.spark, f)]
            if present:
                parts.append(self.spark.read.schema(parts[0].schema).parquet(*present))
            fs, hadoop_path = _fs(self.spark, f"{folder}/{BASE}")
            fs.create(hadoop_path).close()
        for i, part in enumerate(parts):
            part = part.withColumn(OPEN, F.col("valid_to").isNull())
            self._write(part.sortWithinPartitions(OPEN, *sort), folder, OPEN, last=i == len(parts) - 1)
        for old in self.versions(table)[:-2]:
            self._delete(f"{old}/{OPEN}=true")
        kept = {f.rsplit("/", 1)[0] for f in self._closed(self.versions(table)[:-1])}
        for old in self.versions(table)[:-2]:
            if old not in kept:
                self._delete(old)

    def drop_old_versions(self, table: str, keep: int = 2) -> None:
        """Free the space of replaced versions, and of runs that died before the oldest one kept.

        Not for history tables, whose versions are all in use.
        """
        kept = self.versions(table)[-keep:]
        for number in self._numbers(table):
            folder = self._folder(table, number)
            if kept and folder < kept[0]:
                self._delete(folder)


class SourceLake(Lake):
    """Copies of source tables, in a folder each: a table's name is its folder."""

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"
