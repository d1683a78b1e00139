"""Copies of large inputs, cut by the hash of a column, so that each slice is read alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import empty_frame
from ledgermill.sources.lake import CODEC, Lake, path_exists

SLICE = "_slice"
SLICE_FILE_BYTES = 32 * 1024 * 1024
MOST_SLICES = 8
"""A task that cuts a gigabyte then still writes files of the size that a task reads."""
SPLIT_BYTES, WRITERS = "spark.sql.files.maxPartitionBytes", "spark.sql.maxConcurrentOutputFileWriters"


def slice_of(column: str, n: int) -> Column:
    """The slice of a value; a null belongs to one of them as well."""
    return F.pmod(F.xxhash64(column), F.lit(n)).cast("int")


def cut_settings(n: int) -> dict[str, str]:
    """Session settings under which a copy in ``n`` slices is written without a shuffle or a sort.

    A task reads enough to fill a file of each slice, and holds a writer open for each.
    """
    return {SPLIT_BYTES: str(min(n * SLICE_FILE_BYTES, 1 << 30)), WRITERS: str(n)}


class Slices:
    """Rows with a slice number each, in a folder for each number. Rows may be added in several writes."""

    def __init__(self, lake: Lake, folder: str, n: int):
        self.lake, self.folder, self.n = lake, folder, n
        self.schema = None

    def add(self, rows: DataFrame, number: Column) -> None:
        """One pass over ``rows``, which need no shuffle for it: each task writes to all folders."""
        self.schema = rows.schema
        self.add_numbered(rows.withColumn(SLICE, number))

    def add_numbered(self, rows: DataFrame) -> None:
        rows.write.mode("append").option("compression", CODEC).partitionBy(SLICE).parquet(self.folder)

    def part(self, i: int) -> DataFrame:
        spark, folder = self.lake.spark, f"{self.folder}/{SLICE}={i}"
        return spark.read.schema(self.schema).parquet(folder) if path_exists(spark, folder) else empty_frame(spark, self.schema)

    def parts(self) -> list[DataFrame]:
        return [self.part(i) for i in range(self.n)]

    def bytes(self, i: int) -> int:
        return self.lake.bytes_under(f"{self.folder}/{SLICE}={i}")


class Cutter:
    """Slices for one piece of work; ``close`` frees them."""

    def __init__(self, lake: Lake, n: int):
        self.lake, self.n = lake, n
        self.folder = lake.staging_folder("slices")
        self.made: dict[tuple[str, str], Slices] = {}

    def __enter__(self) -> Cutter:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def close(self) -> None:
        self.lake.drop_staged(self.folder)

    def by(self, rows: DataFrame, name: str, column: str) -> Slices:
        """``rows`` by the hash of one of their columns."""
        made = Slices(self.lake, f"{self.folder}/{name}-by-{column}", self.n)
        made.add(rows, slice_of(column, self.n))
        self.made[name, column] = made
        return made

    def by_owner(self, rows: DataFrame, name: str, via: str, owners: DataFrame, column: str, join) -> Slices:
        """``rows`` by the hash of a column that ``owners`` have, which they are joined to on ``via``.

        Both are first cut by ``via``, so the join, too, is made slice by slice. A row goes to the slice of each of
        its owners once; a row without an owner to none. ``join(rows, owners)`` joins two slices on ``via``.
        """
        known = owners.select(via, slice_of(column, self.n).alias("_owner_slice"))
        left, right = self.by(rows, name, via), self.by(known, f"{name}-owners", via)
        made = Slices(self.lake, f"{self.folder}/{name}-by-{column}", self.n)
        made.schema = rows.schema
        for part, owned in zip(left.parts(), right.parts()):
            made.add_numbered(join(part, owned.distinct()).select(*rows.columns, F.col("_owner_slice").alias(SLICE)))
        self.made[name, column] = made
        return made
