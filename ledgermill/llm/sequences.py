"""Rows of long sequences: numbers within a group, without a window over it, and streams over sorted rows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.jobs import checkpointed


def shuffle_tasks(frame: DataFrame) -> int:
    return int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def numbered(rows: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """``rows`` with ``index``, a row's place in its group from 0, in the given order.

    Rows are dealt by ranges of (group, order), so a group of any size fills as many tasks as its rows need;
    rows equal in all of it are dealt by their place in the input. A group has a run of rows in each task
    that it reaches; a row's index is its place in the run and the rows of the runs before. ``group`` must
    hold no null.
    """
    dealt = [F.col(group), *order]
    sorted_rows = rows.withColumn("_place", F.monotonically_increasing_id())
    sorted_rows = sorted_rows.repartitionByRange(shuffle_tasks(rows), *dealt, "_place").sortWithinPartitions(*dealt, "_place")
    sorted_rows = checkpointed(sorted_rows.drop("_place").withColumn("_n", F.monotonically_increasing_id()))
    task = F.shiftright("_n", 33)
    runs = sorted_rows.groupBy(group, task.alias("_task")).agg(F.min("_n").alias("_first"), F.count("*").alias("_rows"))
    earlier = Window.partitionBy(group).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(group, "_task", "_first", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    found = sorted_rows.withColumn("_task", task).join(runs, [group, "_task"])
    return found.withColumn("index", F.col("_n") - F.col("_first") + F.col("_before")).drop("_n", "_task", "_first", "_before")


def streamed(rows: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """Each group's rows together and in order, as the input of a function that holds no group whole."""
    return rows.repartition(shuffle_tasks(rows), group).sortWithinPartitions(group, *order)


def records(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    """The given columns of all rows, one row at a time."""
    for batch in batches:
        yield from zip(*(batch[c].to_pylist() for c in columns))


def batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 4_096) -> Iterator[pa.RecordBatch]:
    """Arrow batches of up to ``size`` rows."""
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = zip(*held) if held else [[]] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    for row in rows:
        held.append(row)
        if len(held) == size:
            yield batch()
            held.clear()
    if held:
        yield batch()
