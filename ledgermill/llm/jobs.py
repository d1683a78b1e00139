"""What the operators share on the side of Spark."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from math import ceil
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHIPPED: dict[str, Path] = {}

HOLDERS: list[Callable[[], None]] = []
"""What gives back memory that modules hold between tasks; they add themselves."""

SHARD_BYTES = 8 << 20
"""Bytes of text in a shard, the unit that one Python call holds in memory."""


def ship(spark: SparkSession) -> SparkSession:
    """Give the package to the Python workers, wherever they run; once for each application."""
    context = spark.sparkContext
    if SHIPPED.get(context.applicationId) is None:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="ledgermill-package-")) / "ledgermill.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, str(file.relative_to(package.parent)))
        context.addPyFile(str(archive))
        SHIPPED[context.applicationId] = archive
    return spark


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, which all executors reach.

    Only a session that names none and runs in local mode gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        configured = tempfile.mkdtemp(prefix="ledgermill-llm-")
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def checkpointed(frame: DataFrame) -> DataFrame:
    """Cut the lineage through the shared folder."""
    context = frame.sparkSession.sparkContext
    folder = shared_folder(frame.sparkSession)
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return frame.checkpoint(eager=True)


def freed(frame: DataFrame) -> DataFrame:
    """``frame``, which stands on checkpoints; the shuffles and checkpoints that nothing refers to any more are deleted.

    Spark does that once the driver's JVM has collected its garbage, which a JVM with much memory puts off.
    """
    gc.collect()
    frame.sparkSession._jvm.System.gc()
    return frame


def unused(docs: DataFrame, name: str) -> str:
    """``name``, made longer until no column has it."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def utf8(column: str | Column) -> Column:
    """The text's bytes; a null is empty."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string").cast("binary"), F.lit(b""))


def shard_count(texts: DataFrame, column: str, shard_bytes: int = SHARD_BYTES) -> int:
    """How many shards of about ``shard_bytes`` the column fills, from its total length."""
    total = texts.agg(F.sum(F.octet_length(column).cast("long")).alias("b")).first()["b"] or 0
    return max(1, ceil(total / shard_bytes))


def remainder(doc_id: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the text "null"."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))), F.lit(divisor))


def release() -> None:
    """Give back what a Python worker holds of memory it no longer uses: it lives on, idle, beside the next ones.

    That includes the ids which an earlier stage's encoder remembers; stages that encode do not call this.
    """
    for forget in HOLDERS:
        forget()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library keeps its memory
        pass


def releasing(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` on the batches of a task, between two calls of ``release``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        yield from work(batches)
        release()

    return run


def by_batch(frame: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``work`` on every Arrow batch; it keeps nothing between batches that results depend on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = work(batch)
            if made is not None:
                yield made

    return frame.mapInArrow(releasing(run), schema)
