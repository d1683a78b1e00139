"""Session settings the plans are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


SHUFFLE_TASKS = "spark.sql.shuffle.partitions"
TASK_BYTES = 128 * 1024 * 1024
PARQUET_EXPANSION = 2
"""Shuffled rows are compressed too, but wider than the columns they were read from."""


def tasks_for(spark: SparkSession, size: int, task_bytes: int = TASK_BYTES) -> int:
    """Shuffle tasks of about ``task_bytes`` for ``size`` stored bytes; at least those of the session."""
    return max(int(spark.conf.get(SHUFFLE_TASKS)), -(-size * PARQUET_EXPANSION // task_bytes))


def own_session(spark: SparkSession, shuffle_tasks: int, **settings: str) -> SparkSession:
    """A session with the settings of ``spark``, its own number of shuffle tasks and ``settings``, on the same cluster."""
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if session.conf.isModifiable(name):
            session.conf.set(name, value)
    for name, value in {SHUFFLE_TASKS: str(shuffle_tasks), **settings}.items():
        session.conf.set(name, value)
    return session


def build_session(master: str | None = None, shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName("ledgermill")
    if master:
        builder = builder.master(master)
    settings = {**SETTINGS, **extra}
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
