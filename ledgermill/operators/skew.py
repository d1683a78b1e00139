"""Joins on keys of which one may hold a large part of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import empty_frame, literal_frame
from ledgermill.session import SHUFFLE_TASKS

HOT_KEYS = 1_000
"""A key is hot if it has more than one in so many rows; so there are fewer hot keys than this."""


def hot_keys(rows: DataFrame, key: str, tasks: int) -> DataFrame:
    """key, parts: the hot keys of ``rows`` and how many tasks their rows are to be dealt to.

    Rows are counted in full; counts are combined before the shuffle, and fewer than ``HOT_KEYS`` keys come out.
    Nulls match nothing in a join and are left to the caller.
    """
    known = rows.filter(F.col(key).isNotNull())
    total = known.count()
    counts = known.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") * HOT_KEYS > total)
    parts = F.ceil(F.col("n") * tasks / F.lit(max(total, 1))).cast("int") + 1
    hot = counts.select(key, parts.alias("parts"))
    found = hot.collect()
    return literal_frame(rows.sparkSession, found, hot.schema) if found else empty_frame(rows.sparkSession, hot.schema)


def spread_join(rows: DataFrame, other: DataFrame, key: str, spread: Sequence[str | Column], how: str = "inner") -> DataFrame:
    """``rows`` joined to ``other`` on ``key`` (``how``: inner, left or right); rows of hot keys are dealt over many tasks.

    A row of a hot key takes one of the key's parts by the hash of ``spread``, columns that tell rows apart and
    are the same whenever a task runs again; rows of ``other`` with that key go to each part. Rows with a null
    key are dealt alike. ``rows`` is read once more to count its keys. A right join keeps a row of ``other``
    without a match once: a hot key has matches, so what its parts lack is no row of the result.
    """
    if how not in ("inner", "left", "right"):
        raise ValueError(how)
    tasks = int(rows.sparkSession.conf.get(SHUFFLE_TASKS))
    hot = hot_keys(rows, key, tasks)
    hot = F.broadcast(hot.withColumnRenamed("parts", "_parts"))
    if how == "left":
        parts = F.when(F.col(key).isNull(), F.lit(tasks)).otherwise(F.coalesce("_parts", F.lit(1)))
    else:
        rows, parts = rows.filter(F.col(key).isNotNull()), F.coalesce("_parts", F.lit(1))
    dealt = rows.join(hot, key, "left").withColumn("_part", F.pmod(F.xxhash64(*spread), parts).cast("int")).drop("_parts")
    if how != "right":
        other = other.filter(F.col(key).isNotNull())
    copies = other.join(hot, key, "left").withColumn("_parts", F.coalesce("_parts", F.lit(1)))
    copies = copies.withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    if how != "right":
        return dealt.join(copies.drop("_parts"), [key, "_part"], how).drop("_part")
    joined = dealt.withColumn("_matched", F.lit(True)).join(copies, [key, "_part"], "right")
    return joined.filter("_matched OR _parts = 1").drop("_part", "_parts", "_matched")
