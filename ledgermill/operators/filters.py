"""Filters of keys: a few bits for each, small enough to be sent to every task, so that other rows need no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY_BITS, MOST_BITS = 16, 1 << 28
"""Bits for each key in a filter, and of a filter (32 MB): with more keys it lets more of the others pass, no fewer of its own."""

CHUNK = 4_096
"""Words of a filter that are brought together at once."""


def _spot(columns: Sequence[str], words: int) -> tuple[Column, Column]:
    """The word of a key in a filter of ``words`` words, a power of 2, and the key's three bits in it."""
    code = F.xxhash64(*columns)
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(code, n).bitwiseAND(63).cast("int")) for n in (46, 52, 58)]
    return F.pmod(code, F.lit(words)).cast("int"), bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2])


def key_filter(keys: DataFrame, most: int) -> tuple[DataFrame, int]:
    """A Bloom filter of the rows of ``keys``, at most about ``most``: one row with its ``words`` of 64 bits, and how many there are."""
    n = min(MOST_BITS, 1 << max(6, (KEY_BITS * most - 1).bit_length())) // 64
    at, bits = _spot(keys.columns, n)
    every = keys.sparkSession.range(n).select(F.col("id").cast("int").alias("at"), F.lit(0).cast("long").alias("word"))
    found = every.unionByName(keys.select(at.alias("at"), bits.alias("word"))).withColumn("chunk", F.expr(f"at div {CHUNK}"))
    found = found.repartition("chunk").groupBy("chunk", "at").agg(F.bit_or("word").alias("word"))  # of both groupings the one shuffle

    def in_order(at: str) -> Column:
        return F.transform(F.sort_array(F.collect_list(F.struct(at, "word"))), lambda x: x["word"]).alias("word")

    chunks = found.groupBy("chunk").agg(in_order("at"))
    return chunks.agg(in_order("chunk")).select(F.flatten("word").alias("words")), n


def by_filter(rows: DataFrame, columns: Sequence[str], words: DataFrame, n: int, passing: bool = True) -> DataFrame:
    """The ``rows`` whose ``columns`` are a key of the filter, and a few others; or, not ``passing``, the rest. No row is shuffled."""
    at, bits = _spot(columns, n)
    return rows.join(F.broadcast(words), F.get("words", at).bitwiseAND(bits) == bits, "left_semi" if passing else "left_anti")
