"""Left join to a reference table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.operators.skew import spread_join

BROADCAST_BYTES = 32 * 1024 * 1024
"""Bound of a broadcast reference, in bytes of its values."""

VALUE_BYTES, ROW_BYTES = 8, 32


def reference_bytes(reference: DataFrame) -> int:
    """Bytes of all values, added up, not estimated: texts by length, other values and rows at a fixed size."""
    texts = [f.name for f in reference.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    fixed = ROW_BYTES + VALUE_BYTES * (len(reference.columns) - len(texts))
    size = F.lit(fixed).cast("long")
    for name in texts:
        size = size + F.coalesce(F.octet_length(name), F.lit(0)).cast("long")
    return reference.agg(F.sum(size).alias("bytes")).first()["bytes"] or 0


def fits_broadcast(reference: DataFrame) -> bool:
    return reference_bytes(reference) <= BROADCAST_BYTES


def occurring(reference: DataFrame, facts: DataFrame, code: str) -> DataFrame:
    """The rows of ``reference`` whose code some fact has, found without a shuffle of it.

    The distinct codes of the facts are broadcast; of more than may be, nothing is gained and all rows stay.
    """
    codes = facts.select(code).filter(F.col(code).isNotNull()).distinct()
    return reference.join(F.broadcast(codes), code, "left_semi") if fits_broadcast(codes) else reference


def join_reference(facts: DataFrame, reference: DataFrame, code: str, spread: Sequence[str], broadcast: bool) -> DataFrame:
    """``facts`` left-joined to ``reference`` on ``code``, which both have; ``spread`` tells facts apart.

    A reference that was found to fit is broadcast. Else both are shuffled, of the reference only the rows that facts
    have a code for; facts of codes that hold a large part of all facts, or of none, are dealt over many tasks. The
    facts then lose the order they were stored in.
    """
    if broadcast:
        return facts.join(F.broadcast(reference), code, "left")
    return spread_join(facts, occurring(reference, facts, code), code, spread, "left")
