"""Small frames from driver-side values, built of literals: no Python worker is started for them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.functions.temporal import ntz


def _literal(value: Any, field: T.StructField) -> Column:
    column = ntz(value) if isinstance(value, datetime) else F.lit(value)
    return column.cast(field.dataType).alias(field.name)


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.range(0).select(*[_literal(None, f) for f in schema])


def literal_frame(spark: SparkSession, rows: Sequence[Sequence[Any]], schema: T.StructType) -> DataFrame:
    if not rows:
        return empty_frame(spark, schema)
    structs = [F.struct(*[_literal(v, f) for v, f in zip(row, schema)]) for row in rows]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))
