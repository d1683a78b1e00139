"""Exact distinct counts of columns that have few values."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.functions import literal_frame

FEW = 512
"""Most values of a column that are counted by bits: eight numbers of 64 bits in every group."""

WORD = 64


def values_of(rows: DataFrame, columns: Mapping[str, str]) -> dict[str, list]:
    """The distinct values of each column, in one pass; of more than ``FEW`` in all, one more than that."""
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).alias("value")) for i, c in enumerate(columns)]))
    found = rows.select(pairs.alias("p")).select("p.i", "p.value").filter("value IS NOT NULL").distinct()
    kept: dict[str, list] = {column: [] for column in columns}
    for row in found.limit(FEW + 1).collect():
        kept[list(columns)[row.i]].append(row.value)
    return kept


def count_few_values(rows: DataFrame, columns: Mapping[str, str]) -> tuple[DataFrame, list[Column]]:
    """``rows`` and the aggregates that count the distinct values of ``columns`` (name of the count by column).

    With at most ``FEW`` values in all, a value is a bit: a group is a few numbers that are or-ed, on the map side
    first, however many rows or groups there are, and no row is expanded. Else Spark's distinct count is used,
    whose values are spread by value. Both are exact; a null is no value.
    """
    known = values_of(rows, columns)
    if sum(map(len, known.values())) > FEW:
        return rows, [F.count_distinct(c).alias(name) for c, name in columns.items()]
    counts = []
    for column, name in columns.items():
        values, word, bit = sorted(known[column]), f"_{column}_word", f"_{column}_bit"
        pair = T.StructType([T.StructField(column, rows.schema[column].dataType), T.StructField(word, T.IntegerType()), T.StructField(bit, T.LongType())])
        # the highest bit of a word is the sign
        codes = [(value, i // WORD, (1 << i % WORD) - (1 << WORD) * (i % WORD == WORD - 1)) for i, value in enumerate(values)]
        rows = rows.join(F.broadcast(literal_frame(rows.sparkSession, codes, pair)), column, "left")
        bits = F.lit(0)
        for i in range(-(-len(values) // WORD)):
            bits = bits + F.bit_count(F.coalesce(F.bit_or(F.when(F.col(word) == i, F.col(bit))), F.lit(0).cast("long")))
        counts.append(bits.cast("long").alias(name))
    return rows, counts

