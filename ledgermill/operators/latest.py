"""Latest record per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.operators.filters import by_filter, key_filter


def latest_per_key(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Keep, per ``keys``, the row with the highest ``version``.

    Rows that tie on ``version`` are ranked by all their other columns, so the survivor is the same
    on every run and after a lost executor: rows still tied then are equal in every column.

    Catalyst turns ``row_number() = 1`` into a partial WindowGroupLimit before the shuffle, so of a
    key that holds a large share of the table each map task sends on one row only.
    """
    others = [c for c in df.columns if c not in keys and c != version]
    ranking = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in (version, *others)])
    return df.withColumn("_rank", F.row_number().over(ranking)).filter("_rank = 1").drop("_rank")


def latest_of_repeated(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """``latest_per_key``, in which rows of keys that occur once meet no others: they stay in the task that read them.

    The keys alone are counted first. A filter of those that several rows have tells which rows are ranked;
    a row that it takes for one of them by mistake is the only one of its key there, too. ``df`` is read
    three times.
    """
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*keys)
    words, n = key_filter(repeated, df.count() // 2)
    ranked = latest_per_key(by_filter(df, keys, words, n), keys, version)
    return ranked.unionByName(by_filter(df, keys, words, n, passing=False))
