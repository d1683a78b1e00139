"""Column-wise merge of aggregates that share a key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merge_metrics(key: str, defaults: Mapping[str, Column], branches: Sequence[DataFrame]) -> DataFrame:
    """Stack the branches, fill the metrics a branch lacks with its default and take the max of each.

    ``defaults`` fixes names, order and types of the metrics. A default of zero therefore also lifts a
    negative metric to zero once another branch knows the key; a NULL default does not take part.
    Each branch is already hash-partitioned by ``key``, and the union keeps that, so the closing
    group-by needs no further exchange.
    """

    def padded(branch: DataFrame) -> DataFrame:
        return branch.select(
            key, *[(F.col(m) if m in branch.columns else d).alias(m) for m, d in defaults.items()]
        )

    stacked = reduce(DataFrame.unionByName, map(padded, branches))
    return stacked.groupBy(key).agg(*[F.max(m).alias(m) for m in defaults])
