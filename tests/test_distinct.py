import pytest
from pyspark.sql import functions as F

from helpers import plan
from ledgermill.operators import distinct
from ledgermill.operators.distinct import count_few_values

COLUMNS = {"a": "n_a", "b": "n_b"}


def counted(rows):
    coded, counts = count_few_values(rows, COLUMNS)
    return coded.groupBy("g").agg(F.count("*").alias("n"), *counts)


def frame(spark, groups, values):
    value = lambda k: F.when(F.col("id") % 11 == k, None).otherwise(F.concat(F.lit("v"), F.xxhash64("id", F.lit(k)) % values))
    return spark.range(20_000).select((F.col("id") % groups).alias("g"), value(1).alias("a"), value(2).alias("b"))


@pytest.mark.parametrize("groups", [1, 300, 20_000])
@pytest.mark.parametrize("few", [512, 20])
def test_equals_the_plain_count(spark, monkeypatch, groups, few):
    """One hot group, some, and groups of one row; by bits, and beyond the bound by Spark's own count."""
    monkeypatch.setattr(distinct, "FEW", few)
    rows = frame(spark, groups, 70)
    found = counted(rows)
    plain = rows.groupBy("g").agg(F.count("*").alias("n"), *[F.count_distinct(c).alias(n) for c, n in COLUMNS.items()])
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect()))
    assert ("Expand" in plan(found)) == (few == 20)
    assert found.dtypes == plain.dtypes
    if few == 512:
        assert plan(counted(rows)).count("Exchange hashpartitioning") == 1


def test_no_rows_and_only_nulls(spark):
    rows = frame(spark, 5, 70).limit(0)
    assert counted(rows).collect() == []
    nulls = spark.range(4).selectExpr("id % 2 AS g", "cast(null AS string) AS a", "'x' AS b")
    assert sorted(map(tuple, counted(nulls).collect())) == [(0, 2, 0, 1), (1, 2, 0, 1)]
