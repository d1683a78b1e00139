import pytest
from helpers import plan
from pyspark.sql import functions as F

from ledgermill.operators.skew import HOT_KEYS, hot_keys, spread_join


@pytest.fixture(scope="module")
def frames(spark):
    """A third of the rows has key 7, a third none; of ``other`` key 7 has two rows and key 3 none."""
    rows = spark.range(6_000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id")).cast("long").alias("key"),
    )
    other = spark.range(6_000).select(F.col("id").alias("key"), (F.col("id") * 2).alias("value")).filter("key <> 5")
    return rows, other.union(spark.range(1).select(F.lit(7).cast("long"), F.lit(-1).cast("long"))).unionByName(
        spark.range(1).select(F.lit(None).cast("long").alias("key"), F.lit(0).cast("long").alias("value"))
    )


@pytest.mark.parametrize("how", ["inner", "left", "right"])
def test_equals_the_plain_join(frames, how):
    rows, other = frames
    got = spread_join(rows, other, "key", ["id"], how)
    assert got.columns == ["key", "id", "value"]
    assert sorted(map(str, got.collect())) == sorted(map(str, rows.join(other, "key", how).collect()))


def test_hot_rows_are_dealt_evenly(spark, frames):
    """The largest task of the join reads little more than its share, though two thirds of the rows have one key or none."""
    rows, other = frames
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = rows.join(other, "key", "left").filter("value is null or value <> -1")
        spread = spread_join(rows, other, "key", ["id"], "left").filter("value is null or value <> -1")
        largest = lambda df: df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert largest(plain) >= 2_000
        assert largest(spread) < 2 * 6_000 / 8
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_keys_are_few_and_broadcast(spark, frames):
    rows, other = frames
    found = hot_keys(rows, "key", 8).collect()
    assert len(found) < HOT_KEYS and {r.key: r.parts for r in found}[7] >= 4
    assert "BroadcastExchange" in plan(spread_join(rows, other, "key", ["id"]))


def test_nothing_to_join(spark, frames):
    rows, other = frames
    assert spread_join(rows.limit(0), other, "key", ["id"], "left").collect() == []
    assert spread_join(rows.filter("key is null"), other.limit(0), "key", ["id"], "left").count() == 2_000
    with pytest.raises(ValueError):
        spread_join(rows, other, "key", ["id"], "full")
