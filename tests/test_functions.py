from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.functions import (
    blank_to_null,
    empty_frame,
    has_text,
    hash_pii,
    literal_frame,
    month_key,
    ntz,
    positive,
    to_seconds,
)


def test_blank_to_null_trims_spaces_only(spark):
    df = spark.createDataFrame([(" a ",), ("   ",), ("",), ("\ta ",), (None,)], "s string")
    got = [r[0] for r in df.select(blank_to_null("s")).collect()]
    assert got == ["a", None, None, "\ta", None]


def test_hash_is_sha256_hex_and_keeps_null(spark):
    df = spark.createDataFrame([("abc",), (None,)], "s string")
    known = "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"
    assert [r[0] for r in df.select(hash_pii(F.col("s"))).collect()] == [known, None]


def test_key_predicates_drop_null(spark):
    df = spark.createDataFrame([(None, None), (0, ""), (-1, "  "), (2, "k")], "n int, s string")
    assert [r.n for r in df.filter(positive("n")).collect()] == [2]
    assert [r.s for r in df.filter(has_text("s")).collect()] == ["  ", "k"]


def test_time_helpers_ignore_the_session_zone(spark):
    moment = datetime(2024, 3, 31, 2, 30, 1, 500000)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "Europe/Berlin", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", name)
            df = spark.range(1).select(ntz(moment).alias("t")).select("t", to_seconds("t").alias("s"))
            row = df.select("t", "s", month_key("t").alias("m")).first()
            assert row == (moment, moment.replace(microsecond=0), 202403)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_literal_frames(spark):
    schema = T.StructType.fromDDL("k int, s string, t timestamp_ntz, n bigint")
    given = [(1, "it's", datetime(2024, 1, 2, 3, 4, 5, 6), None), (2, None, None, 7)]
    df = literal_frame(spark, given, schema)
    assert [tuple(r) for r in df.collect()] == given
    for frame in (df, literal_frame(spark, [], schema), empty_frame(spark, schema)):
        assert frame.dtypes == [(f.name, f.dataType.simpleString()) for f in schema]
    assert empty_frame(spark, schema).isEmpty()
