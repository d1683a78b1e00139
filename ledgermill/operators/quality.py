"""Data-quality rules: each returns the offending rows or a one-row verdict."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from threading import Lock
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.functions import literal_frame, ntz

WARN_AFTER_HOURS, ERROR_AFTER_HOURS = 36, 72
HASH_LENGTH = 64
PARALLEL_CHECKS = 4

T_ = TypeVar("T_")


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once, with their counts."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
    return counted.filter("n_records > 1")


def nulls(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def negative_amount() -> Column:
    return F.col("amount") < 0


def negative_amounts(fact_transaction: DataFrame) -> DataFrame:
    return fact_transaction.filter(negative_amount()).select("trx_id", "amount")


def broken_rules(df: DataFrame, rules: Mapping[str, Column]) -> set[str]:
    """Which of the rules some row breaks: one aggregate, whose tasks each send one row, over one scan."""
    found = df.agg(*[F.max(F.coalesce(rule, F.lit(False))).alias(f"r{i}") for i, rule in enumerate(rules.values())]).first()
    return {title for i, title in enumerate(rules) if found[f"r{i}"]}


def not_empty(df: DataFrame) -> DataFrame:
    """One row, ``ok``; each task stops at its first row."""
    return df.select(F.lit(1)).limit(1).agg((F.count(F.lit(1)) > 0).alias("ok"))


def is_empty(offending: DataFrame) -> DataFrame:
    return not_empty(offending).select((~F.col("ok")).alias("ok"))


def _bad_hash(column: str) -> Column:
    return F.col(column).isNotNull() & (F.length(column) != HASH_LENGTH)


def malformed_hashes(dim_customer: DataFrame) -> DataFrame:
    return dim_customer.filter(_bad_hash("phone_hash") | _bad_hash("email_hash"))


def failing_mappings(load_audit: DataFrame) -> DataFrame:
    """Mappings whose latest load failed, however long ago it ran."""
    latest = load_audit.groupBy("mapping_name").agg(
        F.max_by("status", F.struct("started_at", "run_id")).alias("last_status")
    )
    return latest.filter(F.col("last_status") == "failed")


def freshness(raw: DataFrame, as_of: datetime) -> DataFrame:
    """One row: newest load time and pass, warn or error; an empty table is an error."""
    age = ntz(as_of) - F.col("max_loaded_at")

    def older_than(hours: int) -> Column:
        return age > F.make_dt_interval(hours=F.lit(hours))

    status = (
        F.when(F.col("max_loaded_at").isNull() | older_than(ERROR_AFTER_HOURS), "error")
        .when(older_than(WARN_AFTER_HOURS), "warn")
        .otherwise("pass")
    )
    newest = raw.agg(F.max("load_dttm").alias("max_loaded_at"))
    return newest.withColumn("freshness_status", status)


def once(work: Callable[[], T_]) -> Callable[[], T_]:
    """``work`` done by the first of several checks that ask for it; what it raises, all of them get."""
    lock, done = Lock(), []

    def result() -> T_:
        with lock:
            if not done:
                try:
                    done.append((work(), None))
                except Exception as error:
                    done.append((None, error))
        value, error = done[0]
        if error:
            raise error
        return value

    return result


class ChecksFailed(RuntimeError):
    def __init__(self, report: DataFrame, failed: list[str]):
        super().__init__("failed checks: " + ", ".join(failed))
        self.report = report


def run_checks(
    spark: SparkSession, checks: Mapping[str, Callable[[], bool]], raise_on_failure: bool = True
) -> DataFrame:
    """Run all checks, a few at a time, and report ``(check, ok, detail)``.

    A check that raises counts as failed and does not stop the others.
    """

    def run(check: Callable[[], bool]) -> tuple[bool, str | None]:
        try:
            return bool(check()), None
        except Exception as error:
            return False, str(error)

    with ThreadPoolExecutor(PARALLEL_CHECKS) as pool:
        results = [(name, *verdict) for name, verdict in zip(checks, pool.map(run, checks.values()))]
    report = literal_frame(spark, results, T.StructType.fromDDL("check string, ok boolean, detail string"))
    failed = [name for name, ok, _ in results if not ok]
    if failed and raise_on_failure:
        raise ChecksFailed(report, failed)
    return report
