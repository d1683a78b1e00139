"""Type-2 history by comparing check columns."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import ntz

def _first_versions(current: DataFrame, key: str, run_ts: datetime) -> DataFrame:
    now = ntz(run_ts)
    scd_id = F.md5(F.concat_ws("|", F.col(key).cast("string"), now.cast("string")))
    return current.select(
        "*",
        scd_id.alias("scd_id"),
        now.alias("scd_updated_at"),
        now.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
    )


def history_changes(
    open_versions: DataFrame | None,
    current: DataFrame,
    key: str,
    check_columns: Sequence[str],
    run_ts: datetime,
    close_deleted: bool = True,
) -> DataFrame:
    """Open versions after this run plus the versions this run closes.

    ``open_versions`` and ``current`` hold one row per ``key``. Versions closed by earlier runs need not
    be given: they never change, so neither the join nor the next write has to carry them. Those that are
    given come back as they are.

    One full outer join decides every case: a key on the right only opens a version; on the left
    only closes one; on both sides with a moved check column does both; otherwise the old row stays
    as it is, including its columns outside the check.
    """
    fresh = _first_versions(current, key, run_ts)
    if open_versions is None:
        return fresh

    columns = fresh.columns
    old, new = F.col("old"), F.col("new")
    # closed versions meet nothing, each under a name of its own, so that none of them gather
    done = F.when(F.col("valid_to").isNotNull(), F.col("scd_id")).otherwise("")
    pairs = open_versions.select(F.col(key).alias("_key"), done.alias("_done"), F.struct(*columns).alias("old")).join(
        fresh.select(F.col(key).alias("_key"), F.lit("").alias("_done"), F.struct(*columns).alias("new")),
        ["_key", "_done"],
        "full_outer",
    )

    moved = reduce(or_, [~old[c].eqNullSafe(new[c]) for c in check_columns])
    closed = old.withField("valid_to", ntz(run_ts))
    gone = F.array(closed if close_deleted else old)
    outcome = (
        F.when(old.isNull(), F.array(new))
        .when(old["valid_to"].isNotNull(), F.array(old))
        .when(new.isNull(), gone)
        .when(moved, F.array(closed, new))
        .otherwise(F.array(old))
    )
    return pairs.select(F.explode(outcome).alias("row")).select("row.*")


def scd2_check(
    previous: DataFrame | None,
    current: DataFrame,
    key: str,
    check_columns: Sequence[str],
    run_ts: datetime,
    close_deleted: bool = True,
) -> DataFrame:
    """The whole history after this run, from the whole history before it, read once."""
    return history_changes(previous, current, key, check_columns, run_ts, close_deleted)
