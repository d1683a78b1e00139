"""Time helpers. Every timestamp is TIMESTAMP_NTZ, so no result depends on the session time zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz(moment: datetime) -> Column:
    """A naive datetime as a TIMESTAMP_NTZ literal."""
    return F.expr(f"TIMESTAMP_NTZ '{moment:%Y-%m-%d %H:%M:%S.%f}'")


def month_key(day: str) -> Column:
    """yyyymm as an int, e.g. 202401."""
    return F.year(day) * 100 + F.month(day)


def to_seconds(name: str) -> Column:
    """Drop the sub-second part. ``date_trunc`` would go through the session time zone."""
    return F.expr(f"`{name}` - make_dt_interval(0, 0, 0, date_part('SECOND', `{name}`) % 1)")
