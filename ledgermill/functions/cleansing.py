"""Column -> Column cleansing helpers; all of them stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(name: str) -> Column:
    """Trim spaces (tabs stay) and turn an empty result into NULL."""
    return F.nullif(F.trim(F.col(name)), F.lit(""))


def hash_pii(value: Column) -> Column:
    """64 lower-case hex digits; NULL stays NULL."""
    return F.sha2(value, 256)


def positive(name: str) -> Column:
    """Key predicate; NULL keys fail it too."""
    return F.col(name) > 0


def has_text(name: str) -> Column:
    """Key predicate on the untrimmed value: a key of blanks passes, NULL does not."""
    return F.col(name) != ""


def required(value: Column, name: str) -> Column:
    """Fail the job when a column the raw table declares non-null is NULL."""
    return F.coalesce(value, F.raise_error(F.lit(f"column {name} must not be null")))
