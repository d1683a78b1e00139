"""Hand-built frames: a row names only the columns a test is about."""

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import types as T

from ledgermill import schemas
from ledgermill.sources import MAPPINGS

T0, T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)
RUN = datetime(2024, 1, 31)
DAY = date(2024, 1, 5)
BY_NAME = {m.name: m for m in MAPPINGS}

DEFAULTS = {
    "customer_id": 1,
    "full_name": "Ann",
    "account_id": "A1",
    "balance": Decimal("10.00"),
    "card_id": 1,
    "trx_id": 1,
    "amount": Decimal("5.00"),
    "session_id": "S1",
    "is_new_device": False,
    "event_id": 1,
    "is_successful": True,
    "source_system": "one",
    "load_dttm": T0,
    "run_id": "r",
    "target_table": "t",
    "load_mode": "incremental",
    "rows_loaded": 1,
    "started_at": T0,
    "finished_at": T0,
    "duration_ms": 0,
}


def nullable(schema):
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])


def frame(spark, schema, rows):
    required = {f.name for f in schema if not f.nullable}
    base = {k: v for k, v in DEFAULTS.items() if k in required}
    return spark.createDataFrame(
        [tuple({**base, **row}.get(f.name) for f in schema) for row in rows], nullable(schema)
    )


def raw(spark, mapping, *rows):
    return frame(spark, BY_NAME[mapping].raw_schema, rows)


def source(spark, mapping, *rows):
    return frame(spark, BY_NAME[mapping].source_schema, rows)


def audit(spark, *rows):
    return frame(spark, schemas.LOAD_AUDIT, rows)


def rows(df, *columns):
    """Sorted tuples of the given columns."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=str)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
