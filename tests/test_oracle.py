"""Every registered query against its DuckDB statement over the same files."""

import math
import os
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry

DATA = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{DATA}/{table}.parquet')")
    return connection


def kind(value):
    if isinstance(value, bool):
        return "flag"
    for types, name in (((int,), "int"), ((Decimal,), "decimal"), ((float,), "double"), ((str,), "text")):
        if isinstance(value, types):
            return name
    if isinstance(value, datetime):
        return "time"
    return "date" if isinstance(value, date) else type(value).__name__


def sort_key(row):
    return tuple((v is None, "" if v is None else str(v)) for v in row)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=sort_key)


def test_every_query_has_a_statement():
    assert set(entry.QUERIES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(entry.QUERIES))
def test_matches_duckdb(spark, duck, name):
    frame = entry.queries()[name](spark, DATA)
    result = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(columns)

    expected = canonical(columns, result.fetchall())
    actual = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    assert len(actual) == len(expected)
    for got, want in zip(actual, expected):
        for a, b in zip(got, want):
            if isinstance(a, float) and isinstance(b, float):
                assert math.isclose(a, b, rel_tol=0, abs_tol=0), (got, want)
            else:
                assert a == b, (got, want)
                assert kind(a) == kind(b), (got, want)
