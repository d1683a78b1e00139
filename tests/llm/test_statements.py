"""Queries that have a statement, against it, over whole tables."""

import duckdb
import pytest

from ledgermill.llm.queries import QUERIES
from ledgermill.llm.statements import STATEMENTS

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", list(STATEMENTS))
def test_matches_duckdb(spark, name):
    frame = QUERIES[name](spark, FOLDER)
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    result = connection.execute(STATEMENTS[name])
    assert [d[0] for d in result.description] == frame.columns
    assert sorted(result.fetchall()) == sorted(map(tuple, frame.collect()))
