"""Relational sources over JDBC.

The scan pushes the column list and the watermark to the database and is split into key ranges that
hold about the same number of rows each, whatever the distribution of the keys.
"""

from __future__ import annotations

import os
from collections.abc import Mapping as Dict
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ledgermill.sources.mappings import Mapping

# Default port and database name of each source system.
SYSTEMS = {
    "crm": (5433, "crm_db"),
    "core": (5434, "core_banking_db"),
    "cards": (5435, "card_processing_db"),
    "transactions": (5436, "transactions_db"),
    "mobile": (5437, "mobile_app_db"),
}


def connection_options(system: str, env: Dict[str, str] = os.environ) -> dict[str, str]:
    """JDBC options of a system; ``<SYSTEM>_DB_HOST``, ``_PORT``, ``_NAME``, ``_USER`` and ``_PASSWORD`` override the defaults."""
    port, name = SYSTEMS[system]
    given = {key: env.get(f"{system.upper()}_DB_{key}") for key in ("HOST", "PORT", "NAME", "USER", "PASSWORD")}
    return {
        "url": f"jdbc:postgresql://{given['HOST'] or 'localhost'}:{given['PORT'] or port}/{given['NAME'] or name}",
        "driver": "org.postgresql.Driver",
        "user": given["USER"] or "postgres",
        "password": given["PASSWORD"] or "postgres",
    }


def sql_literal(value: Any) -> str:
    return str(value) if isinstance(value, int) else "'" + str(value).replace("'", "''") + "'"


def range_predicates(key: str, bounds: Sequence[Any], high: Any = None) -> list[str]:
    """Disjoint predicates that together match every row up to ``high``; ``bounds`` ascend in the source's own order.

    Without ``high`` the last range is open.
    """
    marks = [sql_literal(b) for b in bounds]
    top = "" if high is None else f"{key} <= {sql_literal(high)}"
    if not marks:
        return [f"{top} OR {key} IS NULL" if top else "1 = 1"]
    between = [f"{key} > {low} AND {key} <= {up}" for low, up in zip(marks, marks[1:])]
    last = f"{key} > {marks[-1]}" + (f" AND {top}" if top else "")
    return [f"{key} <= {marks[0]} OR {key} IS NULL", *between, last]


def page_predicates(key: str, pages: int, splits: int, high: Any) -> list[str]:
    """Disjoint predicates by the place of a row in its table, which together match every row up to ``high``.

    Each takes as many of the table's ``pages`` as any other; the last one also what is added behind them.
    """
    cuts = [pages * i // splits for i in range(1, splits)]
    places = [f"ctid < '({cuts[0]},0)'::tid", *(f"ctid >= '({a},0)'::tid AND ctid < '({b},0)'::tid" for a, b in zip(cuts, cuts[1:]))]
    places.append(f"ctid >= '({cuts[-1]},0)'::tid")
    return [f"{place} AND ({key} <= {sql_literal(high)} OR {key} IS NULL)" for place in places]


def cut_points(sample: Sequence[Any], splits: int) -> list[Any]:
    """Keys that cut an ascending sample into ``splits`` parts of about the same size."""
    points = [sample[len(sample) * i // splits - 1] for i in range(1, splits) if len(sample) * i // splits]
    return list(dict.fromkeys(points))


class JdbcSource:
    """Reads mapping tables in key ranges of about ``rows_per_split`` rows.

    The highest key is looked up first and bounds every range, so all ranges read the same state of an
    ascending key: rows that arrive meanwhile lie above the mark and are read by the next load. Where to
    cut is read off a sample at the source, ``SAMPLED`` keys a range; the source counts and sorts nothing
    else. Past ``max_splits`` ranges, ranges hold more rows: a task streams its range, so that costs time
    on one connection, not memory.

    However large the cluster, the reading stage opens at most ``max_connections`` connections; a load
    copies what it reads and goes on from the copy with all tasks (``staged``).

    Of a table that was never analysed the source has no estimate of its rows, but always its pages: it is read
    in ranges of pages, of which each holds ``ROWS_PER_PAGE`` rows or so.
    """

    staged = True
    SAMPLED, ROWS_PER_PAGE = 20, 64

    def __init__(
        self,
        spark: SparkSession,
        options=connection_options,
        fetch_size: int = 2000,
        rows_per_split: int = 1_000_000,
        max_splits: int = 10_000,
        max_connections: int = 64,
    ):
        self.spark, self.options, self.fetch_size = spark, options, fetch_size
        self.rows_per_split, self.max_splits = rows_per_split, max_splits
        self.max_connections = max_connections

    def _query(self, system: str, sql: str) -> list:
        return self.spark.read.format("jdbc").options(**self.options(system)).option("query", sql).load().collect()

    def _rows(self, mapping: Mapping) -> int:
        """The source's own estimate of the table's rows."""
        found = self._query(
            mapping.system, f"SELECT cast(reltuples AS BIGINT) AS n FROM pg_class WHERE oid = '{mapping.source_table}'::regclass"
        )
        return max(0, found[0][0]) if found else 0

    def _pages(self, mapping: Mapping) -> int:
        return self._query(
            mapping.system, f"SELECT pg_relation_size('{mapping.source_table}'::regclass) / cast(current_setting('block_size') AS BIGINT) AS n"
        )[0][0]

    def _sample(self, mapping: Mapping, where: str, percent: float) -> list[Any]:
        key, table = mapping.watermark, mapping.source_table
        rows = self._query(mapping.system, f"SELECT {key} FROM {table} TABLESAMPLE SYSTEM ({percent:.6f}) WHERE {where} ORDER BY {key}")
        return [row[0] for row in rows]

    def _splits(self, mapping: Mapping, watermark: Any) -> list[str]:
        key = mapping.watermark
        above = f"{key} IS NOT NULL" if watermark is None else f"{key} > {sql_literal(watermark)}"
        high = self._query(mapping.system, f"SELECT MAX({key}) AS high FROM {mapping.source_table} WHERE {above}")[0][0]
        if high is None:
            return range_predicates(key, [], high)
        rows = self._rows(mapping)
        if not rows:
            pages = self._pages(mapping)
            splits = min(self.max_splits, -(-pages * self.ROWS_PER_PAGE // self.rows_per_split))
            return page_predicates(key, pages, splits, high) if splits > 1 else range_predicates(key, [], high)
        splits = min(self.max_splits, -(-rows // self.rows_per_split))
        if splits <= 1:
            return range_predicates(key, [], high)
        percent = min(100.0, 100.0 * self.SAMPLED * splits / rows)
        sample = self._sample(mapping, f"{above} AND {key} <= {sql_literal(high)}", percent)
        # above a mark, only that part of the sample is left, and as many fewer ranges are needed
        return range_predicates(key, cut_points(sample, min(splits, -(-len(sample) // self.SAMPLED))), high)

    def table(self, mapping: Mapping, watermark: Any = None) -> DataFrame:
        options = self.options(mapping.system)
        rows = self.spark.read.jdbc(
            url=options["url"],
            table=mapping.source_table,
            predicates=self._splits(mapping, watermark),
            properties={**options, "fetchsize": str(self.fetch_size), "preferTimestampNTZ": "true"},
        )
        return rows.coalesce(self.max_connections)
