"""Command line: ``python -m ledgermill <command> --root <folder> ...`` (or through spark-submit)."""

from __future__ import annotations

import argparse
import sys

from ledgermill.operators.quality import ChecksFailed
from ledgermill.plans.bronze import load_sources, utc_now
from ledgermill.plans.jobs import open_warehouse
from ledgermill.plans.tables import select_tables
from ledgermill.session import build_session
from ledgermill.sources import CsvSource, JdbcSource, ParquetSource
from ledgermill.sources.mappings import with_strategy


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="ledgermill")
    parser.add_argument("--master", help="Spark master; omit under spark-submit")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, text: str, source: bool = False) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=text)
        sub.add_argument("--root", required=True, help="folder of the warehouse, or of the loaded source tables")
        if source:
            sub.add_argument("--source", choices=("jdbc", "csv", "parquet"), default="jdbc")
            sub.add_argument("--source-dir", help="folder of a csv or parquet source")
            sub.add_argument("--multi-line", action="append", default=[], help="csv table with line breaks in quoted fields; repeatable")
            sub.add_argument("--chunk-size", type=int, default=2000, help="rows per fetch from a database")
            sub.add_argument("--strategy", action="append", default=[], metavar="MAPPING=anti_join", help="how a mapping finds new rows; repeatable")
        return sub

    sources = command("load-sources", "CSV extracts to Parquet source tables, replacing them")
    sources.add_argument("--data-dir", required=True)
    sources.add_argument("--multi-line", action="append", default=[], help="table with line breaks in quoted fields; repeatable")
    bronze = command("bronze", "load raw tables", source=True)
    bronze.add_argument("--mapping", action="append", default=[], help="mapping or target table; repeatable")
    bronze.add_argument("--full-refresh", "--replace-table", action="store_true")
    transform = command("transform", "build silver, history and gold, test, and verify unless --select is given")
    transform.add_argument("--full-refresh", action="store_true", help="accepted; tables are always built in full")
    test = command("test", "quality tests of stored tables")
    for sub in (transform, test):
        sub.add_argument("--select", action="append", default=[], help="tag:<layer>, layer.table or table")
    seed = command("seed", "store the risk codes")
    command("snapshot", "record customer history from the stored dimension")
    pipeline = command("pipeline", "load, build, test and verify", source=True)
    pipeline.add_argument("--full-refresh", action="store_true")
    pipeline.add_argument("--skip-bronze", action="store_true")
    for sub in (transform, pipeline):
        sub.add_argument("--skip-test", action="store_true")
        sub.add_argument("--test-before-snapshot", action="store_true", help="keep untested rows out of the history")
    for sub in (transform, pipeline, seed):
        sub.add_argument("--seed-csv", help="risk codes to use instead of the built-in ones")
    command("verify", "health checks")
    command("freshness", "age of the raw tables; fails if one is an error")
    dashboard = command("dashboard", "load health of the last seven days")
    dashboard.add_argument("--store", metavar="DATABASE", help="keep it as a view in a database of the session's catalog")
    return parser


def _source(spark, args):
    if args.source == "jdbc":
        return JdbcSource(spark, fetch_size=args.chunk_size)
    if not args.source_dir:
        raise SystemExit(f"--source-dir is required for a {args.source} source")
    if args.source == "csv":
        return CsvSource(spark, args.source_dir, args.multi_line)
    return ParquetSource(spark, args.source_dir)


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = build_session(args.master)
    strategies = dict(given.split("=", 1) for given in getattr(args, "strategy", []))
    warehouse = open_warehouse(spark, args.root, with_strategy(strategies))
    try:
        if args.command == "load-sources":
            load_sources(spark, args.data_dir, args.root, args.multi_line)
        elif args.command == "bronze":
            for name, rows in warehouse.run_bronze(_source(spark, args), args.mapping, args.full_refresh).items():
                print(f"{name}: {rows} rows")
        elif args.command == "transform":
            warehouse.run_transform(
                select=args.select,
                skip_test=args.skip_test,
                seed_csv=args.seed_csv,
                test_before_snapshot=args.test_before_snapshot,
            )
            if not args.select:
                warehouse.verify().show(truncate=False)
        elif args.command == "seed":
            warehouse.load_seed(args.seed_csv)
        elif args.command == "snapshot":
            warehouse.snapshot(utc_now().replace(microsecond=0))
        elif args.command == "test":
            warehouse.test(select_tables(args.select)).show(truncate=False)
        elif args.command == "pipeline":
            source = None if args.skip_bronze else _source(spark, args)
            report = warehouse.run_pipeline(
                source,
                full_refresh=args.full_refresh,
                skip_bronze=args.skip_bronze,
                skip_test=args.skip_test,
                seed_csv=args.seed_csv,
                test_before_snapshot=args.test_before_snapshot,
            )
            report.show(truncate=False)
        elif args.command == "verify":
            warehouse.verify().show(truncate=False)
        elif args.command == "freshness":
            found = warehouse.freshness(utc_now().replace(microsecond=0))
            found.show(truncate=False)
            return int(not found.filter("freshness_status = 'error'").isEmpty())
        elif args.store:
            print(warehouse.store_view(args.store))
        else:
            warehouse.dashboard().show(truncate=False)
    except ChecksFailed as failure:
        failure.report.show(truncate=False)
        print(failure, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
