"""Run one job, or the whole sequence, with spark-submit or ``python -m marlstone``."""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession

from marlstone.operators.metrics import summary_frame
from marlstone.operators.quality import SUITES, load_suite
from marlstone.plans import gold, pipeline
from marlstone.plans.reports import REPORT_SQL, run_report
from marlstone.schemas import TABLES
from marlstone.session import build_session, tune
from marlstone.sources.jdbc import jdbc_source


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="marlstone", description=__doc__)
    parser.add_argument("--root", required=True, help="directory of the lake, on shared storage")
    parser.add_argument("--run-ts", type=datetime.fromisoformat, help="upper bound of the run; now by default")
    parser.add_argument("--run-id", help="derived from the run's time by default")
    parser.add_argument("--wide-keys", action="store_true", help="64-bit ids in Silver")
    parser.add_argument("--overlap-minutes", type=float, default=0, help="re-read this much before the last mark")
    parser.add_argument(
        "--timestamp-column", action="append", default=[], metavar="TABLE=COLUMN",
        help="extract a table by this column, e.g. orders=updated_at; created_at by default",
    )
    parser.add_argument("--incremental-gold", action="store_true", help="bring marts up to date from what changed")
    parser.add_argument("--fixed-partitions", action="store_true", help="rows never change partition: do not look for moves")
    parser.add_argument(
        "--day-directories", action="append", default=[], choices=list(TABLES), metavar="TABLE",
        help="give the table's days a directory each; one per month by default",
    )
    parser.add_argument("--catalog", help="database in which each layer's tables are registered and reports look them up")
    jobs = parser.add_subparsers(dest="job", required=True)

    source = argparse.ArgumentParser(add_help=False)
    source.add_argument("--jdbc-url", required=True)
    source.add_argument("--user")
    source.add_argument("--password-variable", help="environment variable that holds the password")
    source.add_argument("--readers", type=int, default=8, help="parallel connections per table")

    for job, parents, helped in (
        ("run", [source], "extract, refine, check and aggregate"),
        ("extract", [source], "database to Bronze"),
        ("silver", [], "Bronze to Silver"),
        ("quality", [], "check Silver tables"),
        ("gold", [], "Silver to Gold"),
    ):
        command = jobs.add_parser(job, parents=parents, help=helped)
        choices = {"quality": list(SUITES), "gold": list(gold.GOLD_PARTITIONS)}.get(job, list(TABLES))
        command.add_argument("names", nargs="*", metavar="NAME", help=f"any of {', '.join(choices)}; all by default")
        command.set_defaults(choices=choices)
        if job == "silver":
            command.add_argument("--rebuild", action="store_true", help="from everything in Bronze")
        if job == "quality":
            command.add_argument("--suite", help="suite file to use instead of the built-in one")
    report = jobs.add_parser("report", help="print a standing report")
    report.add_argument("names", nargs=1, metavar="NAME", help=f"one of {', '.join(REPORT_SQL)}")
    report.add_argument("--as-of", help="last day of the period; today by default")
    report.set_defaults(choices=list(REPORT_SQL))
    return parser


def _sources(spark: SparkSession, args, lake: pipeline.LakeConfig, names: Sequence[str]) -> dict[str, pipeline.Source]:
    options = {}
    if args.user:
        options["user"] = args.user
    if args.password_variable:
        options["password"] = os.environ[args.password_variable]
    return {
        name: jdbc_source(
            spark, args.jdbc_url, TABLES[name].source, lake.ts_columns.get(name, "created_at"),
            options=options, partition_column="id", num_partitions=args.readers,
        )
        for name in names
    }


def execute(spark: SparkSession, argv: Sequence[str] | None = None) -> DataFrame:
    """Run the job ``argv`` describes; returns its run summary, or the report's rows."""
    parser = _parser()
    args = parser.parse_args(argv)
    unknown = set(args.names) - set(args.choices)
    if unknown:
        parser.error(f"unknown: {', '.join(sorted(unknown))}; choose from {', '.join(args.choices)}")
    tune(spark)
    run_ts = args.run_ts or datetime.now(timezone.utc).replace(microsecond=0)
    run_ts = run_ts if run_ts.tzinfo else run_ts.replace(tzinfo=timezone.utc)
    run_id = args.run_id or pipeline.make_run_id(run_ts)
    columns = dict(choice.split("=", 1) for choice in args.timestamp_column if "=" in choice)
    if len(columns) < len(args.timestamp_column) or set(columns) - set(TABLES):
        parser.error("--timestamp-column takes TABLE=COLUMN, once per table")
    lake = pipeline.LakeConfig(
        args.root, ts_columns=columns, overlap=timedelta(minutes=args.overlap_minutes), wide_keys=args.wide_keys,
        track_moves=not args.fixed_partitions, incremental_gold=args.incremental_gold, catalog=args.catalog,
        day_directories=frozenset(args.day_directories),
    )
    names = args.names or args.choices
    if args.job == "report":
        return run_report(spark, names[0], args.as_of or run_ts.date(), **pipeline.stored_marts(spark, lake))
    if args.job == "run":
        return pipeline.run_pipeline(spark, lake, _sources(spark, args, lake, names), run_ts, run_id, names)
    if args.job == "extract":
        sources = _sources(spark, args, lake, names)
        job = lambda n: pipeline.extract_table(spark, lake, n, sources[n], run_ts, run_id)
    elif args.job == "silver":
        load = pipeline.rebuild_table if args.rebuild else pipeline.refine_table
        job = lambda n: load(spark, lake, n, run_id)
    elif args.job == "quality":
        suite = load_suite(args.suite) if args.suite else None
        job = lambda n: pipeline.check_table(spark, lake, n, run_id, suite=suite)
    else:
        job = lambda n: pipeline.refresh_mart(spark, lake, n, run_id)
    summaries = pipeline.side_by_side(spark, job, names)
    if args.job in ("silver", "gold"):
        pipeline.register_layer(spark, lake, args.job)
    return summary_frame(spark, summaries)


def main() -> None:
    result = execute(build_session())
    for row in result.toLocalIterator():
        print("\t".join("" if value is None else str(value) for value in row))


if __name__ == "__main__":
    main()
