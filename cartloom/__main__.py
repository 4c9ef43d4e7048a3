"""Commands: ``python -m cartloom <command> --database shop [options]``."""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence

from pyspark.sql import SparkSession

from cartloom.plans.project import Project
from cartloom.session import setting
from cartloom.sources.csv import ingest_directory, ingest_once


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="cartloom", description=__doc__)
    p.add_argument(
        "command",
        choices=["ingest", "run", "seed", "snapshot", "replay", "test", "docs", "clean", "summary", "reset"],
    )
    p.add_argument("--database", help="database of the models (default: setting 'database', else 'shop')")
    p.add_argument("--source-database", help="database of the raw tables (default: the same)")
    p.add_argument("--source-prefix", default="", help="prefix of the raw table names")
    p.add_argument("--select", nargs="+", metavar="MODEL|tag:TAG", help="models to run or test")
    p.add_argument("--vars", type=json.loads, default={}, help="run variables as a JSON object")
    p.add_argument("--buckets", type=int, default=0, help="lay staging tables out by order in N buckets")
    p.add_argument("--history-buckets", type=int, default=0, help="keep the open versions of the history in N buckets")
    p.add_argument("--initial-partitions", type=int, help="shuffle partitions to start with, about shuffled bytes / 128 MB")
    p.add_argument("--single-line", nargs="+", default=(), metavar="TABLE", help="tables without line breaks in quotes, whose files are split over tasks")
    p.add_argument("--directory", help="folder of CSV files to ingest")
    p.add_argument("--once", action="store_true", help="ingest only if the database is not there yet")
    return p


def main(arguments: Sequence[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = SparkSession.builder.appName("cartloom").getOrCreate()
    database = args.database or setting(spark, "database", "shop")
    raw = args.source_database or database
    if args.command == "ingest":
        load = ingest_once if args.once else ingest_directory
        report = load(spark, args.directory, raw, prefix=args.source_prefix, single_line=args.single_line)
        if report is None:
            print(f"{raw} is already loaded")
        else:
            report.show(1000, truncate=False)
        return
    project = Project(
        spark, database, raw, args.source_prefix, variables=args.vars, buckets=args.buckets,
        initial_partitions=args.initial_partitions, history_buckets=args.history_buckets,
    )
    if args.command == "run":
        print("\n".join(project.run(args.select)))
    elif args.command == "test":
        report = project.test(args.select, raise_on_error=False)
        report.show(1000, truncate=False)
        if report.where("status = 'fail'").count():
            raise SystemExit(1)
    elif args.command == "clean":
        print("\n".join(project.clean()))
    elif args.command in ("docs", "summary", "reset"):
        getattr(project, args.command)().show(1000, truncate=False)
    else:
        getattr(project, args.command)()


if __name__ == "__main__":
    main()
