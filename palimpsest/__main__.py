"""Command line: ``python -m palimpsest <command> --root <warehouse> ...``."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from .operators.ingest import land_snapshot, load_snapshot, profile_snapshots
from .operators.warehouse import Warehouse
from .plans.marts import format_summary
from .plans.pipeline import backfill, refresh, run_checks, run_snapshot
from .sources.paged import read_landed_pages
from .streaming import catch_up

# Fixed value: what is printed before the first run.
EMPTY = "No summary data found. Has the pipeline run yet?"


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="palimpsest")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, purpose in {
        "profile": "compare a snapshot's header with the contract",
        "load": "load one snapshot into the raw tables",
        "run": "load one snapshot and refresh everything",
    }.items():
        command = commands.add_parser(name, help=purpose)
        command.add_argument("--csv", required=True, help="snapshot file or folder")
        command.add_argument("--date", type=date.fromisoformat, default=date.today())
    several = commands.add_parser("backfill", help="load several dates, refresh once")
    several.add_argument("snapshots", nargs="+", metavar="DATE=PATH")
    commands.add_parser("refresh", help="build the models from what is loaded")
    commands.add_parser("rebuild", help="build the models from everything in raw")
    commands.add_parser("check", help="count violated invariants, tell the age of the data")
    landing = commands.add_parser("land", help="write landed JSON pages as a date's CSV")
    landing.add_argument("--pages", required=True, help="folder of JSON pages")
    landing.add_argument("--landing", required=True)
    landing.add_argument("--date", type=date.fromisoformat, default=date.today())
    catching_up = commands.add_parser("catch-up", help="run all newly landed snapshots")
    catching_up.add_argument("--landing", required=True)
    catching_up.add_argument("--checkpoint", required=True)
    commands.add_parser("summary", help="print the last run's summary")
    for command in commands.choices.values():
        command.add_argument("--root", required=True, help="folder of the warehouse")
    return parser.parse_args()


def main() -> None:
    args = _arguments()
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    wh = Warehouse(spark, args.root)
    if args.command == "profile":
        for part in profile_snapshots(wh, {args.date: args.csv}):
            print(part.file, ", ".join(part.header))
    elif args.command == "load":
        print(load_snapshot(wh, args.csv, args.date))
    elif args.command == "run":
        print(format_summary(run_snapshot(wh, args.csv, args.date).summary))
    elif args.command == "backfill":
        pairs = (s.split("=", 1) for s in args.snapshots)
        result = backfill(wh, {date.fromisoformat(d): path for d, path in pairs})
        print(format_summary(result.summary))
    elif args.command in ("refresh", "rebuild"):
        summary = refresh(wh, rebuild=args.command == "rebuild")
        print(EMPTY if summary is None else format_summary(summary))
    elif args.command == "check":
        counts, fresh = run_checks(wh)
        for row in counts.collect():
            print(row.check_name, row.violations)
        print("freshness", fresh.first().status)
    elif args.command == "land":
        pages = read_landed_pages(spark, args.pages, list(wh.spec.contract))
        print(land_snapshot(pages, args.landing, args.date, wh.spec))
    elif args.command == "catch-up":
        catch_up(wh, args.landing, args.checkpoint)
    else:
        summary = wh.published.read("quality_summary")
        print(EMPTY if summary is None else format_summary(summary))


if __name__ == "__main__":
    main()
