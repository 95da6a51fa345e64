"""Jobs for spark-submit or ``python -m stridelake``.

The raw folder and the lake default to the environment's DEFAULT_RAW and DEFAULT_OUT, else to data/raw and
lake/parquet/runs.parquet below the working folder.
"""

from __future__ import annotations

import argparse
import logging
import os
import sys

from pyspark.sql import SparkSession

from stridelake.plans.batch import run_batch
from stridelake.plans.build import build_marts
from stridelake.plans.ingest import ingest
from stridelake.plans.load import load_activity_counts, load_summary
from stridelake.plans.report import report
from stridelake.plans.serve import latest_stored_summary, write_json
from stridelake.sources.manifest import vacuum
from stridelake.streaming.compaction import compact
from stridelake.streaming.incremental import run_incremental


# Names of the environment, and the folders where they are not set.
_FOLDERS = {"raw-dir": ("DEFAULT_RAW", "data/raw"), "lake": ("DEFAULT_OUT", "lake/parquet/runs.parquet")}


def _default(option: str) -> str | None:
    if option not in _FOLDERS:
        return None
    variable, folder = _FOLDERS[option]
    return os.environ.get(variable) or folder


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="stridelake", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, text: str, *options: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=text)
        for option in options:
            default = _default(option)
            sub.add_argument(f"--{option}", required=default is None, default=default)
        return sub

    csv_jobs = [
        job("ingest", "CSV folder to lake", "raw-dir", "lake"),
        job("batch", "CSV folder to lake to marts", "raw-dir", "lake", "marts"),
        job("incremental", "take in new, rewritten and deleted CSV files", "raw-dir", "lake", "marts", "checkpoint"),
    ]
    for sub in csv_jobs:
        sub.add_argument("--multi-line", choices=("auto", "yes", "no"), default="auto")
    marts = job("marts", "lake to marts", "lake", "marts")
    for sub in (*csv_jobs, marts):
        sub.add_argument("--on-bad-date", choices=("error", "null"), default="error")
    job("compact", "put the batches of each month together", "lake", "marts").add_argument("--more-than", type=int, default=8)
    job("vacuum", "delete what runs that died have left", "lake", "marts")
    latest = job("latest", "write the latest summary rows as JSON", "marts", "out")
    latest.add_argument("--rows", type=int, default=100)
    shown = job("report", "write the report's tables as JSON", "marts", "lake", "out")
    for option in ("user", "start", "end"):
        shown.add_argument(f"--{option}")
    return parser


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(levelname)s: %(message)s")
    spark = SparkSession.builder.appName(f"stridelake {args.job}").getOrCreate()
    if hasattr(args, "multi_line"):
        multi_line = {"auto": None, "yes": True, "no": False}[args.multi_line]
    if args.job == "ingest":
        rows = ingest(spark, args.raw_dir, args.lake, multi_line=multi_line, on_bad_date=args.on_bad_date)
        print(f"{rows} rows" if rows else f"No CSV files found in {args.raw_dir}")
    elif args.job == "marts":
        build_marts(spark, args.lake, args.marts, args.on_bad_date)
    elif args.job == "batch":
        run_batch(
            spark, args.raw_dir, args.lake, args.marts, multi_line=multi_line, on_bad_date=args.on_bad_date
        )
    elif args.job == "incremental":
        rows = run_incremental(
            spark,
            args.raw_dir,
            args.lake,
            args.marts,
            args.checkpoint,
            multi_line=multi_line,
            on_bad_date=args.on_bad_date,
        )
        print(f"{rows} new rows")
    elif args.job == "compact":
        months = compact(spark, args.lake, args.marts, args.more_than)
        print(f"{len(months)} months: {', '.join(months)}")
    elif args.job == "vacuum":
        print(f"{sum(len(vacuum(spark, root)) for root in (args.lake, args.marts))} folders")
    elif args.job == "latest":
        write_json(latest_stored_summary(spark, args.marts, args.rows), args.out)
    else:
        # Eight tables from two: each is computed once. Users and bounds need the whole summary.
        summary = load_summary(spark, args.marts, args.lake).persist()
        counts = load_activity_counts(spark, args.marts, args.lake, start=args.start, end=args.end).persist()
        for name, table in report(summary, counts, args.user, args.start, args.end).items():
            write_json(table, f"{args.out.rstrip('/')}/{name}")
        summary.unpersist()
        counts.unpersist()
    return 0


if __name__ == "__main__":
    sys.exit(main())
