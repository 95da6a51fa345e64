"""Timings of the headline work; prints one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_RUNS (timed runs; the
median counts, after one warm-up), BENCH_ONLY (comma-separated names).
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from stridelake.exports import FIRST_WAVE, LATE_WAVE, csv_folder, plain_lake, write_csv_files
from stridelake.operators import figures, marts
from stridelake.operators.selection import select_rows
from stridelake.plans.build import build_marts
from stridelake.plans.ingest import ingest
from stridelake.plans.load import load_activity_counts, load_summary
from stridelake.plans.serve import latest_summary
from stridelake.proxies import runs_from_events, runs_from_lineitem
from stridelake.session import local_session, scratch_path
from stridelake.streaming.incremental import run_incremental

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
ONLY = {n for n in os.environ.get("BENCH_ONLY", "").split(",") if n}
WEEK = ("2024-01-08", "2024-01-14")


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def cases(spark: SparkSession) -> dict:
    lineitem_lake = scratch_path(spark, "bench-lake")
    runs_from_lineitem(spark, SF_DIR).write.parquet(lineitem_lake)
    lake, mart_dir = plain_lake(spark, SF_DIR), scratch_path(spark, "bench-marts")
    raw = csv_folder(spark, SF_DIR)
    build_marts(spark, lake, mart_dir)
    no_marts = scratch_path(spark, "no-marts")

    def on_lineitem(build):
        return lambda: consume(build(runs_from_lineitem(spark, SF_DIR)))

    def three_scans():
        runs = spark.read.parquet(lineitem_lake)
        for build in (marts.daily_user_summary_direct, marts.daily_activity_counts, marts.daily_wrist_counts):
            build(runs).write.parquet(scratch_path(spark, "three-scans"))

    def slice_of(where: str):
        def run():
            consume(figures.key_figures(select_rows(load_summary(spark, where, lake), "user_7", *WEEK)))
            consume(figures.share(select_rows(load_activity_counts(spark, where, lake), "user_7", *WEEK)))

        return run

    def incremental_case():
        waves, wave_lake, wave_marts, checkpoint = (
            scratch_path(spark, f"bench-{n}") for n in ("waves", "wave-lake", "wave-marts", "checkpoint")
        )
        write_csv_files(spark, SF_DIR, waves, FIRST_WAVE)
        run_incremental(spark, waves, wave_lake, wave_marts, checkpoint)
        write_csv_files(spark, SF_DIR, waves, LATE_WAVE)
        start = time.perf_counter()
        run_incremental(spark, waves, wave_lake, wave_marts, checkpoint)
        return time.perf_counter() - start

    return {
        "daily_user_summary_lineitem": on_lineitem(marts.daily_user_summary),
        "daily_user_summary_lineitem_direct": on_lineitem(marts.daily_user_summary_direct),
        "daily_activity_counts_lineitem": on_lineitem(marts.daily_activity_counts),
        "daily_wrist_counts_lineitem": on_lineitem(marts.daily_wrist_counts),
        "daily_user_summary": lambda: consume(marts.daily_user_summary(runs_from_events(spark, SF_DIR))),
        "fallback_summary": lambda: consume(marts.fallback_summary(runs_from_events(spark, SF_DIR))),
        "three_marts_three_scans": three_scans,
        "three_marts_one_scan": lambda: build_marts(spark, lineitem_lake, scratch_path(spark, "one-scan")),
        "csv_ingest": lambda: ingest(spark, raw, scratch_path(spark, "bench-ingest")),
        "csv_ingest_whole_files": lambda: ingest(
            spark, raw, scratch_path(spark, "bench-ingest"), multi_line=True
        ),
        "report_slice_marts": slice_of(mart_dir),
        "report_slice_lake": slice_of(no_marts),
        "report_kpis": lambda: consume(figures.key_figures(load_summary(spark, mart_dir))),
        "activity_share": lambda: consume(figures.share(load_activity_counts(spark, mart_dir))),
        "latest_summary": lambda: latest_summary(load_summary(spark, mart_dir)).collect(),
        "incremental_new_files": incremental_case,
    }


def timed(run) -> float:
    """Seconds of one run; a case that prepares something returns its own."""
    start = time.perf_counter()
    own = run()
    return own if isinstance(own, float) else time.perf_counter() - start


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=int(CPUS) if CPUS.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name, run in cases(spark).items():
        if ONLY and name not in ONLY:
            continue
        timed(run)
        seconds[name] = round(statistics.median(timed(run) for _ in range(RUNS)), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
