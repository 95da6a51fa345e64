"""One full run: raw files to lake to marts."""

from __future__ import annotations

from pyspark.sql import SparkSession

from stridelake.plans.build import build_marts
from stridelake.plans.ingest import ingest


def run_batch(
    spark: SparkSession,
    raw_dir: str,
    lake_path: str,
    mart_dir: str,
    *,
    multi_line: bool | None = None,
    on_bad_date: str = "error",
) -> dict[str, str]:
    """Ingest, then build the marts; returns the mart paths.

    Without raw files the marts are built from the lake as it is; without a lake as
    well this raises FileNotFoundError.
    """
    ingest(spark, raw_dir, lake_path, multi_line=multi_line, on_bad_date=on_bad_date)
    return build_marts(spark, lake_path, mart_dir, on_bad_date)
