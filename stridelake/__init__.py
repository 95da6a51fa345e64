"""Stridelake: daily activity analytics over wearable-sensor samples, on Spark."""

from stridelake.operators.marts import (
    daily_activity_counts,
    daily_user_summary,
    daily_wrist_counts,
    fallback_summary,
    rollup,
)
from stridelake.functions.labels import ACTIVITY_LABELS, WRIST_LABELS, label_codes
from stridelake.plans.batch import run_batch
from stridelake.plans.build import build_marts
from stridelake.plans.cache import ResultCache
from stridelake.plans.ingest import ingest
from stridelake.plans.load import load_activity_counts, load_mart, load_summary
from stridelake.plans.report import report
from stridelake.plans.serve import iterate_dicts, latest_stored_summary, latest_summary, query, query_or_error, rows_as_dicts
from stridelake.sources.lake import read_lake, register_runs
from stridelake.sources.manifest import latest_manifest, vacuum
from stridelake.streaming.compaction import compact
from stridelake.streaming.incremental import run_incremental

__all__ = [
    "ACTIVITY_LABELS",
    "WRIST_LABELS",
    "ResultCache",
    "build_marts",
    "compact",
    "daily_activity_counts",
    "daily_user_summary",
    "daily_wrist_counts",
    "fallback_summary",
    "ingest",
    "label_codes",
    "iterate_dicts",
    "latest_manifest",
    "latest_stored_summary",
    "latest_summary",
    "load_activity_counts",
    "load_mart",
    "load_summary",
    "query",
    "query_or_error",
    "read_lake",
    "register_runs",
    "report",
    "rollup",
    "rows_as_dicts",
    "run_batch",
    "run_incremental",
    "vacuum",
]
