"""Marts from storage, or computed from the lake when they are not there."""

from __future__ import annotations

import datetime as dt
import logging

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from stridelake.operators.marts import daily_activity_counts, daily_wrist_counts, fallback_summary
from stridelake.operators.selection import select_rows
from stridelake.plans.cache import ResultCache
from stridelake.schema import ACTIVITY_COUNTS, EVENT_MONTH, MART_SCHEMAS, NO_VALUE, SUMMARY, WRIST_COUNTS
from stridelake.sources.lake import read_lake
from stridelake.sources.manifest import Manifest, latest_manifest, table_path, value_of
from stridelake.sources.tables import check_footers, check_parts, listed_parts, read_parts, read_table

log = logging.getLogger(__name__)

_FROM_LAKE = {
    SUMMARY: fallback_summary,
    ACTIVITY_COUNTS: daily_activity_counts,
    WRIST_COUNTS: daily_wrist_counts,
}


def load_mart(
    spark: SparkSession,
    name: str,
    mart_dir: str | None = None,
    lake_path: str | None = None,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
    keep_month: bool = False,
    manifest: Manifest | None = None,
    user: str | None = None,
    cache: ResultCache | None = None,
) -> DataFrame:
    """A mart if it is whole, else its equivalent from the lake, else no rows.

    From the lake the summary has only date, username, samples and mean magnitude. With
    ``start`` or ``end`` only the partitions that can hold these days are read. Whether a mart is whole is looked at
    only where there is a lake to fall back to. Give a ``manifest`` (``latest_manifest``) to see several marts
    as of one instant. With a ``cache`` the rows of a stored mart come from it, as long as the marts stay as they
    are; without one nothing is cached.
    """
    if name not in MART_SCHEMAS:
        raise KeyError(f"no mart named {name}")
    if mart_dir is not None:
        try:
            manifest = manifest or latest_manifest(spark, mart_dir)
            wanted = (name, user, *(None if d is None else str(d) for d in (start, end)), keep_month)
            kept = cache.find(manifest, wanted, spark) if cache is not None and manifest is not None else None
            if kept is not None:
                return kept if isinstance(kept, DataFrame) else spark.createDataFrame(*kept)
            mart = select_rows(stored_mart(spark, name, mart_dir, start, end, keep_month, manifest), user)
            if lake_path is not None:  # there is something to fall back to: what is not whole must show now
                check_mart(spark, name, mart_dir, start, end, manifest)
            return mart if cache is None or manifest is None else cache.through(manifest, wanted, mart)
        except (OSError, ValueError, PySparkException, Py4JJavaError) as e:
            log.info("mart %s not readable (%s); trying the lake", name, type(e).__name__)
    if lake_path is not None:
        try:
            return select_rows(_FROM_LAKE[name](read_lake(spark, lake_path)), user, start, end)
        except FileNotFoundError:
            pass
    return spark.createDataFrame([], MART_SCHEMAS[name])


def stored_mart(
    spark: SparkSession,
    name: str,
    mart_dir: str,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
    keep_month: bool = False,
    manifest: Manifest | None = None,
) -> DataFrame:
    """A mart as written; FileNotFoundError if it is not there.

    ``keep_month`` leaves the partition column, so that ``select_rows`` can still prune by it.
    """
    manifest = manifest or latest_manifest(spark, mart_dir)
    if manifest is not None and name in manifest.tables:
        parts = _months(manifest, name, start, end)
        mart = read_parts(spark, mart_dir, name, manifest.tables[name], parts)
    else:
        mart = read_table(spark, table_path(mart_dir, name))
    mart = select_rows(mart, start=start, end=end)
    if not keep_month:
        mart = mart.drop(EVENT_MONTH)
    missing = {"date", "username"} - set(mart.columns)
    if missing:
        raise ValueError(f"{name} lacks {', '.join(sorted(missing))}")
    return mart


def _months(manifest: Manifest, name: str, start: dt.date | str | None, end: dt.date | str | None) -> list[str]:
    """The partitions of a mart that can hold days from ``start`` to ``end``."""
    first, last = (None if d is None else str(d)[:7] for d in (start, end))
    months = {p: value_of(p, EVENT_MONTH) for p in manifest.parts(name)}
    if first is None and last is None:
        return list(months)
    return [
        p for p, m in months.items() if m != NO_VALUE and (first is None or m[:7] >= first) and (last is None or m[:7] <= last)
    ]


# Files that were found whole: (application, mart folder, table, partition folder, files with their times).
_whole: set[tuple] = set()


def check_mart(
    spark: SparkSession,
    name: str,
    mart_dir: str,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
    manifest: Manifest | None = None,
) -> None:
    """Raises if files of the mart's months are missing, strange or damaged.

    Files are compared with the manifest by name, length, rows and a digest of the rows; that reads the months
    once, until their files change. The footers alone are read of a mart without manifest.
    """
    manifest = manifest or latest_manifest(spark, mart_dir)
    path = table_path(mart_dir, name)
    if manifest is None or name not in manifest.tables:
        check_footers(spark, path)
        return
    table = manifest.tables[name]
    seen = {}
    for part, found in listed_parts(spark, mart_dir, name, table, _months(manifest, name, start, end)).items():
        there = tuple(sorted((e.name, e.length, e.modified) for e in found))
        seen[part] = (spark.sparkContext.applicationId, path, table.folder(part), there)
    unknown = [p for p, key in seen.items() if key not in _whole]
    check_parts(spark, mart_dir, name, table, unknown)
    _whole.update(seen[p] for p in unknown)


def load_summary(
    spark: SparkSession, mart_dir: str | None = None, lake_path: str | None = None, **days
) -> DataFrame:
    return load_mart(spark, SUMMARY, mart_dir, lake_path, **days)


def load_activity_counts(
    spark: SparkSession, mart_dir: str | None = None, lake_path: str | None = None, **days
) -> DataFrame:
    return load_mart(spark, ACTIVITY_COUNTS, mart_dir, lake_path, **days)
