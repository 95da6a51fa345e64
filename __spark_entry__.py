"""Registered queries and their SQL counterparts.

``entry`` runs the flagship query, ``queries`` one query per operator, ``oracle_sql`` the same
results as SQL over the same tables. The tables hold no sensor samples, so each query first
sees ``events`` or ``lineitem`` as samples (``stridelake.proxies``); all rows take part.
"""

from __future__ import annotations

import functools
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stridelake.exports import (
    FIRST_WAVE,
    LATE_WAVE,
    arrive,
    arrive_wrong,
    csv_folder,
    once,
    plain_lake,
    write_csv_files,
    write_ghost_files,
)
from stridelake.functions.columns import day, magnitude
from stridelake.functions.labels import ACTIVITY_LABELS, WRIST_LABELS, label, label_codes
from stridelake.operators import figures, marts
from stridelake.operators.selection import (
    by_day_and_user,
    by_day_user_and_count,
    select_rows,
)
from stridelake.plans.batch import run_batch
from stridelake.plans.build import build_marts, publish_marts
from stridelake.plans.cache import ResultCache
from stridelake.plans.ingest import ingest
from stridelake.plans.load import load_activity_counts, load_summary, stored_mart
from stridelake.plans.report import CODE_COLUMNS, report
from stridelake.plans.serve import json_rows, latest_stored_summary, latest_summary, query, rows_as_maps, write_json
from stridelake.proxies import runs_from_events, runs_from_lineitem
from stridelake.schema import ACTIVITY_COUNTS, EVENT_MONTH, MART_SCHEMAS, ROLLUP, SUMMARY, WRIST_COUNTS
from stridelake.session import scratch_path
from stridelake.sources.files import delete
from stridelake.sources.lake import read_lake, register_runs
from stridelake.sources.manifest import latest_manifest
from stridelake.sources.sample import generated_runs, sample_runs
from stridelake.sources.tables import read_parts
from stridelake.streaming.compaction import compact
from stridelake.streaming.incremental import run_incremental

try:
    import corpus_pipeline
    from stridelake.llm import queries as training_data
except ImportError:
    corpus_pipeline = training_data = None

USER = "user_7"
START, END = "2024-01-10", "2024-01-16"

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    return marts.daily_user_summary(runs_from_events(spark, "/root/testdata/sf0.001"))


def _rounded(df: DataFrame) -> DataFrame:
    """Doubles at six decimals: sums of doubles depend on the order of addition."""
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({n: F.round(n, 6) for n in doubles}) if doubles else df


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.daily_user_summary(runs_from_events(spark, sf_dir))


def _activity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.daily_activity_counts(runs_from_events(spark, sf_dir))


def _wrist_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.daily_wrist_counts(runs_from_events(spark, sf_dir))


def _sample_magnitude(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = runs_from_events(spark, sf_dir)
    return runs.select(day(runs).alias("date"), "time", "username", magnitude().alias("magnitude"))


def _labelled_samples(code: str, labels: dict[int, str]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return runs_from_events(spark, sf_dir).select("date", "time", "username", label(F.col(code), labels).alias(code))

    return run


def _label_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text codes stay as they are, integer codes of the same frame are labelled."""
    runs = runs_from_events(spark, sf_dir).withColumn("activity", F.col("activity").cast("string"))
    return label_codes(runs).select("date", "time", "username", "activity", "wrist")


def _text_code_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _activity_counts(spark, sf_dir)
    return figures.distribution(counts.withColumn("activity", F.col("activity").cast("string")))


def _lake_from_csv(spark: SparkSession, sf_dir: str) -> str:
    return once(spark, sf_dir, "csv-lake", lambda path: ingest(spark, csv_folder(spark, sf_dir), path))


def _csv_ingest_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_lake(spark, _lake_from_csv(spark, sf_dir))


def _ingest_rows_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ingest(spark, csv_folder(spark, sf_dir), scratch_path(spark, "counted-lake"))
    return _csv_ingest_union(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("rows_read"), F.lit(rows).cast("bigint").alias("rows_written")
    )


def _lake_date_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = _csv_ingest_union(spark, sf_dir)
    return runs.where(F.col("event_date").between(START, END)).select("event_date", "username", "activity", "wrist")


def _runs_view_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_runs(spark, plain_lake(spark, sf_dir))
    return spark.sql(
        """
        SELECT CAST(date AS DATE) AS date, username,
               mode() WITHIN GROUP (ORDER BY activity) AS top_activity,
               count(*) AS samples, avg(gyro_x) AS avg_gyro_x
        FROM runs GROUP BY CAST(date AS DATE), username
        """
    )


def _register_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_runs(spark, runs_from_events(spark, sf_dir), "py_df")
    return spark.sql("SELECT username, count(*) AS samples FROM py_df GROUP BY username")


def _mart_dir(spark: SparkSession, sf_dir: str) -> str:
    return once(spark, sf_dir, "marts", lambda path: build_marts(spark, plain_lake(spark, sf_dir), path))


def _stored(name: str) -> Query:
    return lambda spark, sf_dir: stored_mart(spark, name, _mart_dir(spark, sf_dir))


def _mart_rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same folder built twice."""
    mart_dir = scratch_path(spark, "rebuilt")
    for _ in range(2):
        build_marts(spark, plain_lake(spark, sf_dir), mart_dir)
    return stored_mart(spark, SUMMARY, mart_dir)


def _mart_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    location = scratch_path(spark, "database")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS stridelake_marts LOCATION '{location}'")
    publish_marts(spark, _mart_dir(spark, sf_dir), "stridelake_marts")
    return spark.table(f"stridelake_marts.{ACTIVITY_COUNTS}").drop(EVENT_MONTH)


def _load_from_lake(load: Callable) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return load(spark, scratch_path(spark, "no-marts"), plain_lake(spark, sf_dir))

    return run


def _batch_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart_dir = scratch_path(spark, "batch-marts")
    run_batch(spark, csv_folder(spark, sf_dir), scratch_path(spark, "batch-lake"), mart_dir)
    return stored_mart(spark, SUMMARY, mart_dir)


def _incremental(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        def make(mart_dir: str) -> None:
            raw, lake, checkpoint = (scratch_path(spark, p) for p in ("waves", "wave-lake", "wave-checkpoint"))
            for wave in (FIRST_WAVE, LATE_WAVE):
                write_csv_files(spark, sf_dir, raw, wave)
                run_incremental(spark, raw, lake, mart_dir, checkpoint)

        return stored_mart(spark, name, once(spark, sf_dir, "wave-marts", make))

    return run


def _old_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``incremental_marts``, the files of the second wave being older than those of the first."""
    mart_dir = scratch_path(spark, "old-marts")
    raw, lake, checkpoint = (scratch_path(spark, p) for p in ("old-waves", "old-lake", "old-checkpoint"))
    for wave, days in ((FIRST_WAVE, 0), (LATE_WAVE, 30)):
        came = scratch_path(spark, "wave")
        write_csv_files(spark, sf_dir, came, wave)
        arrive(spark, came, raw, days)
        run_incremental(spark, raw, lake, mart_dir, checkpoint)
    return stored_mart(spark, SUMMARY, mart_dir)


def _corrected(compacting: bool = False) -> Query:
    """Wrong rows come first, in files under names of right ones and under names of their own. The former are then
    rewritten, the latter deleted, between runs, and the late wave comes as well."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        def make(mart_dir: str) -> None:
            raw, lake, checkpoint = (scratch_path(spark, p) for p in ("fixed-waves", "fixed-lake", "fixed-checkpoint"))
            ghosts, more, first, late = (scratch_path(spark, p) for p in ("ghosts", "more-ghosts", "first", "late"))
            for folder in (ghosts, more):
                write_ghost_files(spark, sf_dir, folder)
            write_csv_files(spark, sf_dir, first, FIRST_WAVE)
            write_csv_files(spark, sf_dir, late, LATE_WAVE)
            gone = arrive_wrong(spark, ghosts, first, raw) + arrive_wrong(spark, more, scratch_path(spark, "none"), raw)
            run_incremental(spark, raw, lake, mart_dir, checkpoint)
            for path in gone:
                delete(spark, path)
            arrive(spark, first, raw)
            run_incremental(spark, raw, lake, mart_dir, checkpoint)
            arrive(spark, late, raw)
            run_incremental(spark, raw, lake, mart_dir, checkpoint)
            if compacting:
                compact(spark, lake, mart_dir, more_than=1)
                build_marts(spark, lake, mart_dir)

        label = "fixed-marts-compacted" if compacting else "fixed-marts"
        return stored_mart(spark, SUMMARY, once(spark, sf_dir, label, make))

    return run


def _deleted_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of an incremental run after files with rows of other users and codes were deleted again."""
    mart_dir = scratch_path(spark, "deleted-marts")
    raw, lake, checkpoint, ghosts = (scratch_path(spark, p) for p in ("deleted", "deleted-lake", "deleted-checkpoint", "ghosts"))
    write_csv_files(spark, sf_dir, raw, (*FIRST_WAVE, *LATE_WAVE))
    write_ghost_files(spark, sf_dir, ghosts)
    gone = arrive_wrong(spark, ghosts, scratch_path(spark, "none"), raw)
    run_incremental(spark, raw, lake, mart_dir, checkpoint)
    for path in gone:
        delete(spark, path)
    run_incremental(spark, raw, lake, mart_dir, checkpoint)
    return stored_mart(spark, ACTIVITY_COUNTS, mart_dir)


def _one_instant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples in roll-up and marts, for a reader from before a rebuild with more samples and for one from after it."""
    lake, mart_dir = (scratch_path(spark, p) for p in ("growing-lake", "growing-marts"))
    runs = runs_from_events(spark, sf_dir, extra=[F.col("event_type")])
    runs.where("event_type <> 'error'").write.parquet(lake)
    build_marts(spark, lake, mart_dir)
    before = latest_manifest(spark, mart_dir)
    runs.where("event_type = 'error'").write.mode("append").parquet(lake)
    build_marts(spark, lake, mart_dir)
    found = []
    for state, manifest in (("before", before), ("after", latest_manifest(spark, mart_dir))):
        rolled = read_parts(spark, mart_dir, ROLLUP, manifest.tables[ROLLUP]).select("n")
        tables = {ROLLUP: rolled}
        for name, measure in ((SUMMARY, "samples"), (ACTIVITY_COUNTS, "cnt"), (WRIST_COUNTS, "cnt")):
            tables[name] = stored_mart(spark, name, mart_dir, manifest=manifest).select(F.col(measure).alias("n"))
        for name, counted in tables.items():
            total = counted.agg(F.sum("n").cast("bigint").alias("samples"))
            found.append(total.select(F.lit(state).alias("state"), F.lit(name).alias("mart"), "samples"))
    return functools.reduce(DataFrame.unionAll, found)


def _broken_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart that has lost a file: the summary comes from the lake."""
    mart_dir, lake = scratch_path(spark, "broken-marts"), plain_lake(spark, sf_dir)
    build_marts(spark, lake, mart_dir)
    delete(spark, sorted(stored_mart(spark, SUMMARY, mart_dir).inputFiles())[0])
    return load_summary(spark, mart_dir, lake)


def _cached_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second of two loads: its rows are held, nothing is scanned."""
    cache = ResultCache(max_rows=10_000_000)
    load_summary(spark, _mart_dir(spark, sf_dir), cache=cache)
    return load_summary(spark, _mart_dir(spark, sf_dir), cache=cache)


def _no_csv_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without CSV files nothing is written, and the lake stays."""
    lake = _lake_from_csv(spark, sf_dir)
    written = ingest(spark, scratch_path(spark, "no-files"), lake)
    return read_lake(spark, lake).agg(F.lit(written).cast("bigint").alias("rows_written"), F.count(F.lit(1)).alias("rows_in_lake"))


def _missing_lake_raises(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A build without its lake fails, and the marts stay."""
    mart_dir = _mart_dir(spark, sf_dir)
    try:
        build_marts(spark, scratch_path(spark, "no-lake"), mart_dir)
        raised = False
    except FileNotFoundError:
        raised = True
    samples = F.sum("samples").cast("bigint").alias("samples")
    return stored_mart(spark, SUMMARY, mart_dir).agg(F.lit(raised).alias("raised"), samples)


def _sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The literal sample beside the events."""
    runs = runs_from_events(spark, sf_dir)
    return marts.daily_activity_counts(sample_runs(spark).unionByName(runs))


def _generated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many generated samples as there are events, for as many users."""
    size = runs_from_events(spark, sf_dir).agg(F.count(F.lit(1)), F.count_distinct("username")).first()
    runs = generated_runs(spark, size[0], size[1], days=30)
    of_runs = runs.agg(F.count(F.lit(1)).alias("samples"), F.min(day(runs)).alias("first_date"), F.max(day(runs)).alias("last_date"))
    return of_runs.withColumn("users", F.lit(size[1]).cast("bigint"))


def _mart_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    _mart_catalog(spark, sf_dir)
    described = spark.sql(f"DESCRIBE stridelake_marts.{SUMMARY}").where("NOT startswith(col_name, '#')")
    return described.where(F.col("col_name") != EVENT_MONTH).select("col_name", "data_type").distinct()


def _many_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events in more than 500 CSV files of two headers."""
    raw = scratch_path(spark, "many-files")
    runs = runs_from_events(spark, sf_dir, extra=[F.col("event_id")])
    for rest, names in enumerate((["event_id", "username", "activity"], ["activity", "event_id", "username"])):
        part = runs.where(F.col("event_id") % 2 == rest).repartition(300, "event_id")
        part.select(*names).write.mode("append").csv(raw, header=True)
    lake = scratch_path(spark, "many-files-lake")
    ingest(spark, raw, lake)
    return read_lake(spark, lake).select(*(F.col(n) for n in ("event_id", "username", "activity")))


def _slash_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = runs_from_events(spark, sf_dir).withColumn("date", F.translate("date", "-", "/"))
    return marts.daily_activity_counts(runs)


def _report_table(name: str, user: str | None = None, **days: str) -> Query:
    """One table of ``report`` over the stored marts."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        mart_dir = _mart_dir(spark, sf_dir)
        summary, counts = (load(spark, mart_dir, keep_month=True) for load in (load_summary, load_activity_counts))
        return report(summary, counts, user, **days)[name]

    return run


def _empty_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chosen(spark, sf_dir, "nobody").agg((F.count(F.lit(1)) == 0).alias("is_empty"))


def _mart_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    _mart_catalog(spark, sf_dir)
    return spark.sql("SHOW TABLES IN stridelake_marts").where("NOT isTemporary").select(F.col("tableName").alias("table_name"))


def _missing_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the samples, and of a lake that is not there, which adds no rows."""
    return _activity_counts(spark, sf_dir).unionByName(load_activity_counts(spark, None, scratch_path(spark, "no-lake")))


def _adhoc_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = "SELECT username, count(*) AS samples FROM runs GROUP BY username"
    return query(spark, sql, _mart_dir(spark, sf_dir), plain_lake(spark, sf_dir))


def _dict_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = query(spark, f"SELECT date, username, activity, cnt FROM {ACTIVITY_COUNTS}", _mart_dir(spark, sf_dir))
    return rows_as_maps(counts).select(*(F.col("row")[f.name].cast(f.dataType).alias(f.name) for f in counts.schema))


def _adhoc_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query(spark, _ADHOC, _mart_dir(spark, sf_dir))


def _summary_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = latest_summary(stored_mart(spark, SUMMARY, _mart_dir(spark, sf_dir)))
    objects = json_rows(latest)
    return objects.select(F.from_json("value", MART_SCHEMAS[SUMMARY]).alias("row")).select("row.*")


def _summary_json_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "json")
    write_json(stored_mart(spark, SUMMARY, _mart_dir(spark, sf_dir)), path)
    return spark.read.schema(MART_SCHEMAS[SUMMARY]).json(path)


def _chosen(spark: SparkSession, sf_dir: str, user: str | None = None, **days: str) -> DataFrame:
    return select_rows(_summary(spark, sf_dir), user, **days)


def base_queries() -> dict[str, Query]:
    found: dict[str, Query] = {
        # marts
        "daily_user_summary": _summary,
        "daily_activity_counts": _activity_counts,
        "daily_wrist_counts": _wrist_counts,
        "daily_user_summary_direct": lambda s, d: marts.daily_user_summary_direct(runs_from_events(s, d)),
        "daily_user_summary_lineitem": lambda s, d: marts.daily_user_summary(runs_from_lineitem(s, d)),
        "daily_activity_counts_lineitem": lambda s, d: marts.daily_activity_counts(runs_from_lineitem(s, d)),
        "daily_wrist_counts_lineitem": lambda s, d: marts.daily_wrist_counts(runs_from_lineitem(s, d)),
        "mode_activity": lambda s, d: marts.most_common_code(runs_from_events(s, d), "activity"),
        "mode_wrist": lambda s, d: marts.most_common_code(runs_from_events(s, d), "wrist"),
        "fallback_summary": lambda s, d: marts.fallback_summary(runs_from_events(s, d)),
        # projections
        "sample_magnitude": _sample_magnitude,
        "label_activity": _labelled_samples("activity", ACTIVITY_LABELS),
        "label_wrist": _labelled_samples("wrist", WRIST_LABELS),
        "label_by_type": _label_by_type,
        # filters
        "filter_user": lambda s, d: _chosen(s, d, USER),
        "filter_all_users": lambda s, d: _chosen(s, d, "All"),
        "filter_date_range": lambda s, d: _chosen(s, d, start=START, end=END),
        "filter_open_range": lambda s, d: _chosen(s, d, start=START),
        "filter_user_and_range": lambda s, d: _chosen(s, d, USER, start=START, end=END),
        # report
        "report_kpis": lambda s, d: figures.key_figures(_summary(s, d)),
        "report_kpis_range": lambda s, d: figures.key_figures(_chosen(s, d, start=START, end=END)),
        "report_kpis_empty": lambda s, d: figures.key_figures(_chosen(s, d, "nobody")),
        "date_bounds": lambda s, d: figures.date_bounds(_summary(s, d)),
        "user_list": lambda s, d: figures.user_list(_summary(s, d)),
        "daily_series": lambda s, d: figures.daily_series(_summary(s, d)),
        "daily_series_user": lambda s, d: figures.daily_series(_chosen(s, d, USER)),
        "daily_series_total": lambda s, d: figures.daily_series(_summary(s, d), per_user=False),
        "activity_distribution": lambda s, d: figures.distribution(_activity_counts(s, d)),
        "activity_distribution_text": _text_code_distribution,
        "wrist_distribution": lambda s, d: figures.distribution(_wrist_counts(s, d), "wrist"),
        "activity_share": lambda s, d: figures.share(_activity_counts(s, d)),
        "activity_share_user_and_range": lambda s, d: figures.share(
            select_rows(_activity_counts(s, d), USER, START, END)
        ),
        "labelled_table": lambda s, d: by_day_and_user(label_codes(_summary(s, d), CODE_COLUMNS)),
        "ordered_activity_counts": lambda s, d: by_day_user_and_count(_activity_counts(s, d), "activity"),
        "latest_summary": lambda s, d: latest_summary(_summary(s, d)),
        # sources, sinks and whole runs
        "csv_ingest_union": _csv_ingest_union,
        "ingest_rows_written": _ingest_rows_written,
        "lake_date_slice": _lake_date_slice,
        "runs_view_sql": _runs_view_sql,
        "register_frame": _register_frame,
        "mart_roundtrip": _stored(SUMMARY),
        "mart_roundtrip_activity": _stored(ACTIVITY_COUNTS),
        "mart_roundtrip_wrist": _stored(WRIST_COUNTS),
        "mart_rebuilt": _mart_rebuilt,
        "mart_catalog": _mart_catalog,
        "load_summary_from_lake": _load_from_lake(load_summary),
        "load_counts_from_lake": _load_from_lake(load_activity_counts),
        "batch_marts": _batch_marts,
        "incremental_marts": _incremental(SUMMARY),
        "incremental_activity_counts": _incremental(ACTIVITY_COUNTS),
        "incremental_old_files": _old_files,
        "incremental_rewritten": _corrected(),
        "incremental_deleted": _deleted_files,
        "incremental_compacted": _corrected(compacting=True),
        "marts_of_one_instant": _one_instant,
        "load_broken_mart": _broken_mart,
        "load_cached_summary": _cached_summary,
        "ingest_no_files": _no_csv_files,
        "build_without_lake": _missing_lake_raises,
        "sample_rows": _sample_rows,
        "generated_rows": _generated_rows,
        "mart_columns": _mart_columns,
        "csv_ingest_many_files": _many_files,
        "slash_dates": _slash_dates,
        "report_users": _report_table("users"),
        "report_bounds": _report_table("bounds"),
        "report_figures": _report_table("figures", start=START, end=END),
        "report_daily_total": _report_table("daily_total"),
        "report_series": _report_table("series", USER),
        "report_share": _report_table("share", USER, start=START, end=END),
        "report_distribution": _report_table("distribution"),
        "report_table": _report_table("table"),
        "ordered_wrist_counts": lambda s, d: by_day_user_and_count(_wrist_counts(s, d), "wrist"),
        "latest_stored_summary": lambda s, d: latest_stored_summary(s, _mart_dir(s, d)),
        "empty_selection": _empty_selection,
        "mart_listing": _mart_listing,
        "missing_lake": _missing_lake,
        "adhoc_sql_runs": _adhoc_runs,
        "adhoc_dict_rows": _dict_rows,
        "adhoc_sql": _adhoc_sql,
        "summary_json": _summary_json,
        "summary_json_file": _summary_json_file,
    }
    return {name: _with_rounding(run) for name, run in found.items()}


def _with_rounding(run: Query) -> Query:
    return lambda spark, sf_dir: _rounded(run(spark, sf_dir))


# --- SQL counterparts -------------------------------------------------------------------

_ADHOC = """
SELECT username, count(*) AS days, CAST(sum(samples) AS BIGINT) AS samples,
       max(max_accel_magnitude) AS peak
FROM daily_user_summary WHERE samples > 1 GROUP BY username
"""

_RUNS = """
runs AS (
  SELECT strftime(ts, '%Y-%-m-%-d') AS date, strftime(ts, '%H:%M:%S') AS time,
         'user_' || user_id AS username,
         CAST(CASE WHEN event_type = 'view' THEN 0 WHEN event_type = 'click' THEN 1
                   WHEN event_type <> 'error' THEN 2 END AS BIGINT) AS activity,
         CAST(event_id % 2 AS BIGINT) AS wrist,
         value / 100 AS acceleration_x, (event_id % 7) / 10 AS acceleration_y,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100 AS acceleration_z,
         (event_id % 5) / 10 AS gyro_x, (event_id % 11) / 10 AS gyro_y, (event_id % 13) / 10 AS gyro_z,
         event_id, event_type, props
  FROM events)"""

_LINEITEM_RUNS = """
runs AS (
  SELECT l_shipdate AS date, 'supplier_' || l_suppkey AS username,
         CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS BIGINT) AS activity,
         CAST(CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END AS BIGINT) AS wrist,
         l_quantity AS acceleration_x, l_discount AS acceleration_y, l_tax AS acceleration_z,
         l_discount AS gyro_x, l_tax AS gyro_y, l_linenumber / 10 AS gyro_z
  FROM lineitem)"""

# The files with orders have no gyro_z.
_CSV_RUNS = """
csv_runs AS (
  SELECT * REPLACE (CASE WHEN event_type IN ('view', 'click', 'error') THEN gyro_z END AS gyro_z)
  FROM runs)"""

_MAGNITUDE = (
    "sqrt(acceleration_x * acceleration_x + acceleration_y * acceleration_y + acceleration_z * acceleration_z)"
)


def _summary_cte(source: str = "runs") -> str:
    return f"""
summary AS (
  SELECT CAST(date AS DATE) AS date, username,
         mode() WITHIN GROUP (ORDER BY activity) AS top_activity,
         mode() WITHIN GROUP (ORDER BY wrist) AS top_wrist,
         count(*) AS samples,
         avg({_MAGNITUDE}) AS avg_accel_magnitude, max({_MAGNITUDE}) AS max_accel_magnitude,
         avg(gyro_x) AS avg_gyro_x, avg(gyro_y) AS avg_gyro_y, avg(gyro_z) AS avg_gyro_z
  FROM {source} GROUP BY CAST(date AS DATE), username)"""


def _counts_cte(code: str) -> str:
    return f"""
counts AS (
  SELECT CAST(date AS DATE) AS date, username, {code}, count(*) AS cnt
  FROM runs GROUP BY CAST(date AS DATE), username, {code})"""


_SUMMARY_COLUMNS = """date, username, top_activity, top_wrist, samples,
  round(avg_accel_magnitude, 6) AS avg_accel_magnitude,
  round(max_accel_magnitude, 6) AS max_accel_magnitude,
  round(avg_gyro_x, 6) AS avg_gyro_x, round(avg_gyro_y, 6) AS avg_gyro_y,
  round(avg_gyro_z, 6) AS avg_gyro_z"""

_ACTIVITY_LABEL = (
    "coalesce(CASE activity WHEN 0 THEN 'walking' WHEN 1 THEN 'running' END, CAST(activity AS VARCHAR))"
)
_WRIST_LABEL = "coalesce(CASE wrist WHEN 0 THEN 'left' WHEN 1 THEN 'right' END, CAST(wrist AS VARCHAR))"

_KPIS = """
  SELECT count(DISTINCT date) AS days, count(DISTINCT username) AS users,
         CAST(coalesce(sum(samples), 0) AS BIGINT) AS samples,
         round(avg(avg_accel_magnitude), 6) AS avg_accel_magnitude
  FROM summary"""


def _on_summary(tail: str, source: str = "runs", more: str = "") -> str:
    return f"WITH {_RUNS},{more}{_summary_cte(source)}\n{tail}"


def _on_counts(tail: str, code: str = "activity") -> str:
    return f"WITH {_RUNS},{_counts_cte(code)}\n{tail}"


def _share(where: str = "") -> str:
    return _on_counts(
        f"""
  SELECT activity, CAST(sum(cnt) AS BIGINT) AS cnt,
         round(sum(cnt) / sum(sum(cnt)) OVER (), 6) AS share
  FROM (SELECT {_ACTIVITY_LABEL} AS activity, cnt FROM counts {where})
  WHERE activity IS NOT NULL GROUP BY activity"""
    )


def _distribution(label_sql: str, code: str) -> str:
    return _on_counts(
        f"""
  SELECT {code}, CAST(sum(cnt) AS BIGINT) AS cnt FROM (SELECT {label_sql} AS {code}, cnt FROM counts)
  WHERE {code} IS NOT NULL GROUP BY {code}""",
        code,
    )


def base_oracle_sql() -> dict[str, str]:
    whole_summary = _on_summary(f"SELECT {_SUMMARY_COLUMNS} FROM summary")
    csv_summary = _on_summary(f"SELECT {_SUMMARY_COLUMNS} FROM summary", "csv_runs", f"{_CSV_RUNS},")
    latest = _on_summary(
        f"SELECT {_SUMMARY_COLUMNS} FROM (SELECT * FROM summary ORDER BY date DESC, username LIMIT 100)"
    )
    fallback = _on_summary(
        "SELECT date, username, samples, round(avg_accel_magnitude, 6) AS avg_accel_magnitude FROM summary"
    )
    activity_counts = _on_counts("SELECT * FROM counts")
    wrist_counts = _on_counts("SELECT * FROM counts", "wrist")
    in_range = f"date BETWEEN '{START}' AND '{END}'"
    of_user = f"username = '{USER}'"

    def summary_where(condition: str) -> str:
        return _on_summary(f"SELECT {_SUMMARY_COLUMNS} FROM summary WHERE {condition}")

    def samples(columns: str) -> str:
        return f"WITH {_RUNS} SELECT {columns} FROM runs"

    def lineitem_counts(code: str) -> str:
        return f"WITH {_LINEITEM_RUNS},{_counts_cte(code)} SELECT * FROM counts"

    labelled = _on_summary(
        f"""
  SELECT {_SUMMARY_COLUMNS.replace('top_activity, top_wrist, ', '')},
         {_ACTIVITY_LABEL.replace('activity', 'top_activity')} AS top_activity,
         {_WRIST_LABEL.replace('wrist', 'top_wrist')} AS top_wrist
  FROM summary"""
    )

    return {
        "daily_user_summary": whole_summary,
        "daily_activity_counts": activity_counts,
        "daily_wrist_counts": wrist_counts,
        "daily_user_summary_direct": whole_summary,
        "daily_user_summary_lineitem": (
            f"WITH {_LINEITEM_RUNS},{_summary_cte()} SELECT {_SUMMARY_COLUMNS} FROM summary"
        ),
        "daily_activity_counts_lineitem": lineitem_counts("activity"),
        "daily_wrist_counts_lineitem": lineitem_counts("wrist"),
        "mode_activity": _on_summary("SELECT date, username, top_activity FROM summary"),
        "mode_wrist": _on_summary("SELECT date, username, top_wrist FROM summary"),
        "fallback_summary": fallback,
        "sample_magnitude": samples(
            f"CAST(date AS DATE) AS date, time, username, round({_MAGNITUDE}, 6) AS magnitude"
        ),
        "label_activity": samples(f"date, time, username, {_ACTIVITY_LABEL} AS activity"),
        "label_wrist": samples(f"date, time, username, {_WRIST_LABEL} AS wrist"),
        "label_by_type": samples(
            f"date, time, username, CAST(activity AS VARCHAR) AS activity, {_WRIST_LABEL} AS wrist"
        ),
        "filter_user": summary_where(of_user),
        "filter_all_users": whole_summary,
        "filter_date_range": summary_where(in_range),
        "filter_open_range": summary_where(f"date >= '{START}'"),
        "filter_user_and_range": summary_where(f"{of_user} AND {in_range}"),
        "report_kpis": _on_summary(_KPIS),
        "report_kpis_range": _on_summary(f"{_KPIS} WHERE {in_range}"),
        "report_kpis_empty": _on_summary(f"{_KPIS} WHERE username = 'nobody'"),
        "date_bounds": _on_summary("SELECT min(date) AS first_date, max(date) AS last_date FROM summary"),
        "user_list": _on_summary("SELECT DISTINCT username FROM summary WHERE username IS NOT NULL"),
        "daily_series": _on_summary("SELECT date, username, samples FROM summary"),
        "daily_series_user": _on_summary(f"SELECT date, username, samples FROM summary WHERE {of_user}"),
        "daily_series_total": _on_summary(
            "SELECT date, CAST(sum(samples) AS BIGINT) AS samples FROM summary GROUP BY date"
        ),
        "activity_distribution": _distribution(_ACTIVITY_LABEL, "activity"),
        "activity_distribution_text": _distribution("CAST(activity AS VARCHAR)", "activity"),
        "wrist_distribution": _distribution(_WRIST_LABEL, "wrist"),
        "activity_share": _share(),
        "activity_share_user_and_range": _share(f"WHERE {of_user} AND {in_range}"),
        "labelled_table": labelled,
        "ordered_activity_counts": activity_counts,
        "latest_summary": latest,
        "csv_ingest_union": f"""
WITH {_RUNS},{_CSV_RUNS}
  SELECT date, CASE WHEN event_type <> 'error' THEN time END AS time, username, activity, wrist,
         round(acceleration_x, 6) AS acceleration_x, round(acceleration_y, 6) AS acceleration_y,
         round(acceleration_z, 6) AS acceleration_z, round(gyro_x, 6) AS gyro_x,
         round(gyro_y, 6) AS gyro_y, round(gyro_z, 6) AS gyro_z,
         CASE WHEN event_type IN ('view', 'click', 'error') THEN event_id END AS event_id,
         CASE WHEN event_type NOT IN ('view', 'click', 'error') THEN event_type END AS event_type,
         CASE WHEN event_type NOT IN ('view', 'click', 'error') THEN event_type = 'signup' END AS is_signup,
         CASE WHEN event_type = 'error' THEN props || ',' || chr(10) || event_type END AS note,
         CAST(date AS DATE) AS event_date
  FROM csv_runs""",
        "ingest_rows_written": "SELECT count(*) AS rows_read, count(*) AS rows_written FROM events",
        "lake_date_slice": (
            f"WITH {_RUNS} SELECT CAST(date AS DATE) AS event_date, username, activity, wrist "
            f"FROM runs WHERE CAST(date AS DATE) BETWEEN '{START}' AND '{END}'"
        ),
        "runs_view_sql": _on_summary(
            "SELECT date, username, top_activity, samples, round(avg_gyro_x, 6) AS avg_gyro_x FROM summary"
        ),
        "register_frame": f"WITH {_RUNS} SELECT username, count(*) AS samples FROM runs GROUP BY username",
        "mart_roundtrip": whole_summary,
        "mart_roundtrip_activity": activity_counts,
        "mart_roundtrip_wrist": wrist_counts,
        "mart_rebuilt": whole_summary,
        "mart_catalog": activity_counts,
        "load_summary_from_lake": fallback,
        "load_counts_from_lake": activity_counts,
        "batch_marts": csv_summary,
        "incremental_marts": csv_summary,
        "incremental_activity_counts": activity_counts,
        "incremental_old_files": csv_summary,
        "incremental_rewritten": csv_summary,
        "incremental_deleted": activity_counts,
        "incremental_compacted": csv_summary,
        "marts_of_one_instant": f"""
WITH states AS (
  SELECT 'before' AS state, count(*) AS samples FROM events WHERE event_type <> 'error'
  UNION ALL SELECT 'after', count(*) FROM events)
  SELECT state, mart, samples
  FROM states, (SELECT unnest(['{ROLLUP}', '{SUMMARY}', '{ACTIVITY_COUNTS}', '{WRIST_COUNTS}']) AS mart)""",
        "load_broken_mart": fallback,
        "load_cached_summary": whole_summary,
        "ingest_no_files": "SELECT CAST(0 AS BIGINT) AS rows_written, count(*) AS rows_in_lake FROM events",
        "build_without_lake": "SELECT true AS raised, count(*) AS samples FROM events",
        "sample_rows": _on_counts(
            """
  SELECT * FROM counts UNION ALL
  SELECT CAST(date AS DATE), 'viktor', CAST(activity AS BIGINT), CAST(1 AS BIGINT)
  FROM (VALUES ('2017-07-01', 0), ('2017-07-01', 1), ('2017-07-02', 0), ('2017-07-03', 1)) AS t(date, activity)"""
        ),
        "generated_rows": """
  SELECT count(*) AS samples, DATE '2017-06-30' AS first_date, DATE '2017-07-29' AS last_date,
         count(DISTINCT user_id) AS users FROM events""",
        "mart_columns": """
  SELECT unnest(['date', 'username', 'top_activity', 'top_wrist', 'samples', 'avg_accel_magnitude',
                 'max_accel_magnitude', 'avg_gyro_x', 'avg_gyro_y', 'avg_gyro_z']) AS col_name,
         unnest(['date', 'string', 'bigint', 'bigint', 'bigint', 'double', 'double', 'double', 'double', 'double']) AS data_type""",
        "csv_ingest_many_files": samples("event_id, username, activity"),
        "slash_dates": activity_counts,
        "report_users": _on_summary("SELECT DISTINCT username FROM summary WHERE username IS NOT NULL"),
        "report_bounds": _on_summary("SELECT min(date) AS first_date, max(date) AS last_date FROM summary"),
        "report_figures": _on_summary(f"{_KPIS} WHERE {in_range}"),
        "report_daily_total": _on_summary(
            "SELECT date, CAST(sum(samples) AS BIGINT) AS samples FROM summary GROUP BY date"
        ),
        "report_series": _on_summary(f"SELECT date, username, samples FROM summary WHERE {of_user}"),
        "report_share": _share(f"WHERE {of_user} AND {in_range}"),
        "report_distribution": _distribution(_ACTIVITY_LABEL, "activity"),
        "report_table": labelled,
        "ordered_wrist_counts": wrist_counts,
        "latest_stored_summary": latest,
        "empty_selection": _on_summary("SELECT count(*) = 0 AS is_empty FROM summary WHERE username = 'nobody'"),
        "mart_listing": f"SELECT unnest(['{ACTIVITY_COUNTS}', '{SUMMARY}', '{WRIST_COUNTS}']) AS table_name",
        "missing_lake": activity_counts,
        "adhoc_sql_runs": f"WITH {_RUNS} SELECT username, count(*) AS samples FROM runs GROUP BY username",
        "adhoc_dict_rows": activity_counts,
        "adhoc_sql": _on_summary(
            f"SELECT * REPLACE (round(peak, 6) AS peak) FROM ({_ADHOC.replace('daily_user_summary', 'summary')})"
        ),
        "summary_json": latest,
        "summary_json_file": whole_summary,
    }


def queries() -> dict[str, Query]:
    if training_data is None:
        return base_queries()
    return base_queries() | training_data.QUERIES | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return base_oracle_sql() | (training_data.ORACLES if training_data else {})
