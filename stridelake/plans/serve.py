"""Latest rows, ad-hoc SQL and JSON over the marts."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridelake.functions.columns import quoted
from stridelake.operators.selection import latest
from stridelake.plans.load import check_mart, stored_mart
from stridelake.schema import EVENT_MONTH, MART_SCHEMAS, NO_VALUE, SUMMARY
from stridelake.session import session_like
from stridelake.sources.lake import read_lake
from stridelake.sources.manifest import latest_manifest, value_of
from stridelake.sources.tables import read_parts


def latest_summary(summary: DataFrame, n: int = 100) -> DataFrame:
    """The latest ``n`` summary rows, newest first."""
    return latest(summary, n)


def latest_stored_summary(spark: SparkSession, mart_dir: str, n: int = 100) -> DataFrame:
    """``latest_summary`` of the stored mart; only its newest months are read, as many as hold ``n`` rows."""
    manifest = latest_manifest(spark, mart_dir)
    mart = stored_mart(spark, SUMMARY, mart_dir, manifest=manifest)
    if manifest is None:
        return latest(mart, n)
    table = manifest.tables[SUMMARY]
    no_day = [m for m in table.parts if value_of(m, EVENT_MONTH) == NO_VALUE]
    months = sorted(set(table.parts) - set(no_day), reverse=True) + no_day
    taken = 1
    while 0 < taken < len(months):
        newest = read_parts(spark, mart_dir, SUMMARY, table, months[:taken]).drop(EVENT_MONTH)
        if newest.limit(n).count() >= n:
            return latest(newest, n)
        taken *= 4
    return latest(mart, n)


def query(spark: SparkSession, sql: str, mart_dir: str, lake_path: str | None = None) -> DataFrame:
    """Run one SQL statement with the marts in ``mart_dir``, and the samples of ``lake_path`` as ``runs``, as views.

    The statement runs in a session of its own, with the settings of ``spark``: it sees these views and the catalog, but
    no temporary views of the caller, which stay as they are. All marts are seen as of one instant. Without any of
    them the result is an empty frame without columns. Errors in the statement are raised, and so is a mart or lake that
    is there but cannot be opened; ``query_or_error`` gives them as a row.
    """
    session = session_like(spark)
    manifest = latest_manifest(spark, mart_dir)
    views: dict[str, DataFrame] = {}
    if lake_path is not None:
        with contextlib.suppress(FileNotFoundError):
            views["runs"] = read_lake(session, lake_path)
    for name in MART_SCHEMAS:
        with contextlib.suppress(FileNotFoundError):
            views[name] = stored_mart(session, name, mart_dir, manifest=manifest)
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return session.sql(sql) if views else spark.createDataFrame([], T.StructType([]))


def query_or_error(spark: SparkSession, sql: str, mart_dir: str, lake_path: str | None = None) -> DataFrame:
    """As ``query``; where marts or lake cannot be opened, one row with the message in a column ``error``.

    Errors of the statement itself are raised.
    """
    try:
        for name in MART_SCHEMAS:
            with contextlib.suppress(FileNotFoundError):
                stored_mart(spark, name, mart_dir)
                check_mart(spark, name, mart_dir)
        if lake_path is not None:
            with contextlib.suppress(FileNotFoundError):
                read_lake(spark, lake_path)
    except (OSError, ValueError, PySparkException, Py4JJavaError) as e:
        return spark.createDataFrame([(f"Could not open the marts: {e}".splitlines()[0],)], "error string")
    return query(spark, sql, mart_dir, lake_path)


def rows_as_dicts(df: DataFrame, n: int | None = None) -> list[dict[str, Any]]:
    """All rows, or the first ``n``, as dicts keyed by column name; for results that fit the driver."""
    return [r.asDict() for r in (df.collect() if n is None else df.take(n))]


def iterate_dicts(df: DataFrame) -> Iterator[dict[str, Any]]:
    """All rows as dicts, fetched one partition at a time."""
    return (r.asDict() for r in df.toLocalIterator())


def rows_as_maps(df: DataFrame) -> DataFrame:
    """Each row as one map of column names to values as text, in column ``row``; rows stay in Spark."""
    pairs = [x for f in df.schema for x in (F.lit(f.name), quoted(f.name).cast("string"))]
    return df.select(F.create_map(*pairs).alias("row"))


def json_rows(df: DataFrame) -> DataFrame:
    """Each row as one JSON object in column ``value``; dates are ISO, NaN is left out."""
    return df.select(F.to_json(F.struct(*_without_nan(df))).alias("value"))


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines, one object per row, in a folder."""
    df.select(*_without_nan(df)).write.mode("overwrite").json(path)


def _without_nan(df: DataFrame):
    for field in df.schema:
        column = quoted(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = F.nanvl(column, F.lit(None).cast(field.dataType))
        yield column.alias(field.name)
