"""Lake to marts."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.functions.columns import sql_name
from stridelake.operators.marts import counts_of, rollup, summary_of
from stridelake.schema import ACTIVITY_COUNTS, BATCH_ID, EVENT_MONTH, NO_VALUE, ROLLUP, SUMMARY, WRIST_COUNTS
from stridelake.session import sized_session
from stridelake.sources.files import side_by_side
from stridelake.sources.lake import read_lake
from stridelake.sources.manifest import Manifest, Table, commit, latest_manifest, new_build, resolve, table_path, value_of
from stridelake.sources.tables import merged_schema, read_parts, read_table, sealed, write_parts

# Notes in manifests: the incremental run that tables belong to, and the lake's state that marts show.
RUN, LAKE_VERSION = "run", "lake_version"
# Roll-up rows of a full build; batches of the incremental run count from 0.
FULL_BUILD = -1


def roll_up(runs: DataFrame, batch_id: int | None = None, on_bad_date: str = "error") -> DataFrame:
    """Roll-up in stored form: with partition columns ``event_month`` and ``batch_id``."""
    if batch_id is not None or BATCH_ID not in runs.columns:
        runs = runs.withColumn(BATCH_ID, F.lit(FULL_BUILD if batch_id is None else batch_id).cast("bigint"))
    return _with_month(rollup(runs, keep=[BATCH_ID], on_bad_date=on_bad_date))


def marts_of(rolled: DataFrame) -> dict[str, DataFrame]:
    """The three marts from a roll-up."""
    return {
        SUMMARY: summary_of(rolled),
        ACTIVITY_COUNTS: counts_of(rolled, "activity"),
        WRIST_COUNTS: counts_of(rolled, "wrist"),
    }


def write_rollup(rolled: DataFrame, mart_dir: str, build: str) -> Table:
    """The rows as new partitions of the roll-up, for a manifest that is yet to be written."""
    parts, _ = write_parts(rolled, mart_dir, ROLLUP, build, [EVENT_MONTH, BATCH_ID], sort_by=["date", "username"])
    return Table(merged_schema(None, rolled.schema, ROLLUP), parts)


def write_marts(rolled: DataFrame, mart_dir: str, build: str) -> dict[str, Table]:
    """The three marts of a roll-up, or of some months of one, as new partitions.

    By month, and sorted, so that day and user filters skip row groups. Files, rows and digests are taken
    down, so that a reader can tell that a mart is whole.
    """
    spark = rolled.sparkSession

    def write(name: str, mart: DataFrame) -> Table:
        parts, _ = write_parts(mart, mart_dir, name, build, [EVENT_MONTH], sort_by=["date", "username"])
        table = Table(merged_schema(None, mart.schema, name), parts)
        return Table(table.schema, sealed(spark, mart_dir, name, table, parts))

    marts = {name: _with_month(mart) for name, mart in marts_of(rolled).items()}
    return dict(zip(marts, side_by_side(spark, [functools.partial(write, *m) for m in marts.items()])))


def _with_month(df: DataFrame) -> DataFrame:
    return df.withColumn(EVENT_MONTH, F.trunc("date", "month"))


def build_marts(
    spark: SparkSession, lake_path: str, mart_dir: str, on_bad_date: str = "error"
) -> dict[str, str]:
    """Build the roll-up and the three marts from the whole lake; returns their paths.

    The lake is scanned once. The roll-up is a written table, so the marts are three
    small jobs over it, and a lost executor never causes a second scan of the lake. All four change at
    one instant, when the manifest that names their new folders is moved into place; until then, and if the
    build fails, readers see the old ones. Running it again gives the same tables.
    """
    lake = resolve(spark, lake_path)
    sized = sized_session(spark, read_lake(spark, lake_path, keep_batch_id=True).count())  # reads the footers
    runs = read_lake(sized, lake_path, keep_batch_id=True)
    before = latest_manifest(spark, mart_dir) or Manifest(mart_dir)
    build = new_build()
    rolled = write_rollup(roll_up(runs, on_bad_date=on_bad_date), mart_dir, build)
    marts = write_marts(read_parts(sized, mart_dir, ROLLUP, rolled), mart_dir, build)
    notes = {RUN: lake[0].notes.get(RUN), LAKE_VERSION: lake[0].version} if lake else {RUN: None, LAKE_VERSION: None}
    commit(spark, before.following({ROLLUP: rolled, **marts}, **notes))
    return {name: table_path(mart_dir, name) for name in (ROLLUP, *marts)}


def publish_marts(spark: SparkSession, mart_dir: str, database: str = "default") -> list[str]:
    """Make the marts catalog tables over their folders as they are now; repeat after marts were updated.

    The tables also show the partition column ``event_month``.
    """
    names = []
    manifest = latest_manifest(spark, mart_dir)
    for name in (SUMMARY, ACTIVITY_COUNTS, WRIST_COUNTS):
        path = table_path(mart_dir, name)
        table = f"{sql_name(database)}.{sql_name(name)}"
        schema = manifest.tables[name].schema if manifest else read_table(spark, path).schema
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        columns = ", ".join(f"{sql_name(f.name)} {f.dataType.simpleString()}" for f in schema)
        quoted_path = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet "
            f"PARTITIONED BY ({EVENT_MONTH}) LOCATION '{quoted_path}'"
        )
        if manifest is None:
            spark.catalog.recoverPartitions(table)
        for part in manifest.parts(name) if manifest else ():
            month = value_of(part, EVENT_MONTH)
            spec = "NULL" if month == NO_VALUE else f"'{month}'"
            folder = f"{quoted_path}/{manifest.tables[name].folder(part)}"
            spark.sql(f"ALTER TABLE {table} ADD PARTITION ({EVENT_MONTH} = {spec}) LOCATION '{folder}'")
        names.append(f"{database}.{name}")
    return names
