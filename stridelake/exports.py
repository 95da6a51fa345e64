"""Proxy samples written out as raw files, for the queries that start from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.proxies import runs_from_events
from stridelake.session import scratch_path
from stridelake.sources import tables
from stridelake.sources.files import list_csv_files

_AXES = ["acceleration_x", "acceleration_y", "acceleration_z", "gyro_x", "gyro_y", "gyro_z"]
_LAYOUTS = {
    "views": ["date", "time", "username", "activity", "wrist", *_AXES, "event_id"],
    # other column order, one sensor column absent, extra columns
    "orders": ["username", "wrist", "activity", "date", "time", *_AXES[:-1], "event_type", "is_signup"],
    # codes blank, quoted text with line breaks
    "errors": ["date", "username", "note", "activity", "wrist", *_AXES, "event_id"],
}
FIRST_WAVE = ("views", "orders")
LATE_WAVE = ("errors",)

_stored: dict[tuple[str, str, str], str] = {}


def once(spark: SparkSession, sf_dir: str, label: str, make) -> str:
    """Path of something made by ``make(path)``, made once per application and input."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _stored:
        path = scratch_path(spark, label)
        make(path)
        _stored[key] = path
    return _stored[key]


def csv_folder(spark: SparkSession, sf_dir: str) -> str:
    """All events as CSV files with three different headers, in one flat folder."""
    return once(
        spark, sf_dir, "raw", lambda path: write_csv_files(spark, sf_dir, path, (*FIRST_WAVE, *LATE_WAVE))
    )


def write_csv_files(spark: SparkSession, sf_dir: str, path: str, layouts: tuple[str, ...]) -> None:
    runs = _runs_with_extras(spark, sf_dir)
    for layout in layouts:
        rows = runs.where(F.col("layout") == layout).select(*_LAYOUTS[layout])
        rows.write.mode("append").csv(path, header=True, quote='"', escape='"')


def write_ghost_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Files of the first layout whose rows should not be there: every event under another user and code."""
    ghosts = _runs_with_extras(spark, sf_dir).withColumn("username", F.concat(F.lit("ghost_"), "username"))
    ghosts = ghosts.withColumn("activity", F.lit(7).cast("bigint")).select(*_LAYOUTS["views"])
    ghosts.write.csv(path, header=True, quote='"', escape='"')


def plain_lake(spark: SparkSession, sf_dir: str) -> str:
    """The samples as a plain Parquet folder, as other tools would leave it."""

    def make(path: str) -> None:
        runs_from_events(spark, sf_dir).write.option("maxRecordsPerFile", tables.ROWS_A_FILE).parquet(path)

    return once(spark, sf_dir, "lake", make)


def _runs_with_extras(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    layout = F.when(kind.isin("view", "click"), "views").when(kind == "error", "errors").otherwise("orders")
    return runs_from_events(
        spark,
        sf_dir,
        extra=[
            F.col("event_id"),
            kind,
            (kind == "signup").alias("is_signup"),
            F.concat("props", F.lit(",\n"), kind).alias("note"),
            layout.alias("layout"),
        ],
    )


def arrive(spark: SparkSession, came: str, folder: str, days_old: int = 0) -> None:
    """Move CSV files into ``folder``, their modification time so many days back."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(folder))
    for file in list_csv_files(spark, came):
        _put(fs, path(file.path), path(f"{folder}/{file.name}"), days_old)


def _put(fs, source, target, days_old: int) -> None:
    fs.delete(target, False)
    fs.rename(source, target)
    when = fs.getFileStatus(target).getModificationTime() - days_old * 86_400_000
    fs.setTimes(target, when, -1)


def arrive_wrong(spark: SparkSession, wrong: str, right: str, folder: str) -> list[str]:
    """Files of ``wrong`` take the names of those in ``right`` for as long as there are some, else their own, and
    move to ``folder``, dated a day back. Returns the paths of those with names of their own."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    names = [file.name for file in list_csv_files(spark, right)]
    own = []
    for k, file in enumerate(list_csv_files(spark, wrong)):
        name = names[k] if k < len(names) else file.name
        own += [] if k < len(names) else [f"{folder}/{name}"]
        _put(fs, path(file.path), path(f"{folder}/{name}"), 1)
    return own
