"""Column names and types of the sample relation and of the marts."""

from __future__ import annotations

from pyspark.sql import types as T

# Declared types of the sensor columns; other columns are carried and inferred.
SENSOR_TYPES: dict[str, str] = {
    "date": "string",
    "time": "string",
    "username": "string",
    "wrist": "bigint",
    "activity": "bigint",
    "acceleration_x": "double",
    "acceleration_y": "double",
    "acceleration_z": "double",
    "gyro_x": "double",
    "gyro_y": "double",
    "gyro_z": "double",
}

_TYPES = {"string": T.StringType, "bigint": T.LongType, "double": T.DoubleType, "date": T.DateType}


def _schema(columns: dict[str, str]) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]()) for name, kind in columns.items()])


RUNS_SCHEMA = _schema(SENSOR_TYPES)

# Columns the lake adds to the raw ones.
EVENT_DATE = "event_date"
BATCH_ID = "batch_id"
# In lakes of incremental runs: the raw file that a row comes from.
SOURCE_FILE = "source_file"
# Note of such a lake: type of the values of each undeclared column for each batch.
KINDS = "kinds"
# What Spark writes for NULL in the name of a partition folder.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
# Partition of the roll-up and the marts: a day of them is small even where a day of
# samples is large.
EVENT_MONTH = "event_month"

ROLLUP = "daily_rollup"
SUMMARY = "daily_user_summary"
ACTIVITY_COUNTS = "daily_activity_counts"
WRIST_COUNTS = "daily_wrist_counts"

MART_SCHEMAS: dict[str, T.StructType] = {
    SUMMARY: _schema(
        {
            "date": "date",
            "username": "string",
            "top_activity": "bigint",
            "top_wrist": "bigint",
            "samples": "bigint",
            "avg_accel_magnitude": "double",
            "max_accel_magnitude": "double",
            "avg_gyro_x": "double",
            "avg_gyro_y": "double",
            "avg_gyro_z": "double",
        }
    ),
    ACTIVITY_COUNTS: _schema(
        {"date": "date", "username": "string", "activity": "bigint", "cnt": "bigint"}
    ),
    WRIST_COUNTS: _schema({"date": "date", "username": "string", "wrist": "bigint", "cnt": "bigint"}),
}
