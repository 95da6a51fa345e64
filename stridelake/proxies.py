"""Star-schema tables seen as sensor samples, for the registered queries and benches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_EVENT_COLUMNS = (
    "date_format(ts, 'yyyy-M-d') AS date",
    "date_format(ts, 'HH:mm:ss') AS time",
    "concat('user_', user_id) AS username",
    """CAST(CASE WHEN event_type = 'view' THEN 0 WHEN event_type = 'click' THEN 1
            WHEN event_type <> 'error' THEN 2 END AS BIGINT) AS activity""",
    "CAST(event_id % 2 AS BIGINT) AS wrist",
    "value / 100 AS acceleration_x",
    "(event_id % 7) / 10 AS acceleration_y",
    "CAST(get_json_object(props, '$.k') AS DOUBLE) / 100 AS acceleration_z",
    "(event_id % 5) / 10 AS gyro_x",
    "(event_id % 11) / 10 AS gyro_y",
    "(event_id % 13) / 10 AS gyro_z",
)

_LINEITEM_COLUMNS = (
    "l_shipdate AS date",
    "concat('supplier_', l_suppkey) AS username",
    "CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS BIGINT) AS activity",
    "CAST(CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END AS BIGINT) AS wrist",
    "l_quantity AS acceleration_x",
    "l_discount AS acceleration_y",
    "l_tax AS acceleration_z",
    "l_discount AS gyro_x",
    "l_tax AS gyro_y",
    "l_linenumber / 10 AS gyro_z",
)


def runs_from_events(spark: SparkSession, sf_dir: str, extra: Sequence[Column] = ()) -> DataFrame:
    """Events as samples; dates are un-padded text, codes include unknown and missing ones."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select(*map(F.expr, _EVENT_COLUMNS), *extra)


def runs_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as samples: the larger table, for benches."""
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(*_LINEITEM_COLUMNS)
