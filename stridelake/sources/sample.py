"""Sample rows for tests and trials."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.schema import RUNS_SCHEMA

# The four sample rows, in the column order of RUNS_SCHEMA.
SAMPLE_ROWS = (
    ("2017-07-01", "12:00:00", "viktor", 0, 0, 0.1, 0.0, 0.0, 0.01, 0.0, 0.0),
    ("2017-07-01", "12:05:00", "viktor", 1, 1, 0.2, 0.1, 0.0, 0.02, 0.005, 0.0),
    ("2017-07-02", "12:10:00", "viktor", 0, 0, 0.15, -0.05, 0.0, -0.01, -0.002, 0.0),
    ("2017-07-03", "12:15:00", "viktor", 1, 1, 0.12, 0.02, 0.01, 0.0, 0.001, 0.0),
)


def sample_runs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SAMPLE_ROWS), RUNS_SCHEMA)


def generated_runs(
    spark: SparkSession, rows: int, users: int, days: int, hot_share: float = 0.0
) -> DataFrame:
    """Deterministic samples; user 0 on the first day holds ``hot_share`` of all rows."""
    i = F.col("id")

    def spread(salt: int, n: int):
        return F.pmod(F.xxhash64(i, F.lit(salt)), F.lit(n))

    hot = spread(0, 1000) < F.lit(int(hot_share * 1000))
    day = F.when(hot, 0).otherwise(spread(1, days)).cast("int")
    user = F.when(hot, 0).otherwise(spread(2, users))
    axes = [(spread(10 + k, 2001) / 1000 - 1).alias(n) for k, n in enumerate(RUNS_SCHEMA.names[5:])]
    return spark.range(rows).select(
        F.date_format(F.date_add(F.lit("2017-06-30").cast("date"), day), "yyyy-M-d").alias("date"),
        F.lit("12:00:00").alias("time"),
        F.concat(F.lit("user_"), user).alias("username"),
        spread(3, 2).alias("wrist"),
        spread(4, 3).alias("activity"),
        *axes,
    )
