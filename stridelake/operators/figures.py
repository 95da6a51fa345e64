"""Figures of the report, computed from the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridelake.functions.columns import quoted
from stridelake.functions.labels import LABELS_BY_COLUMN, has_integer_codes, label


def key_figures(summary: DataFrame) -> DataFrame:
    """Days, users, samples, and the mean of the daily means (not weighted by samples).

    One row also for an empty selection: counts 0, mean NULL.
    """
    return summary.agg(
        F.count_distinct("date").alias("days"),
        F.count_distinct("username").alias("users"),
        F.coalesce(F.sum("samples"), F.lit(0)).cast("bigint").alias("samples"),
        F.avg("avg_accel_magnitude").alias("avg_accel_magnitude"),
    )


def date_bounds(df: DataFrame) -> DataFrame:
    return df.agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def user_list(df: DataFrame) -> DataFrame:
    """Distinct users in order, without NULL."""
    return df.select("username").where(F.col("username").isNotNull()).distinct().orderBy("username")


def daily_series(summary: DataFrame, per_user: bool = True) -> DataFrame:
    """Samples per day, one line per user; ``per_user=False`` adds the users up."""
    if not per_user:
        total = F.sum("samples").alias("samples")
        return summary.groupBy("date").agg(total).orderBy(F.asc_nulls_last("date"))
    return summary.select("date", "username", "samples").orderBy(
        F.asc_nulls_last("date"), F.asc_nulls_last("username")
    )


def distribution(counts: DataFrame, code: str = "activity") -> DataFrame:
    """Samples per label; a column that holds no integers is grouped by its own values."""
    key = quoted(code)
    if has_integer_codes(counts, code):
        key = label(key, LABELS_BY_COLUMN[code])
    return (
        counts.select(key.alias(code), "cnt")
        .where(F.col(code).isNotNull())
        .groupBy(code)
        .agg(F.sum("cnt").alias("cnt"))
    )


def share(counts: DataFrame, code: str = "activity") -> DataFrame:
    """``distribution`` with each label's part of the total.

    The total is a scalar subquery, not a window over all labels, which would bring every
    label to one task.
    """
    labelled = distribution(counts, code)
    total = distribution(counts, code).agg(F.sum("cnt")).scalar()
    return labelled.withColumn("share", F.try_divide(F.col("cnt").cast("double"), total.cast("double")))
