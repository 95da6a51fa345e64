"""The daily marts.

One pass over the samples gives a small roll-up per (day, user, activity, wrist) whose
parts add up; all three marts are derived from it. The roll-up is a plain hash aggregate,
so every map task combines its rows first, and a user or day that holds a large part of
the samples arrives at the shuffle as a few rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridelake.functions.columns import day, magnitude, reading
from stridelake.schema import BATCH_ID, EVENT_MONTH

GYRO = ("gyro_x", "gyro_y", "gyro_z")


def rollup(runs: DataFrame, keep: Sequence[str] = (), on_bad_date: str = "error") -> DataFrame:
    """Additive measures per (date, username, activity, wrist) and the ``keep`` columns."""
    samples = runs.select(
        day(runs, on_bad_date).alias("date"),
        "username",
        "activity",
        "wrist",
        *keep,
        magnitude().alias("magnitude"),
        *(reading(g).alias(g) for g in GYRO),
    )
    measures = ["count(1) AS n", "max(magnitude) AS magnitude_max"]
    for name in ("magnitude", *GYRO):
        measures += [f"sum({name}) AS {name}_sum", f"count({name}) AS {name}_n"]
    return samples.groupBy("date", "username", "activity", "wrist", *keep).agg(*map(F.expr, measures))


def merged_rollup(rolled: DataFrame) -> DataFrame:
    """The rows of several batches added up; what is left out are the batches."""
    keys = ["date", "username", "activity", "wrist", *(c for c in (EVENT_MONTH,) if c in rolled.columns)]
    measures = [c for c in rolled.columns if c not in (*keys, BATCH_ID)]
    return rolled.groupBy(*keys).agg(*((F.max(c) if c.endswith("_max") else F.sum(c)).alias(c) for c in measures))


def summary_of(rolled: DataFrame) -> DataFrame:
    """``daily_user_summary`` from a roll-up.

    However many samples a user-day has, here it is one row per pair of codes. These rows
    are brought together once; totals per code and the final aggregate then need no
    further shuffle. The most common code is the smallest (-count, code) pair, so that
    equal counts give the smallest code.
    """
    coded = rolled.repartition("date", "username").selectExpr(
        "*",
        "sum(n) OVER (PARTITION BY date, username, activity) AS activity_total",
        "sum(n) OVER (PARTITION BY date, username, wrist) AS wrist_total",
    )
    aggregates = [
        f"{_smallest_of('activity_total', 'activity')} AS top_activity",
        f"{_smallest_of('wrist_total', 'wrist')} AS top_wrist",
        "sum(n) AS samples",
        "try_divide(sum(magnitude_sum), sum(magnitude_n)) AS avg_accel_magnitude",
        "max(magnitude_max) AS max_accel_magnitude",
        *(f"try_divide(sum({g}_sum), sum({g}_n)) AS avg_{g}" for g in GYRO),
    ]
    return coded.groupBy("date", "username").agg(*map(F.expr, aggregates))


def _smallest_of(total: str, code: str) -> str:
    return f"min(CASE WHEN {code} IS NOT NULL THEN struct(-{total} AS rank, {code} AS code) END).code"


def counts_of(rolled: DataFrame, code: str) -> DataFrame:
    """Samples per (date, username, code) from a roll-up."""
    return rolled.groupBy("date", "username", code).agg(F.sum("n").alias("cnt"))


def daily_user_summary(runs: DataFrame, on_bad_date: str = "error") -> DataFrame:
    return summary_of(rollup(runs, on_bad_date=on_bad_date))


def daily_user_summary_direct(runs: DataFrame, on_bad_date: str = "error") -> DataFrame:
    """The same mart as one plain aggregate with ordered ``mode``; used to check the other.

    ``mode`` keeps a map of values per group and leaves hash aggregation for sorting the
    samples once a task sees many groups, which is why this is not the main form.
    """
    samples = runs.select(
        day(runs, on_bad_date).alias("date"),
        "username",
        "activity",
        "wrist",
        magnitude().alias("magnitude"),
        *(reading(g).alias(g) for g in GYRO),
    )
    return samples.groupBy("date", "username").agg(
        F.mode("activity", True).alias("top_activity"),
        F.mode("wrist", True).alias("top_wrist"),
        F.count(F.lit(1)).alias("samples"),
        F.avg("magnitude").alias("avg_accel_magnitude"),
        F.max("magnitude").alias("max_accel_magnitude"),
        *(F.avg(g).alias(f"avg_{g}") for g in GYRO),
    )


def daily_code_counts(runs: DataFrame, code: str, on_bad_date: str = "error") -> DataFrame:
    return (
        runs.select(day(runs, on_bad_date).alias("date"), "username", code)
        .groupBy("date", "username", code)
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def daily_activity_counts(runs: DataFrame, on_bad_date: str = "error") -> DataFrame:
    return daily_code_counts(runs, "activity", on_bad_date)


def daily_wrist_counts(runs: DataFrame, on_bad_date: str = "error") -> DataFrame:
    return daily_code_counts(runs, "wrist", on_bad_date)


def most_common_code(runs: DataFrame, code: str, on_bad_date: str = "error") -> DataFrame:
    """Most common code per (date, username); ties give the smallest code."""
    counts = daily_code_counts(runs, code, on_bad_date)
    return counts.groupBy("date", "username").agg(F.expr(f"{_smallest_of('cnt', code)} AS top_{code}"))


def fallback_summary(runs: DataFrame, on_bad_date: str = "error") -> DataFrame:
    """The short summary served straight from the lake when no mart is there."""
    return (
        runs.select(day(runs, on_bad_date).alias("date"), "username", magnitude().alias("magnitude"))
        .groupBy("date", "username")
        .agg(
            F.count(F.lit(1)).alias("samples"),
            F.avg("magnitude").alias("avg_accel_magnitude"),
        )
    )
