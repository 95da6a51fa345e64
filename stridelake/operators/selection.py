"""Filters and orders of the report."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelake.schema import EVENT_MONTH

ALL_USERS = "All"


def select_rows(
    df: DataFrame,
    user: str | None = None,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
) -> DataFrame:
    """Rows of one user and of the days from ``start`` to ``end``, both included.

    No user, or ``"All"``, keeps every user. A missing bound keeps every day on its side.
    The predicates are plain comparisons on stored columns: where the rows still have their
    month column it prunes partitions, user and days are pushed into the Parquet scan.
    """
    monthly = EVENT_MONTH in df.columns
    if user is not None and user != ALL_USERS:
        df = df.where(F.col("username") == user)
    if start is not None:
        df = df.where(F.col("date") >= as_day(start))
        df = df.where(F.col(EVENT_MONTH) >= F.trunc(as_day(start), "month")) if monthly else df
    if end is not None:
        df = df.where(F.col("date") <= as_day(end))
        df = df.where(F.col(EVENT_MONTH) <= as_day(end)) if monthly else df
    return df


def as_day(value: dt.date | str) -> Column:
    """A day given as date, datetime or ISO text, as a date literal."""
    if isinstance(value, dt.datetime):
        value = value.date()
    return F.lit(value).cast("date")


def by_day_and_user(df: DataFrame) -> DataFrame:
    """Order of the summary; missing keys come last."""
    return df.orderBy(F.asc_nulls_last("date"), F.asc_nulls_last("username"))


def by_day_user_and_count(df: DataFrame, code: str) -> DataFrame:
    """Order of a count mart: most frequent code first, equal counts by code."""
    return df.orderBy(
        F.asc_nulls_last("date"),
        F.asc_nulls_last("username"),
        F.desc_nulls_last("cnt"),
        F.asc_nulls_last(code),
    )


def latest(summary: DataFrame, n: int = 100) -> DataFrame:
    """The ``n`` rows with the latest days; equal days by username. One pass: every task keeps its ``n`` best."""
    return summary.orderBy(F.desc_nulls_last("date"), F.asc_nulls_last("username")).limit(n)
