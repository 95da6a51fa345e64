"""Column expressions of the marts: magnitude, day, quoting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridelake.schema import EVENT_DATE


def sql_name(name: str) -> str:
    """The literal name, dots and backticks included, as an SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def quoted(name: str) -> Column:
    return F.col(sql_name(name))


def reading_sql(name: str) -> str:
    """A sensor reading as double; NaN counts as missing."""
    return f"nanvl(CAST({sql_name(name)} AS DOUBLE), CAST(NULL AS DOUBLE))"


def reading(name: str) -> Column:
    return F.expr(reading_sql(name))


def magnitude(prefix: str = "acceleration") -> Column:
    """Length of the (x, y, z) vector of one sample; NULL if any axis is missing."""
    axes = [reading_sql(f"{prefix}_{axis}") for axis in "xyz"]
    squares = (f"{axis} * {axis}" for axis in axes)
    return F.expr(f"sqrt({' + '.join(squares)})")


def parse_day(name: str, on_bad_date: str = "error") -> Column:
    """Day of a text date such as ``2017-6-30`` or ``2017/6/30``; a time may follow.

    Year, month and day must all be there. ``on_bad_date="error"`` fails the job on unreadable
    text, ``"null"`` gives NULL.
    """
    if on_bad_date not in ("error", "null"):
        raise ValueError(f"on_bad_date must be 'error' or 'null', not {on_bad_date!r}")
    text = sql_name(name)
    # One pattern over the text, for both separators; the cast reads what stands before a blank or T.
    found = rf"{text} RLIKE r'^\s*[+-]?\d+([-/])\d+\1\d'"
    day = f"CASE WHEN {found} THEN try_cast(translate({text}, '/', '-') AS DATE) END"
    if on_bad_date == "null":
        return F.expr(day)
    failure = f"CAST(raise_error(concat('unreadable date: ', {text})) AS DATE)"
    return F.expr(f"coalesce({day}, CASE WHEN {text} IS NOT NULL THEN {failure} END)")


def day(runs: DataFrame, on_bad_date: str = "error") -> Column:
    """Day of a sample: the lake's typed column if there, else parsed from ``date``."""
    if EVENT_DATE in runs.columns:
        return F.col(EVENT_DATE)
    if isinstance(runs.schema["date"].dataType, T.StringType):
        return parse_day("date", on_bad_date)
    return F.col("date").cast("date")
