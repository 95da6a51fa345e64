"""The report: one filtered slice of the marts, seen several ways."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from stridelake.functions.labels import label_codes
from stridelake.operators.figures import (
    daily_series,
    date_bounds,
    distribution,
    key_figures,
    share,
    user_list,
)
from stridelake.operators.selection import by_day_and_user, select_rows
from stridelake.schema import EVENT_MONTH

CODE_COLUMNS = ("activity", "wrist", "top_activity", "top_wrist")


def report(
    summary: DataFrame,
    counts: DataFrame,
    user: str | None = None,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
) -> dict[str, DataFrame]:
    """Plans only; each is run by its own action. Persist both tables to take several, or load them with
    ``keep_month`` so that each plan reads only the months of the range.

    ``users`` and ``bounds`` describe the whole summary, the rest the selection.
    """
    chosen = select_rows(summary, user, start, end).drop(EVENT_MONTH)
    chosen_counts = select_rows(counts, user, start, end).drop(EVENT_MONTH)
    return {
        "users": user_list(summary),
        "bounds": date_bounds(summary),
        "figures": key_figures(chosen),
        "series": daily_series(chosen),
        "daily_total": daily_series(chosen, per_user=False),
        "distribution": distribution(chosen_counts),
        "share": share(chosen_counts),
        "table": by_day_and_user(label_codes(chosen, CODE_COLUMNS)),
    }
