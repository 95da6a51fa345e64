"""Labels of the coded columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridelake.functions.columns import quoted

# The code dictionaries of the data set.
ACTIVITY_LABELS = {0: "walking", 1: "running"}
WRIST_LABELS = {0: "left", 1: "right"}

LABELS_BY_COLUMN: dict[str, Mapping[int, str]] = {
    "activity": ACTIVITY_LABELS,
    "top_activity": ACTIVITY_LABELS,
    "wrist": WRIST_LABELS,
    "top_wrist": WRIST_LABELS,
}


def label(code: Column, labels: Mapping[int, str]) -> Column:
    """Label of an integer code; an unknown code gives its decimal text, NULL stays NULL."""
    code = code.cast("bigint")
    pairs = [F.lit(v).cast("bigint") if i == 0 else F.lit(v) for kv in labels.items() for i, v in enumerate(kv)]
    return F.coalesce(F.create_map(*pairs)[code], code.cast("string"))


def has_integer_codes(df: DataFrame, name: str) -> bool:
    """True if the column is there and holds integers; read from the schema, not the rows."""
    return name in df.columns and isinstance(df.schema[name].dataType, T.IntegralType)


def label_codes(df: DataFrame, columns: Sequence[str] = ("activity", "wrist")) -> DataFrame:
    """Replace codes by labels in those of ``columns`` that exist and hold integers."""
    replaced = {
        name: label(quoted(name), LABELS_BY_COLUMN[name])
        for name in columns
        if has_integer_codes(df, name)
    }
    return df.withColumns(replaced) if replaced else df
