"""Types of text columns, found in one aggregate pass over the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from stridelake.functions.columns import sql_name
from stridelake.functions.missing import is_missing_sql, missing_to_null_sql

_BOOLEAN = r"^(true|True|TRUE|false|False|FALSE)$"
_INTEGER = r"^[+-]?[0-9]+$"
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*([eE][+-]?[0-9]+)?|\.[0-9]+([eE][+-]?[0-9]+)?|(?i:inf|infinity))$"


def infer_types(
    raw: DataFrame, names: Sequence[str], when_empty: str | None = "double"
) -> dict[str, str]:
    """Narrowest type that holds every value: boolean, bigint, double, else string.

    A column without any value gets ``when_empty``, or is left out if that is None. An
    integer too long for bigint makes the column a string, so that no digit is lost.
    """
    return _types(raw.selectExpr(*_aggregates(names)).first(), names, when_empty) if names else {}


def infer_types_by(raw: DataFrame, names: Sequence[str], key: str) -> dict[object, dict[str, str]]:
    """``infer_types`` of the rows of each value of the column ``key``; columns without values are left out."""
    if not names:
        return {}
    found = raw.groupBy(key).agg(*map(F.expr, _aggregates(names))).collect()
    return {r[key]: _types(r, names, None) for r in found}


def wider(a: str | None, b: str | None) -> str | None:
    """The narrowest type that holds the values of both; None stands for no values."""
    if a is None or b is None or a == b:
        return a or b
    return "double" if {a, b} == {"bigint", "double"} else "string"


def _aggregates(names: Sequence[str]) -> list[str]:
    aggregates = []
    for i, name in enumerate(names):
        text = missing_to_null_sql(name)
        fits_long = f"try_cast(trim({text}) AS BIGINT) IS NOT NULL"
        integer = f"trim({text}) RLIKE r'{_INTEGER}'"
        tests = {
            "boolean": f"{text} RLIKE r'{_BOOLEAN}'",
            "bigint": f"{integer} AND {fits_long}",
            "double": f"trim({text}) RLIKE r'{_NUMBER}' AND (NOT {integer} OR {fits_long})",
        }
        aggregates.append(f"count({text}) AS filled_{i}")
        for kind, test in tests.items():
            aggregates.append(f"bool_and(CASE WHEN {text} IS NOT NULL THEN {test} END) AS {kind}_{i}")
    return aggregates


def _types(found: Row, names: Sequence[str], when_empty: str | None) -> dict[str, str]:
    types = {}
    for i, name in enumerate(names):
        if found[f"filled_{i}"] == 0:
            if when_empty:
                types[name] = when_empty
        else:
            kinds = (k for k in ("boolean", "bigint", "double") if found[f"{k}_{i}"])
            types[name] = next(kinds, "string")
    return types


def typed_sql(name: str, kind: str) -> str:
    """The text column as ``kind``; missing tokens, and text that does not fit, give NULL."""
    if kind == "string":
        return missing_to_null_sql(name)
    value = f"try_cast(trim({sql_name(name)}) AS {kind})"
    return f"nanvl({value}, CAST(NULL AS DOUBLE))" if kind == "double" else value


def misfit_sql(name: str, kind: str) -> str:
    """True where ``typed_sql`` loses a value, false otherwise."""
    if kind == "string":
        return "false"
    return f"({typed_sql(name, kind)} IS NULL AND NOT {is_missing_sql(name)})"
