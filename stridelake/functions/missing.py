"""Missing-value tokens of CSV text."""

from __future__ import annotations

from stridelake.functions.columns import sql_name

# The texts pandas' CSV reader takes as missing by default.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


_TOKEN_LIST = ", ".join(f"'{token}'" for token in NA_TOKENS)


def is_missing_sql(name: str) -> str:
    """True where the text column is NULL or holds one of the tokens."""
    return f"({sql_name(name)} IS NULL OR {sql_name(name)} IN ({_TOKEN_LIST}))"


def missing_to_null_sql(name: str) -> str:
    return f"CASE WHEN {sql_name(name)} NOT IN ({_TOKEN_LIST}) THEN {sql_name(name)} END"
