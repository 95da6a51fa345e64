"""A flat folder of headered CSV files as one DataFrame.

A single multi-file CSV read maps the columns of every file by position. Files may have
different headers here, so they are grouped by header, each group is read as text columns
with its own names, and the groups are united by name.
"""

from __future__ import annotations

import csv
import functools
import re
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridelake.functions.columns import quoted, sql_name
from stridelake.sources.csv_records import records_of
from stridelake.sources.files import files_over, literal_path, start_reader

MALFORMED = "__malformed__"
TOO_LONG = "__too_long__"
FILE_PATH = "__file_path__"


@dataclass(frozen=True)
class HeaderGroup:
    """Files read together: same columns, same need for multi-line parsing.

    ``in_ranges``: values may hold line breaks, and Spark's multi-line reader won't do.
    """

    columns: tuple[str, ...]
    multi_line: bool
    paths: tuple[str, ...]
    in_ranges: bool = False


def read_csv_files(
    spark: SparkSession,
    paths: Sequence[str],
    multi_line: bool | None = None,
    folder: str | None = None,
    file_column: str | None = None,
) -> DataFrame:
    """All rows of the files as text columns, in first-seen column order, plus ``TOO_LONG``.

    ``multi_line`` says whether quoted values may hold line breaks. By default the lines are checked
    first (one scan of the text); ``False`` skips the check. Of the files that need it, those that one task would
    read anyway go to Spark's multi-line reader; larger ones, and a few that it would misread, are cut into
    records range by range (``csv_records``), in as many tasks as files without line breaks.

    If the files are all there is in ``folder``, scans of all of them name the folder alone,
    which is listed once instead of looking up every path. ``file_column`` names a column for the file's name.
    """
    groups = header_groups(spark, paths, multi_line, folder)
    _refuse_case_twins(spark, [c for g in groups for c in g.columns])
    names = list(dict.fromkeys(c for g in groups for c in g.columns))
    if file_column is not None:
        if file_column in names:
            raise ValueError(f"column {file_column} is reserved for the file's name")
        names.append(file_column)
    frames = [_read_group(spark, g, folder if len(groups) == 1 else None, file_column) for g in groups]
    united = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return united.select(*(quoted(n) for n in names), TOO_LONG)


def header_groups(
    spark: SparkSession, paths: Sequence[str], multi_line: bool | None = None, folder: str | None = None
) -> list[HeaderGroup]:
    headers = read_headers(spark, paths)
    if multi_line is None:
        whole = files_with_open_quotes(spark, paths, folder)
    else:
        whole = set(paths) if multi_line else set()
    ranged = files_over(spark, sorted(whole), split_bytes(spark))
    ranged |= files_with_carriage_returns(spark, sorted(whole - ranged))
    grouped: dict[tuple[tuple[str, ...], bool, bool], list[str]] = {}
    for path in sorted(paths):
        if path not in headers:
            raise ValueError(f"{path} has no header line")
        columns = column_names(headers[path])
        # Of a single column, a blank line and a blank value look alike to Spark's multi-line reader.
        in_ranges = path in ranged or path in whole and len(columns) == 1
        grouped.setdefault((columns, path in whole, in_ranges), []).append(path)
    return [HeaderGroup(c, multi, tuple(members), ranges) for (c, multi, ranges), members in grouped.items()]


def split_bytes(spark: SparkSession) -> int:
    """What a scan gives to a task at most."""
    in_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    return in_bytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))


def files_with_carriage_returns(spark: SparkSession, paths: Sequence[str]) -> set[str]:
    """Files in which Spark's multi-line reader, which knows one kind of line end a file, may take the wrong one."""
    if not paths:
        return set()
    text = spark.read.option("lineSep", "\n").text([literal_path(p) for p in paths])
    found = text.where(F.contains("value", F.lit("\r"))).select(F.col("_metadata.file_path").alias("path")).distinct()
    return {_listed(r["path"]) for r in found.collect()}


def column_names(header: str) -> tuple[str, ...]:
    """Names of a header record: blanks become ``Unnamed: i``, repeats get ``.1``, ``.2``, ..."""
    tokens = next(csv.reader([header]))
    named = [t if t else f"Unnamed: {i}" for i, t in enumerate(tokens)]
    taken = set(named)
    seen: dict[str, int] = {}
    names = []
    for name in named:
        repeat = seen.get(name, 0)
        seen[name] = repeat + 1
        unique = name
        while repeat and unique in taken:
            unique = f"{name}.{repeat}"
            repeat += 1
        taken.add(unique)
        names.append(unique)
    return tuple(names)


_HEADER_READERS = 32
_HEADER_BYTES = 1 << 12


def read_headers(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """First record of each file that has one, from the starts of the files; the same way for few and many."""
    read_header = functools.partial(_read_header, start_reader(spark, paths[0]))
    with ThreadPoolExecutor(_HEADER_READERS) as pool:
        found = pool.map(inheritable_thread_target(spark)(read_header), paths)
        return {path: header for path, header in zip(paths, found) if header is not None}


def _read_header(read_start: Callable[[str, int], tuple[str, bool]], path: str) -> str | None:
    size = _HEADER_BYTES
    while True:
        text, whole = read_start(path, size)
        header = first_record(text.removeprefix("\ufeff"), whole)
        if header is not None or whole:
            return header
        size *= 16


def first_record(text: str, whole: bool) -> str | None:
    """The first record after blank lines, or None if ``text``, the start of a file or the
    ``whole`` of it, holds none to its end."""
    lines = re.split(r"\r\n|\r|\n", text)
    if not whole:
        lines.pop()  # may be cut
    record = None
    for line in lines:
        if record is None:
            if not line.strip():
                continue
            record = line
        else:
            record += "\n" + line
        if record.count('"') % 2 == 0:  # no quote is open
            return record
    return record if whole else None


def files_with_open_quotes(
    spark: SparkSession, paths: Sequence[str], folder: str | None = None
) -> set[str]:
    """Files with a line that is not a whole number of well-quoted fields.

    If every line is one, no record goes over a line end. Lines without a quote drop out
    in the scan, and each map task keeps one row per file.
    """
    lines = _lines(spark, paths, folder).where(F.contains("value", F.lit('"')))
    open_files = lines.where(_open_quote(F.col("value"))).select("path").distinct()
    found = {_listed(r["path"]) for r in open_files.collect()}
    if not found <= set(paths):
        raise ValueError(f"the scan spells paths differently from the listing: {sorted(found - set(paths))[:3]}")
    return found


def _open_quote(line: Column) -> Column:
    """Pieces between quotes alternate outside, inside, outside, ...; an outside piece must
    be empty or touch a comma on the sides where it meets a quote."""
    pieces = F.split(line, '"', -1)
    count = F.size(pieces)

    def ill_placed(piece: Column, i: Column) -> Column:
        before = (i == 0) | piece.startswith(",")
        after = (i == count - 1) | piece.endswith(",")
        return (i % 2 == 0) & (piece != "") & ~(before & after)

    return (count % 2 == 0) | F.array_contains(F.transform(pieces, ill_placed), True)


def _lines(spark: SparkSession, paths: Sequence[str], folder: str | None) -> DataFrame:
    text = _scan(spark.read.format("text"), paths, folder)
    return text.select("value", F.col("_metadata.file_path").alias("path"))


def _scan(reader: DataFrameReader, paths: Sequence[str], folder: str | None) -> DataFrame:
    if folder is not None:
        whole = reader.option("pathGlobFilter", "*.csv").load(literal_path(folder))
        if len(whole._jdf.inputFiles()) == len(paths):  # no file came or went since they were listed
            return whole
    return reader.load([literal_path(p) for p in paths])


def _listed(metadata_path: str) -> str:
    """Path as listed; scan metadata gives it URL-encoded, with or without an empty host."""
    path = unquote(metadata_path)
    return "file:" + path[len("file://"):] if path.startswith("file:///") else path


def _read_group(spark: SparkSession, group: HeaderGroup, folder: str | None, file_column: str | None) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*group.columns, MALFORMED)])
    options = {
        "quote": '"',
        "escape": '"',
        "multiLine": group.multi_line,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": MALFORMED,
        "maxColumns": max(20480, 2 * len(group.columns)),
    }
    if group.in_ranges:
        parsed = F.from_csv("record", ", ".join(f"{sql_name(n)} STRING" for n in schema.names), {k: str(v) for k, v in options.items()})
        path, row = F.col("path").alias(FILE_PATH), parsed.alias("row")
        rows, file_path = records_of(spark, group.paths).select(path, row).select(FILE_PATH, "row.*"), F.col(FILE_PATH)
    else:
        rows = _scan(spark.read.format("csv").schema(schema).options(header=True, **options), group.paths, folder)
        if group.multi_line:  # lines of blanks are no rows
            rows = rows.where(f"{MALFORMED} IS NULL OR trim({MALFORMED}) <> ''")
        file_path = F.col("_metadata.file_path")
    # Rows with too few fields are padded; rows with too many must not lose any.
    unquoted = F.regexp_replace(MALFORMED, '"[^"]*"', "")
    fields = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","))) + 1
    too_long = F.coalesce(fields > len(group.columns), F.lit(False))
    columns = [quoted(c) for c in group.columns]
    if file_column is not None:
        # Scan metadata has paths URL-encoded, where a plus stands for itself.
        path = F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))
        columns.append(F.substring_index(path, "/", -1).alias(file_column))
    return rows.select(*columns, too_long.alias(TOO_LONG))


def _refuse_case_twins(spark: SparkSession, names: Sequence[str]) -> None:
    if spark.conf.get("spark.sql.caseSensitive") == "true":
        return
    spelled: dict[str, str] = {}
    for name in names:
        if spelled.setdefault(name.lower(), name) != name:
            raise ValueError(
                f"columns {spelled[name.lower()]!r} and {name!r} differ only by case; "
                "set spark.sql.caseSensitive=true to keep both"
            )
