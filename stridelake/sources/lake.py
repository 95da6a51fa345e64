"""The sample lake: a Parquet folder partitioned by day."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridelake.functions.columns import parse_day, quoted, sql_name
from stridelake.functions.inference import infer_types, misfit_sql, typed_sql, wider
from stridelake.schema import BATCH_ID, EVENT_DATE, KINDS, SENSOR_TYPES, SOURCE_FILE
from stridelake.session import session_like
from stridelake.sources.csv_folder import TOO_LONG
from stridelake.sources.files import literal_path
from stridelake.sources.manifest import Part, latest_manifest
from stridelake.sources.tables import read_table, write_parts, write_table

MISFITS = "__misfits__"


@dataclass(frozen=True)
class Written:
    """What a batch has written: its rows, its partitions for a manifest, and their columns."""

    rows: int
    parts: dict[str, Part]
    schema: T.StructType


class Misfit(ValueError):
    """A value does not fit the type its column was written with."""

    def __init__(self, names: Sequence[str]):
        super().__init__(f"values do not fit the declared types of {', '.join(names)}")
        self.names = list(names)


def write_lake(
    raw: DataFrame,
    path: str,
    types: dict[str, str],
    batch_id: int | None = None,
    on_bad_date: str = "error",
    rebalance: bool = True,
    build: str | None = None,
) -> int | Written:
    """Type the text rows and write them by day; returns the number of rows, or what there is to say of a batch.

    Casts, checks and counts happen in the one write job. A row with more fields than its
    header fails it. A value that does not fit its type raises ``Misfit`` after the
    write of a whole lake, naming every such column; with a ``batch_id`` and the name of a ``build``, which writes
    partitions for a manifest, it fails the write.
    """
    names = [n for n in raw.columns if n in types]
    for reserved in (EVENT_DATE, BATCH_ID):
        if reserved in names:
            raise ValueError(f"column {reserved} is reserved for the lake")
    in_place = batch_id is not None
    columns = {n: typed_sql(n, types[n]) for n in names}
    if in_place:
        for n in names:
            text = f"concat('does not fit {types[n]}: ', {sql_name(n)})"
            columns[n] = f"CASE WHEN {misfit_sql(n, types[n])} THEN raise_error({text}) ELSE {columns[n]} END"
    failure = "raise_error('a row has more fields than its header')"
    columns[names[0]] = f"CASE WHEN {TOO_LONG} THEN {failure} ELSE {columns[names[0]]} END"
    # Columns typed by inference fit by construction; declared ones are checked while written.
    declared = [n for n in names if not in_place and types[n] == SENSOR_TYPES.get(n) != "string"]
    bits = [f"CASE WHEN {misfit_sql(n, types[n])} THEN {1 << i} ELSE 0 END" for i, n in enumerate(declared)]
    rows = raw.selectExpr(
        *(f"{sql} AS {sql_name(n)}" for n, sql in columns.items()),
        f"{' + '.join(bits) or '0'} AS {MISFITS}",
    )
    partition_by = []
    if "date" in names:
        rows = rows.withColumn(EVENT_DATE, parse_day("date", on_bad_date))
        partition_by.append(EVENT_DATE)
    if in_place:
        rows = rows.withColumn(BATCH_ID, F.lit(batch_id).cast("bigint"))
        partition_by.append(BATCH_ID)
    sort_by = ["username"] if "username" in names else []
    if in_place:
        rows = rows.drop(MISFITS)
        parts, found = write_parts(rows, path, "", build, partition_by, sort_by=sort_by, rebalance=rebalance)
        return Written(found["rows"], parts, rows.schema)
    found = write_table(
        rows,
        path,
        partition_by=partition_by,
        sort_by=sort_by,
        rebalance=rebalance,
        measure={"misfits": f"bit_or({MISFITS})"},
        drop=[MISFITS],
    )
    lossy = [n for i, n in enumerate(declared) if (found["misfits"] or 0) >> i & 1]
    if lossy:
        raise Misfit(lossy)
    return found["rows"]


def column_types(
    raw: DataFrame, known: dict[str, str] | None = None, when_empty: str | None = "double"
) -> dict[str, str]:
    """Type of each raw column: ``known``, else declared for sensor columns, else inferred.

    An undeclared column without values gets ``when_empty``, or is left out if that is None.
    """
    known = {**SENSOR_TYPES, **(known or {})}
    names = [n for n in raw.columns if n != TOO_LONG]
    inferred = infer_types(raw, [n for n in names if n not in known], when_empty)
    return {n: known.get(n) or inferred[n] for n in names if n in known or n in inferred}


def read_lake(spark: SparkSession, path: str, keep_batch_id: bool = False) -> DataFrame:
    """The lake as a lazy, pruned scan, with its ``event_date`` if it has one.

    Also reads a Parquet file or folder written by other tools, including one whose ``date`` is a nanosecond timestamp.
    Spark reads that only as a number and only with a setting, which a session of its own has; that of
    ``spark`` stays as it is. A ``date`` that the file itself has as a number is refused.
    """
    nanoseconds = False
    plain = spark.conf.get(_NANOSECONDS) == "false"
    session = spark if plain else session_like(spark, **{_NANOSECONDS: "false"})
    try:
        runs = read_table(session, path)
    except PySparkException as e:
        if "PARQUET_TYPE_ILLEGAL" not in f"{e.getCondition()} {e}" and "NANOS" not in str(e):
            raise
        nanoseconds = True
        runs = session_like(spark, **{_NANOSECONDS: "true"}).read.parquet(literal_path(path))
    if "date" in runs.columns and isinstance(runs.schema["date"].dataType, T.IntegralType):
        if not nanoseconds:
            raise ValueError(f"column date of {path} is a number, not a date")
        epoch = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
        runs = runs.withColumn("date", F.expr(f"timestampadd(MICROSECOND, date div 1000, {epoch})"))
    manifest = latest_manifest(spark, path)
    if manifest is not None and KINDS in manifest.notes:
        runs = _with_kinds(runs, manifest.notes[KINDS].values())
    return (runs if keep_batch_id else runs.drop(BATCH_ID)).drop(SOURCE_FILE)


def _with_kinds(runs: DataFrame, of_batches: Iterable[Mapping[str, str]]) -> DataFrame:
    """Undeclared columns, kept as text, with the type that holds the values of all batches."""
    kinds: dict[str, str] = {}
    for found in of_batches:
        kinds |= {name: wider(kinds.get(name), kind) for name, kind in found.items()}
    own = {*SENSOR_TYPES, EVENT_DATE, BATCH_ID, SOURCE_FILE}
    typed = {n: F.expr(typed_sql(n, kinds.get(n, "double"))) for n in runs.columns if n not in own}
    return runs.select(*(typed[n].alias(n) if n in typed else quoted(n) for n in runs.columns))


_NANOSECONDS = "spark.sql.legacy.parquet.nanosAsLong"


def register_runs(spark: SparkSession, source: str | DataFrame, name: str = "runs") -> DataFrame:
    """Make a lake path or a DataFrame available to SQL under ``name``."""
    runs = read_lake(spark, source) if isinstance(source, str) else source
    runs.createOrReplaceTempView(name)
    return runs
