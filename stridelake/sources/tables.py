"""Parquet tables kept as folders: the lake, the roll-up and the marts.

Each folder carries its schema in ``_columns.json``. Reading with that schema needs no
footer scan, keeps types when only some files have a column, and types the partition
columns even when all their values are NULL.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import replace
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridelake.functions.columns import quoted
from stridelake.sources import files
from stridelake.sources.files import Entry
from stridelake.sources.manifest import BUILD, Part, Table, resolve, table_path

_COLUMNS_FILE = "_columns.json"
# Of a file: a scan can't divide a row group, which of rows that compress well would hold tens of millions.
ROWS_A_FILE = 1_000_000


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    dynamic: bool = False,
    rebalance: bool = True,
    measure: dict[str, str] | None = None,
    drop: Sequence[str] = (),
    build: str | None = None,
) -> dict[str, object]:
    """Write ``df`` as Parquet, replacing the folder, or only the partitions it holds, or, with ``build``,
    adding a folder of that name to them, which a manifest will name.

    Rows are brought together by partition value with a rebalance: adaptive execution
    splits a value that holds much of the data over several tasks and joins small ones,
    so neither one huge task nor many tiny files result. With ``rebalance=False`` each
    task writes what it reads, for input already grouped by partition value.

    Returns the ``measure`` aggregates (SQL) and ``rows``, counted in the writing stage itself:
    no second scan, and no double count when a lost executor's map tasks are re-run. The
    columns in ``drop`` are only there to be measured.
    """
    spark = df.sparkSession
    kept = df.drop(*drop).schema
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    order = [*partition_by, *sort_by]
    if order:
        df = df.sortWithinPartitions(*order)
    counted = Observation()
    df = df.observe(counted, F.count(F.lit(1)).alias("rows"), *(F.expr(sql).alias(n) for n, sql in (measure or {}).items()))
    df = df.drop(*drop)
    if build is not None:
        writer = df.withColumn(BUILD, F.lit(build)).write.mode("append").option("maxRecordsPerFile", ROWS_A_FILE)
        writer.partitionBy(*partition_by, BUILD).parquet(path)
        return counted.get
    if dynamic:
        _keep_schema(spark, path, kept)
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", ROWS_A_FILE)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    if not dynamic:
        _keep_schema(spark, path, kept)
    return counted.get


def _keep_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    known = table_schema(spark, path)
    merged = merged_schema(known, schema, path)
    if merged != known:
        files.write_text(spark, f"{path}/{_COLUMNS_FILE}", merged.json())


def merged_schema(known: T.StructType | None, schema: T.StructType, path: str) -> T.StructType:
    """A known schema gains new columns but may not change a type."""
    if known is None:
        return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
    merged = T.StructType(list(known.fields))
    for f in schema:
        if f.name not in known.names:
            merged.add(f.name, f.dataType, True)
        elif known[f.name].dataType != f.dataType:
            raise ValueError(
                f"column {f.name} of {path} is {known[f.name].dataType.simpleString()}, new rows "
                f"have {f.dataType.simpleString()}: rebuild from all files"
            )
    return merged


def write_parts(df: DataFrame, root: str, name: str, build: str, partition_by: Sequence[str], **how) -> tuple[dict[str, Part], dict]:
    """The rows as new partition folders of a table of a manifest that is yet to be written; also what was measured."""
    path = table_path(root, name)
    measured = write_table(df, path, partition_by, build=build, **how)
    found = partition_folders(df.sparkSession, path, "/".join([*(f"{c}=*" for c in partition_by), f"{BUILD}={build}"]))
    return {f.rpartition("/")[0]: Part(build) for f in found}, measured


def read_parts(spark: SparkSession, root: str, name: str, table: Table, parts: Iterable[str] | None = None) -> DataFrame:
    """Scan of the partitions of a table, or of some of them, with the columns in stored order."""
    return _scan_parts(spark, root, name, table, table.parts if parts is None else parts).select(*_columns(table.schema))


def _scan_parts(spark: SparkSession, root: str, name: str, table: Table, parts: Iterable[str]) -> DataFrame:
    path = table_path(root, name)
    folders = [f"{files.literal_path(path)}/{table.folder(p)}" for p in parts]
    if not folders:
        return spark.createDataFrame([], table.schema)
    schema = T.StructType([*table.schema.fields, T.StructField(BUILD, T.StringType())])
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def sealed(spark: SparkSession, root: str, name: str, table: Table, parts: Iterable[str]) -> dict[str, Part]:
    """The partitions with the length, rows and a digest of the rows of each of their files.

    One scan; the driver gets a row for each file.
    """
    parts = list(parts)
    lengths = {p: {e.name: e.length for e in found} for p, found in listed_parts(spark, root, name, table, parts).items()}
    out = {p: {} for p in parts}
    if parts:
        of_row = F.xxhash64(*_columns(table.schema)).bitwiseAND(F.lit((1 << 31) - 1))
        scan = _scan_parts(spark, root, name, table, parts).groupBy(F.col("_metadata.file_path").alias("path"))
        of_folder = {table.folder(p): p for p in parts}
        depth = parts[0].count("/") + 2
        for r in scan.agg(F.count(F.lit(1)).alias("rows"), F.sum(of_row).alias("digest")).collect():
            *folders, file = unquote(r["path"]).split("/")
            part = of_folder["/".join(folders[-depth:])]
            out[part][file] = (lengths[part].get(file, -1), r["rows"], r["digest"])
    for p in parts:  # files without rows
        for file, length in lengths[p].items():
            out[p].setdefault(file, (length, 0, 0))
    return {p: replace(table.parts[p], files=out[p]) for p in parts}


def listed_parts(spark: SparkSession, root: str, name: str, table: Table, parts: Iterable[str]) -> dict[str, list[Entry]]:
    """The data files that there are in each partition's folder, by one listing of the table."""
    of_folder = {table.folder(p): p for p in parts}
    found: dict[str, list[Entry]] = {p: [] for p in of_folder.values()}
    if found:
        depth = next(iter(of_folder)).count("/") + 1
        pattern = files.literal_path(table_path(root, name)) + "/*=*" * (depth - 1) + f"/{BUILD}=*/*"
        for e in files.glob_entries(spark, pattern):
            part = of_folder.get("/".join(e.path.split("/")[-1 - depth : -1]))
            if part is not None and not e.name.startswith(("_", ".")):
                found[part].append(e)
    return found


class Damaged(ValueError):
    """The files of a table are not those that its manifest names."""


def check_parts(spark: SparkSession, root: str, name: str, table: Table, parts: Iterable[str]) -> None:
    """Raises ``Damaged`` unless the partitions' files are there, no others are, and their rows are as written."""
    parts = [p for p in parts if table.parts[p].files is not None]
    for p, there in listed_parts(spark, root, name, table, parts).items():
        if {e.name: e.length for e in there} != {f: n for f, (n, _, _) in table.parts[p].files.items()}:
            raise Damaged(f"{name}/{p}: files differ from the manifest")
    found = sealed(spark, root, name, table, parts)
    for p in parts:
        if found[p].files != table.parts[p].files:
            raise Damaged(f"{name}/{p}: rows differ from the manifest")


def table_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The stored schema, or None for a folder or file written by others."""
    found = resolve(spark, path)
    if found is not None:
        return found[0].tables[found[1]].schema
    stored = f"{path}/{_COLUMNS_FILE}"
    if not files.exists(spark, stored):
        return None
    return T.StructType.fromJson(json.loads(files.read_text(spark, stored)))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Scan a table, as its manifest has it now if it has one; columns come in stored order.

    A missing path raises FileNotFoundError.
    """
    found = resolve(spark, path)
    if found is not None:
        manifest, name = found
        return read_parts(spark, manifest.root, name, manifest.tables[name])
    if not files.exists(spark, path):
        raise FileNotFoundError(f"no table at {path}")
    schema = table_schema(spark, path)
    if schema is None:
        return spark.read.parquet(files.literal_path(path))
    return spark.read.schema(schema).parquet(files.literal_path(path)).select(*_columns(schema))


def check_footers(spark: SparkSession, path: str) -> None:
    """Reads the footer of every file, as a Spark job; raises if one is not Parquet."""
    spark.read.option("mergeSchema", "true").parquet(files.literal_path(path))


def read_partitions(spark: SparkSession, path: str, folders: Iterable[str]) -> DataFrame:
    """Scan only the given partition folders (globs allowed), so only they are listed."""
    schema = table_schema(spark, path)
    paths = [f"{files.literal_path(path)}/{f}" for f in folders]
    return spark.read.schema(schema).option("basePath", path).parquet(*paths).select(*_columns(schema))


def partition_folders(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """Partition folders below ``path`` that match the glob, relative to it."""
    depth = pattern.count("/") + 1
    return ["/".join(p.split("/")[-depth:]) for p in files.glob(spark, f"{files.literal_path(path)}/{pattern}")]


def _columns(schema: T.StructType) -> list[Column]:
    return [quoted(name) for name in schema.names]
