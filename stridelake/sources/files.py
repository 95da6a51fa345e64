"""Folder listing, existence checks and swaps on any Hadoop file system."""

from __future__ import annotations

import functools
import re
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

_GLOB_CHARACTERS = re.compile(r"([\\*?\[\]{}])")
_STATUS = re.compile(r"\{path=(.*?); isDirectory=(true|false); (?:length=(\d+); )?.*?modification_time=(\d+); ")


@dataclass(frozen=True)
class Entry:
    path: str
    is_directory: bool
    length: int
    modified: int  # milliseconds since 1970

    @property
    def name(self) -> str:
        return self.path.rsplit("/", 1)[-1]


def _at(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _at(spark, path)
    return fs.exists(jpath)


def list_folder(spark: SparkSession, folder: str) -> list[Entry]:
    """Entries directly in the folder; none if there is no such folder."""
    fs, jpath = _at(spark, folder)
    if not fs.exists(jpath):
        return []
    return _entries(spark, fs.listStatus(jpath))


def _entries(spark: SparkSession, statuses) -> list[Entry]:
    # One call for the whole listing: asking the JVM entry by entry takes minutes at a
    # million files.
    text = spark._jvm.org.apache.commons.lang3.ArrayUtils.toString(statuses)
    found = _STATUS.findall(text)
    if len(found) == len(statuses):
        return [Entry(path, kind == "true", int(length or 0), int(time)) for path, kind, length, time in found]
    return [Entry(s.getPath().toString(), s.isDirectory(), s.getLen(), s.getModificationTime()) for s in statuses]


def list_csv_files(spark: SparkSession, raw_dir: str) -> list[Entry]:
    """The ``*.csv`` files directly in ``raw_dir``, in name order; dot-files are left out.

    Spark silently skips files whose name starts with an underscore, so those are refused.
    An empty file has no header and is refused as well.
    """
    files = [
        e
        for e in list_folder(spark, raw_dir)
        if e.name.endswith(".csv") and not e.name.startswith(".")
    ]
    for e in files:
        if e.name.startswith("_"):
            raise ValueError(f"rename {e.path}: Spark does not read names starting with '_'")
        if e.is_directory:
            raise ValueError(f"{e.path} is a folder, not a CSV file")
        if e.length == 0:
            raise ValueError(f"{e.path} is empty: no header to read")
    return sorted(files, key=lambda e: e.path)


def files_over(spark: SparkSession, paths: Sequence[str], size: int) -> set[str]:
    """Those of the files that are longer than ``size`` bytes."""
    folders = {p.rpartition("/")[0] for p in paths}
    lengths = {e.path: e.length for folder in folders for e in list_folder(spark, folder)}
    return {p for p in paths if lengths[p] > size}


def is_flat(spark: SparkSession, folder: str) -> bool:
    return not any(e.is_directory for e in list_folder(spark, folder))


def glob(spark: SparkSession, pattern: str) -> list[str]:
    return [e.path for e in glob_entries(spark, pattern)]


def glob_entries(spark: SparkSession, pattern: str) -> list[Entry]:
    fs, jpath = _at(spark, pattern)
    statuses = fs.globStatus(jpath)
    return _entries(spark, statuses) if statuses else []


def literal_path(path: str) -> str:
    """The path with glob characters escaped, for Spark's readers."""
    return _GLOB_CHARACTERS.sub(r"\\\1", path)


def rename(spark: SparkSession, old: str, new: str) -> bool:
    fs, source = _at(spark, old)
    return fs.rename(source, _at(spark, new)[1])


def delete(spark: SparkSession, path: str) -> None:
    fs, jpath = _at(spark, path)
    fs.delete(jpath, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, jpath = _at(spark, path)
    out = fs.create(jpath, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, jpath = _at(spark, path)
    stream = fs.open(jpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def start_reader(spark: SparkSession, sample_path: str) -> Callable[[str, int], tuple[str, bool]]:
    """A function that gives the text of the first bytes of a file, and whether that is all
    of it; for many files on the file system of ``sample_path``."""
    # Looked up once: each dotted name costs a round trip per part.
    path_class = spark._jvm.org.apache.hadoop.fs.Path
    bounded_class = spark._jvm.org.apache.commons.io.input.BoundedInputStream
    to_text = spark._jvm.org.apache.commons.io.IOUtils.toString
    fs, _ = _at(spark, sample_path)

    def read_start(path: str, size: int) -> tuple[str, bool]:
        stream = fs.open(path_class(path))
        try:
            text = to_text(bounded_class(stream, size), "UTF-8")
            return text, stream.getPos() < size
        finally:
            stream.close()

    return read_start


def write_swapped(spark: SparkSession, *waves: dict[str, Callable[[str], object]]) -> dict[str, object]:
    """Write each target to a staging folder beside it, then swap all of them in.

    A wave maps a path to a function that writes to the staging path it is given. The
    writes of one wave run at the same time, the waves one after the other. Until every
    write has succeeded the old folders stay as they are, and a folder may be read while its
    replacement is written. Rename is a metadata operation on HDFS and local disks.
    """
    token = uuid.uuid4().hex
    staged = {target: _beside(target, f"staging-{token}") for wave in waves for target in wave}
    results: dict[str, object] = {}
    try:
        for wave in waves:
            jobs = [functools.partial(write, staged[target]) for target, write in wave.items()]
            results |= zip(wave, side_by_side(spark, jobs))
        for target, staging in staged.items():
            _swap(spark, staging, target, _beside(target, f"retired-{token}"))
    finally:
        for staging in staged.values():
            fs, jpath = _at(spark, staging)
            if fs.exists(jpath):
                fs.delete(jpath, True)
    return results


def side_by_side(spark: SparkSession, jobs: Sequence[Callable[[], object]]) -> list[object]:
    """Run independent jobs at the same time, so that one fills what the others leave idle."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    return [job.result() for job in started]


def _beside(target: str, suffix: str) -> str:
    parent, slash, name = target.rstrip("/").rpartition("/")
    return f"{parent}{slash}.{name}.{suffix}"


def _swap(spark: SparkSession, staging: str, target: str, retired: str) -> None:
    fs, new = _at(spark, staging)
    _, old = _at(spark, target)
    _, aside = _at(spark, retired)
    had_old = fs.exists(old)
    if had_old and not fs.rename(old, aside):
        raise OSError(f"cannot move {target} aside")
    if not fs.rename(new, old):
        if had_old:
            fs.rename(aside, old)
        raise OSError(f"cannot move the new data to {target}")
    if had_old:
        fs.delete(aside, True)
    spark.catalog.refreshByPath(target)
