"""Manifests: tables below one folder that change at one instant.

Each writing of a partition has a folder of its own, ``<partition>/build=<token>``, and nothing is ever written
into a folder again. Which folders make up the tables is said by the manifest with the highest number
below ``_manifests``. It gets there by one rename, so a reader that has taken a manifest sees tables of
one and the same state, whatever is written meanwhile, and a run that dies leaves folders that nobody reads.

There is one writer at a time. The folders of the last ``KEPT`` manifests stay, those of older ones are deleted.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from stridelake.sources import files

MANIFESTS = "_manifests"
BUILD = "build"
KEPT = 2


@dataclass(frozen=True)
class Part:
    """One partition: the folder it was written to and, where they were taken down, its files.

    ``files`` gives length, rows and a digest of the rows for each file name; ``covers`` the batches
    whose rows were put together here.
    """

    build: str
    files: dict[str, tuple[int, int, int]] | None = None
    covers: tuple[int, ...] = ()


@dataclass(frozen=True)
class Table:
    schema: T.StructType
    parts: dict[str, Part] = field(default_factory=dict)

    def folder(self, part: str) -> str:
        return f"{part}/{BUILD}={self.parts[part].build}" if part else f"{BUILD}={self.parts[part].build}"


@dataclass(frozen=True)
class Manifest:
    """Tables by their folder below ``root`` ("" is the root itself), and notes of whoever wrote them."""

    root: str
    version: int = 0
    tables: dict[str, Table] = field(default_factory=dict)
    notes: dict[str, object] = field(default_factory=dict)

    def following(self, tables: dict[str, Table], **notes: object) -> Manifest:
        return replace(self, version=self.version + 1, tables={**self.tables, **tables}, notes={**self.notes, **notes})

    def parts(self, name: str) -> dict[str, Part]:
        return self.tables[name].parts if name in self.tables else {}


def new_build() -> str:
    return f"b{uuid.uuid4().hex}"


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}" if name else root.rstrip("/")


def latest_manifest(spark: SparkSession, root: str) -> Manifest | None:
    numbers = _numbers(spark, root)
    return _read(spark, root, numbers[-1]) if numbers else None


def resolve(spark: SparkSession, path: str) -> tuple[Manifest, str] | None:
    """The manifest and table that ``path`` stands for: a folder with manifests, or a table below one."""
    path = path.rstrip("/")
    own = latest_manifest(spark, path)
    if own is not None and "" in own.tables:
        return own, ""
    parent, slash, name = path.rpartition("/")
    above = latest_manifest(spark, parent) if slash and parent else None
    return (above, name) if above is not None and name in above.tables else None


def commit(spark: SparkSession, manifest: Manifest, kept: int = KEPT) -> None:
    """Makes the manifest the current one. A manifest of the same number means another writer: that is refused."""
    target = _manifest_path(manifest.root, manifest.version)
    if files.exists(spark, target):
        raise RuntimeError(f"{target} exists: something else writes to {manifest.root}")
    staged = f"{manifest.root.rstrip('/')}/{MANIFESTS}/.{uuid.uuid4().hex}"
    files.write_text(spark, staged, json.dumps(_as_json(manifest)))
    if not files.rename(spark, staged, target):
        raise OSError(f"cannot move {staged} to {target}")
    for name in manifest.tables:
        spark.catalog.refreshByPath(table_path(manifest.root, name))
    _retire(spark, manifest.root, kept)


def _retire(spark: SparkSession, root: str, kept: int) -> None:
    numbers = _numbers(spark, root)
    used = {f for n in numbers[-kept:] for f in _folders(_read(spark, root, n))}
    for number in numbers[:-kept]:
        for folder in _folders(_read(spark, root, number)) - used:
            files.delete(spark, folder)
        files.delete(spark, _manifest_path(root, number))


def vacuum(spark: SparkSession, root: str) -> list[str]:
    """Deletes the folders that no manifest names, which runs that died have left; not beside a running writer."""
    manifests = [_read(spark, root, n) for n in _numbers(spark, root)]
    used = {f for m in manifests for f in _folders(m)}
    depths = {(name, len(part.split("/")) if part else 0) for m in manifests for name, t in m.tables.items() for part in t.parts}
    kept, found = {_plain(f) for f in used}, []
    for name, depth in depths:
        pattern = files.literal_path(table_path(root, name)) + "/*=*" * depth + f"/{BUILD}=*"
        found += [f for f in files.glob(spark, pattern) if _plain(f) not in kept]
    for folder in found:
        files.delete(spark, folder)
    return found


def _plain(path: str) -> str:
    """The path without scheme and host, which listings add."""
    return re.sub(r"/+", "/", re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", path))


def _folders(manifest: Manifest) -> set[str]:
    return {f"{table_path(manifest.root, name)}/{t.folder(part)}" for name, t in manifest.tables.items() for part in t.parts}


def _manifest_path(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/{MANIFESTS}/{number:010d}.json"


def _numbers(spark: SparkSession, root: str) -> list[int]:
    names = (e.name for e in files.list_folder(spark, f"{root.rstrip('/')}/{MANIFESTS}"))
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))


def _read(spark: SparkSession, root: str, number: int) -> Manifest:
    stored = json.loads(files.read_text(spark, _manifest_path(root, number)))
    tables = {
        name: Table(
            T.StructType.fromJson(t["columns"]),
            {p: Part(b["build"], _files_of(b.get("files")), tuple(b.get("covers", ()))) for p, b in t["parts"].items()},
        )
        for name, t in stored["tables"].items()
    }
    return Manifest(root, number, tables, stored["notes"])


def _files_of(stored: dict[str, list] | None) -> dict[str, tuple[int, int, int]] | None:
    return None if stored is None else {name: (f[0], f[1], f[2]) for name, f in stored.items()}


def _as_json(manifest: Manifest) -> dict:
    def part(p: Part) -> dict:
        return {"build": p.build} | ({} if p.files is None else {"files": p.files}) | ({"covers": p.covers} if p.covers else {})

    return {
        "notes": manifest.notes,
        "tables": {
            name: {"columns": t.schema.jsonValue(), "parts": {k: part(p) for k, p in t.parts.items()}}
            for name, t in manifest.tables.items()
        },
    }


def parts_with(parts: Iterable[str], column: str, values: set[str]) -> list[str]:
    """The partitions (``a=1/b=2``) whose ``column`` has one of the values, as written in the folder's name."""
    return [p for p in parts if value_of(p, column) in values]


def value_of(part: str, column: str) -> str | None:
    return next((v for k, _, v in (piece.partition("=") for piece in part.split("/")) if k == column), None)
