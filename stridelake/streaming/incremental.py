"""Incremental run: only new and changed files are read, only the months they touch are rebuilt.

A file stream finds the files that came and remembers them in its checkpoint. The lake keeps a ledger of the
files it holds: name, length, time and batch. Files that the ledger has otherwise than the folder were rewritten,
those that the folder has no more were deleted; both are corrected, in a batch of their own. Each batch
ends in the same tables as a full rebuild would:

* its rows go to the lake partitions (event_date, batch_id), with the name of their file; in partitions
  that hold rows of a rewritten or deleted file the others are written again;
* the roll-up of the (event_month, batch_id) it touched is made again from these; it adds up over batches, so
  nothing else of the lake is read;
* the marts of the months it touched are rebuilt from all roll-up rows of those months.

Lake and marts each change at one instant, by a manifest. The lake's says which partitions changed in which
version, the marts' which version they show, so a run that finds marts behind the lake first makes
them follow. A batch that is run again replaces its own partitions, and a run that dies leaves nothing to mend.

Both carry the checkpoint's id, and the checkpoint a note once both hold rows. A run whose lake, marts and
checkpoint do not belong together is refused before anything is written.

Columns that are not declared are kept as text, so that no later file can fail to fit them. The lake's manifest
notes for each batch the narrowest type of their values; readers of the lake see the type that holds those of
all batches, which is the type that a full run would give (``read_lake``).
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridelake.functions.columns import quoted
from stridelake.functions.inference import infer_types_by
from stridelake.plans.build import LAKE_VERSION, RUN, roll_up, write_marts, write_rollup
from stridelake.schema import BATCH_ID, EVENT_DATE, EVENT_MONTH, KINDS, NO_VALUE, ROLLUP, SENSOR_TYPES, SOURCE_FILE
from stridelake.session import sized_session
from stridelake.sources.csv_folder import TOO_LONG, read_csv_files
from stridelake.sources.files import Entry, exists, list_csv_files, literal_path, read_text, write_text
from stridelake.sources.lake import write_lake
from stridelake.sources.manifest import Manifest, Part, Table, commit, latest_manifest, new_build, parts_with, value_of
from stridelake.sources.tables import merged_schema, read_parts, write_parts

LEDGER = "_files"
LEDGER_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType() if n == "name" else T.LongType()) for n in ("name", "length", "modified", BATCH_ID)]
)
#: Corrections count down from here, so that their batches never meet those of the stream (or of a full build).
FIRST_CORRECTION = -2
#: Note of the lake: the partitions that changed, with the version in which they did.
CHANGES = "changes"
_KEPT_CHANGES = 32
_ANY_AGE = "36500d"
_FILLED = "lake-and-rollup-hold-rows"
_FILE_COLUMNS = "path string, modificationTime timestamp, length bigint, content binary"


def run_incremental(
    spark: SparkSession,
    raw_dir: str,
    lake_path: str,
    mart_dir: str,
    checkpoint: str,
    *,
    multi_line: bool | None = None,
    on_bad_date: str = "error",
    max_files_per_batch: int | None = None,
) -> int:
    """Bring lake and marts up to date with the CSV files; returns the number of rows read from new and rewritten ones.

    The lake must have been made by this function with the same checkpoint. A file is new if the lake does not
    know its name, however old the file is; it is rewritten if its length or time is another. The rows of a
    file that is gone leave lake and marts. A folder without any CSV file changes nothing, as in a full run.
    """
    if not list_csv_files(spark, raw_dir):
        return 0
    _refuse_strangers(spark, lake_path, mart_dir, checkpoint)
    follow(spark, lake_path, mart_dir, on_bad_date)
    options = (lake_path, mart_dir, multi_line, on_bad_date)
    counted: dict[int, int] = {}

    def take_in(found: DataFrame, batch_id: int) -> None:
        # One path per new file: the stream's own driver already holds this list.
        paths = {r["path"] for r in found.select("path").collect()}
        known = {name for name, (_, _, batch) in _ledger(spark, lake_path).items() if batch != batch_id}
        paths = sorted(p for p in paths if p.rpartition("/")[2] not in known)  # the others are corrections
        if paths:
            lake, mart, *how = options
            counted[batch_id] = add_files(spark, paths, batch_id, lake, mart, *how, _checkpoint_id(spark, checkpoint))
            _note_filled(spark, checkpoint, counted[batch_id])

    # The content column is not selected, so no file is read to be discovered.
    reader = spark.readStream.format("binaryFile").schema(_FILE_COLUMNS).option("pathGlobFilter", "*.csv")
    reader = reader.option("maxFileAge", _ANY_AGE)
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    stream = (
        reader.load(literal_path(raw_dir))
        .select("path")
        .writeStream.foreachBatch(take_in)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()
    corrected = _correct(spark, raw_dir, *options, _checkpoint_id(spark, checkpoint))
    _note_filled(spark, checkpoint, corrected)
    return sum(counted.values()) + corrected


def add_files(
    spark: SparkSession,
    paths: list[str],
    batch_id: int,
    lake_path: str,
    mart_dir: str,
    multi_line: bool | None = None,
    on_bad_date: str = "error",
    run_id: str | None = None,
) -> int:
    """One batch: lake, roll-up, then the marts of the touched months. Returns its rows.

    ``run_id``, the checkpoint's id, is left in lake and marts.
    """
    folder = paths[0].rpartition("/")[0]
    there = {e.name: e for e in list_csv_files(spark, folder)}
    took = [there[p.rpartition("/")[2]] for p in paths]
    rows = _change_lake(spark, lake_path, batch_id, took, {}, multi_line, on_bad_date, run_id)
    follow(spark, lake_path, mart_dir, on_bad_date)
    return rows


def _correct(
    spark: SparkSession, raw_dir: str, lake_path: str, mart_dir: str, multi_line: bool | None, on_bad_date: str, run_id: str | None
) -> int:
    """One batch for the files that the ledger has otherwise than the folder; returns the rows read again."""
    ledger = _ledger(spark, lake_path)
    there = {e.name: e for e in list_csv_files(spark, raw_dir)}
    if not there:
        return 0
    drop = {n: batch for n, (length, time, batch) in ledger.items() if n not in there or (length, time) != _state(there[n])}
    # Without an entry are files that were deleted once and came back: the stream does not name them again.
    took = [e for n, e in there.items() if n in drop or n not in ledger]
    if not drop and not took:
        return 0
    batch_id = min([FIRST_CORRECTION + 1, *(batch for _, _, batch in ledger.values())]) - 1
    rows = _change_lake(spark, lake_path, batch_id, took, drop, multi_line, on_bad_date, run_id)
    follow(spark, lake_path, mart_dir, on_bad_date)
    return rows


def _state(entry: Entry) -> tuple[int, int]:
    return entry.length, entry.modified


def _ledger(spark: SparkSession, lake_path: str) -> dict[str, tuple[int, int, int]]:
    """(length, time, batch) of every file in the lake; the driver holds the folder's listing as well."""
    manifest = latest_manifest(spark, lake_path)
    if manifest is None or LEDGER not in manifest.tables:
        return {}
    rows = read_parts(spark, lake_path, LEDGER, manifest.tables[LEDGER]).collect()
    return {r["name"]: (r["length"], r["modified"], r[BATCH_ID]) for r in rows}


def batches_of(part: str, table: Table) -> set[int]:
    """The batches whose rows a partition of lake or roll-up holds."""
    return {int(value_of(part, BATCH_ID)), *table.parts[part].covers}


def _change_lake(
    spark: SparkSession,
    lake_path: str,
    batch_id: int,
    took: list[Entry],
    drop: dict[str, int],
    multi_line: bool | None,
    on_bad_date: str,
    run_id: str | None,
) -> int:
    """Takes the files in as a batch and leaves out the rows of the files in ``drop`` (name to batch), at one instant."""
    before = latest_manifest(spark, lake_path) or Manifest(lake_path, 0, {"": Table(T.StructType([]))}, {RUN: run_id, CHANGES: []})
    build, lake = new_build(), before.tables[""]
    if any(batch_id in b.covers for b in lake.parts.values()):  # a batch run again after a compaction
        drop = drop | {n: batch_id for n, (_, _, batch) in _ledger(spark, lake_path).items() if batch == batch_id}
    parts = {p: b for p, b in lake.parts.items() if value_of(p, BATCH_ID) != str(batch_id)}  # a batch run again
    changed = set(lake.parts) - set(parts)
    rows, schema = 0, lake.schema
    if drop:
        again, kept = _without_files(spark, lake_path, lake, drop)
        parts = {p: b for p, b in parts.items() if p not in again} | kept
        changed |= again
    if took:
        raw = read_csv_files(spark, sorted(e.path for e in took), multi_line, file_column=SOURCE_FILE)
        known = {f.name: f.dataType.simpleString() for f in lake.schema if f.name not in (EVENT_DATE, BATCH_ID)}
        types = {n: known.get(n) or SENSOR_TYPES.get(n, "string") for n in raw.columns if n != TOO_LONG}
        written = write_lake(raw, lake_path, types, batch_id=batch_id, on_bad_date=on_bad_date, build=build)
        rows, new = written.rows, written.parts
        schema = merged_schema(lake.schema if lake.schema.names else None, written.schema, lake_path)
        parts |= new
        changed |= set(new)
    ledger = before.tables.get(LEDGER, Table(LEDGER_SCHEMA))
    entries = _ledger_without(spark, before, drop, batch_id) + [(e.name, *_state(e), batch_id) for e in took]
    stale = {str(batch_id), *(str(b) for b in drop.values())}
    of_ledger = {p: b for p, b in ledger.parts.items() if value_of(p, BATCH_ID) not in stale}
    if entries:
        frame = spark.createDataFrame(entries, LEDGER_SCHEMA)
        of_ledger |= write_parts(frame, lake_path, LEDGER, build, [BATCH_ID], sort_by=["name"])[0]
    after = Table(schema, parts)
    kinds = kinds_after(spark, lake_path, before.notes.get(KINDS, {}), after, {value_of(p, BATCH_ID) for p in changed})
    changes = [*before.notes[CHANGES][-_KEPT_CHANGES:], [before.version + 1, sorted(changed)]]
    tables = {"": after, LEDGER: Table(LEDGER_SCHEMA, of_ledger)}
    commit(spark, before.following(tables, **{RUN: run_id or before.notes[RUN], CHANGES: changes, KINDS: kinds}))
    return rows


def _without_files(
    spark: SparkSession, lake_path: str, lake: Table, drop: dict[str, int]
) -> tuple[set[str], dict[str, Part]]:
    """The partitions that hold rows of the files, and those that are left of them, written anew."""
    wanted = set(drop.values())
    near = [p for p in lake.parts if batches_of(p, lake) & wanted]
    if not near:
        return set(), {}
    names = spark.createDataFrame([(n,) for n in drop], f"{SOURCE_FILE} string")
    rows = read_parts(spark, lake_path, "", lake, near)
    # Folders that hold such rows: only names and partition columns are read.
    keys = [c for c in (EVENT_DATE, BATCH_ID) if c in rows.columns]
    found = rows.join(names, SOURCE_FILE, "left_semi").select(*keys).distinct().collect()
    held = {"/".join(f"{c}={NO_VALUE if r[c] is None else r[c]}" for c in keys) for r in found}
    left = read_parts(spark, lake_path, "", lake, sorted(held)).join(names, SOURCE_FILE, "left_anti").select(*map(quoted, rows.columns))
    sort_by = ["username"] if "username" in left.columns else []
    kept, _ = write_parts(left, lake_path, "", new_build(), keys, sort_by=sort_by)
    return held, {p: Part(b.build, covers=lake.parts[p].covers) for p, b in kept.items()}


def kinds_after(
    spark: SparkSession, lake_path: str, known: Mapping[str, Mapping[str, str]], lake: Table, changed: set[str]
) -> dict[str, Mapping[str, str]]:
    """Type of the values of each undeclared column for each batch of the lake; found anew for the changed batches,
    from these columns alone."""
    present = {value_of(p, BATCH_ID) for p in lake.parts}
    names = [n for n in lake.schema.names if n not in (*SENSOR_TYPES, EVENT_DATE, BATCH_ID, SOURCE_FILE)]
    found = {}
    if names and changed & present:
        rows = read_parts(spark, lake_path, "", lake, parts_with(lake.parts, BATCH_ID, changed))
        found = {str(b): kinds for b, kinds in infer_types_by(rows, names, BATCH_ID).items()}
    return {b: found.get(b, {}) if b in changed else known.get(b, {}) for b in sorted(present)}


def _ledger_without(spark: SparkSession, lake: Manifest, drop: Mapping[str, int], batch_id: int) -> list[tuple]:
    """What stays of the ledger's partitions that lose files; without the batch that is written."""
    ledger = lake.tables.get(LEDGER)
    touched = parts_with(lake.parts(LEDGER), BATCH_ID, {str(b) for b in drop.values()})
    if not touched:
        return []
    rows = read_parts(spark, lake.root, LEDGER, ledger, touched).where(F.col(BATCH_ID) != batch_id).collect()
    return [tuple(r[n] for n in LEDGER_SCHEMA.names) for r in rows if r["name"] not in drop]


def month_of(part: str) -> str:
    """Value of the month that a lake partition's rows belong to."""
    day = value_of(part, EVENT_DATE)
    return NO_VALUE if day in (None, NO_VALUE) else f"{day[:7]}-01"


def follow(spark: SparkSession, lake_path: str, mart_dir: str, on_bad_date: str) -> None:
    """Brings the marts to the lake's state: roll-up of the changed partitions, marts of their months."""
    lake = latest_manifest(spark, lake_path)
    if lake is None:
        return
    marts = latest_manifest(spark, mart_dir) or Manifest(mart_dir)
    shown = marts.notes.get(LAKE_VERSION) or 0
    if shown >= lake.version:
        return
    noted = lake.notes[CHANGES]
    changed = {p for version, parts in noted if version > shown for p in parts}
    if noted and noted[0][0] > shown + 1:  # marts so far behind that not all changes are noted any more
        changed = set(lake.parts("")) | {
            p.replace(EVENT_MONTH, EVENT_DATE) for p in marts.parts(ROLLUP)
        }
    notes = {RUN: lake.notes[RUN], LAKE_VERSION: lake.version}
    touched = {(month_of(p), value_of(p, BATCH_ID)) for p in changed}
    source, build = lake.tables[""], new_build()
    near = [p for p in source.parts if (month_of(p), value_of(p, BATCH_ID)) in touched]
    tables = dict(marts.tables)
    if touched:
        runs = sized_parts(spark, lake_path, "", source, near)
        rolled = write_rollup(roll_up(runs, on_bad_date=on_bad_date), mart_dir, build)
        tables[ROLLUP] = _replaced(marts, ROLLUP, rolled, {f"{EVENT_MONTH}={m}/{BATCH_ID}={b}" for m, b in touched})
        months = {m for m, _ in touched}
        of_months = parts_with(tables[ROLLUP].parts, EVENT_MONTH, months)
        made = write_marts(sized_parts(spark, mart_dir, ROLLUP, tables[ROLLUP], of_months), mart_dir, build)
        for name, mart in made.items():
            tables[name] = _replaced(marts, name, mart, {f"{EVENT_MONTH}={m}" for m in months})
    commit(spark, marts.following(tables, **notes))


def sized_parts(spark: SparkSession, root: str, name: str, table: Table, parts: list[str]) -> DataFrame:
    """The partitions, in a session for their number of rows."""
    return read_parts(sized_session(spark, read_parts(spark, root, name, table, parts).count()), root, name, table, parts)


def _replaced(manifest: Manifest, name: str, new: Table, stale: Iterable[str]) -> Table:
    stale = set(stale)
    known = manifest.tables[name].schema if name in manifest.tables else None
    kept = {p: b for p, b in manifest.parts(name).items() if p not in stale}
    return Table(merged_schema(known, new.schema, name), kept | new.parts)


def _note_filled(spark: SparkSession, checkpoint: str, rows: int) -> None:
    if rows and not exists(spark, f"{checkpoint}/{_FILLED}"):
        write_text(spark, f"{checkpoint}/{_FILLED}", "")


def _checkpoint_id(spark: SparkSession, checkpoint: str) -> str | None:
    """The id that the stream gave its checkpoint when it first ran."""
    path = f"{checkpoint}/metadata"
    return json.loads(read_text(spark, path))["id"] if exists(spark, path) else None


def _refuse_strangers(spark: SparkSession, lake_path: str, mart_dir: str, checkpoint: str) -> None:
    own = _checkpoint_id(spark, checkpoint)
    filled = exists(spark, f"{checkpoint}/{_FILLED}")
    for path, table in ((lake_path, ""), (mart_dir, ROLLUP)):
        manifest = latest_manifest(spark, path)
        where = f"{path}/{table}".rstrip("/")
        there = exists(spark, where)
        if there and own is None:
            raise ValueError(f"{where} exists but {checkpoint} does not: its files would be read twice")
        made_by = manifest.notes.get(RUN) if manifest else None
        if filled and made_by is None:
            what = "was not made by this run" if there else "is gone"
            raise ValueError(f"{where} {what}, but {checkpoint} counts its files as taken in: start anew with all three")
        if there and made_by != own:
            raise ValueError(f"{where} was not made with the checkpoint {checkpoint}")
