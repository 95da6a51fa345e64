"""Compaction: the batches of a month put together, in the lake and in the roll-up.

The rows keep the name of their file and a partition says which batches it covers, so files can be corrected and
batches be run again afterwards. Marts stay as they are. Lake and marts change as in a batch of the
incremental run: a compaction that dies half way is made good by the next run, which rolls up what the marts
do not show yet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.functions.columns import quoted
from stridelake.operators.marts import merged_rollup
from stridelake.plans.build import LAKE_VERSION, write_rollup
from stridelake.schema import BATCH_ID, EVENT_DATE, EVENT_MONTH, KINDS, ROLLUP
from stridelake.sources.manifest import Part, Table, commit, latest_manifest, new_build, parts_with, value_of
from stridelake.sources.tables import read_parts, write_parts
from stridelake.streaming.incremental import CHANGES, batches_of, follow, kinds_after, month_of, sized_parts

#: Merged batches count down from here, one number for each compaction; batches and corrections never get there.
FIRST_MERGED = -1_000_000_000


def compact(
    spark: SparkSession, lake_path: str, mart_dir: str, more_than: int = 8, on_bad_date: str = "error"
) -> list[str]:
    """Puts the batches of every month that has ``more_than`` of them together; returns these months.

    A month is read and written once, its days one by one as before, so nothing outgrows a task. Not beside an
    incremental run.
    """
    follow(spark, lake_path, mart_dir, on_bad_date)
    lake, marts = latest_manifest(spark, lake_path), latest_manifest(spark, mart_dir)
    if lake is None:
        raise FileNotFoundError(f"no lake of an incremental run at {lake_path}")
    source = lake.tables[""]
    batches: dict[str, set[str]] = {}
    for part in source.parts:
        batches.setdefault(month_of(part), set()).add(value_of(part, BATCH_ID))
    months = sorted(m for m, found in batches.items() if len(found) > more_than)
    if not months:
        return []
    merged, build = FIRST_MERGED - lake.version, new_build()
    old = [p for p in source.parts if month_of(p) in set(months)]
    rows = _as_batch(read_parts(spark, lake_path, "", source, old), merged)
    keys = [c for c in (EVENT_DATE, BATCH_ID) if c in rows.columns]
    new, _ = write_parts(rows, lake_path, "", build, keys, sort_by=["username"] if "username" in rows.columns else [])
    covers: dict[str, set[int]] = {}
    for part in old:
        own = batches_of(part, source)
        covers.setdefault(part.rpartition("/")[0], set()).update(b for b in own if b > FIRST_MERGED)
    new = {p: Part(b.build, covers=tuple(sorted(covers[p.rpartition("/")[0]]))) for p, b in new.items()}
    kept = {p: b for p, b in source.parts.items() if p not in set(old)}
    changes = [*lake.notes[CHANGES], [lake.version + 1, sorted([*old, *new])]]
    together = Table(source.schema, kept | new)
    stale = {str(merged), *(value_of(p, BATCH_ID) for p in old)}
    kinds = kinds_after(spark, lake_path, lake.notes.get(KINDS, {}), together, stale)
    after = lake.following({"": together}, **{CHANGES: changes, KINDS: kinds})
    commit(spark, after)

    of_months = parts_with(marts.parts(ROLLUP), EVENT_MONTH, set(months))
    rolled = _as_batch(merged_rollup(sized_parts(spark, mart_dir, ROLLUP, marts.tables[ROLLUP], of_months)), merged)
    rolled = rolled.select(*map(quoted, marts.tables[ROLLUP].schema.names))
    written = write_rollup(rolled, mart_dir, build)
    others = {p: b for p, b in marts.parts(ROLLUP).items() if p not in set(of_months)}
    table = Table(marts.tables[ROLLUP].schema, others | written.parts)
    commit(spark, marts.following({ROLLUP: table}, **{LAKE_VERSION: after.version}))
    return months


def _as_batch(rows: DataFrame, batch_id: int) -> DataFrame:
    return rows.withColumn(BATCH_ID, F.lit(batch_id).cast("bigint"))
