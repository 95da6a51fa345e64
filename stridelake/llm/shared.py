"""Helpers of the operators: written tables, the hold-out rule, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read again: lineage ends here, and a lost executor
    costs no recomputation."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


BATCH_BYTES = 8 << 20
_CHARACTERS = 1 << 18


def bounded(df: DataFrame) -> DataFrame:
    """The same rows; batches sent to Python are from now on bounded by bytes in this session, and not by rows alone,
    so that long texts don't fill the workers. A bound that is set already and smaller stays."""
    conf, setting = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    in_bytes = df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if in_bytes(conf.get(setting)) > BATCH_BYTES:
        conf.set(setting, str(BATCH_BYTES))
    return df


def slices(batches: Iterator[pd.Series], rows: int = 256, characters: int = _CHARACTERS) -> Iterator[pd.Series]:
    """Runs of texts (or arrays) of bounded total length; one that is longer comes alone."""
    for batch in batches:
        start = total = 0
        sizes = [0 if t is None else len(t) for t in batch]
        for at, size in enumerate(sizes):
            if at > start and (total + size > characters or at - start == rows):
                yield batch.iloc[start:at]
                start, total = at, 0
            total += size
        if start < len(batch):
            yield batch.iloc[start:]


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that the table does not have (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def remainder(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null ids count as the empty text."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


LONGEST_TO_LEARN = 50_000


def _thresholds(target: str, counts: dict, most: int, id_col: str) -> Column:
    """True for about ``most`` rows of each class: a threshold on a hash of the id, set from the counts."""
    chance = F.xxhash64(F.col(id_col), F.lit(11)) / F.lit(float(2**63))
    share = F.lit(-2.0)
    for value, n in counts.items():
        share = F.when(F.col(target) == value, F.lit(2.0 * min(1.0, most / n) - 1.0)).otherwise(share)
    return chance <= share


def _counts(df: DataFrame) -> dict:
    return {r["target"]: r["n"] for r in df.groupBy("target").agg(F.count(F.lit(1)).alias("n")).collect()}


def learnt_rows(docs: DataFrame, most: int) -> tuple[list[tuple], dict]:
    """About ``most`` (text, target) of each class of ``docs`` (doc_id, text, target), for fitting on the driver.

    Rows with a null in text or target and texts over ``LONGEST_TO_LEARN`` bytes are not learnt from. The sample
    is spread over all rows and the same in every run. Also the number of rows of each class.
    """
    usable = docs.where(F.col("text").isNotNull() & F.col("target").isNotNull() & (F.octet_length("text") <= LONGEST_TO_LEARN))
    counts = _counts(usable)
    chosen = usable.where(_thresholds("target", counts, most, "doc_id")).select("text", "target")
    rows = chosen.dropDuplicates().collect()  # a row that is repeated without end is learnt from once
    return sorted((r["text"], r["target"]) for r in rows), counts


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, keep: Column, most: int) -> tuple[list[tuple], dict]:
    """As ``learnt_rows``, the target being the 0 or 1 that ``labels`` has in ``label`` for the document.

    ``keep`` says which ids may be learnt from. Ids labelled twice count by the larger label.
    """
    marks = (
        labels.select("doc_id", F.col(label).cast("int").alias("target"))
        .where(F.col("doc_id").isNotNull() & F.col("target").isin(0, 1) & keep)
        .groupBy("doc_id")
        .agg(F.max("target").alias("target"))
    )
    counts = _counts(marks)
    chosen = marks.where(_thresholds("target", counts, most, "doc_id"))  # bounded by most: may be broadcast
    met = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    met = met.where(F.col("text").isNotNull() & (F.octet_length("text") <= LONGEST_TO_LEARN))
    return sorted((r["text"], r["target"]) for r in met.select("text", "target").dropDuplicates().collect()), counts


def sent(spark: SparkSession, model):
    """A broadcast of the model that is read with ``received``; its code travels with it."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(model))


def received(broadcast):
    return cloudpickle.loads(broadcast.value)


def components(links: DataFrame, label: str) -> DataFrame:
    """Connected components: links (a, b) of long ids to rows (node, root), root the smallest id.

    Each round points every node at its smallest neighbour, follows the pointers to their ends and
    contracts the links to those ends, so that the nodes still linked at least halve. Every step is an
    aggregate with map-side combine or a join of two written tables, whose skewed keys adaptive
    execution splits; nothing is gathered anywhere. Nodes without links have no row.
    """
    a, b = F.col("a"), F.col("b")
    edges = saved(links.select(a.cast("long"), b.cast("long")).where(a != b).distinct(), f"{label}-links")
    roots = None
    while not edges.isEmpty():
        both = edges.select(a.alias("node"), b.alias("other")).unionAll(edges.select(b.alias("node"), a.alias("other")))
        parents = saved(
            both.groupBy("node").agg(F.min("other").alias("other")).select("node", F.least("node", "other").alias("up")),
            f"{label}-parents",
        )
        while True:
            above = parents.select(F.col("node").alias("up"), F.col("up").alias("top"))
            jumped = saved(parents.join(above, "up").select("node", "up", "top"), f"{label}-jumps")
            still = jumped.where("up <> top").isEmpty()
            parents = jumped.select("node", F.col("top").alias("up"))
            if still:
                break
        if roots is None:
            roots = parents.select("node", F.col("up").alias("root"))
        else:
            over = parents.select(F.col("node").alias("root"), "up")
            roots = roots.join(over, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
        roots = saved(roots, f"{label}-roots")
        of_a, of_b = (parents.select(F.col("node").alias(n), F.col("up").alias(f"up_{n}")) for n in "ab")
        edges = saved(
            edges.join(of_a, "a").join(of_b, "b").where("up_a <> up_b").select(
                F.col("up_a").alias("a"), F.col("up_b").alias("b")
            ).distinct(),
            f"{label}-links",
        )
    if roots is None:
        return edges.select(a.alias("node"), b.alias("root"))
    return roots
