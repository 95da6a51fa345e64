"""Hard negatives by Kronecker-packed products.

Components become integers. Several candidates' components, made non-negative by a bias, lie in separated fields
of one wide integer, so that one multiplication with a (biased) component of an anchor multiplies them all. The
fields are as wide as the largest sum of products over the dimensions, so that none runs into the next; the
sums are unpacked and the bias is taken off, which gives exact scores. Fields that fit twice or more into 64 bits
are packed into machine words, wider ones into Python's integers.

Anchors are a stated set of rows and meet all rows in blocks of bounded size, each sent to the executors on its
own. A task passes on its best rows of each window of scores. Windows around the scores of an anchor's
positives overlap; a row that several of them want is passed on once.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stridelake.llm.shared import bounded, received, saved, sent, table

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOWEST, HIGHEST = 30, 90  # percent of the positive's score
BLOCK_BYTES = 16 << 20
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_ROWS_AT_ONCE, _ANCHORS_AT_ONCE = 512, 256


class Packed:
    """Rows whose integer components, of ``low`` to ``high``, are packed into fields.

    They are multiplied with anchors whose components have the same bounds.
    """

    def __init__(self, rows: np.ndarray, low: int, high: int):
        self.n, self.dims = rows.shape
        self.bias = -low
        self.bits = max(1, (self.dims * (high - low) ** 2).bit_length())
        self.wide = self.bits > 32
        self.fields = 8 if self.wide else 64 // self.bits
        self.kind = object if self.wide else np.uint64
        rows = rows.astype(object) if self.wide else rows
        self.sums = rows.sum(axis=1)
        biased = np.zeros((self.fields * -(-self.n // self.fields), self.dims), self.kind)
        biased[: self.n] = rows + self.bias
        self.words = np.zeros((self.dims, len(biased) // self.fields), self.kind)
        for f in range(self.fields):
            self.words += biased[f :: self.fields].T << self._number(f * self.bits)

    def _number(self, n: int):
        return n if self.wide else np.uint64(n)

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Exact inner products of every anchor with every row."""
        anchors = anchors.astype(object) if self.wide else anchors
        biased = (anchors + self.bias).astype(self.kind)
        total = np.zeros((len(anchors), self.words.shape[1]), self.kind)
        product = np.empty_like(total)
        for j in range(self.dims):
            np.multiply(biased[:, j, None], self.words[j], out=product)  # one product for all fields
            total += product
        found = np.empty((*total.shape, self.fields), object if self.wide else np.int64)
        for f in range(self.fields):
            found[:, :, f] = total >> self._number(f * self.bits) & self._number((1 << self.bits) - 1)
        found = found.reshape(len(anchors), -1)[:, : self.n]
        return found - self.bias * (anchors.sum(axis=1)[:, None] + self.sums) - self.dims * self.bias**2


def components(vectors: list, dims: int, scale: int) -> np.ndarray:
    """floor(scale * x) of each component, as integers; shorter vectors end in zeros."""
    out = np.zeros((len(vectors), dims))
    for row, v in zip(out, vectors):
        row[: len(v)] = v
    np.floor(np.multiply(out, scale, out=out), out=out)
    if np.abs(out).max(initial=0) < 2**31:
        return out.astype(np.int64)
    return np.array([[int(x) for x in row] for row in out], object)


class Anchors:
    """A block of anchors, which looks for the best rows of windows of scores."""

    def __init__(self, rows: list, dims: int, scale: int, low: int, high: int):
        self.ids = np.array([r["id"] for r in rows], np.int64)
        self.labels = np.array([r["label"] for r in rows], np.int64)
        self.rows = components([r["vec"] for r in rows], dims, scale)
        self.dims, self.scale, self.low, self.high = dims, scale, low, high
        bound = dims * max(-low, high) ** 2 + 1
        self.every = [(slot, -bound, bound) for slot in range(len(rows))]
        self.kind = np.int64 if bound < 1 << 62 else object

    def search(self, batches: Iterator[pd.DataFrame], same_label: bool, windows: list[tuple], most: int) -> pd.DataFrame:
        """The ``most`` best rows of each window (slot of the anchor, lowest, highest score): slot, row, id, score.

        Only rows whose label is, or is not, the anchor's, and never those with its id. ``row`` counts the rows
        that came in; a row that is among the best of several windows of an anchor comes once.
        """
        windows = sorted(windows)
        slot = np.array([w[0] for w in windows], np.int64)
        least, highest = (np.array([w[k] for w in windows], self.kind) for k in (1, 2))
        first = np.searchsorted(slot, np.arange(len(self.ids) + 1))  # windows of an anchor lie together
        wanted = np.flatnonzero(np.diff(first))
        best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, self.kind))
        seen = 0
        for frame in batches:
            for at in range(0, len(frame), _ROWS_AT_ONCE):
                part = frame.iloc[at : at + _ROWS_AT_ONCE]
                ids, labels = part["id"].to_numpy(), part["label"].to_numpy()
                packed = Packed(components(part["vec"].tolist(), self.dims, self.scale), self.low, self.high)
                for k in range(0, len(wanted), _ANCHORS_AT_ONCE):
                    a = wanted[k : k + _ANCHORS_AT_ONCE]
                    scores = packed.scores(self.rows[a]).astype(self.kind, copy=False)
                    fit = ((self.labels[a, None] == labels) == same_label) & (self.ids[a, None] != ids)
                    fit &= (scores >= np.minimum.reduceat(least, first[a])[:, None]).astype(bool)
                    fit &= (scores <= np.maximum.reduceat(highest, first[a])[:, None]).astype(bool)
                    i, c = np.nonzero(fit)
                    times = first[a[i] + 1] - first[a[i]]
                    w = np.repeat(first[a[i]] + times - np.cumsum(times), times) + np.arange(times.sum())
                    i, c = np.repeat(i, times), np.repeat(c, times)
                    new = scores[i, c]
                    inside = ((new >= least[w]) & (new <= highest[w])).astype(bool)
                    if inside.any():
                        i, c, w = i[inside], c[inside], w[inside]
                        best = _first(*map(np.concatenate, zip(best, (w, seen + c, ids[c], new[inside]))), most)
                        ends = np.flatnonzero(np.diff(best[0], append=-1))
                        full = ends[np.diff(ends, prepend=-1) == most]
                        least[best[0][full]] = best[3][full]  # a row below the last one has no place any more
                seen += len(part)
        w, row, ids, scores = best
        found = pd.DataFrame({"slot": slot[w], "row": row, "id": ids, "score": scores})
        return found.drop_duplicates(["slot", "row"]).astype({"score": "int64"})


def _first(window: np.ndarray, row: np.ndarray, ids: np.ndarray, scores: np.ndarray, most: int) -> tuple:
    by = np.lexsort((ids, -scores, window))
    rank = np.arange(len(by)) - np.searchsorted(window[by], window[by])
    by = by[rank < most]
    return window[by], row[by], ids[by], scores[by]


def _searched(points: DataFrame, anchors, same_label: bool, windows, most: int) -> DataFrame:
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = received(anchors)
        wanted = block.every if windows is None else received(windows)
        yield block.search(batches, same_label, wanted, most)[["slot", "id", "score"]]

    return points.mapInPandas(search, "slot long, id long, score long")


def _mined(points, rows: list, bounds: tuple, positives: int, negatives: int, lowest: int, highest: int) -> DataFrame:
    """The result for one block of anchors."""
    spark = points.sparkSession
    anchors = sent(spark, Anchors(rows, *bounds))
    nth = F.row_number().over(Window.partitionBy("slot").orderBy(F.desc("score"), "id"))
    near = _searched(points, anchors, True, None, positives).withColumn("nth", nth).where(F.col("nth") <= positives)
    wanted = []  # a few rows for each anchor of the block
    for r in saved(near, "positives").collect():
        low, high = -(-lowest * r["score"] // 100), highest * r["score"] // 100
        wanted.append((r["slot"], low, high, r["nth"], rows[r["slot"]]["id"], r["id"], r["score"]))
    windows = sent(spark, [w[:3] for w in wanted])
    far = saved(_searched(points, anchors, False, windows, negatives), "negatives").withColumnRenamed("id", "negative_id")
    schema = "slot long, low long, high long, nth int, anchor_id long, positive_id long, positive_score long"
    met = far.join(F.broadcast(spark.createDataFrame(wanted, schema)), "slot").where("score BETWEEN low AND high")
    rank = F.row_number().over(Window.partitionBy("slot", "nth").orderBy(F.desc("score"), "negative_id"))
    return met.withColumn("rank", rank).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", F.col("score").alias("negative_score")
    )


def usable(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """Rows with id, label and a vector without null and non-finite components; vectors as doubles."""
    vec = F.col("vec").cast("array<double>")
    finite = F.forall(vec, lambda x: F.coalesce(F.abs(x * F.lit(float(scale))) < F.lit(math.inf), F.lit(False)))
    points = rows.select(F.col("id").cast("long"), F.col("label").cast("long"), vec.alias("vec"))
    return points.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    *,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lowest: int = LOWEST,
    highest: int = HIGHEST,
    scale: int = SCALE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Hard negatives of the anchors among ``rows`` (id, label, vec); ``is_anchor`` is a condition on the id.

    A component x counts as floor(scale * x), a row's score is its inner product with the anchor; higher scores
    come first, ties by smaller id. An anchor's positives are its first ``positives`` other rows of its label. For each
    of them the first ``negatives`` rows of other labels are returned whose score lies between ``lowest`` and ``highest``
    percent of the positive's: anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Rows with a null id, label or vector, or a null or non-finite component take no part. Shorter vectors end in zeros,
    so an empty one scores 0. A positive with a negative score has no negatives. Rows that repeat an id each count, but an
    anchor never meets rows of its own id; anchors that are repeated entirely are searched once. An empty table, or
    one without anchors, gives no rows; other columns are not looked at. A score that does not fit a long fails the job.

    Every block of anchors (about ``block_bytes`` of vectors) is one pass over the rows for the positives and one for
    the negatives; a task holds a block, its best rows and a batch.
    """
    spark = bounded(rows).sparkSession
    points = usable(rows, scale)
    dims, least, most = points.agg(F.max(F.size("vec")), F.min(F.array_min("vec")), F.max(F.array_max("vec"))).first()
    anchors = points.where(is_anchor).distinct()
    blocks = -(-anchors.count() * (8 * (dims or 0) + 16) // block_bytes)
    if not blocks:
        return spark.createDataFrame([], RESULT)
    bounds = dims, scale, math.floor(scale * min(least or 0.0, 0.0)), math.floor(scale * max(most or 0.0, 0.0))
    anchors = saved(anchors.withColumn("block", F.pmod(F.xxhash64("id", "label", "vec"), F.lit(blocks))), "anchors")
    done = []
    for k in range(blocks):
        block = anchors.where(F.col("block") == k).drop("block").orderBy("id", "label", "vec").collect()
        if block:
            mined = _mined(points, block, bounds, positives, negatives, lowest, highest)
            done.append(mined if blocks == 1 else saved(mined, "mined"))
    return functools.reduce(DataFrame.unionAll, done)


def op12_hard_negatives(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select(F.col("vec_id").alias("id"), label.alias("label"), F.col("embedding").alias("vec"))
    return hard_negatives(rows, F.col("id") % 100 == 0)


ORACLE = """
WITH points AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
met AS (
  SELECT a.id AS anchor_id, a.label = b.label AS alike, b.id AS id, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM points a JOIN points b ON a.id <> b.id WHERE a.id % 100 = 0),
near AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM met WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
far AS (
  SELECT anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS rank
  FROM near JOIN (SELECT * FROM met WHERE NOT alike) USING (anchor_id)
  WHERE 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM far WHERE rank <= 10
"""
