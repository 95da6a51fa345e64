"""Embedding near-duplicates: a navigable small-world graph per shard, queried by every shard.

Equal vectors of one label are one point with a count. The points of a label are cut into shards of
about ``shard_points``; a task builds the graph of one shard. Every pair of shards of a label is then
one task: the points of each query the graph of the other, beams are widened until wider ones find nothing new
and audits against brute force find ``recall`` of the links (``hnsw.near_points``), each link is verified in double
precision, and a link found from one side counts for both. A task passes on counts and, of its links, only a
spanning forest, at most one link for each point, so that dense groups of copies don't multiply what is
shuffled. Components are united over these.

A task holds two shards: memory is bounded by ``shard_points``, not by the label's size. Work grows
with the square of a label's number of shards, as each shard must meet each.
"""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridelake.llm.hnsw import Graph, near_points, unit, with_pairs
from stridelake.llm.shared import components, saved

THRESHOLD = 0.98
SHARD_POINTS = 16384
RECALL = 0.99
AUDIT = 64
_SHARD = ["label", "dim", "shard"]


def _packed(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _build(key: tuple, points: pd.DataFrame) -> pd.DataFrame:
    points = points.sort_values("point", ignore_index=True)
    wide = unit(np.stack(points["embedding"].to_numpy()))
    graph, order = Graph.build(wide)
    body = _packed(
        own=wide[order],
        point=points["point"].to_numpy()[order],
        copies=points["copies"].to_numpy()[order],
        **{f"layer{i}": layer for i, layer in enumerate(graph.layers)},
    )
    return pd.DataFrame([[*key, len(points), body]], columns=[*_SHARD, "n", "body"])


def _graph(shard) -> Graph:
    return Graph(shard["own"], [shard[f"layer{i}"] for i in range(sum(n.startswith("layer") for n in shard.files))])


def _meet(threshold: float, recall: float, audit: int):
    def query(key: tuple, shards: pd.DataFrame) -> pd.DataFrame:
        asking, asked = np.load(io.BytesIO(shards["asking"][0])), np.load(io.BytesIO(shards["body"][0]))
        same = key[2] == key[3]
        here, there = asking["own"], asked["own"]
        rows, hits = near_points(_graph(asked), there, here, threshold, audit, recall, same)
        ids, place = np.unique(np.concatenate([asking["point"], asked["point"]]), return_inverse=True)
        if not same:
            back = near_points(_graph(asking), here, there, threshold, audit, recall)
            rows, hits = with_pairs((rows, hits), back[::-1], len(there))
        links = np.bincount(rows, asked["copies"][hits], minlength=len(here)).astype(np.int64)
        a, b = place[: len(links)][rows], place[len(links) :][hits]
        root, before = np.arange(len(ids)), None
        while before is None or (root != before).any():
            before = root.copy()
            low = np.minimum(root[a], root[b])
            np.minimum.at(root, a, low)
            np.minimum.at(root, b, low)
            root = root[root]
        n = np.zeros(len(ids), np.int64)
        np.add.at(n, place[: len(links)], links)
        if not same:
            np.add.at(n, place[len(links) :], np.bincount(hits, asking["copies"][rows], minlength=len(there)).astype(np.int64))
        return pd.DataFrame({"point": ids, "n": n, "root": ids[root]})

    return query


def _usable(vectors: DataFrame) -> DataFrame:
    """Finite, not zero, not empty, with a label; as arrays of doubles that hold the same numbers."""
    e = F.col("embedding").cast("array<double>")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (
        vectors.select("vec_id", "label", e.alias("embedding"))
        .where("label IS NOT NULL AND embedding IS NOT NULL")
        .where(finite & F.exists("embedding", lambda x: x != 0.0))
    )


def embedding_groups(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    shard_points: int = SHARD_POINTS,
    recall: float = RECALL,
    audit: int = AUDIT,
) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one for each row of ``vectors`` (vec_id, embedding, label).

    Vectors link when their labels and lengths are equal and the cosine is at least ``threshold``. Vectors that
    are null, empty, zero or hold null or non-finite components, and those without label, link with
    nothing and are their own component. Repeated rows are vectors of their own that link with each
    other; a null vec_id is never a component's id unless it has no other, and is not kept. An empty
    table gives no rows; other columns are not looked at.
    """
    usable = _usable(vectors)
    points = saved(
        usable.groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .withColumn("point", F.monotonically_increasing_id())
        .withColumn("dim", F.size("embedding")),
        "vectors-points",
    )
    sizes = points.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / F.lit(shard_points)).alias("shards"))
    sizes = saved(sizes, "vectors-sizes")
    of_shard = points.join(sizes, ["label", "dim"]).select(
        "label", "dim", F.pmod(F.xxhash64("point"), F.col("shards")).cast("int").alias("shard"), "point", "copies", "embedding"
    )
    kinds = {f.name: f.dataType.simpleString() for f in of_shard.schema}
    graphs = saved(
        of_shard.groupBy(*_SHARD).applyInPandas(
            _build, f"label {kinds['label']}, dim int, shard int, n long, body binary"
        ),
        "vectors-graphs",
    )
    there = graphs.select(*_SHARD)
    meetings = there.withColumnRenamed("shard", "asking_shard").join(there, ["label", "dim"]).where("asking_shard <= shard")
    asking = graphs.select("label", "dim", F.col("shard").alias("asking_shard"), F.col("body").alias("asking"))
    both = meetings.join(graphs.select(*_SHARD, "body"), _SHARD).join(asking, ["label", "dim", "asking_shard"])
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("point", "n", "root")])
    found = saved(
        both.groupBy("label", "dim", "shard", "asking_shard").applyInPandas(_meet(threshold, recall, audit), schema),
        "vectors-links",
    )
    roots = components(found.where("point <> root").select(F.col("point").alias("a"), F.col("root").alias("b")), "vectors")
    counts = found.groupBy("point").agg(F.sum("n").alias("n"))
    classes = saved(
        points.join(counts, "point", "left")
        .join(roots.withColumnRenamed("node", "point"), "point", "left")
        .select(
            "label", "embedding", "first_id", F.coalesce("root", "point").alias("root"),
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        ),
        "vectors-classes",
    )
    ids = saved(classes.groupBy("root").agg(F.min("first_id").alias("component_id")), "vectors-components")
    known = saved(
        classes.join(ids, "root").select("label", "embedding", "n_links", "component_id"), "vectors-known"
    )
    all_rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label")
    met = all_rows.join(known, ["label", "embedding"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return met.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op2_embedding_dedup(spark, sf_dir):
    return embedding_groups(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM usable a JOIN usable b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reached AS (
  SELECT vec_id AS node, vec_id AS other FROM embeddings
  UNION SELECT node, b FROM reached JOIN links ON other = a),
roots AS (SELECT node, min(other) AS component_id FROM reached GROUP BY node),
counts AS (SELECT a AS node, count(*) AS n_links FROM links GROUP BY a)
SELECT node AS vec_id, coalesce(n_links, 0) AS n_links, component_id, node = component_id AS kept
FROM roots LEFT JOIN counts USING (node)
"""
