"""Sharding by a k-d tree: nodes are split at weighted medians along their widest metadata dimension.

Weights are bytes. A tree for n leaves splits a node of k leaves so that k // 2 of them get what they have room
for of its bytes (the median where k is even and all are empty), until every node is a leaf. Points of the tree are
groups of equal texts, which stay together. A group of more than ``SPLIT`` of a leaf would unbalance the cut
that it lies on: such groups are placed before, the largest first, each where there is most room, and the tree
fills what they leave. Only a group that is larger than a leaf is cut, into pieces that are points of the tree, so
that a text that makes up a third of all rows can't unbalance anything. Along every dimension the order is
completed by a hash of the group, so that ties (one source with a third of the rows) can be cut anywhere.

A level of the tree takes a few aggregates over all points of all its nodes at once: the ranges of the
dimensions, then histograms of bytes, each within the bucket that holds the cut. The driver sees
histograms, of at most ``BUCKETS`` rows per node, and the tree itself; never points.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridelake.llm.shared import saved, table

DIMENSIONS = ("source", "lang", "n_chars")
ROW_BYTES = 16
SPLIT = 0.04
CLOSE = 0.002
BUCKETS = 512
SLOT_ROWS = 50_000
_HASH_BITS = 42
_STEPS = (1 << 20) - 1


@dataclass
class Node:
    """``first`` and ``leaves``: the shards below. A split node has a dimension, a cut and two parts."""

    first: int
    leaves: int
    dimension: int = -1
    cut: int = 0
    left: Node | None = None
    right: Node | None = None


def _leaf(node: Node, key, value) -> Column:
    if node.left is None:
        return value(node)
    return F.when(F.col(key(node.dimension)) < F.lit(node.cut), _leaf(node.left, key, value)).otherwise(
        _leaf(node.right, key, value)
    )


def _key(dimension: int) -> str:
    return f"k{dimension}"


def _number(df: DataFrame, name: str) -> Column:
    """Numbers as they are (null, NaN and infinite: zero), everything else by the crc32 of its text."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.NumericType):
        value = F.col(name).cast("double")
        return F.when(F.abs(value) < F.lit(float("inf")), value).otherwise(F.lit(0.0))
    if isinstance(kind, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)):
        return F.coalesce(F.crc32(F.col(name).cast("string").cast("binary")), F.lit(0)).cast("double")
    raise ValueError(f"column {name} can't be a dimension")


def _cuts(points: DataFrame, active: list[Node], node: Column, room: list[float]) -> None:
    """Sets dimension and cut of every active node; ``room`` has the bytes that each leaf can take."""
    dims = [c for c in points.columns if c.startswith("k")]
    wide = points.withColumn("node", node.cast("int")).where("node >= 0")
    stats = wide.groupBy("node").agg(
        F.sum("bytes").alias("bytes"),
        *(f(c).alias(f"{n}{i}") for i, c in enumerate(dims) for n, f in (("low", F.min), ("high", F.max))),
    )
    goal, leaf_bytes, low, high, below = {}, {}, {}, {}, {}
    for r in stats.collect():
        n = active[r["node"]]
        spread = [(r[f"high{i}"] >> _HASH_BITS) - (r[f"low{i}"] >> _HASH_BITS) for i in range(len(dims))]
        n.dimension = max(range(len(dims)), key=lambda i: (spread[i], -i))
        left, both = (sum(room[n.first : n.first + k]) for k in (n.leaves // 2, n.leaves))
        goal[r["node"]] = r["bytes"] * (left / both if both else n.leaves // 2 / n.leaves)
        leaf_bytes[r["node"]] = r["bytes"] / n.leaves
        low[r["node"]], high[r["node"]], below[r["node"]] = r[f"low{n.dimension}"], r[f"high{n.dimension}"], 0
    for i, n in enumerate(active):
        if i not in goal:  # no points: any cut will do
            n.dimension = 0
    open_ = set(goal)
    while open_:
        asked = [(i, active[i].dimension, low[i], (high[i] - low[i]) // BUCKETS + 1, high[i]) for i in open_]
        bounds = points.sparkSession.createDataFrame(asked, "node int, dimension int, s long, w long, e long")
        key = F.coalesce(*(F.when(F.col("dimension") == int(d[1:]), F.col(d)) for d in dims))
        if len(active) == 1:  # the root: nothing to look up
            inside = wide.withColumns(dict(zip(("dimension", "s", "w", "e"), map(F.lit, asked[0][1:]))))
        else:
            inside = wide.join(F.broadcast(bounds), "node")
        inside = inside.withColumn("key", key).where("key BETWEEN s AND e")
        inside = inside.select("node", "bytes", "key", F.expr("(key - s) div w").alias("bucket"))
        rows = (
            inside.groupBy("node", "bucket")
            .agg(F.sum("bytes").alias("bytes"), F.min("key").alias("low"), F.max("key").alias("high"))
            .collect()
        )
        for i in list(open_):
            total = below[i]
            for r in sorted((r for r in rows if r["node"] == i), key=lambda r: r["bucket"]):
                if total + r["bytes"] >= goal[i]:
                    break
                total += r["bytes"]
            before, after = goal[i] - total, total + r["bytes"] - goal[i]
            if min(before, after) <= CLOSE * leaf_bytes[i] or r["low"] == r["high"]:
                active[i].cut = r["low"] if before <= after else r["high"] + 1
                open_.discard(i)
            else:
                low[i], high[i], below[i] = r["low"], r["high"], total


def kd_tree(points: DataFrame, room: list[float]) -> Node:
    """``points``: bytes and the long keys k0, k1, ... of the dimensions, widest value range first in the bits.
    There is a leaf for each number in ``room``, the bytes it can take."""
    leaves = len(room)
    root = Node(0, leaves)
    level = [root] if leaves > 1 else []
    while level:
        place = {id(n): i for i, n in enumerate(level)}
        _cuts(points, level, _leaf(root, _key, lambda n: F.lit(place.get(id(n), -1))), room)
        below = []
        for n in level:
            n.left = Node(n.first, n.leaves // 2)
            n.right = Node(n.first + n.leaves // 2, n.leaves - n.leaves // 2)
            below += [c for c in (n.left, n.right) if c.leaves > 1]
        level = below
    return root


def _placed(groups: list[tuple[int, int]], shards: int, share: float) -> tuple[list[tuple[int, int]], list[float]]:
    """(group, shard) for groups (id, bytes), the largest first and each into the emptiest shard; the room left."""
    loads = [(0, k) for k in range(shards)]
    out = []
    for h, size in sorted(groups, key=lambda g: (-g[1], g[0])):
        load, k = heapq.heappop(loads)
        out.append((h, k))
        heapq.heappush(loads, (load + size, k))
    return out, [max(share - load, 0.0) for load, _ in sorted(loads, key=lambda x: x[1])]


def kd_shards(
    docs: DataFrame,
    shards: int | None = None,
    target_bytes: int | None = None,
    dimensions: tuple[str, ...] = DIMENSIONS,
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """Rows (the columns ``keep``, size, text_crc32, shard, slot), one for each row of ``docs``.

    Give the number of shards, or the bytes of a shard. ``size`` is the text's UTF-8 bytes (null: none) plus
    16, ``text_crc32`` the crc32 of its bytes (null: of none), ``slot`` counts from 0 within the shard. Shards
    hold near equal bytes: no further from their share than a few per cent of it and one row, or one group of equal
    texts, which is in one shard unless it is larger than that. Dimensions that
    the table lacks are left out; without any, groups are cut by hash alone. Repeated rows, null ids and null or empty
    texts are rows like others; an empty table gives no rows. Columns kept under the name of a
    result are replaced by it.
    """
    if (shards is None) == (target_bytes is None):
        raise ValueError("give either shards or target_bytes")
    text = F.coalesce("text", F.lit(""))
    present = [d for d in dimensions if d.lower() in {c.lower() for c in docs.columns}]
    rows = saved(
        docs.select(
            F.struct(*keep).alias("row"),
            (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("h"),
            *(_number(docs, d).alias(f"d{i}") for i, d in enumerate(present)),
            F.monotonically_increasing_id().alias("row_id"),
        ),
        "kd-rows",
    )
    ranges = [f(f"d{i}").alias(f"{n}{i}") for i in range(len(present)) for n, f in (("low", F.min), ("high", F.max))]
    whole = rows.agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"), *ranges).first()
    total = whole["bytes"] or 0
    shards = shards or max(1, -(-total // target_bytes))
    share = total / shards
    limit = max(1, int(SPLIT * share))
    # at most total / limit groups, 25 for each shard, are that large, whatever the number of rows
    large = saved(rows.groupBy("h").agg(F.sum("size").alias("bytes")).where(F.col("bytes") > limit), "kd-large")
    groups = [(r["h"], r["bytes"]) for r in large.where(F.col("bytes") <= share).collect()]
    placed, room = _placed(groups, shards, share)
    whole_groups = docs.sparkSession.createDataFrame(placed, "h long, shard int")
    pieces = large.where(F.col("bytes") > share).select("h", F.ceil(F.col("bytes") / limit).alias("pieces"))
    cut = rows.join(F.broadcast(pieces), "h", "left")
    cut = cut.withColumn("piece", F.coalesce(F.pmod(F.xxhash64("row_id"), F.col("pieces")), F.lit(0)))
    merged = cut.groupBy("h", "piece").agg(
        F.sum("size").alias("bytes"), *(F.min(f"d{i}").alias(f"d{i}") for i in range(len(present)))
    )
    hashed = F.xxhash64("h", "piece").bitwiseAND((1 << _HASH_BITS) - 1)

    def key(i: int) -> Column:
        low, high = whole[f"low{i}"] or 0.0, whole[f"high{i}"] or 0.0
        scaled = F.floor((F.col(f"d{i}") - low) / ((high - low) or 1.0) * _STEPS).cast("long")
        return F.shiftleft(scaled, _HASH_BITS).bitwiseOR(hashed)

    keys = [key(i).alias(_key(i)) for i in range(len(present))] or [hashed.alias(_key(0))]
    others = merged.join(F.broadcast(whole_groups), "h", "left_anti")
    points = saved(others.select("h", "piece", "bytes", *keys), "kd-points")
    tree = kd_tree(points, room)
    leaf = points.select("h", "piece", _leaf(tree, _key, lambda n: F.lit(n.first)).alias("shard"))
    leaf = leaf.unionByName(whole_groups.withColumn("piece", F.lit(0).cast(leaf.schema["piece"].dataType)))
    placed = saved(
        cut.join(leaf, ["h", "piece"]).select("row", "size", "text_crc32", "shard", "row_id"), "kd-placed"
    )
    parts = max(1, -(-whole["n"] // (shards * SLOT_ROWS)), 8)
    placed = placed.withColumn("part", F.pmod(F.xxhash64("row_id"), F.lit(parts)).cast("int"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "part").orderBy("row_id")
    out = placed.withColumn("at", F.row_number().over(inside) - 1).join(offsets, ["shard", "part"])
    taken = {"size", "text_crc32", "shard", "slot"}
    return out.select(
        *(F.col("row")[k].alias(k) for k in keep if k.lower() not in taken),
        "size", "text_crc32", "shard", (F.col("offset") + F.col("at")).cast("long").alias("slot"),
    )


def write_shards(docs: DataFrame, path: str, **how) -> None:
    """All columns of ``docs``, one folder for each shard."""
    placed = kd_shards(docs, keep=tuple(docs.columns), **how)
    placed.write.partitionBy("shard").parquet(path)


def op7_kd_sharding(spark, sf_dir):
    placed = kd_shards(table(spark, sf_dir, "documents"), shards=40)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
