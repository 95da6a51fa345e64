"""Benchmark decontamination by Wu-Manber search over words.

The patterns are the windows of ten words of the benchmark items (an item of fewer words is one shorter
window), the symbols are words. Patterns of one length m are searched together: a block is two
words (one where m is 1), and the shift table says how far the window's end may move when a block stands
under it: m - 1 for blocks of no pattern, else the block's distance to the nearest pattern end. Where the
shift is zero, the block's bucket holds the patterns that end with it, and direct comparison with the words
confirms an occurrence. Texts are laid side by side in numpy arrays, so that all texts of a batch
take a step at once; a long text is cut into lanes that overlap by m - 1 words.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelake.llm.shared import bounded, free_name, saved, slices, table

WINDOW = 10
BLOCK_BYTES = 16 << 20
_LANE = 512
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
FOUND = "n_words long, n_hit long, item_ids array<string>, spans array<struct<start:int,end:int>>"


def words(text: str | None) -> list[bytes]:
    return text.encode().translate(_FOLD).split() if text else []


class _Patterns:
    """The distinct patterns of one length, as rows of word numbers."""

    def __init__(self, rows: np.ndarray, items: list[np.ndarray], vocabulary: int):
        self.rows, self.items, self.m = rows, items, rows.shape[1]
        self.block = min(2, self.m)
        self.base = vocabulary + 1
        reach = self.m - self.block + 1
        codes = np.stack([self.code(rows, at) for at in range(reach)], 1)
        flat, shift = codes.ravel(), np.tile(reach - 1 - np.arange(reach), len(rows))
        by = np.lexsort((shift, flat))
        self.codes, first = np.unique(flat[by], return_index=True)
        self.shifts, self.most = shift[by][first], reach
        last = codes[:, -1]
        self.by_end = np.argsort(last, kind="stable")
        ends, start, count = np.unique(last[self.by_end], return_index=True, return_counts=True)
        self.start, self.count = np.zeros(len(self.codes), np.int64), np.zeros(len(self.codes), np.int64)
        at = np.searchsorted(self.codes, ends)
        self.start[at], self.count[at] = start, count

    def code(self, rows: np.ndarray, at) -> np.ndarray:
        if self.block == 1:
            return rows[..., at]
        return rows[..., at] * self.base + rows[..., at + 1]

    def search(self, flat: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences (start in ``flat``, pattern) in the texts at ``first`` with ``size`` words."""
        starts, stops = [], []
        for f, n in zip(first.tolist(), size.tolist()):
            cuts = range(f, f + n - self.m + 1, _LANE)
            starts += cuts
            stops += [min(c + _LANE, f + n - self.m + 1) for c in cuts]
        pos, stop = np.array(starts, np.int64), np.array(stops, np.int64)
        block = np.r_[self.code(np.stack([flat[:-1], flat[1:]], 1), 0), 0] if self.block == 2 else flat
        tail = self.m - self.block
        found_at, found = [], []
        while len(pos):
            code = block[pos + tail]
            slot = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            known = self.codes[slot] == code
            shift = np.where(known, self.shifts[slot], self.most)
            here = np.flatnonzero(shift == 0)
            if len(here):
                count = self.count[slot[here]]
                place = np.repeat(pos[here], count)
                inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                pattern = self.by_end[np.repeat(self.start[slot[here]], count) + inside]
                same = (flat[place[:, None] + np.arange(self.m)] == self.rows[pattern]).all(axis=1)
                found_at.append(place[same])
                found.append(pattern[same])
            pos = pos + np.maximum(shift, 1)
            on = pos < stop
            pos, stop = pos[on], stop[on]
        none = np.zeros(0, np.int64)
        return np.concatenate(found_at or [none]), np.concatenate(found or [none])


class Searcher:
    def __init__(self, items: list[tuple], window: int = WINDOW):
        self.number: dict[bytes, int] = {}
        kinds: dict[int, dict[tuple, set]] = {}
        for item_id, text in items:
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in words(text)]
            m = min(window, len(ids))
            for at in range(len(ids) - m + 1 if m else 0):
                kinds.setdefault(m, {}).setdefault(tuple(ids[at : at + m]), set()).add(item_id)
        self.kinds = [
            _Patterns(np.array(list(p), np.int64), [[i for i in s if i is not None] for s in p.values()], len(self.number))
            for _, p in sorted(kinds.items())
        ]

    def search(self, texts: list[str | None]) -> list[tuple]:
        """For each text: words, hit words, ids of the items found, spans of hit words."""
        number, lists = self.number.get, [words(t) for t in texts]
        size = np.fromiter(map(len, lists), np.int64, len(lists))
        first = np.cumsum(size) - size
        flat = np.fromiter((i for w in lists for i in map(number, w, repeat(0))), np.int64, int(size.sum()))
        step = np.zeros(len(flat) + 1, np.int64)
        items: list[set] = [set() for _ in texts]
        for p in self.kinds:
            at, pattern = p.search(flat, first, size)
            np.add.at(step, at, 1)
            np.add.at(step, at + p.m, -1)
            for text, k in {*zip((np.searchsorted(first, at, side="right") - 1).tolist(), pattern.tolist())}:
                items[text].update(p.items[k])
        hit = np.r_[0, np.cumsum(step[:-1]) > 0, 0].astype(np.int64)
        total = np.cumsum(hit)
        out = []
        for t, (f, n) in enumerate(zip(first.tolist(), size.tolist())):
            n_hit = int(total[f + n] - total[f])
            spans = []
            if n_hit:
                edges = np.flatnonzero(np.diff(np.r_[0, hit[f + 1 : f + n + 1], 0]))
                spans = edges.reshape(-1, 2).tolist()
            out.append((n, n_hit, sorted(map(str, items[t])), [{"start": a, "end": b} for a, b in spans]))
        return out


def _sent(spark, rows: list[tuple], window: int):
    return spark.sparkContext.broadcast(cloudpickle.dumps(Searcher(rows, window)))


def _find(text: Column, searcher) -> Column:
    @F.pandas_udf(FOUND)
    def of_batches(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        search = cloudpickle.loads(searcher.value).search
        for texts in slices(batches):
            yield pd.DataFrame(search(texts.tolist()), columns=["n_words", "n_hit", "item_ids", "spans"])

    return of_batches(text)


def _merged(spans: Column) -> Column:
    """Spans put together where they overlap or touch."""
    ordered = F.array_sort(spans)
    return F.aggregate(
        ordered,
        F.slice(ordered, 1, 0),
        lambda done, s: F.when(
            (F.size(done) > 0) & (s["start"] <= F.try_element_at(done, F.lit(-1))["end"]),
            F.concat(
                F.slice(done, F.lit(1), F.size(done) - 1),
                F.array(
                    F.struct(
                        F.try_element_at(done, F.lit(-1))["start"].alias("start"),
                        F.greatest(F.try_element_at(done, F.lit(-1))["end"], s["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )


def found_in(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, into: str = "found"
) -> DataFrame:
    """``docs`` with a column ``into`` (replaced if there): struct of n_words, n_hit, item_ids, spans.

    ``spans`` are the hit words as ranges of word positions, ``item_ids`` the items with a window in the
    text, as text and in order. Null and empty texts have no words. Items without words are found nowhere;
    windows of an item without id mark words but name no item; equal items are all named. Repeated
    documents each have their row; an empty benchmark finds nothing.

    The benchmark is a stated query set: it is searched in blocks of about ``block_bytes``, each sent to
    the executors on its own, so that no task holds more than a block whatever the benchmark's size.
    """
    spark = bounded(docs).sparkSession
    items = benchmark.select("item_id", "text").where(F.length("text") > 0)
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // block_bytes) or 1
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    out, seen = docs, None
    for k in range(blocks):
        rows = [(r["item_id"], r["text"]) for r in items.where(part == k).collect()]
        name = free_name(out, f"{into}_{k}")
        if blocks == 1:
            return docs.withColumn(into, _find(F.col("text"), _sent(spark, rows, window)))
        out = out.withColumn(name, _find(F.col("text"), _sent(spark, rows, window)))
        new = F.col(name)
        if seen is not None:
            old = F.col(seen)
            spans = _merged(F.concat(old["spans"], new["spans"]))
            new = F.struct(
                new["n_words"].alias("n_words"),
                F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_hit"),
                F.array_sort(F.array_union(old["item_ids"], new["item_ids"])).alias("item_ids"),
                spans.alias("spans"),
            )
        out = out.withColumn(name, new)
        out = saved(out.drop(seen) if seen is not None else out, "decontamination-block")
        seen = name
    return out.withColumn(into, F.col(seen)).drop(seen)


def digests(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = found_in(docs.select("doc_id", "text"), benchmark).select("doc_id", "found.*")
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op6_decontamination(spark, sf_dir):
    return digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    " '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

ORACLE = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS win
  FROM items, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS t(i) WHERE len(w) > 0),
lengths AS (SELECT DISTINCT m FROM windows),
places AS (
  SELECT r, i, m, array_to_string(w[i : i + m - 1], ' ') AS win
  FROM docs, lengths, unnest(range(1, len(w) - m + 2)) AS t(i)),
met AS (SELECT r, i, places.m AS m, item_id FROM places JOIN windows USING (win, m)),
hits AS (SELECT r, count(DISTINCT k) AS n_hit FROM met, unnest(range(i, i + m)) AS t(k) GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM met WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN named USING (r)
"""
