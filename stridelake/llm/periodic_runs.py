"""Periodic runs of words, found by block convolution.

A run is a stretch of words with smallest period q (words q apart are identical) and a length of at least
max(24, 3 q), that no neighbouring word extends keeping period q. At each dyadic scale L a text is cut into
blocks of L words. A run with a period in [L, 2 L) holds a whole block whose copy one period later is in the run
too, so the block has an occurrence without mismatch at that distance; the smallest scale, 8, serves the shorter
periods as well. The sum of squared differences of a block and all places of its window comes from one
product of number-theoretic transforms. Words are folded to numbers so small that the sum stays below
the prime, so it is exact, and zero where the block occurs. Each distance seeds an extension, which compares
the words themselves in both directions.

A block with a word that does not come again within the window has no occurrence there and is not transformed. A
seed inside a known stretch of a period that divides its distance can only give that stretch again, and is dropped.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelake.llm.shared import bounded, free_name, slices, table

SHORTEST = 24
EXPONENT = 3
SMALLEST_BLOCK = 8  # 2 * 8 - 1 words fit in what a run of 24 words has besides a period below 8
FOUND = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"

# A prime of the form k * 2^27 + 1, below 2^31, and a generator of its multiplicative group.
PRIME, GENERATOR = 2013265921, 31
_AT_ONCE = 1 << 18


def words(text: str | None) -> list[bytes]:
    """Words are what spaces and the control characters 9 to 13 leave."""
    return text.encode().split() if text else []


class _Transform:
    """Number-theoretic transforms of the rows of an array with ``size`` columns, a power of two."""

    def __init__(self, size: int):
        self.size = size
        self.levels, inverse = [], pow(GENERATOR, PRIME - 2, PRIME)
        for root in (GENERATOR, inverse):
            levels, half = [], size // 2
            while half:
                step, powers = pow(root, (PRIME - 1) // (2 * half), PRIME), np.ones(1, np.uint64)
                while len(powers) < half:
                    powers = np.concatenate((powers, powers * np.uint64(pow(step, len(powers), PRIME)) % np.uint64(PRIME)))
                levels.append(powers)
                half //= 2
            self.levels.append(levels)
        self.scale = np.uint64(pow(size, PRIME - 2, PRIME))

    def forward(self, rows: np.ndarray) -> np.ndarray:
        """Values in bit-reversed order; ``back`` takes them so."""
        m, prime = len(rows), np.uint64(PRIME)
        out = rows.astype(np.uint64)
        for powers in self.levels[0]:
            parts = out.reshape(m, -1, 2, len(powers))
            low, high = parts[:, :, 0], parts[:, :, 1]
            out = np.stack(((low + high) % prime, (low + (prime - high)) % prime * powers % prime), axis=2)
        return out.reshape(m, self.size)

    def back(self, rows: np.ndarray) -> np.ndarray:
        m, prime = len(rows), np.uint64(PRIME)
        out = rows
        for powers in reversed(self.levels[1]):
            parts = out.reshape(m, -1, 2, len(powers))
            low, high = parts[:, :, 0], parts[:, :, 1] * powers % prime
            out = np.stack(((low + high) % prime, (low + (prime - high)) % prime), axis=2)
        return out.reshape(m, self.size) * self.scale % prime


def zero_mismatches(values: np.ndarray, starts: np.ndarray, length: int, offset: int, transform: _Transform) -> np.ndarray:
    """For the blocks values[s : s + length], whether they stand again at distance offset + t, t from 0 to length - 1.

    ``values`` are symbols whose squared differences add up to less than the prime over a block, followed by
    at least ``offset`` + 2 * ``length`` others.
    """
    block = values[starts[:, None] + np.arange(length)]
    window = values[starts[:, None] + offset + np.arange(2 * length)]
    padded = np.zeros_like(window)
    padded[:, :length] = block[:, ::-1]
    product = transform.forward(padded) * transform.forward(window) % np.uint64(PRIME)
    met = transform.back(product)[:, length - 1 : 2 * length - 1].astype(np.int64)
    squares = np.cumsum(np.pad(window * window, ((0, 0), (1, 0))), axis=1)
    of_place = squares[:, length : 2 * length] - squares[:, :length]
    of_block = (block * block).sum(axis=1, keepdims=True)
    return (of_block + of_place - 2 * met) % PRIME == 0


def _scales(longest: int) -> Iterator[tuple[int, int]]:
    """(block length, first distance) of each window that a period of up to ``longest`` words needs."""
    yield SMALLEST_BLOCK, 0
    length = SMALLEST_BLOCK
    while length <= longest:
        yield length, length
        length *= 2


def seeds(flat: np.ndarray, first: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(starts, distances, block length) of the blocks that occur again, in texts that lie side by side in ``flat``."""
    longest = size // EXPONENT
    text = np.repeat(np.arange(len(size)), size)
    by = np.lexsort((flat, text))
    again = np.full(len(flat), np.iinfo(np.int64).max)
    same = (flat[by][1:] == flat[by][:-1]) & (text[by][1:] == text[by][:-1])
    again[by[:-1][same]] = (by[1:] - by[:-1])[same]  # distance to the word's next place in the text
    transforms: dict[int, _Transform] = {}
    for length, offset in _scales(int(longest.max(initial=0))):
        lone = np.concatenate(([0], np.cumsum(again > offset + length - 1)))
        near = max(offset, 1)
        parts = [
            np.arange(f, f + n - length - near + 1, length)
            for f, n in zip(first.tolist(), size.tolist())
            if n >= SHORTEST and n // EXPONENT >= near
        ]
        starts = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        starts = starts[lone[starts + length] == lone[starts]]
        if not len(starts):
            continue
        symbols = int(((PRIME - 1) // length) ** 0.5)
        values = np.concatenate((flat % symbols, np.zeros(offset + 2 * length, np.int64)))
        transform = transforms.get(length) or transforms.setdefault(length, _Transform(2 * length))
        ends = (first + size)[text[starts]]
        at_once = max(1, _AT_ONCE // (2 * length))
        for at in range(0, len(starts), at_once):
            some = starts[at : at + at_once]
            row, t = np.nonzero(zero_mismatches(values, some, length, offset, transform))
            start, distance = some[row], offset + t
            fits = (distance > 0) & (start + distance + length <= ends[at : at + at_once][row])
            yield start[fits], distance[fits], length


def _equal_words(a: np.ndarray, b: np.ndarray) -> int:
    """How many first elements agree; looks at twice as many in each step."""
    done, step, n = 0, 64, min(len(a), len(b))
    while done < n:
        differ = a[done : done + step][: n - done] != b[done : done + step][: n - done]
        if differ.any():
            return done + int(differ.argmax())
        done += step
        step *= 2
    return n


def _stretch(flat: np.ndarray, low: int, high: int, at: int, distance: int) -> tuple[int, int]:
    """The longest stretch in [low, high) around ``at`` whose words ``distance`` apart are identical."""
    right = at + distance + _equal_words(flat[at : high - distance], flat[at + distance : high])
    left = at - _equal_words(flat[low:at][::-1], flat[low + distance : at + distance][::-1])
    return left, right


def runs_in(lists: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each list of words, by start, then period."""
    number: dict[bytes, int] = defaultdict(count().__next__)
    size = np.fromiter(map(len, lists), np.int64, len(lists))
    first = np.cumsum(size) - size
    flat = np.fromiter((i for w in lists for i in map(number.__getitem__, w)), np.int64, int(size.sum()))
    known: list[tuple[int, int, int]] = []  # stretches (left, right, period)
    for start, distance, length in seeds(flat, first, size):
        _extended(flat, first, size, start, distance, length, known)
    periods: dict[tuple[int, int], int] = {}
    for left, right, q in known:
        if right - left >= max(SHORTEST, EXPONENT * q):
            periods[left, right] = min(q, periods.get((left, right), q))
    out: list[list[tuple[int, int, int]]] = [[] for _ in lists]
    for (left, right), q in periods.items():
        text = int(np.searchsorted(first + size, left, side="right"))
        out[text].append((left - int(first[text]), right - left, q))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def _extended(flat, first, size, start, distance, length, known) -> None:
    """Adds to ``known`` the stretches of these seeds that it lacks. The starts are in ascending order."""
    if not len(start):
        return
    end, unmet = start + distance + length, np.ones(len(start), bool)

    def close(left: int, right: int, q: int) -> None:
        a, b = np.searchsorted(start, (left, right))
        unmet[a:b] &= (end[a:b] > right) | (distance[a:b] % q > 0)

    if known:
        stretches = np.array(known, np.int64)
        for stretch in stretches[(stretches[:, 0] <= start[-1]) & (stretches[:, 1] > start[0])].tolist():
            close(*stretch)
    text = np.searchsorted(first + size, start, side="right")
    for k in np.argsort(distance, kind="stable").tolist():
        if unmet[k]:
            low, q = int(first[text[k]]), int(distance[k])
            left, right = _stretch(flat, low, low + int(size[text[k]]), int(start[k]), q)
            known.append((left, right, q))
            close(left, right, q)


def collapsed(tokens: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words that no run repeats: of each run its first period stays."""
    if not runs:
        return b" ".join(tokens).decode()
    step = np.zeros(len(tokens) + 1, np.int64)
    for start, length, period in runs:
        step[start + period] += 1
        step[start + length] -= 1
    return b" ".join([tokens[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0).tolist()]).decode()


def _found(text: Column) -> Column:
    @F.pandas_udf(FOUND)
    def of_batches(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in slices(batches):
            lists = [words(t) for t in texts]
            runs = runs_in(lists)
            rows = [
                (len(w), [dict(zip(("start", "length", "period"), r)) for r in rs], collapsed(w, rs))
                for w, rs in zip(lists, runs)
            ]
            yield pd.DataFrame(rows, columns=["n_words", "runs", "collapsed"])

    return of_batches(text)


def periodic_runs(docs: DataFrame, into: str = "periodic") -> DataFrame:
    """``docs`` with a column ``into`` (replaced if there): struct of n_words, runs and collapsed.

    ``runs`` are (start, length, period) in words, by start, then period; ``collapsed`` is the text whose
    runs keep their first period, words joined by one space. Null and empty texts and texts without words have no
    words, no runs and an empty collapsed text. Each row stands for itself, so repeated rows, repeated and
    null ids give a row each, and an empty table gives none. A run that has two periods is named by the smaller.
    Texts are looked at whole, however long; the work grows with n log^2 n.
    """
    return bounded(docs).withColumn(into, _found(F.col("text")))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with runs planted in the texts of every tenth id by crc32, as the contract of the query has it.

    Rows without id keep their text.
    """
    w, a, p = (free_name(docs, n) for n in ("own_words", "own_from", "own_period"))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g, n = F.floor(h / 10), F.size(F.col(w))
    chosen = F.coalesce((h % 10 == 0) & F.col("text").isNotNull(), F.lit(False))
    found = F.regexp_extract_all(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    # Only the chosen texts are cut into words here.
    out = docs.withColumn(w, F.when(chosen, found))
    out = out.withColumn(a, F.when(n > 0, F.pmod(g, n)))
    out = out.withColumn(p, F.lit(1) + F.floor((n - F.col(a)) / (F.lit(3) + g % 8)))
    moved = F.transform(
        F.col(w), lambda word, i: F.when(i < F.col(a), word).otherwise(F.get(F.col(w), (F.col(a) + (i - F.col(a)) % F.col(p)).cast("int")))
    )
    return out.withColumn("text", F.when(F.col(a).isNotNull(), F.array_join(moved, " ")).otherwise(F.col("text"))).drop(w, a, p)


def digests(docs: DataFrame) -> DataFrame:
    found = periodic_runs(docs.select("doc_id", "text")).select("doc_id", "periodic.*")
    # Exact comparison of length / period: by cross multiplication.
    best = F.expr(
        "aggregate(runs, CAST(NULL AS STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>), (b, r) -> "
        "CASE WHEN b IS NULL OR r.length * b.period > b.length * r.period THEN r ELSE b END)"
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.transform(lines, lambda line: F.concat(line, F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )


def op13_periodic_runs(spark, sf_dir):
    return digests(with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text")))
