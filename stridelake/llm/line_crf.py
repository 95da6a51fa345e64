"""Document quality by a linear-chain conditional random field over lines.

Every line that is not blank is good or bad. A label's score is a weighted sum of the line's features and
of those of the lines before and after it; neighbouring labels have a transition score. Marginals come
from forward-backward, and a document's quality is their mean weighted by line length, put on a scale of
probabilities by a logistic fit. Learning takes a document's label for all its lines.

Forward-backward runs over all documents of a batch at once, one line of each per step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelake.llm.shared import bounded, labelled_rows, received, remainder, sent, slices, table

MOST = 2000
THRESHOLD = 0.7
ROUNDS = 80
_LOWER, _UPPER, _DIGIT, _SPACE, _STOP, _SYMBOL, _LINE = range(7)
#: Thermometer steps of each raw feature of a line.
STEPS = {
    "upper": (0.03, 0.1, 0.3, 0.6),
    "digit": (0.01, 0.05, 0.2, 0.5),
    "stop": (0.01, 0.04, 0.08, 0.15),
    "symbol": (0.01, 0.05, 0.12, 0.25),
    "space": (0.05, 0.12, 0.18, 0.25, 0.4),
    "word": (2.5, 4.0, 5.5, 7.0, 10.0),
    "words": (2.0, 5.0, 15.0, 40.0, 120.0),
    "unique": (0.1, 0.25, 0.45, 0.65, 0.85, 0.95),
    "repeats": (0.05, 0.25, 0.6),
    "same": (0.5,),
}


def _classes() -> np.ndarray:
    kinds = np.full(0x3000, _LOWER, np.int64)
    for c in range(0x3000):
        ch = chr(c)
        if ch == "\n":
            kinds[c] = _LINE
        elif ch.isspace():
            kinds[c] = _SPACE
        elif ch.isdigit():
            kinds[c] = _DIGIT
        elif ch.isupper():
            kinds[c] = _UPPER
        elif ch in ".,;:?'\"()-":
            kinds[c] = _STOP
        elif not ch.isalnum():
            kinds[c] = _SYMBOL
    return kinds


class LineFeatures:
    def __init__(self):
        self.classes = _classes()
        self.steps = [np.array(s) for s in STEPS.values()]
        self.own = sum(map(len, self.steps))

    def raw(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Raw features of the lines that are not blank, and their lengths."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        kinds = self.classes[np.minimum(codes, 0x2FFF)]
        line = np.cumsum(kinds == _LINE) - (kinds == _LINE)
        lines = text.split("\n")
        counts = np.bincount(line * 8 + kinds, minlength=8 * len(lines)).reshape(-1, 8)
        words = [x.split() for x in lines]
        n_words = np.fromiter(map(len, words), np.float64, len(words))
        unique = np.fromiter((len(set(w)) for w in words), np.float64, len(words))
        pairs = np.fromiter((sum(map(str.__eq__, w, w[1:])) for w in words), np.float64, len(words))
        shown = n_words > 0
        length = counts[:, :_LINE].sum(axis=1)[shown].astype(np.float64)
        counts, n_words, unique, pairs = counts[shown], n_words[shown], unique[shown], pairs[shown]
        kept = [x for x, s in zip(lines, shown.tolist()) if s]
        seen: dict[str, int] = {}
        for x in kept:
            seen[x] = seen.get(x, 0) + 1
        same = np.fromiter((seen[x] > 1 for x in kept), np.float64, len(kept))
        letters = np.maximum(counts[:, _LOWER] + counts[:, _UPPER], 1)
        raw = np.stack(
            [
                counts[:, _UPPER] / letters,
                counts[:, _DIGIT] / length,
                counts[:, _STOP] / length,
                counts[:, _SYMBOL] / length,
                counts[:, _SPACE] / length,
                (length - counts[:, _SPACE]) / n_words,
                n_words,
                unique / n_words,
                pairs / n_words,
                same,
            ],
            1,
        ) if len(kept) else np.zeros((0, len(STEPS)))
        return raw, length

    def rows(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Feature rows of all lines (1, own, before, after), their lengths and the lines of each text."""
        both = [self.raw(t) for t in texts]
        n = np.array([len(x) for x, _ in both], np.int64)
        raw, length = np.concatenate([x for x, _ in both]), np.concatenate([y for _, y in both])
        own = np.concatenate([raw[:, [i]] > s for i, s in enumerate(self.steps)], axis=1).astype(np.float32)
        first = np.cumsum(n) - n
        before, after = np.zeros((len(own), self.own + 1), np.float32), np.zeros((len(own), self.own + 1), np.float32)
        if len(own):
            before[1:, :-1], after[:-1, :-1] = own[:-1], own[1:]
            starts, ends = first[n > 0], (first + n - 1)[n > 0]
            before[starts], after[ends] = 0, 0
            before[starts, -1], after[ends, -1] = 1, 1
        return np.hstack([np.ones((len(own), 1), np.float32), own, before, after]), length, n


def _over_time(n: np.ndarray):
    """Documents, longest first, and how many have a line at each step."""
    order = np.argsort(-n, kind="stable")
    alive = np.bincount(n, minlength=int(n.max(initial=0)) + 1)[::-1].cumsum()[::-1][1:]
    return order, alive


def forward_backward(score: np.ndarray, move: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For chains of ``n`` lines one after the other: log marginals of label 1 minus label 0 for each line, log
    partition of each chain, expected transitions (2 x 2). ``score`` is that of label 1; label 0 has none."""
    order, alive = _over_time(n)
    first = (np.cumsum(n) - n)[order]
    unary = np.stack([np.zeros_like(score), score], 1)
    alpha, beta = np.zeros_like(unary), np.zeros_like(unary)
    for t, m in enumerate(alive.tolist()):
        at = first[:m] + t
        if t:
            at_before = alpha[at - 1]
            alpha[at] = np.logaddexp(at_before[:, :1] + move[0], at_before[:, 1:] + move[1])
        alpha[at] += unary[at]
    for t in range(len(alive) - 2, -1, -1):
        at = first[: alive[t + 1]] + t
        ahead = beta[at + 1] + unary[at + 1]
        beta[at] = np.logaddexp(ahead[:, :1] + move[:, 0], ahead[:, 1:] + move[:, 1])
    both = alpha + beta
    last = (np.cumsum(n) - 1)[n > 0]
    total = np.zeros(len(n))
    total[n > 0] = np.logaddexp(alpha[last, 0], alpha[last, 1])
    inner = np.ones(len(score), bool)
    inner[last] = False
    at = np.flatnonzero(inner)
    chain = np.repeat(total, n)[at]
    moves = np.array(
        [[np.exp(alpha[at, i] + move[i, j] + unary[at + 1, j] + beta[at + 1, j] - chain).sum() for j in (0, 1)] for i in (0, 1)]
    )
    return both[:, 1] - both[:, 0], total, moves


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


class LineCrf:
    def __init__(self, rounds: int = ROUNDS, penalty: float = 1e-3, step: float = 0.1):
        self.features, self.rounds, self.penalty, self.step = LineFeatures(), rounds, penalty, step
        self.weights = np.zeros(1 + 3 * self.features.own + 2)
        self.move = np.zeros((2, 2))
        self.scale = np.array([1.0, 0.0])

    def fit(self, rows: list[tuple], counts: dict) -> LineCrf:
        if len({t for _, t in rows}) < 2:  # nothing to tell apart: every document scores the label's share
            share = sum(t for _, t in rows) / len(rows) if rows else 0.5
            self.scale = np.array([0.0, float(_logit(np.array(share)))])
            return self
        x, length, n = self.features.rows([t for t, _ in rows])
        target = np.array([t for _, t in rows])
        line = np.repeat(target, n).astype(float)
        weight = np.repeat(1 / np.maximum(n, 1), n)  # a document counts once, however many its lines
        docs = max(1, int((n > 0).sum()))
        inner = np.ones(len(line), bool)
        inner[(np.cumsum(n) - 1)[n > 0]] = False
        at = np.flatnonzero(inner)
        seen = np.zeros((2, 2))
        np.add.at(seen, (line[at].astype(int), line[at + 1].astype(int)), 1)
        g1, g2 = np.zeros(len(self.weights) + 4), np.zeros(len(self.weights) + 4)
        for k in range(1, self.rounds + 1):
            odds, _, moves = forward_backward(x @ self.weights, self.move, n)
            slope = x.T @ ((line - _sigmoid(odds)) * weight) / docs - self.penalty * self.weights
            shift = (seen - moves) / max(1, len(at)) - 0.02 * self.move
            g = np.concatenate([slope, shift.ravel()])
            g1, g2 = 0.9 * g1 + 0.1 * g, 0.99 * g2 + 0.01 * g * g
            step = self.step * (g1 / (1 - 0.9**k)) / (np.sqrt(g2 / (1 - 0.99**k)) + 1e-8)
            self.weights += step[:-4]
            self.move += step[-4:].reshape(2, 2)
        mean = self._means(x, length, n)
        share = np.array([counts[t] / max(1, (target == t).sum()) for t in (0, 1)])[target]
        a, b, z = 1.0, 0.0, _logit(mean)
        keep = n > 0
        for _ in range(50):  # Newton's method on the weighted logistic loss
            p = _sigmoid(a * z + b)
            d, w = ((target - p) * share)[keep], (share * p * (1 - p) + 1e-6)[keep]
            zz = z[keep]
            hess = np.array([[(w * zz * zz).sum() + 1.0, (w * zz).sum()], [(w * zz).sum(), w.sum() + 1.0]])
            da, db = np.linalg.solve(hess, [(d * zz).sum() - (a - 1), d.sum() - b])
            a, b = a + np.clip(da, -1, 1), b + np.clip(db, -1, 1)
        self.scale = np.array([a, b])
        return self

    def _means(self, x, length, n) -> np.ndarray:
        good = _sigmoid(forward_backward(x @ self.weights, self.move, n)[0])
        doc = np.repeat(np.arange(len(n)), n)
        return np.bincount(doc, good * length, len(n)) / np.maximum(np.bincount(doc, length, len(n)), 1)

    def score(self, texts: list[str | None]) -> np.ndarray:
        x, length, n = self.features.rows([t or "" for t in texts])
        return np.where(n > 0, _sigmoid(self.scale[0] * _logit(self._means(x, length, n)) + self.scale[1]), 0.0)


def learnt_from() -> Column:
    return remainder("doc_id", 4) != 2


def fitted(docs: DataFrame, labels: DataFrame, most: int = MOST) -> LineCrf:
    """A model of about ``most`` documents of each label, of ids whose crc32 modulo 4 is not 2."""
    return LineCrf().fit(*labelled_rows(docs, labels, "quality", learnt_from(), most))


def quality(text: Column, broadcast) -> Column:
    """Scores of whole texts from 0 to 1; null texts and texts without a visible character score 0."""

    @F.pandas_udf("double")
    def of_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = received(broadcast)
        for texts in slices(batches):
            yield pd.Series(model.score(texts.tolist()))

    return of_batches(text)


def scored(docs: DataFrame, labels: DataFrame, most: int = MOST) -> DataFrame:
    """``docs`` with ``score`` (replaced if there). Every row has its score, repeated rows and null ids too; rows
    with equal texts score alike. Without labels of both kinds every text scores their share, or one half."""
    docs = bounded(docs)
    return docs.withColumn("score", quality(F.col("text"), sent(docs.sparkSession, fitted(docs, labels, most))))


def op4_quality_crf(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scored(docs, table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id", (~learnt_from()).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
