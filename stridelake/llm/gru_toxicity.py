"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word enters as the embedding of the word, if it was frequent enough in training, beside the largest
values among the embeddings of its character trigrams and beginnings. Runs of one word count as one. Both directions run over windows of words that overlap and cover
the whole text; attention weighs the states of a window into one vector and that gives the window's
logit. A document's logit is its highest window's. Training goes by documents: each round scores all
windows and learns from each document's highest.

The input side of the gates depends on the word alone, so scoring computes it once for each different word.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelake.llm.shared import bounded, labelled_rows, received, remainder, sent, slices, table

MOST = 2000
THRESHOLD = 0.5
WINDOW, STRIDE = 24, 16
WORD_DIM, CHAR_DIM, HIDDEN, ATTEND = 16, 8, 8, 8
GRAMS = 1 << 15
#: Words are learnt by name if this share of the training documents has them, and five of them.
FREQUENT = 0.003
KNOWN_WORDS = 150_000
_AT_ONCE = 4096
_EDGE = ".,;:!?\"'()[]{}<>|*#%&$-_/\\"


def _plain(token: str) -> str:
    return token.strip(_EDGE)


def _grams(word: str) -> list[int]:
    """Character trigrams, and beginnings of three to eight characters, by hash."""
    marked = f"^{word}$"
    parts = [marked[i : i + 3] for i in range(max(1, len(marked) - 2))]
    parts += [marked[:i] for i in range(4, min(9, len(marked)) + 1)]
    return [zlib.crc32(g.encode("utf-8", "surrogatepass")) % GRAMS for g in parts]


def _words(text: str) -> list[str]:
    tokens = text.lower().split()
    return [a for a, b in zip(tokens, [None, *tokens]) if a != b]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def windows(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts in the words of all texts one after the other, lengths, and texts of all windows.

    A text's windows start every ``STRIDE`` words; the last one ends with the text. A text without words has none.
    """
    count = np.where(sizes > 0, np.maximum(0, -(-(sizes - WINDOW) // STRIDE)) + 1, 0)
    text = np.repeat(np.arange(len(sizes)), count)
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    offset = np.minimum(nth * STRIDE, np.maximum(sizes[text] - WINDOW, 0))
    first = (np.cumsum(sizes) - sizes)[text]
    return first + offset, np.minimum(sizes[text], WINDOW), text


class Network:
    """Parameters ``p`` by name; words are rows of inputs."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        d, h = WORD_DIM + CHAR_DIM, HIDDEN

        def normal(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.vocabulary: dict[str, int] = {}
        self.p = {
            "chars": normal(GRAMS, CHAR_DIM, scale=0.02),
            "words": np.zeros((1, WORD_DIM), np.float32),
            "w": normal(2, d, 3 * h, scale=d**-0.5),
            "b": np.zeros((2, 1, 3 * h), np.float32),
            "u": normal(2, h, 3 * h, scale=h**-0.5),
            "bu": np.zeros((2, 1, 3 * h), np.float32),
            "att": normal(2 * h, ATTEND, scale=(2 * h) ** -0.5),
            "ba": np.zeros(ATTEND, np.float32),
            "v": normal(ATTEND, scale=ATTEND**-0.5),
            "out": normal(2 * h, scale=(2 * h) ** -0.5),
            "bo": np.zeros(1, np.float32),
        }
        self.scale = np.array([1.0, 0.0])
        self.known: dict[str, int] = {}
        self.gates = np.zeros((0, 2, 3 * h), np.float32)

    # inputs

    def _inputs(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Rows of the words, their place in the vocabulary (0: none), grams one after the other and how many."""
        place = np.fromiter((self.vocabulary.get(w, 0) for w in words), np.int64, len(words))
        grams = [_grams(w) for w in words]
        n = np.fromiter(map(len, grams), np.int64, len(grams))
        flat = np.fromiter((g for x in grams for g in x), np.int64, int(n.sum()))
        first = np.cumsum(n) - n
        most = np.maximum.reduceat(self.p["chars"][flat], first, axis=0) if len(words) else np.zeros((0, CHAR_DIM))
        return np.hstack([self.p["words"][place], most]).astype(np.float32), place, flat, n

    def _lookup(self, tokens: list[str]) -> np.ndarray:
        """Rows of ``gates`` of the tokens, new words added."""
        new = [t for t in dict.fromkeys(tokens) if t not in self.known]
        if len(self.known) + len(new) > KNOWN_WORDS:
            self.known, self.gates = {}, self.gates[:0]
            new = list(dict.fromkeys(tokens))
        if new:
            x = self._inputs([_plain(t) for t in new])[0]
            gates = (x @ self.p["w"] + self.p["b"]).transpose(1, 0, 2)
            self.known.update(zip(new, range(len(self.gates), len(self.gates) + len(new))))
            self.gates = np.concatenate([self.gates, gates])
        return np.fromiter(map(self.known.__getitem__, tokens), np.int64, len(tokens))

    # the network over windows of gate inputs: g (2, T, B, 3H), the second direction from the end

    def _forward(self, g: np.ndarray, live: np.ndarray, keep: bool = False):
        p, h = self.p, HIDDEN
        steps, rows = g.shape[1], g.shape[2]
        state = np.zeros((2, rows, h), np.float32)
        states = np.empty((2, steps, rows, h), np.float32)
        trace = []
        for t in range(steps):
            on = np.stack([live[t], live[steps - 1 - t]])[:, :, None]
            rec = state @ p["u"] + p["bu"]
            zr = _sigmoid(g[:, t, :, : 2 * h] + rec[:, :, : 2 * h])
            z, r = zr[:, :, :h], zr[:, :, h:]
            n = np.tanh(g[:, t, :, 2 * h :] + r * rec[:, :, 2 * h :])
            new = np.where(on, n + z * (state - n), state)
            if keep:
                trace.append((state, z, r, n, rec[:, :, 2 * h :], on))
            state = states[:, t] = new
        both = np.concatenate([states[0], states[1][::-1]], axis=2)  # T, B, 2H
        act = np.tanh(both @ p["att"] + p["ba"])
        score = np.where(live, act @ p["v"], -np.inf)
        weight = np.exp(score - score.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = (weight[:, :, None] * both).sum(axis=0)
        logit = pooled @ p["out"] + p["bo"][0]
        return (logit, trace, both, act, weight, pooled) if keep else logit

    def _backward(self, d: np.ndarray, g_shape: tuple, trace, both, act, weight, pooled) -> tuple[dict, np.ndarray]:
        """Gradients by parameter and those of the gate inputs; ``d`` is that of the logits."""
        p, h, steps = self.p, HIDDEN, g_shape[1]
        grad = {"out": pooled.T @ d, "bo": np.array([d.sum()])}
        d_pooled = d[:, None] * p["out"]
        d_weight = (both * d_pooled).sum(axis=2)
        d_both = weight[:, :, None] * d_pooled
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        grad["v"] = (act * d_score[:, :, None]).sum(axis=(0, 1))
        d_act = d_score[:, :, None] * p["v"] * (1 - act * act)
        grad["att"] = both.reshape(-1, 2 * h).T @ d_act.reshape(-1, ATTEND)
        grad["ba"] = d_act.sum(axis=(0, 1))
        d_both = d_both + d_act @ p["att"].T
        d_states = np.stack([d_both[:, :, :h], d_both[::-1, :, h:]])
        dg = np.zeros(g_shape, np.float32)
        grad["u"], grad["bu"] = np.zeros_like(p["u"]), np.zeros_like(p["bu"])
        d_state = np.zeros_like(d_states[:, 0])
        for t in range(steps - 1, -1, -1):
            state, z, r, n, rec_n, on = trace[t]
            d_state = d_state + d_states[:, t]
            live = np.where(on, d_state, 0)
            dn = live * (1 - z) * (1 - n * n)
            dz = live * (state - n) * z * (1 - z)
            dr = dn * rec_n * r * (1 - r)
            dg[:, t] = np.concatenate([dz, dr, dn], axis=2)
            d_rec = np.concatenate([dz, dr, dn * r], axis=2)
            grad["u"] += state.transpose(0, 2, 1) @ d_rec
            grad["bu"] += d_rec.sum(axis=1, keepdims=True)
            d_state = np.where(on, live * z, d_state) + d_rec @ p["u"].transpose(0, 2, 1)
        return grad, dg

    # whole texts

    def _window_logits(self, rows: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        out = np.empty(len(start), np.float32)
        for at in range(0, len(start), _AT_ONCE):
            s, n = start[at : at + _AT_ONCE], length[at : at + _AT_ONCE]
            steps = np.arange(int(n.max()))[:, None]
            live = steps < n
            ids = rows[np.where(live, s + steps, s)]
            g = np.stack([self.gates[ids, 0], self.gates[ids[::-1], 1]])
            out[at : at + _AT_ONCE] = self._forward(g, live)
        return out

    def logits(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The highest window's logit of each text (-inf without words), that window's start and length."""
        tokens = [_words(t) if t else [] for t in texts]
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        start, length, text = windows(sizes)
        best, at = np.full(len(texts), -np.inf), np.zeros(len(texts), np.int64)
        if len(start):
            out = self._window_logits(self._lookup([w for t in tokens for w in t]), start, length)
            by = np.lexsort((out, text))
            last = np.flatnonzero(np.r_[text[by][1:] != text[by][:-1], True])
            best[text[by][last]], at[text[by][last]] = out[by][last], by[last]
            return best, start[at], length[at]
        return best, at, at

    def score(self, texts: list[str | None]) -> np.ndarray:
        best = self.logits(texts)[0]
        some = np.isfinite(best)
        return np.where(some, _sigmoid(self.scale[0] * np.where(some, best, 0) + self.scale[1]), 0.0)

    # training

    def fit(self, rows: list[tuple], counts: dict, rounds: int = 7, batch: int = 256, step: float = 0.01) -> Network:
        rows = sorted(set(rows))  # copies would make a document's rare words look like signs of its label
        target = np.array([t for _, t in rows], np.float32)
        if len(set(target.tolist())) < 2:  # nothing to tell apart: every text scores the label's share
            share = float(np.clip(target.mean() if len(target) else 0.0, 1e-4, 1 - 1e-4))
            self.scale = np.array([0.0, np.log(share / (1 - share))])
            return self
        same: dict[str, str] = {}  # one copy of every word
        tokens = [[same.setdefault(w, w) for w in map(_plain, _words(t))] for t, _ in rows]
        self._start_words(tokens, target)
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        words = list(dict.fromkeys(w for t in tokens for w in t))
        number = {w: i for i, w in enumerate(words)}
        flat = np.fromiter((number[w] for t in tokens for w in t), np.int64, int(sizes.sum()))
        start, length, text = windows(sizes)
        rng = np.random.default_rng(3)
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        balance = np.where(target == 1, 0.5 / target.mean(), 0.5 / (1 - target.mean())).astype(np.float32)
        k = 0
        for _ in range(rounds):
            x, place, grams, n = self._inputs(words)
            self.gates = (x @ self.p["w"] + self.p["b"]).transpose(1, 0, 2)
            out = self._window_logits(flat, start, length)
            by = np.lexsort((out, text))
            top = by[np.r_[text[by][1:] != text[by][:-1], True]]
            more = rng.permutation(np.flatnonzero(target[text] == 0))[: len(top) // 2]
            chosen = rng.permutation(np.r_[top, more])
            for at in range(0, len(chosen), batch):
                k += 1
                self._learn(chosen[at : at + batch], flat, start, length, text, target, balance, words, place, grams, n, moments, step, k)
        x = self._inputs(words)[0]
        self.gates = (x @ self.p["w"] + self.p["b"]).transpose(1, 0, 2)
        out = self._window_logits(flat, start, length)
        best = np.full(len(rows), -np.inf)
        np.maximum.at(best, text, out)
        self._calibrate(best, target, counts)
        self.known, self.gates = {}, self.gates[:0]
        return self

    def _start_words(self, tokens: list[list[str]], target: np.ndarray) -> None:
        """The vocabulary, and the log odds of the label as the first number of words and grams."""
        seen: dict[str, np.ndarray] = {}
        grams, of_word = np.zeros((GRAMS, 2)), {}
        for t, y in zip(tokens, target.astype(int).tolist()):
            some = set()
            for w in set(t):
                seen.setdefault(w, [0, 0])[y] += 1
                if w not in of_word:
                    of_word[w] = _grams(w)
                some.update(of_word[w])
            grams[list(some), y] += 1
        ones, rest = target.sum(), len(target) - target.sum()
        least = max(5, FREQUENT * len(tokens))

        def odds(counts: np.ndarray) -> np.ndarray:
            value = 0.5 * np.log(((counts[:, 1] + 1) / (ones + 2)) / ((counts[:, 0] + 1) / (rest + 2)))
            return np.where(counts.sum(axis=1) >= least, value, 0)

        kept = sorted(w for w, c in seen.items() if w and sum(c) >= least)
        self.vocabulary = {w: i + 1 for i, w in enumerate(kept)}
        start = np.random.default_rng(1).standard_normal((len(kept) + 1, WORD_DIM)).astype(np.float32) * 0.05
        start[0] = 0
        if kept:
            start[1:, 0] = odds(np.array([seen[w] for w in kept]))
        self.p["words"] = start
        self.p["chars"][:, 0] = odds(grams)

    def _learn(self, chosen, flat, start, length, text, target, balance, words, place, grams, n, moments, step, k) -> None:
        s, size = start[chosen], length[chosen]
        steps = np.arange(int(size.max()))[:, None]
        live = steps < size
        ids = flat[np.where(live, s + steps, s)]
        unique, inverse = np.unique(ids, return_inverse=True)
        inverse = inverse.reshape(ids.shape)
        x, place, grams, n = self._inputs([words[i] for i in unique])
        gates = (x @ self.p["w"] + self.p["b"]).transpose(1, 0, 2)
        g = np.stack([gates[inverse, 0], gates[inverse[::-1], 1]])
        logit, *kept = self._forward(g, live, keep=True)
        weight = balance[text[chosen]]
        d = ((_sigmoid(logit) - target[text[chosen]]) * weight / weight.sum()).astype(np.float32)
        grad, dg = self._backward(d, g.shape, *kept)
        d_gates = np.zeros((2, len(unique), 3 * HIDDEN), np.float32)
        np.add.at(d_gates[0], inverse.ravel(), dg[0].reshape(-1, 3 * HIDDEN))
        np.add.at(d_gates[1], inverse[::-1].ravel(), dg[1].reshape(-1, 3 * HIDDEN))
        grad["w"], grad["b"] = x.T @ d_gates, d_gates.sum(axis=1, keepdims=True)
        dx = (d_gates @ self.p["w"].transpose(0, 2, 1)).sum(axis=0)
        grad["words"], grad["chars"] = np.zeros_like(self.p["words"]), np.zeros_like(self.p["chars"])
        np.add.at(grad["words"], place, dx[:, :WORD_DIM])
        grad["words"][0] = 0
        largest = self.p["chars"][grams] == np.repeat(x[:, WORD_DIM:], n, axis=0)
        np.add.at(grad["chars"], grams, np.where(largest, np.repeat(dx[:, WORD_DIM:], n, axis=0), 0))
        norm = np.sqrt(sum(float((v * v).sum()) for v in grad.values()))
        for name, v in grad.items():
            m1, m2 = moments[name]
            v = v * min(1.0, 1.0 / (norm + 1e-9))
            m1 += 0.1 * (v - m1)
            m2 += 0.01 * (v * v - m2)
            move = step * (m1 / (1 - 0.9**k)) / (np.sqrt(m2 / (1 - 0.99**k)) + 1e-7)
            decay = 0.002 if name in ("words", "chars") else 0.0005
            self.p[name] = (self.p[name] * (1 - decay) - move * (0.3 if name == "chars" else 1.0)).astype(np.float32)

    def _calibrate(self, best: np.ndarray, target: np.ndarray, counts: dict) -> None:
        keep = np.isfinite(best)
        z, y = best[keep], target[keep]
        share = np.array([counts[t] / max(1, (target == t).sum()) for t in (0, 1)])[y.astype(int)]
        a, b = 1.0, 0.0
        for _ in range(60):
            p = _sigmoid(a * z + b)
            d, w = (y - p) * share, share * p * (1 - p) + 1e-6
            hess = np.array([[(w * z * z).sum() + 5.0, (w * z).sum()], [(w * z).sum(), w.sum() + 1.0]])
            da, db = np.linalg.solve(hess, [(d * z).sum() - 5.0 * (a - 1), d.sum() - b])
            a, b = a + np.clip(da, -0.5, 0.5), b + np.clip(db, -0.5, 0.5)
        self.scale = np.array([a, b])


def learnt_from() -> Column:
    return remainder("doc_id", 5) != 0


def fitted(docs: DataFrame, labels: DataFrame, most: int = MOST) -> Network:
    """A network of about ``most`` documents of each label, of ids whose crc32 modulo 5 is not 0."""
    return Network().fit(*labelled_rows(docs, labels, "toxic", learnt_from(), most))


def toxicity(text: Column, broadcast) -> Column:
    """Scores of whole texts from 0 to 1; null texts and texts without words score 0."""

    @F.pandas_udf("double")
    def of_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = received(broadcast)
        for texts in slices(batches):
            yield pd.Series(model.score(texts.tolist()))

    return of_batches(text)


def scored(docs: DataFrame, labels: DataFrame, most: int = MOST) -> DataFrame:
    """``docs`` with ``score`` (replaced if there). Every row has its score, repeated rows and null ids too; rows
    with equal texts score alike. Without labels of both kinds every text with words scores their share."""
    docs = bounded(docs)
    return docs.withColumn("score", toxicity(F.col("text"), sent(docs.sparkSession, fitted(docs, labels, most))))


def op5_toxicity_gru(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scored(docs, table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id", (~learnt_from()).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
