"""Language identification in two steps: the family first, then the languages of that family.

Texts are hashed character pairs and triples of the whole text. A linear support vector machine for each
family against the rest picks the family; inside it, one for each two languages decide by votes. All are
fitted by dual coordinate descent on a bounded sample of labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelake.llm.shared import bounded, learnt_rows, received, remainder, sent, slices, table

MOST = 1000
SIZE = 4096
UNKNOWN = "und"
#: Languages by family; one that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "sl", "mk"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
    "indic": ("hi", "bn", "ur", "mr", "pa", "gu", "ne"),
}
_LETTER = regex.compile(r"\p{L}")
_AT_ONCE = 1 << 20


def _letters() -> np.ndarray:
    """Code points with everything that is no letter as a space."""
    codes = np.arange(0x3000)
    return np.where([chr(c).isalpha() for c in codes], codes, 32).astype(np.uint32)


class Features:
    def __init__(self):
        self.map = _letters()

    def __call__(self, text: str) -> np.ndarray:
        codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4")
        counts = np.zeros(SIZE)
        for at in range(0, len(codes), _AT_ONCE):
            part = codes[at : at + _AT_ONCE + 2]
            part = np.where(part < 0x3000, self.map[np.minimum(part, 0x2FFF)], part)
            two = part[:-1] * np.uint32(0x9E3779B1) + part[1:] * np.uint32(0x85EBCA6B)
            three = two[:-1] ^ (part[2:] * np.uint32(0xC2B2AE35))
            pairs = (part[:-1] != 32) | (part[1:] != 32)
            for h, keep in ((two, pairs), (three, pairs[:-1])):
                counts += np.bincount((h >> np.uint32(20))[keep], minlength=SIZE)
        root = np.sqrt(counts)
        return (root / max(1.0, np.sqrt(counts.sum()))).astype(np.float32)


def linear_svm(x: np.ndarray, y: np.ndarray, cost: float = 4.0, epochs: int = 12, seed: int = 1) -> np.ndarray:
    """Weights (the last is the bias) of the squared-hinge machine; classes 1 and -1 count alike."""
    x = np.hstack([x, np.full((len(x), 1), 0.5, np.float32)])
    w, alpha = np.zeros(x.shape[1], np.float32), np.zeros(len(x))
    share = {s: len(y) / (2 * max(1, (y == s).sum())) for s in (1, -1)}
    slack = np.array([1 / (2 * cost * share[s]) for s in y.tolist()])
    norm, rng = (x * x).sum(axis=1) + slack, np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(x)).tolist():
            slope = y[i] * float(w @ x[i]) - 1 + slack[i] * alpha[i]
            new = max(0.0, alpha[i] - slope / norm[i])
            if new != alpha[i]:
                w += np.float32((new - alpha[i]) * y[i]) * x[i]
                alpha[i] = new
    return w


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class LanguageModel:
    def __init__(self):
        self.features, self.languages, self.families = Features(), [], []

    def fit(self, rows: list[tuple]) -> LanguageModel:
        rows = [(t, y) for t, y in rows if _LETTER.search(t)]
        self.languages = sorted({y for _, y in rows})
        family = {lang: name for name, members in FAMILIES.items() for lang in members}
        of = {lang: family.get(lang, lang) for lang in self.languages}
        self.families = sorted(set(of.values()))
        self.members = {f: [x for x in self.languages if of[x] == f] for f in self.families}
        if not rows:
            return self
        x = np.stack([self.features(t) for t, _ in rows])
        lang, fam = np.array([y for _, y in rows]), np.array([of[y] for _, y in rows])
        several = len(self.families) > 1
        self.first = np.stack([linear_svm(x, np.where(fam == f, 1, -1)) for f in self.families], 1) if several else None
        self.pairs = {}
        for members in self.members.values():
            for i, a in enumerate(members):
                for b in members[i + 1 :]:
                    both = (lang == a) | (lang == b)
                    self.pairs[a, b] = linear_svm(x[both], np.where(lang[both] == a, 1, -1))
        return self

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        known = [i for i, t in enumerate(texts) if t and _LETTER.search(t)] if self.languages else []
        if not known:
            return names, scores
        x = np.stack([self.features(texts[i]) for i in known])
        x = np.hstack([x, np.full((len(x), 1), 0.5, np.float32)])
        family, sure = np.zeros(len(x), np.int64), np.ones(len(x))
        if self.first is not None:
            margin = x @ self.first
            family = margin.argmax(axis=1)
            shares = np.exp(3 * (margin - margin.max(axis=1, keepdims=True)))
            sure = shares.max(axis=1) / shares.sum(axis=1)
        for f, name in enumerate(self.families):
            at, members = np.flatnonzero(family == f), self.members[name]
            votes, weight = np.zeros((len(at), len(members))), np.zeros((len(at), len(members)))
            for i, a in enumerate(members):
                for j in range(i + 1, len(members)):
                    won = _sigmoid(3 * (x[at] @ self.pairs[a, members[j]]))
                    votes[:, i] += won >= 0.5
                    votes[:, j] += won < 0.5
                    weight[:, i] += won
                    weight[:, j] += 1 - won
            best = (votes + weight / (len(members) + 1)).argmax(axis=1) if len(members) > 1 else np.zeros(len(at), np.int64)
            inside = weight[np.arange(len(at)), best] / max(1, len(members) - 1) if len(members) > 1 else np.ones(len(at))
            for k, b, s in zip(at.tolist(), best.tolist(), (sure[at] * inside).tolist()):
                names[known[k]], scores[known[k]] = members[b], float(s)
        return names, scores


def learnt_from() -> Column:
    return remainder("doc_id", 4) != 2


def fitted(docs: DataFrame, most: int = MOST) -> LanguageModel:
    """A model of about ``most`` rows of each language in ``lang``, of ids whose crc32 modulo 4 is not 2."""
    rows = docs.where(learnt_from()).select("doc_id", "text", F.col("lang").alias("target"))
    return LanguageModel().fit(learnt_rows(rows, most)[0])


def language(text: Column, broadcast) -> Column:
    """Struct (lang_pred, score) of whole texts; null texts and texts without a letter are ``und`` with score 0."""

    @F.pandas_udf("lang_pred string, score double")
    def of_batches(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = received(broadcast)
        for texts in slices(batches):
            names, scores = model.predict(texts.tolist())
            yield pd.DataFrame({"lang_pred": pd.Series(names, dtype=object), "score": scores})

    return of_batches(text)


def op3_language_svm(spark, sf_dir):
    """One row per document, repeated rows and null ids too; rows with equal texts are answered alike. Without
    any row to learn from every document is ``und``."""
    docs = bounded(table(spark, sf_dir, "documents"))
    model = sent(spark, fitted(docs))
    found = docs.select("doc_id", (~learnt_from()).alias("held_out"), language(F.col("text"), model).alias("found"))
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")
