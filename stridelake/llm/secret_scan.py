"""Secret scan: candidates by grammar, false positives removed by a random forest.

Candidates are runs of at least sixteen token characters with a digit or mixed case, values assigned to a
name that speaks of secrets, passwords in addresses, tokens in the form of a known issuer, and private key blocks.
The forest looks at the candidate's length and characters, how usual its character transitions are, how much of it
dictionary words cover, marks of paths, identifiers and issuers, and the words beside it. Transitions and dictionary
are counted over all documents; the forest is trained on labelled findings, a bounded sample of them, and not on
doubtful ones. ``findings`` has labelled findings of many kinds to learn from as well.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelake.llm.findings import stated_findings
from stridelake.llm.shared import bounded, free_name, received, remainder, saved, sent, slices, table

MOST = 2000
SHARE = 1e-6
THRESHOLD = 0.5
CONTEXT = 60
FAR = "x://"
LONGEST_FINDING = 4096
MASK = "[SECRET]"
#: Names that speak of secrets.
NAMES = ("token", "secret", "password", "passwd", "pwd", "apikey", "api_key", "api-key", "access_key", "private_key",
         "auth", "credential", "credentials", "bearer")
_NAMED = "(?:" + "|".join(sorted(map(re.escape, NAMES), key=len, reverse=True)) + ")"
#: Tokens that issuers mark by a prefix or a form of their own.
_ISSUED = (
    r"(?<![A-Za-z0-9_-])(?:(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])|gh[pousr]_[A-Za-z0-9]{20,}|github_pat_[A-Za-z0-9_]{20,}"
    r"|glpat-[A-Za-z0-9_-]{20,}|sk-[A-Za-z0-9_-]{20,}|[rs]k_(?:live|test)_[A-Za-z0-9]{16,}|xox[abeoprs]-[A-Za-z0-9-]{10,}"
    r"|AIza[A-Za-z0-9_-]{35}|npm_[A-Za-z0-9]{36}|hf_[A-Za-z0-9]{30,}|SG\.[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{16,}"
    r"|eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})"
)
_BEGIN, _END = (re.compile(rf"-----{w} [A-Z ]{{0,40}}PRIVATE KEY(?: BLOCK)?-----") for w in ("BEGIN", "END"))
_LOGIN = r"(?<![A-Za-z0-9+.-])[A-Za-z][A-Za-z0-9+.-]{1,20}://[^\s/@:\"'<>]{0,100}:(?P<login>[^\s/@\"'<>]{3,200})@"
_CANDIDATE = re.compile(
    rf"(?P<issued>{_ISSUED})|{_LOGIN}"
    rf"|(?i:(?<![A-Za-z]){_NAMED}[\"']?[ \t]{{0,3}}[=:][ \t]{{0,3}}[\"']?)(?P<value>[^\s\"']{{8,}})"
    r"|(?P<run>[A-Za-z0-9+/_=-]{16,})"
)
_AT_LOGIN = re.compile(r"://[^\s/@:\"'<>]*:$")
_UUID = re.compile(r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$")
_ASSIGNED = re.compile(rf"(?i)(?<![A-Za-z]){_NAMED}[\"']?[ \t]{{0,3}}[=:][ \t]{{0,3}}[\"']?$")
_IS_ISSUED = re.compile(_ISSUED)
_NUMBER = re.compile(r"[\d+/_=-]+$")
_HEX = re.compile(r"[0-9a-fA-F]{16,}$")
_HASH_NAME = re.compile(r"(?i)(?<![a-z])(?:commit|revision|rev|merge|tree|parent|checksum|digest|hash|sha-?\d*|md5)[\"']?[ \t:=(]{1,3}[\"'(]?$")
_URL = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*://[^\s?@\"'<>]*$")
_PATH = re.compile(r"(?:[A-Za-z]:|~|\.{1,2})?(?:[/\\][a-z._-]+\d{0,4}){2,}[/\\]?$")
_EMPTY = re.compile(r"<[^<>]*>$|\$\{|\{\{|%[({]|(.)\1*$")
_CODE = re.compile(r"[A-Za-z_]\w*(?:\.\w+)*[(\[]")
_PIECES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_LETTERS = re.compile(r"[^\W\d_]+")
_CLASSES = 40
_HELD = 32 << 20


def _class_table() -> bytes:
    """Letters by themselves without case, digits as one, then space, path marks, other."""
    kinds = bytearray([39] * 256)
    for c in range(26):
        kinds[65 + c] = kinds[97 + c] = c
    for c in b"0123456789":
        kinds[c] = 26
    for c in b" \t\r\n":
        kinds[c] = 27
    for i, c in enumerate(b"/._-+=:"):
        kinds[c] = 28 + i
    return bytes(kinds)


_TABLE = _class_table()


def _key_blocks(text: str) -> Iterator[tuple[int, int]]:
    """From each begin mark to the next end mark; every mark is looked at once."""
    ends = _END.finditer(text)
    end, done = next(ends, None), 0
    for begin in _BEGIN.finditer(text):
        while end is not None and end.start() < begin.end():
            end = next(ends, None)
        if end is None:
            return
        if begin.start() >= done:
            done = end.end()
            yield begin.start(), done


def candidates(text: str) -> list[tuple[int, int]]:
    """Spans (start, end) of candidates, in order, none overlapping. Linear in the text."""
    out, at = [], 0
    for start, end in (*_key_blocks(text), (len(text), len(text))):
        for m in _CANDIDATE.finditer(text, at, start):
            run = m["run"]
            if run is None or any(c.isdigit() for c in run) or not (run[1:].islower() or run.isupper()):
                part = next((g for g in ("value", "login") if m[g] is not None), 0)
                out.append(m.span(part))
        if start < end:
            out.append((start, end))
        at = end
    return out


def contexts(text: str) -> Iterator[tuple[int, int, str, str, str]]:
    """Start, end, text before, candidate and text after of every candidate; ``FAR`` stands before the text of one
    that is deep in an address, whose beginning is not in what is shown."""
    done, inside = 0, False
    for start, end in candidates(text):
        between = text[done:start]
        word = "" if between[-1:].isspace() else (between.split() or [""])[-1]
        inside = "://" in word or (inside and len(word) == len(between))
        before = text[max(0, start - CONTEXT) : start]
        far = inside and "://" not in (before.split() or [""])[-1]
        yield start, end, (FAR if far else "") + before, text[start:end], text[end : end + CONTEXT]
        done = end


def _in_address(before: str) -> bool:
    return not before[-1:].isspace() and "://" in (before.split() or [""])[-1]


def _of_words(candidate: str, words: set[str] | frozenset[str]) -> bool:
    """Dictionary words, joined by case, marks or short numbers."""
    pieces = _PIECES.findall(candidate)
    letters = [p.lower() for p in pieces if p.isalpha()]
    known = sum(len(p) for p in letters if p in words)
    return bool(letters) and known == sum(map(len, letters)) and 2 * known > len(candidate)


def rule(before: str, candidate: str, after: str, words: set[str] | frozenset[str] = frozenset()) -> int | None:
    """The label of a finding where nobody has given one; None where the text leaves it open.

    1: a private key, a token of a known issuer, a value assigned to a secret's name. 0: what is clearly something
    else (address, path, placeholder, plain number, hash that is called so, words of the dictionary ``words``).
    """
    if candidate.startswith("-----BEGIN") or _IS_ISSUED.search(candidate):
        return 1
    if _AT_LOGIN.search(before) and after[:1] == "@":
        return 0 if _EMPTY.match(candidate) else 1
    if _ASSIGNED.search(before):
        if _EMPTY.match(candidate) or _URL.match(candidate) or _PATH.match(candidate):
            return 0
        quoted = before[-1:] in ("'", '"')
        plain = candidate.rstrip(".,;:!?)")
        if not quoted and (_CODE.match(candidate) or (plain.isalpha() and (plain[1:].islower() or plain.isupper()))):
            return None  # an expression, or a word of running text
        return 1
    left = before[-CONTEXT:].split()[-1:] if not before[-1:].isspace() else []
    if _NUMBER.match(candidate) or (left and _URL.search(left[0])) or _PATH.match(candidate):
        return 0
    if _HEX.match(candidate):
        return 0 if _HASH_NAME.search(before) else None
    return 0 if _of_words(candidate, words) else None


# what the corpus says


def _word_rows(words: Counter) -> pd.DataFrame:
    joined: Counter = Counter()
    for token, n in words.items():
        word = token if token.isalpha() else "".join(_LETTERS.findall(token))
        if len(word) >= 3:
            joined[word] += n
    return pd.DataFrame({"word": pd.Series(list(joined), dtype=object), "pair": -1, "n": list(joined.values())})


def _count_part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    words: Counter = Counter()
    pairs = np.zeros(_CLASSES * _CLASSES + 1, np.int64)  # the last: all tokens
    for batch in batches:
        for text in batch["text"]:
            if text:
                kinds = np.frombuffer(text.encode("utf-8", "surrogatepass").translate(_TABLE), np.uint8).astype(np.int64)
                pairs += np.bincount(kinds[:-1] * _CLASSES + kinds[1:], minlength=len(pairs))
                tokens = [w for w in text.lower().split() if len(w) >= 3]
                pairs[-1] += len(tokens)
                words.update(tokens)
        if len(words) > 150_000 or sum(map(len, words)) > _HELD:
            yield _word_rows(words)
            words.clear()
    yield _word_rows(words)
    some = np.flatnonzero(pairs)
    yield pd.DataFrame({"word": "", "pair": some, "n": pairs[some]})


class Corpus:
    """The words of more than a share of all tokens, and the character transitions of all documents."""

    def __init__(self, words: set[str], pairs: np.ndarray):
        self.words = words
        lengths: dict[str, set[int]] = {}
        for w in words:
            lengths.setdefault(w[:3], set()).add(len(w))
        self.lengths = {start: sorted(found, reverse=True) for start, found in lengths.items()}
        table_ = pairs.reshape(_CLASSES, _CLASSES) + 1.0
        self.log = np.log(table_ / table_.sum(axis=1, keepdims=True))

    def covered(self, low: str) -> int:
        """Characters that dictionary words cover: greedy, the longest that starts at each place."""
        covered, at = 0, 0
        while at < len(low):
            hit = next((k for k in self.lengths.get(low[at : at + 3], ()) if low[at : at + k] in self.words), 0)
            covered += hit
            at += hit or 1
        return covered


def corpus(docs: DataFrame, share: float = SHARE) -> Corpus:
    """The dictionary is every word, of any length, that is seen twice and makes up ``share`` of all tokens of three and
    more characters: the same rule at every size, and never more than 1 / ``share`` words. A word is a token's letters."""
    counted = bounded(docs).select("text").mapInPandas(_count_part, "word string, pair long, n long")
    counts = counted.groupBy("word", "pair").agg(F.sum("n").alias("n"))
    counts = saved(counts.where("pair >= 0 OR n > 1"), "secrets-counts")
    pairs = np.zeros(_CLASSES * _CLASSES + 1)
    for r in counts.where("pair >= 0").collect():
        pairs[r["pair"]] = r["n"]
    frequent = counts.where((F.col("pair") < 0) & (F.col("n") >= F.lit(float(share * pairs[-1])))).select("word")
    return Corpus({r["word"] for r in frequent.collect()}, pairs[:-1])


# features

FEATURES = (
    "length", "distinct", "entropy", "digits", "upper", "lower", "marks", "hex", "switches", "usual", "rarest", "covered",
    "slashes", "dots", "path_before", "url", "assigned", "named", "quoted", "word_before", "word_after", "line_start", "issued",
    "login", "uuid", "hash_named", "path", "encoded", "piece", "separators",
)


def features(about: Corpus, before: str, candidate: str, after: str) -> list[float]:
    n = len(candidate)
    count = np.array(list(Counter(candidate).values()), float) / n
    kinds = np.frombuffer(candidate.encode("utf-8", "surrogatepass").translate(_TABLE), np.uint8)
    moves = about.log[kinds[:-1], kinds[1:]] if len(kinds) > 1 else np.zeros(1)
    groups = np.where(kinds < 26, 0, np.where(kinds == 26, 1, 2))
    low = candidate.lower()
    covered = about.covered(low)
    left, right = before.split(), after.split()
    last = "".join(_LETTERS.findall(left[-1].lower())) if left else ""
    first = "".join(_LETTERS.findall(right[0].lower())) if right else ""
    tail = before.rstrip(" \t\"'")
    named = any(name in "".join(left[-3:]).lower() for name in NAMES)
    return [
        float(np.log2(n)), len(count), float(-(count * np.log2(count)).sum()),
        sum(map(str.isdigit, candidate)) / n, sum(map(str.isupper, candidate)) / n, sum(map(str.islower, candidate)) / n,
        float((groups == 2).mean()), float(all(c in "0123456789abcdefABCDEF" for c in candidate)),
        float((groups[1:] != groups[:-1]).mean()) if n > 1 else 0.0, float(moves.mean()), float(moves.min()), covered / n,
        candidate.count("/"), candidate.count("."), float(before[-1:] in ("/", "\\", ".")), float(_in_address(before) or "://" in candidate),
        float(tail[-1:] in ("=", ":")), float(named), float(before[-1:] in ("'", '"') and after[:1] == before[-1:]),
        float(last in about.words), float(first in about.words), float(not before or before.endswith("\n")),
        float(candidate.startswith("-----BEGIN") or bool(_IS_ISSUED.search(candidate))),
        float(after[:1] == "@" and bool(_AT_LOGIN.search(before))), float(bool(_UUID.match(candidate))),
        float(bool(_HASH_NAME.search(before))), float(bool(_PATH.match(candidate))), float("base64," in before[-12:]),
        len(candidate) / max(1, len(_PIECES.findall(candidate))), sum(map(candidate.count, "-_/")) / n,
    ]


# the forest


class Forest:
    def __init__(self, trees: int = 25, depth: int = 9, leaf: int = 2, seed: int = 3):
        self.trees, self.depth, self.leaf, self.seed = trees, depth, leaf, seed
        self.grown: list[tuple] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Forest:
        rng = np.random.default_rng(self.seed)
        self.grown = [self._grow(x[i], y[i], rng) for i in (rng.integers(0, len(x), len(x)) for _ in range(self.trees))] if len(x) else []
        return self

    def _grow(self, x: np.ndarray, y: np.ndarray, rng) -> tuple:
        feature, cut, left, right, value = [], [], [], [], []
        some = max(1, int(np.ceil(np.sqrt(x.shape[1]))))

        def grow(rows: np.ndarray, depth: int) -> int:
            at = len(feature)
            share = y[rows].mean()
            for part, start in ((feature, -1), (cut, 0.0), (left, -1), (right, -1), (value, share)):
                part.append(start)
            if depth == self.depth or share in (0, 1) or len(rows) < 2 * self.leaf:
                return at
            best = None
            for f in rng.permutation(x.shape[1])[:some].tolist():
                column = x[rows, f]
                levels = np.unique(np.quantile(column, np.linspace(0.02, 0.98, 24), method="lower"))
                under = column[:, None] <= levels
                n = under.sum(axis=0)
                ok = (n >= self.leaf) & (len(rows) - n >= self.leaf)
                if not ok.any():
                    continue
                ones = (under & (y[rows][:, None] == 1)).sum(axis=0)
                p, q = ones / np.maximum(n, 1), (y[rows].sum() - ones) / np.maximum(len(rows) - n, 1)
                impure = np.where(ok, n * p * (1 - p) + (len(rows) - n) * q * (1 - q), np.inf)
                k = int(impure.argmin())
                if best is None or impure[k] < best[0]:
                    best = impure[k], f, levels[k]
            if best is None:
                return at
            feature[at], cut[at] = best[1], best[2]
            under = x[rows, best[1]] <= best[2]
            left[at] = grow(rows[under], depth + 1)
            right[at] = grow(rows[~under], depth + 1)
            return at

        grow(np.arange(len(x)), 0)
        return tuple(map(np.array, (feature, cut, left, right, value)))

    def predict(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for feature, cut, left, right, value in self.grown:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                f = feature[node]
                below = np.where(x[np.arange(len(x)), np.maximum(f, 0)] <= cut[node], left[node], right[node])
                node = np.where(f < 0, node, below)
            total += value[node]
        return total / max(1, len(self.grown))


class Scanner:
    def __init__(self, about: Corpus, forest: Forest):
        self.about, self.forest = about, forest

    def scan(self, texts: list[str | None]) -> list[list[tuple[int, int, float]]]:
        """Of each text its candidates: start, end (code points) and the share of trees that call it a secret."""
        spans, rows = [], []
        for text in texts:
            found = list(contexts(text)) if text else []
            spans.append([(a, b) for a, b, *_ in found])
            rows += [features(self.about, *around) for _, _, *around in found]
        score = iter(self.forest.predict(np.array(rows)).tolist() if rows else [])
        return [[(a, b, next(score)) for a, b in s] for s in spans]


def findings(docs: DataFrame) -> DataFrame:
    """Rows (before, candidate, after) of all candidates of ``docs`` (text); one row per occurrence."""

    def of_part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [around for t in batch["text"] if t for _, _, *around in contexts(t)]
            yield pd.DataFrame(rows, columns=["before", "candidate", "after"], dtype=object)

    return bounded(docs).select("text").mapInPandas(of_part, "before string, candidate string, after string")


def labelled_by_rule(docs: DataFrame, words: set[str] | frozenset[str] = frozenset()) -> DataFrame:
    """Labelled findings for corpora without any: ``rule`` on the documents whose id's crc32 modulo 4 is not 2.
    The label is null where the rule leaves it open."""
    dictionary = sent(docs.sparkSession, words)

    @F.pandas_udf("int")
    def label(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        words = received(dictionary)
        for batch in batches:
            yield pd.Series([rule(*x, words) for x in zip(*batch)], dtype="Int32")

    found = findings(docs.where(remainder("doc_id", 4) != 2))
    return found.withColumn("label", label("before", "candidate", "after"))


def fitted(docs: DataFrame, labelled: DataFrame | None = None, most: int = MOST, stated: list[tuple] = ()) -> Scanner:
    """A scanner whose corpus is ``docs`` and whose forest learns from about ``most`` distinct findings of each label
    in ``labelled`` (before, candidate, after, label), chosen by hash over all of them, of ``LONGEST_FINDING`` characters
    at most, and from the ``stated`` ones (the same four, and others that are not looked at)."""
    about = corpus(docs)
    marks = labelled if labelled is not None else labelled_by_rule(docs, about.words)
    marks = marks.where("candidate IS NOT NULL AND label IN (0, 1)").where(
        F.length("candidate").between(1, LONGEST_FINDING)
    ).select(
        *(F.coalesce(c, F.lit("")).alias(c) for c in ("before", "candidate", "after")), "label"
    )
    marks = saved(marks.distinct().withColumn("chance", F.xxhash64("before", "candidate", "after")), "secrets-findings")
    counts = {r["label"]: r["n"] for r in marks.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = []
    for label, n in sorted(counts.items()):
        limit = min(int(min(1.0, most / n) * 2**64) - 2**63, 2**63 - 1)
        rows += [(*r[:3], label) for r in marks.where((F.col("label") == label) & (F.col("chance") <= limit)).select("before", "candidate", "after").collect()]
    rows = sorted([*rows, *(r[:4] for r in stated)])
    x = np.array([features(about, *r[:3]) for r in rows]).reshape(-1, len(FEATURES))
    return Scanner(about, Forest().fit(x, np.array([r[3] for r in rows])))


def scanned(text: Column, broadcast, threshold: float = THRESHOLD) -> Column:
    """Struct of n_candidates, secrets (start, end, score; code points) and redacted, the text with every secret masked.

    Null texts have no candidates and stay null; whole texts are scanned, whatever their length.
    """

    @F.pandas_udf("n_candidates long, secrets array<struct<start:int,end:int,score:double>>, redacted string")
    def of_batches(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scanner = received(broadcast)
        for batch in slices(batches):
            texts, rows = batch.tolist(), []
            for text, found in zip(texts, scanner.scan(texts)):
                secrets = [{"start": a, "end": b, "score": s} for a, b, s in found if s >= threshold]
                shown, last = [], 0
                for s in secrets:
                    shown += [text[last : s["start"]], MASK]
                    last = s["end"]
                rows.append((len(found), secrets, text if not secrets else "".join([*shown, text[last:]])))
            yield pd.DataFrame(rows, columns=["n_candidates", "secrets", "redacted"], dtype=object)

    return of_batches(text)


def with_secrets(docs: DataFrame, scanner: Scanner) -> DataFrame:
    """``docs`` with the column ``scan`` (replaced if there). Every row has its result, repeated rows and null ids too;
    a scanner without training rows calls nothing a secret."""
    return bounded(docs).withColumn("scan", scanned(F.col("text"), sent(docs.sparkSession, scanner)))


def redacted(docs: DataFrame, scanner: Scanner) -> DataFrame:
    """``docs`` with every secret in ``text`` masked; all rows and columns stay."""
    scan = free_name(docs, "scan")
    found = bounded(docs).withColumn(scan, scanned(F.col("text"), sent(docs.sparkSession, scanner)))
    return found.withColumn("text", F.col(scan)["redacted"]).select(*docs.columns)


def op9_secret_scan(spark, sf_dir):
    """Per document: candidates, secrets and their spans, and the sha256 of the redacted text (null: of the empty text)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_secrets(docs, fitted(docs, stated=stated_findings()))
    return found.select(
        "doc_id", "scan.n_candidates", F.size("scan.secrets").cast("long").alias("n_secrets"), "scan.secrets",
        F.sha2(F.coalesce(F.col("scan.redacted"), F.lit("")), 256).alias("redacted_sha256"),
    )
