"""Personal data: findings by form, and terms that give them away.

E-mail and network addresses, card and phone numbers are found by their form. They are the protected entities of
an information-theoretic sanitisation: a term that stands beside an entity (at most ``BESIDE`` terms away) discloses
a part of it. With N distinct texts, of which n_c hold the entity, n_t the term, and n_ct the term beside the
entity, the entity has IC = log2(N / n_c) bits, and the term tells PMI = log2(N n_ct / (n_c n_t)) of them. A term that
tells at least ``DISCLOSED`` of an entity's bits, and does so in ``SUPPORT`` distinct texts or more, is taken out
wherever it stands: it is generalised to its first ``KEPT`` letters if what begins like it tells less, else removed.

Copies of a text count once. n_ct and n_c come from the surroundings of the entities alone. So does a lower bound of
n_t, which leaves the terms that stand beside few entities; they are counted in all texts. The scan for them
looks words up in a bitmap of 2^26 bits, whatever their number; what it lets through by chance goes in the join.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelake.llm.shared import bounded, free_name, saved, slices, table

BESIDE = 8
SUPPORT = 3
DISCLOSED = 0.95
KEPT = 3
KINDS = ("email", "ip", "card", "phone")
TERM = "term"

_BITS = 26
_KNOWN_WORDS = 1 << 18
_SPANS = "array<struct<kind:string,start:int,end:int>>"
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CHAIN = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3,}+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TERM = re.compile(r"\w+")
_NO_DIGIT = re.compile(r"[^0-9]+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From every @ to both sides, so that long runs of name characters are seen once."""
    done, at = 0, text.find("@")
    while at >= 0:
        before = text[done:at]
        start = done + len(before.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """Matches follow each other in a chain of numbers and dots: four numbers each."""
    for chain in _CHAIN.finditer(text):
        parts, start = chain[0].split("."), chain.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p := part.lstrip("0")) < 4 and int(p or 0) < 256 for part in four):
                yield start, end
            start = end + 1


def _passes_luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _NO_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and _passes_luhn(digits):
                yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 10 <= len(_NO_DIGIT.sub("", m[0])) <= 15:
            yield m.span()


_FINDERS = dict(zip(KINDS, (_emails, _addresses, _cards, _phones)))


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind. Linear in the text."""
    found = [(start, n, end) for n, kind in enumerate(KINDS) for start, end in _FINDERS[kind](text or "")]
    return [(KINDS[n], start, end) for start, n, end in sorted(found)]


def _entity(kind: str, value: str) -> str:
    """A name for the entity, the same for all ways to write it, that does not show it."""
    plain = value.lower() if kind == "email" else value if kind == "ip" else _NO_DIGIT.sub("", value)
    return hashlib.blake2b(f"{kind}:{plain}".encode(), digest_size=16).hexdigest()


def _terms(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[int, int, str]]:
    """(start, end, term) of the words that no span touches."""
    out, k, reach = [], 0, 0
    for m in _TERM.finditer(text):
        while k < len(spans) and spans[k][1] < m.end():
            reach = max(reach, spans[k][2])
            k += 1
        if m.start() >= reach:
            out.append((*m.span(), m[0].lower()))
    return out


def surroundings(text: str, spans: list[tuple[str, int, int]]) -> tuple[list[str], list[str]]:
    """Parallel lists of entities and the distinct terms beside them; each entity also has the empty term."""
    terms = _terms(text, spans) if spans else []
    starts = [t[0] for t in terms]
    beside: dict[str, set] = {}
    for kind, start, end in spans:
        at = bisect.bisect(starts, start)
        near = terms[max(0, at - BESIDE) : at] + terms[at : at + BESIDE]
        beside.setdefault(_entity(kind, text[start:end]), {""}).update(t for _, _, t in near)
    return [e for e, ts in beside.items() for _ in ts], [t for ts in beside.values() for t in ts]


def _by_form(text: Column) -> Column:
    @F.pandas_udf(f"spans {_SPANS}, entities array<string>, terms array<string>")
    def of_batches(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in slices(batches):
            spans = [base_spans(t) for t in texts]
            near = [surroundings(t or "", s) for t, s in zip(texts, spans)]
            yield pd.DataFrame(
                {
                    "spans": [[dict(zip(("kind", "start", "end"), s)) for s in of_text] for of_text in spans],
                    "entities": [entities for entities, _ in near],
                    "terms": [terms for _, terms in near],
                }
            )

    return of_batches(text)


class _Finder:
    """Places of the words whose terms may be among those of the bitmap."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.seen, self.hits = bits, set(), set()

    def _learn(self, words: set[str]) -> None:
        if len(self.seen) > _KNOWN_WORDS:
            self.seen, self.hits = set(), set()
        for word in words - self.seen:
            at = zlib.crc32(word.lower().encode()) & ((1 << _BITS) - 1)
            if int(self.bits[at >> 6]) >> (at & 63) & 1:
                self.hits.add(word)
        self.seen |= words

    def find(self, text: str | None) -> tuple[list[str], list[int], list[int]]:
        """Parallel lists: term, start, end."""
        words = set(_TERM.findall(text or ""))
        self._learn(words)
        wanted = words & self.hits
        terms, starts, ends = [], [], []
        if wanted:
            spans, k, reach = base_spans(text), 0, 0
            for m in _TERM.finditer(text):
                if m[0] in wanted:
                    start, end = m.span()
                    while k < len(spans) and spans[k][1] < end:
                        reach = max(reach, spans[k][2])
                        k += 1
                    if start >= reach:
                        terms.append(m[0].lower())
                        starts.append(start)
                        ends.append(end)
        return terms, starts, ends


def _places(text: Column, bitmap) -> Column:
    @F.pandas_udf("term array<string>, start array<int>, end array<int>")
    def of_batches(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        find = _Finder(bitmap.value).find
        for texts in slices(batches):
            yield pd.DataFrame([find(t) for t in texts], columns=["term", "start", "end"])

    return of_batches(text)


def _bitmap(terms: DataFrame) -> np.ndarray:
    """One bit for each value of the terms' hashes: 2^20 numbers, whatever the number of terms."""
    at = F.crc32(F.col("term").cast("binary")).bitwiseAND(F.lit((1 << _BITS) - 1))
    bit = terms.select(at.alias("at")).selectExpr(
        "CAST(shiftright(at, 6) AS INT) AS word", "shiftleft(1L, CAST(at & 63 AS INT)) AS bit"
    )
    bits = np.zeros(1 << (_BITS - 6), np.uint64)
    for r in bit.groupBy("word").agg(F.bit_or("bit").alias("bits")).collect():
        bits[r["word"]] = r["bits"] & (2**64 - 1)
    return bits


def _texts_with(near: DataFrame, *by: str) -> DataFrame:
    """Number ``n`` of distinct texts of each value of the columns."""
    return near.select(*by, "key").distinct().groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def _tells(n_texts: int, n_ct: str, n_c: str, n_t: str, disclosed: float) -> Column:
    """Whether the term tells that part of the entity's bits."""
    texts = F.lit(float(n_texts))
    pmi = F.log2(texts * F.col(n_ct) / F.col(n_c) / F.col(n_t))
    return (F.col(n_c) < texts) & (pmi >= F.lit(disclosed) * F.log2(texts / F.col(n_c)))


def _key(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _disclosing(docs: DataFrame, found: DataFrame, support: int, disclosed: float) -> tuple[DataFrame, DataFrame] | None:
    """Rows (term, put) of the terms to take out, and (key, term, start, end) of where they may stand."""
    both = found.select("key", F.explode(F.arrays_zip("entities", "terms")).alias("x"))
    near = saved(both.select("key", "x.entities", "x.terms").toDF("key", "entity", "term").distinct(), "pii-near")
    n_texts = found.where(F.col("key").isNotNull()).select("key").distinct().count()
    of_entity = near.where("term = ''").groupBy("entity").agg(F.count(F.lit(1)).alias("n_c"))
    near = near.where("term <> ''").withColumn("general", F.substring("term", 1, KEPT))
    pairs = near.groupBy("entity", "term", "general").agg(F.count(F.lit(1)).alias("n_ct")).where(F.col("n_ct") >= support)
    pairs = pairs.join(of_entity, "entity").join(_texts_with(near, "term").withColumnRenamed("n", "n_near"), "term")
    pairs = saved(pairs.where(_tells(n_texts, "n_ct", "n_c", "n_near", disclosed)), "pii-pairs")
    if pairs.isEmpty():
        return None
    bitmap = docs.sparkSession.sparkContext.broadcast(_bitmap(pairs.select("term")))
    places = docs.select(_key(F.col("text")).alias("key"), _places(F.col("text"), bitmap).alias("x"))
    places = places.select("key", F.explode(F.arrays_zip("x.term", "x.start", "x.end")).alias("x"))
    places = saved(places.select("key", "x.*").distinct(), "pii-places")  # copies are at the same places
    of_term = _texts_with(places, "term").withColumnRenamed("n", "n_t")
    pairs = pairs.join(of_term, "term").where(_tells(n_texts, "n_ct", "n_c", "n_t", disclosed))
    # What begins like the term stands in no fewer texts than those counted here, so it tells no more than this.
    of_general = _texts_with(near, "general").withColumnRenamed("n", "n_g")
    of_both = _texts_with(near, "entity", "general").withColumnRenamed("n", "n_cg")
    told = pairs.join(of_general, "general").join(of_both, ["entity", "general"])
    less = (F.length("term") > KEPT) & ~_tells(n_texts, "n_cg", "n_c", "n_g", disclosed)
    put = F.when(F.bool_and(less), F.concat(F.first("general"), F.lit("*"))).otherwise("")
    return told.groupBy("term").agg(put.alias("put")), places


def _spans(docs: DataFrame, support: int, disclosed: float) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, key, spans) of the findings by form, one for each of ``docs``, and (key, marks) of the terms."""
    own = bounded(docs).select("doc_id", "text")
    found = own.select("doc_id", _key(F.col("text")).alias("key"), _by_form(F.col("text")).alias("x"))
    found = saved(found.select("doc_id", "key", "x.*"), "pii-found")
    disclosing = _disclosing(own, found, support, disclosed)
    if disclosing is None:
        none = f"key binary, marks {_MARKS}"
        return found, docs.sparkSession.createDataFrame([], none)
    terms, places = disclosing
    mark = F.struct(F.lit(TERM).alias("kind"), "start", "end", "put")
    marks = places.join(terms, "term")
    return found, saved(marks.groupBy("key").agg(F.sort_array(F.collect_list(mark)).alias("marks")), "pii-marks")


_MARKS = "array<struct<kind:string,start:int,end:int,put:string>>"


def personal_data(docs: DataFrame, support: int = SUPPORT, disclosed: float = DISCLOSED) -> DataFrame:
    """Rows (doc_id, spans), one for each of ``docs``; spans are structs kind, start, end, put, by start, then kind.

    Positions are code points, the end exclusive. The kinds email, ip, card and phone are found by their form; spans
    of kind term are words that disclose such an entity (see above); they touch none of the others. ``put``
    is what ``sanitised`` puts there. Null and empty texts have no spans. Repeated rows each have their
    row and count as one text; null ids are kept. An empty table gives no rows; other columns are not looked at.
    """
    found, marks = _spans(docs, support, disclosed)
    by_form = F.transform("spans", lambda s: s.withField("put", F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))))
    order = F.create_map(*(x for n, kind in enumerate((*KINDS, TERM)) for x in (F.lit(kind), F.lit(n))))
    every = F.concat(by_form, F.coalesce("marks", F.array().cast(_MARKS)))
    ranked = F.array_sort(F.transform(every, lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("n"), s.alias("s"))))
    return found.join(marks, "key", "left").select("doc_id", F.transform(ranked, lambda r: r["s"]).alias("spans"))


def sanitised(docs: DataFrame, support: int = SUPPORT, disclosed: float = DISCLOSED) -> DataFrame:
    """``docs`` with personal data replaced in the texts: findings by ``[EMAIL]`` and so on, disclosing terms by
    their first letters and ``*``, or by nothing. Of spans that overlap the first says what is put there.
    """
    _, marks = _spans(docs, support, disclosed)
    key, of_key, put = (free_name(docs, n) for n in ("own_key", "mark_key", "own_marks"))
    met = docs.withColumn(key, _key(F.col("text"))).join(marks.toDF(of_key, put), F.col(key) == F.col(of_key), "left")
    return met.withColumn("text", _replaced(F.col("text"), F.col(put))).select(*docs.columns)


def replaced(text: str, spans: list[tuple[int, int, str]]) -> str:
    out, done = [], 0
    for start, end, put in spans:
        if start >= done:
            out += [text[done:start], put]
        done = max(done, end)
    return "".join([*out, text[done:]])


def _replaced(text: Column, marks: Column) -> Column:
    @F.pandas_udf("string")
    def of_batches(texts: pd.Series, marks: pd.Series) -> pd.Series:
        out = []
        for t, of_text in zip(texts, marks):
            spans = [(start, end, f"[{kind.upper()}]") for kind, start, end in base_spans(t)]
            spans += [(m["start"], m["end"], m["put"]) for m in (() if of_text is None else of_text)]
            out.append(None if t is None else replaced(t, sorted(spans, key=lambda s: s[0])))
        return pd.Series(out, dtype=object)

    return of_batches(text, marks)


def digests(docs: DataFrame, support: int = SUPPORT, disclosed: float = DISCLOSED) -> DataFrame:
    found = personal_data(docs, support, disclosed)

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(which) -> Column:
        return F.size(F.filter("spans", which)).cast("long")

    def number_of(kind: str) -> Column:
        return number(lambda s: s["kind"] == kind).alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(number_of, (*KINDS, TERM)),
        number(lambda s: (s["kind"] == TERM) & (s["put"] != "")).alias("n_generalised"),
        F.sha2(listed(F.filter("spans", lambda s: s["kind"] != TERM)), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def op11_pii(spark, sf_dir):
    return digests(table(spark, sf_dir, "documents"))
