import hashlib
import math
import random
import re

import duckdb
from awkward import AWKWARD
from conftest import SF_DIR

from stridelake.llm.pii import base_spans, op11_pii, personal_data, sanitised

# The forms that the findings have.
FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def plain_spans(text):
    found = [(m.start(), n, m.end(), k) for n, (k, form) in enumerate(FORMS.items()) for m in re.finditer(form, text or "") if passes(k, m[0])]
    return [(k, start, end) for start, _, end, k in sorted(found)]


def plain(texts, support, disclosed, beside=8, kept=3):
    """Spans with replacements of each distinct text."""
    entities, near, words = {}, {}, {}
    for text in texts:
        spans = plain_spans(text)
        free = [m for m in re.finditer(r"\w+", text) if not any(s < m.end() and m.start() < e for _, s, e in spans)]
        words[text] = [(*m.span(), m[0].lower()) for m in free]
        for kind, s, e in spans:
            value = text[s:e].lower() if kind in ("email", "ip") else re.sub("[^0-9]", "", text[s:e])
            entities.setdefault((kind, value), set()).add(text)
            ahead, behind = [w for a, _, w in words[text] if a < s][-beside:], [w for a, _, w in words[text] if a > s][:beside]
            for w in ahead + behind:
                near.setdefault(((kind, value), w), set()).add(text)

    def tells(n_ct, n_c, n_t):
        n = len(texts)
        return n_c < n and math.log2(n * n_ct / n_c / n_t) >= disclosed * math.log2(n / n_c)

    put = {}
    for (c, w), of_pair in near.items():
        n_c = len(entities[c])
        if len(of_pair) >= support and tells(len(of_pair), n_c, sum(w in {x for _, _, x in ws} for ws in words.values())):
            alike = [(d, ts) for (d, x), ts in near.items() if x[:kept] == w[:kept]]
            n_g, n_cg = len(set().union(*(ts for _, ts in alike))), len(set().union(*(ts for d, ts in alike if d == c)))
            put[w] = put.get(w, True) and len(w) > kept and not tells(n_cg, n_c, n_g)
    out = {}
    for text in texts:
        spans = [(s, n, e, f"[{k.upper()}]", k) for k, s, e in plain_spans(text) for n in [list(FORMS).index(k)]]
        spans += [(s, 4, e, w[:kept] + "*" if put[w] else "", "term") for s, e, w in words[text] if w in put]
        out[text] = [(k, s, e, p) for s, _, e, p, k in sorted(spans)]
    return out


def corpus(seed=3):
    rng = random.Random(seed)
    common = ["the", "of", "harvest", "river", "Stone", "évry", "plan9", "it"]
    people = [f"user{k}@mail.example.com" for k in range(6)] + ["10.0.0.7", "+44 20 7946 0958", "4111 1111 1111 1111", "4111-1111-1111-1111"]
    marked = {p: [f"nick{k}", f"harbour{k % 3}", f"X{k}"] for k, p in enumerate(people)}
    rows = []
    for k in range(400):
        words = rng.choices(common, k=rng.randrange(5, 40))
        if rng.random() < 0.4:
            p = rng.choice(people)
            at = rng.randrange(len(words))
            words[at:at] = [rng.choice(marked[p]), p, *rng.sample(marked[p], 2)]
        if rng.random() < 0.1:
            words.append(rng.choice(marked[rng.choice(people)]))
        rows.append((100 + k, " ".join(words)))
    return rows + [(1000 + k, rows[k % 5][1]) for k in range(60)]


def test_forms_like_the_patterns():
    rng = random.Random(8)
    alphabet = ["@", "a", "b-", ".", "+", "1", "22", "255", "256", " ", "(", ")", "-", "4111111111111111", "1.2.3.4", "x@y.z", "é", "+1", "\n", "%"]
    for _ in range(6000):
        text = "".join(rng.choices(alphabet, k=rng.randrange(25)))
        assert base_spans(text) == plain_spans(text), text
    for text in ("1." * 9 + "1", "0001.002.3.0000255", "a@b.c@d.e.f@g", "@a.b", "a@@b.c", "+1 2345 67890-", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5"):
        assert base_spans(text) == plain_spans(text), text


def test_long_runs_in_time():
    for unit in ("a", "1", "1.", "a.b", "@", "+1", "+1 ", "1 ", "a@", "a@b.c", "1.1.1.1.", "((((", "+(", "9-"):
        base_spans(unit * (1_000_000 // len(unit)))


def test_disclosing_terms_like_brute_force(spark, docs_of):
    rows = corpus()
    for support, disclosed in ((3, 0.95), (2, 0.5), (8, 0.99)):
        want = plain({t for _, t in rows}, support, disclosed)
        got = [(r["doc_id"], [tuple(s[k] for k in ("kind", "start", "end", "put")) for s in r["spans"]]) for r in personal_data(docs_of(rows), support, disclosed).collect()]
        assert sorted(got) == sorted((i, want[t]) for i, t in rows)
    puts = {s[3] for i, t in rows for s in plain({t for _, t in rows}, 3, 0.95)[t]}
    assert "" in puts and any(p.endswith("*") for p in puts)


def test_sanitised_texts(spark, docs_of):
    rows = corpus()
    want = plain({t for _, t in rows}, 3, 0.95)
    frame = docs_of([*rows, *AWKWARD])
    out = sanitised(frame)
    assert out.columns == frame.columns
    got = {}
    for r in out.collect():
        got.setdefault(r["doc_id"], r["text"])
    for i, text in rows:
        for _, s, e, put in reversed(want[text]):
            text = text[:s] + put + text[e:]
        assert got[i] == text
    assert got[7] is None and got[8] == "" and got[12] == "word " * 40_000
    assert not any("@" in t for t in got.values() if t)


def test_overlaps_and_awkward_rows(spark, docs_of):
    text = "+4111111111111111@x.yy 4111 1111 1111 1111"
    rows = [*AWKWARD, (20, text), (21, "é a@b.cd")]
    got = sorted(((r["doc_id"], [tuple(s) for s in r["spans"]]) for r in personal_data(docs_of(rows)).collect()), key=str)
    assert got == sorted(((i, [(k, s, e, f"[{k.upper()}]") for k, s, e in plain_spans(t)]) for i, t in rows), key=str)
    assert len(dict(got)[20]) > 2 and dict(got)[21] == [("email", 2, 8, "[EMAIL]")]
    assert personal_data(docs_of(rows).limit(0)).count() == 0


def test_query_like_brute_force(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet'").fetchall()
    want = plain({t for _, t in rows if t is not None}, 3, 0.95)
    got = {r["doc_id"]: r for r in op11_pii(spark, SF_DIR).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        spans = want[text] if text is not None else []
        base = [s for s in spans if s[0] != "term"]
        joined = [",".join(f"{k}:{s}:{e}" for k, s, e, _ in some) for some in (base, spans)]
        assert got[i]["spans"] == joined[1] and got[i]["base_sha256"] == hashlib.sha256(joined[0].encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in FORMS] == [sum(s[0] == k for s in base) for k in FORMS]
