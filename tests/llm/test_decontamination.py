import random
import re

from awkward import AWKWARD

from stridelake.llm.decontamination import Searcher, found_in


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, window=10):
    patterns = {}
    for item, text in items:
        w = words(text)
        m = min(window, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            patterns.setdefault(tuple(w[i : i + m]), set()).add(item)
    out = []
    for _, text in docs:
        w, hit, found = words(text), set(), set()
        for m in {len(p) for p in patterns}:
            for i in range(len(w) - m + 1):
                if tuple(w[i : i + m]) in patterns:
                    hit |= set(range(i, i + m))
                    found |= patterns[tuple(w[i : i + m])]
        out.append((len(w), len(hit), sorted(str(i) for i in found if i is not None), hit))
    return out


def cases():
    rng = random.Random(2)
    small = ["a", "b", "c", "é", "a1"]
    items = [(k, " ".join(rng.choices(small, k=rng.choice([0, 1, 2, 3, 9, 10, 11, 14])))) for k in range(25)]
    items += [(3, items[3][1]), (90, items[4][1]), (None, "zz zz"), (91, None), (92, "?!"), (93, "Zz-zZ")]
    docs = [(k, " ".join(rng.choices([*small, "x", "zz"], k=rng.randrange(0, 60)))) for k in range(60)]
    docs += [(100 + k, f"x {t}, {t} y") for k, (_, t) in enumerate(items)] + AWKWARD + [(12, "x " * 3000 + "zz zz" + " x" * 3000)]
    return docs, items


def spans(found):
    return {p for s in found["spans"] for p in range(s["start"], s["end"])}


def test_searcher_like_brute_force():
    docs, items = cases()
    for use in (items, items[10:11], []):
        got = Searcher(use).search([t for _, t in docs])
        want = plain(docs, use)
        assert [g[:3] for g in got] == [w[:3] for w in want]
        assert [{p for s in g[3] for p in range(s["start"], s["end"])} for g in got] == [w[3] for w in want]


def test_blocks_change_nothing(spark, docs_of):
    docs, items = cases()
    benchmark = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, found int")
    frame = docs_of(docs)

    def rows(**how):
        out = found_in(frame, benchmark, **how)
        assert set(out.columns) == set(frame.columns)
        got = [(r["doc_id"], r["found"]["n_words"], r["found"]["n_hit"], r["found"]["item_ids"], sorted(spans(r["found"]))) for r in out.collect()]
        return sorted(got, key=str)

    want = sorted(((i, w[0], w[1], w[2], sorted(w[3])) for (i, _), w in zip(docs, plain(docs, items))), key=str)
    assert rows() == want
    assert rows(block_bytes=60) == want
    assert found_in(frame.limit(0), benchmark).count() == 0 and found_in(frame, benchmark.limit(0)).where("found.n_hit > 0").count() == 0
