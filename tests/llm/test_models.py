"""Language, quality and toxicity: held-out accuracy, and a result for every row."""

import zlib

import numpy as np
import pytest
from awkward import AWKWARD

from stridelake.llm import gru_toxicity, language_svm, line_crf
from stridelake.llm.line_crf import forward_backward

TABLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{TABLE}/documents.parquet"), spark.read.parquet(f"{TABLE}/labels.parquet")


def held(doc_id, modulus, rest):
    return zlib.crc32(str(doc_id).encode()) % modulus == rest


def test_language(spark, tables, docs_of):
    docs = tables[0]
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    got = language_svm.op3_language_svm(spark, TABLE).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(truth) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["held_out"] == held(r["doc_id"], 4, 2) for r in got)
    right = [r["lang_pred"] == truth[r["doc_id"]] for r in got if r["held_out"]]
    assert np.mean(right) > 0.98
    model = language_svm.LanguageModel().fit([("the cat sat on the mat and the dog", "en"), ("der Hund und die Katze sind nicht hier", "de"),
                                              ("le chat et le chien ne sont pas ici", "fr"), ("ola k ase", "xx")])
    assert model.predict([None, "", "12 !?", "le chien"])[0] == ["und", "und", "und", "fr"]
    assert language_svm.LanguageModel().fit([]).predict(["a"]) == (["und"], [0.0])
    frame = docs_of(AWKWARD)
    assert language_svm.fitted(frame).languages == ["en"] and language_svm.fitted(frame.limit(0)).languages == []


@pytest.mark.parametrize(("module", "label", "modulus", "rest", "cut"), [(line_crf, "quality", 4, 2, 0.7), (gru_toxicity, "toxic", 5, 0, 0.5)])
def test_labels(spark, tables, docs_of, module, label, modulus, rest, cut):
    docs, labels = tables
    truth = {r["doc_id"]: r[label] for r in labels.collect()}
    query = line_crf.op4_quality_crf if label == "quality" else gru_toxicity.op5_toxicity_gru
    got = query(spark, TABLE).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= cut) for r in got)
    assert all(r["held_out"] == held(r["doc_id"], modulus, rest) for r in got)
    right = [r["predicted"] == truth[r["doc_id"]] for r in got if r["held_out"] and r["doc_id"] in truth]
    assert np.mean(right) > 0.9
    frame = docs_of(AWKWARD)
    for some in (labels, labels.limit(0), labels.where(f"{label} = 1")):
        out = module.scored(frame, some)
        rows = out.collect()
        assert sorted(out.columns) == sorted(frame.columns) and len(rows) == len(AWKWARD)
        assert all(0 <= r["score"] <= 1 for r in rows) and all(r["score"] == 0 for r in rows if r["doc_id"] in (7, 8, 9))
    assert module.scored(frame.limit(0), labels).count() == 0


def test_forward_backward_like_all_labelings():
    rng = np.random.default_rng(0)
    n = np.array([3, 0, 1, 4])
    score, move = rng.standard_normal(8), rng.standard_normal((2, 2))
    odds, total, moves = forward_backward(score, move, n)
    expected, at = np.zeros((2, 2)), 0
    for k, size in enumerate(n.tolist()):
        weights = {}
        for bits in range(2**size):
            y = [bits >> i & 1 for i in range(size)]
            weights[tuple(y)] = np.exp(sum(score[at + i] * y[i] for i in range(size)) + sum(move[a, b] for a, b in zip(y, y[1:])))
        z = sum(weights.values())
        if size:
            assert np.isclose(total[k], np.log(z))
        for i in range(size):
            one = sum(w for y, w in weights.items() if y[i]) / z
            assert np.isclose(1 / (1 + np.exp(-odds[at + i])), one)
        for y, w in weights.items():
            for a, b in zip(y, y[1:]):
                expected[a, b] += w / z
        at += size
    assert np.allclose(moves, expected)


def test_gradients_of_the_network():
    net = gru_toxicity.Network()
    rng = np.random.default_rng(0)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    g = rng.standard_normal((2, 5, 3, 24))
    live = np.arange(5)[:, None] < np.array([5, 3, 1])
    d = rng.standard_normal(3)

    def value():
        return float(net._forward(g, live) @ d)

    logit, *kept = net._forward(g, live, keep=True)
    grad, dg = net._backward(d, g.shape, *kept)
    for name in ("u", "bu", "att", "ba", "v", "out", "bo"):
        for at in rng.integers(0, net.p[name].size, 4).tolist():
            place = np.unravel_index(at, net.p[name].shape)
            net.p[name][place] += 1e-3
            high = value()
            net.p[name][place] -= 2e-3
            low = value()
            net.p[name][place] += 1e-3
            assert np.isclose((high - low) / 2e-3, grad[name][place], rtol=0.05, atol=2e-3), name
    for at in rng.integers(0, g.size, 20).tolist():
        place = np.unravel_index(at, g.shape)
        g[place] += 1e-3
        high = value()
        g[place] -= 2e-3
        low = value()
        g[place] += 1e-3
        assert np.isclose((high - low) / 2e-3, dg[place], rtol=0.05, atol=2e-3)


def test_windows_cover_every_word():
    sizes = np.array([0, 1, 23, 24, 25, 40, 41, 500])
    start, length, text = gru_toxicity.windows(sizes)
    first = np.cumsum(sizes) - sizes
    for k, n in enumerate(sizes.tolist()):
        at = text == k
        seen = {p for s, m in zip(start[at], length[at]) for p in range(s, s + m)}
        assert seen == set(range(first[k], first[k] + n))
