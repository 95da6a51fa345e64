import hashlib
import random
import re
import zlib
from fractions import Fraction

import duckdb
import numpy as np
from awkward import AWKWARD
from conftest import SF_DIR

from stridelake.llm.periodic_runs import PRIME, _Transform, op13_periodic_runs, periodic_runs, runs_in, zero_mismatches


def smallest_period(w):
    fail, k = [0] * len(w), 0
    for i in range(1, len(w)):
        while k and w[i] != w[k]:
            k = fail[k - 1]
        k += w[i] == w[k]
        fail[i] = k
    return len(w) - fail[-1]


def plain(w):
    n, runs = len(w), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            end = i
            while end + q < n and w[end] == w[end + q]:
                end += 1
            if end + q - i >= max(24, 3 * q) and smallest_period(w[i : end + q]) == q:
                runs.append((i, end + q - i, q))
            i = end + 1
    return sorted(runs, key=lambda r: (r[0], r[2]))


def kept(w, runs):
    return [x for i, x in enumerate(w) if not any(a + q <= i < a + n for a, n, q in runs)]


def cases():
    rng = random.Random(5)
    for letters, n in ((1, 1), (1, 23), (1, 24), (1, 25), (1, 700), (2, 400), (3, 300), (2, 60), (40, 200)):
        yield [str(rng.randrange(letters)) for _ in range(n)]
    for _ in range(150):
        out = []
        for _ in range(rng.randrange(1, 6)):
            unit = [str(rng.randrange(rng.choice((1, 2, 4, 1000)))) for _ in range(rng.choice((1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 33, 64, 90)))]
            out += [str(rng.randrange(1000)) for _ in range(rng.randrange(9))]
            out += (unit * rng.randrange(1, 12))[: rng.randrange(1, 400)]
        yield out
    inner = ["a"] * 9 + ["b"]
    yield (inner * 3 + ["c"]) * 5
    yield (["a"] * 25 + ["b"]) * 4
    yield []


def test_runs_like_brute_force():
    lists = [[x.encode() for x in w] for w in cases()]
    assert [runs for runs in map(plain, lists)] == runs_in(lists)
    for w in lists[::7]:
        assert runs_in([w]) == [plain(w)]  # what lies beside a text has no part in it
    assert runs_in([]) == [] and runs_in([[]]) == [[]]


def test_transform_counts_exactly():
    rng = np.random.default_rng(3)
    for length, offset in ((8, 0), (16, 16), (64, 64)):
        most = int(((PRIME - 1) // length) ** 0.5)
        values = rng.choice([0, 1, most - 1, most // 2], 40 * length)
        starts = np.arange(0, 30 * length, length)
        values[5 * length : 30 * length] = np.tile(values[:length], 25)
        got = zero_mismatches(values, starts, length, offset, _Transform(2 * length))
        want = [[(values[s : s + length] == values[s + offset + t : s + offset + t + length]).all() for t in range(length)] for s in starts]
        assert got.tolist() == want and got.any() and not got.all()


def test_long_texts_in_time():
    assert runs_in([[b"w"] * 300_000]) == [[(0, 300_000, 1)]]
    unit = [b"%d" % (i * 7919 % 1000) for i in range(20_011)]
    assert (5, 100_055, 20_011) in runs_in([[b"x%d" % i for i in range(5)] + unit * 5])[0]


def test_awkward_rows(spark, docs_of):
    frame = docs_of([*AWKWARD, (13, "a b " * 20 + "c")])
    out = periodic_runs(frame, "score")
    assert set(out.columns) == set(frame.columns)
    got = sorted(((r["doc_id"], r["score"]["n_words"], [tuple(x) for x in r["score"]["runs"]], r["score"]["collapsed"]) for r in out.collect()), key=str)
    want = []
    for i, t in [*AWKWARD, (13, "a b " * 20 + "c")]:
        w = re.findall("[^\x20\x09-\x0d]+", t or "")
        runs = [(0, 40_000, 1)] if i == 12 else plain(w)
        want.append((i, len(w), runs, "word" if i == 12 else " ".join(kept(w, runs))))
    assert got == sorted(want, key=str)
    assert periodic_runs(frame.limit(0)).count() == 0


def test_query_like_brute_force(spark):
    got = {r["doc_id"]: tuple(r)[1:] for r in op13_periodic_runs(spark, SF_DIR).collect()}
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet' WHERE text IS NULL OR length(text) < 6000").fetchall()
    planted = 0
    for i, text in rows:
        w = re.findall("[^\x20\x09-\x0d]+", text or "")
        h, n = zlib.crc32(str(i).encode()), len(w)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (j - a) % p] for j in range(a, n)]
        runs = plain(w)
        planted += bool(runs)
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else (None,) * 3
        milli = 1000 * best[1] // best[2] if runs else None
        lines = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, " ".join(kept(w, runs)))]
        assert got[i] == (len(runs), *best, milli, *digest), i
    assert planted > 5
