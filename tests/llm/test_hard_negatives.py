import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stridelake.llm.hard_negatives import Packed, hard_negatives

SCHEMA = "id long, label int, vec array<double>, slot string, nth int, score double, block int"


@pytest.mark.parametrize("low, high, dims", [(-256, 255, 64), (-3, 0, 7), (0, 0, 5), (-40_000, 90_000, 9), (-(2**40), 2**41, 3), (0, 1, 0)])
def test_packed_products_are_exact(low, high, dims):
    rng = random.Random(4)
    rows, anchors = (np.array([[rng.choice((low, high, rng.randint(low, high))) for _ in range(dims)] for _ in range(n)], np.int64).reshape(n, dims) for n in (41, 6))
    want = [[sum(int(x) * int(y) for x, y in zip(a, r)) for r in rows] for a in anchors]
    assert Packed(rows, low, high).scores(anchors).tolist() == want


def plain(rows, positives=5, negatives=10, lowest=30, highest=90, scale=256):
    points = [
        (i, label, [math.floor(scale * x) for x in v])
        for i, label, v in rows
        if None not in (i, label, v) and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, label, v in {(i, k, tuple(v)) for i, k, v in points if i % 100 == 0}:
        met = sorted((-sum(x * y for x, y in zip(v, w)), i, k) for i, k, w in points if i != a)
        for s, p, _ in [m for m in met if m[2] == label][:positives]:
            far = [m for m in met if m[2] != label and lowest * -s <= 100 * -m[0] <= highest * -s][:negatives]
            out += [(a, p, n + 1, i, -s, -t) for n, (t, i, _) in enumerate(far)]
    return sorted(out)


def made(n, dims=6, seed=1):
    """Few distinct vectors, so that scores tie; repeated ids and rows; awkward vectors."""
    rng = random.Random(seed)
    vectors = [[rng.uniform(-1, 1) for _ in range(dims)] for _ in range(n // 3)]
    rows = [(rng.randrange(2 * n), rng.choice((0, 0, 1, 2, None)), rng.choice(vectors)) for _ in range(n)]
    rows += [(100 * k, k % 3, rng.choice(vectors)) for k in range(8)]
    rows += rows[:9] + rows[-3:]
    rows += [(None, 1, vectors[0]), (200, None, vectors[0]), (300, 1, None), (400, 1, []), (500, 2, [0.5]), (600, 0, [0.0] * dims)]
    rows += [(700, 0, [math.nan] + [0.0] * 5), (800, 0, [math.inf] * 6), (900, 1, [None] * 6), (1000, 2, [1e-300] * 6)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 2, 0.5, 7) for r in rows], SCHEMA)


def found(df):
    return sorted(tuple(r) for r in df.collect())


def test_like_brute_force(spark):
    rows = made(1500)
    df, anchor = frame(spark, rows).repartition(3), F.col("id") % 100 == 0
    want = plain(rows)
    assert found(hard_negatives(df, anchor)) == want and len(want) > 300
    assert found(hard_negatives(df, anchor, block_bytes=400)) == want  # several blocks
    other = dict(positives=2, negatives=30, lowest=50, highest=100, scale=10)
    assert found(hard_negatives(df, anchor, **other)) == plain(rows, **other)


def test_wide_scores(spark):
    rows = [(i, k, [x * 3e7 for x in v]) for i, k, v in made(200)[:200]]
    got = found(hard_negatives(frame(spark, rows), F.col("id") % 100 == 0, scale=8))
    assert got == plain(rows, scale=8) and got


def test_no_rows_and_no_anchors(spark):
    df = frame(spark, made(30))
    assert hard_negatives(df.limit(0), F.col("id") % 100 == 0).count() == 0
    assert hard_negatives(df, F.col("id") == -5).count() == 0
    assert hard_negatives(df.where("label IS NULL"), F.col("id") % 100 == 0).count() == 0
