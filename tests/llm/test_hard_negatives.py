import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trajspark.llm.hard_negatives import Lists, hard_negatives


def brute(rows, is_anchor, k=5, m=3, low=50, high=95):
    kept = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept[(i, label, tuple(math.floor(256 * x) for x in v))] = None

    def score(a, b):
        return sum(x * y for x, y in zip(a, b, strict=False))

    out = []
    for i, label, v in kept:
        if not is_anchor(i):
            continue
        others = [(-score(v, w), j, b) for j, b, w in kept if j != i]
        positives = sorted((s, j) for s, j, b in others if b == label)[:k]
        for s, j in positives:
            p = -s
            inside = sorted((t, n) for t, n, b in others if b != label and low * p <= -100 * t <= high * p)
            out += [(i, j, r, n, p, -t) for r, (t, n) in enumerate(inside[:m], 1)]
    return sorted(out)


def found(df, **options):
    rows = hard_negatives(df, is_anchor=lambda i: i % 5 == 0, **options).collect()
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in rows)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)


def clusters(n, dims, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.2, (4, dims))
    # multiples of 1/64, so that floats are exact and many scores are equal
    return [(i, [float(x) for x in np.round(64 * (centres[i % 4] + rng.normal(0, 0.1, dims))) / 64], int(rng.integers(0, 4))) for i in range(n)]


@pytest.mark.parametrize("block_bytes", [1 << 20, 8 * 12 * 20])
def test_against_all_pairs(spark, block_bytes):
    rows = clusters(300, 12, 1)
    assert found(frame(spark, rows), block_bytes=block_bytes) == brute(rows, lambda i: i % 5 == 0)


def test_odd_rows(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-0.5, 0.25, 1.0, 0.0]) for _ in range(3)], i % 2) for i in range(40)]
    rows += [rows[5], rows[10], (None, [1.0, 1.0, 1.0], 0), (50, None, 1), (55, [1.0, None, 0.0], 1), (60, [float("nan"), 1.0, 1.0], 0)]
    rows += [(65, [float("inf"), 0.0, 0.0], 0), (70, [0.0, 0.0, 0.0], 1), (75, [1.0, 1.0, 1.0], None), (80, [1.0], 1), (85, [], 0)]
    df = frame(spark, rows).withColumns({"score": F.lit(1), "block": F.lit("b"), "key": F.lit(None), "ids": F.lit(2)})
    assert found(df) == brute(rows, lambda i: i % 5 == 0)
    assert found(df.filter("false")) == []
    assert found(frame(spark, rows[:1])) == []


def test_equal_vectors_go_by_the_smaller_id(spark):
    rows = [(i, [0.5, 0.5], 0) for i in range(0, 30)] + [(i, [0.25, 0.25], 1) for i in range(30, 90)]
    assert found(frame(spark, rows)) == brute(rows, lambda i: i % 5 == 0)


def test_reading_stops_early():
    rng = np.random.default_rng(3)
    vectors = np.round(256 * rng.normal(0, 0.05, (5000, 4)))
    vectors[17] = vectors[18] = [200, -200, 200, 200]
    orders = np.argsort(vectors, axis=0, kind="stable").T.astype(np.int32)
    lists, read = Lists(np.arange(5000), vectors, orders), []
    settled = Lists._settled
    Lists._settled = staticmethod(lambda t, s, w, k: read.append(len(s)) or settled(t, s, w, k))
    try:
        (best,) = lists.search(vectors[17], np.array([17]), [(-np.inf, np.inf)], 1)
    finally:
        Lists._settled = staticmethod(settled)
    assert best[0, 0] == 18 and read[-1] < 500


def test_large_components_stay_exact():
    vectors = np.array([[2.0**26, 2.0**26 - 1], [2.0**26, 2.0**26], [1, 1]])
    orders = np.argsort(vectors, axis=0, kind="stable").T.astype(np.int32)
    (best,) = Lists(np.arange(3), vectors, orders).search(vectors[1], np.zeros(0, int), [(-np.inf, np.inf)], 2)
    assert best.tolist() == [[1, 2**53], [0, 2**53 - 2**26]]
