"""Op 13: packed products against plain ones, the whole result against brute force, awkward rows."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import hard_negatives as H


@pytest.mark.parametrize("low, high", [(-3, 4), (-120, 90), (5, 200), (-2**20, 2**20), (-2**31, 2**31), (0, 1), (-7, -2)])
def test_scores_are_exact(low, high):
    rng = np.random.default_rng(7)
    for m, n, d in [(1, 1, 1), (3, 7, 5), (5, 131, 64), (2, 4, 0), (4, 0, 3)]:
        a, c = rng.integers(low, high + 1, (m, d)), rng.integers(low, high + 1, (n, d))
        top = 2**63 - 1
        want = [[max(-top, min(top, sum(int(x) * int(y) for x, y in zip(u, v)))) for v in c] for u in a]
        assert H.scores(a, c).tolist() == want


def test_scores_of_extreme_components_are_clipped():
    top = 1 << 62
    a = np.array([[top, top, 3], [-top, -top, 1]])
    c = np.array([[top, top, 0], [top, -top, 5], [0, 0, 7]])
    assert H.scores(a, c).tolist() == [[2**63 - 1, 15, 21], [-(2**63 - 1), 5, 7]]


def test_scores_of_vectors_of_different_length():
    assert H.scores(np.array([[2, 3, 9]]), np.array([[5, 7], [-1, 0]])).tolist() == [[31, -2]]


def brute(rows, every, k, m):
    best = {}
    for vec_id, label, vec in rows:
        if vec_id is None or label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        r = (label, [math.floor(256 * x) for x in vec])
        best[vec_id] = min(best.get(vec_id, r), r)
    out = []
    for anchor, (label, q) in best.items():
        if anchor % every:
            continue
        score = {i: sum(x * y for x, y in zip(q, v)) for i, (_, v) in best.items() if i != anchor}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if best[i][0] == label][:k]:
            hard = [i for i in order if best[i][0] != label and 50 * score[p] <= 100 * score[i] <= 95 * score[p]][:m]
            out += [(anchor, p, n, i, score[p], score[i]) for n, i in enumerate(hard, 1)]
    return sorted(out)


def run(spark, rows, every=5, **kw):
    df = spark.createDataFrame(rows, "vec_id long, label long, embedding array<double>").withColumn("id", F.lit("clash")).withColumn(
        "block", F.lit("clash")).withColumn("score", F.lit(0))
    got = H.hard_negatives(df.repartition(3), F.col("id") % every == 0, **kw)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("kw", [{}, {"block_components": 64, "anchor_components": 16}])
def test_against_brute_force(spark, kw):
    rnd = random.Random(3)
    rows = [(i, rnd.randrange(3), [rnd.gauss(0.05, 0.2) for _ in range(8)]) for i in range(300)]
    rows += [(300 + i, i % 3, rows[i % 4][2]) for i in range(200)]  # many copies of few vectors: ties
    assert run(spark, rows, **kw) == brute(rows, 5, 5, 3)
    hot = [(i, 1 if rnd.random() < 0.5 else i, [rnd.gauss(0.1, 0.2) for _ in range(4)]) for i in range(250)]
    assert run(spark, hot, positives=2, negatives=7, **kw) == brute(hot, 5, 2, 7)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [0.5, 0.5]), (0, 1, [0.5, 0.5]), (0, 2, [0.1, 0.9]), (1, 1, [0.6, 0.4]), (2, 2, [0.3, 0.3]), (3, 2, [0.25, 0.4, 9.0]),
            (4, None, [0.5, 0.5]), (5, 1, None), (6, 1, [None, 0.5]), (7, 2, [nan, 0.5]), (8, 2, [inf, 0.5]), (None, 1, [0.5, 0.5]),
            (9, 2, []), (10, 5, [0.4]), (11, 1, [0.6, 0.4]), (-5, 1, [0.2, 0.2]), (15, 2, [-0.5, -0.5])]
    got = run(spark, rows)
    assert got == brute(rows, 5, 5, 3) and got
    far = [(0, 1, [1e300, 1.0]), (1, 1, [1.0, 1.0]), (2, 2, [0.6, 0.5]), (5, 2, [-1e300, 2.0])]
    assert run(spark, far) == []  # scores of clipped components are clipped alike, so none lies below the positive's
    assert run(spark, rows[:1]) == [] and run(spark, []) == []
