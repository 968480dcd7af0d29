"""Inverted genre lists against scoring every set, and a vocabulary of 200 genres end to end."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marquee.operators import content as C
from marquee.operators.genre_index import Sets
from test_content import brute_force


def _catalogue(rng, k, n, most=8):
    """Distinct sets; genres are of unequal frequency, as in a real catalogue."""
    weight = 1 / np.arange(1, k + 1) ** 0.5
    out = {tuple(sorted(rng.choice(k, size=rng.integers(1, most + 1), replace=False, p=weight / weight.sum()) + 1)) for _ in range(n)}
    return sorted(out)


def _sets(rows, movies, k):
    kind = pa.struct([("mask", pa.int64()), ("size", pa.int64()), ("idx", pa.list_(pa.int32()))])
    return Sets(pa.array([{"mask": i, "size": int(m), "idx": list(r)} for i, (r, m) in enumerate(zip(rows, movies))], type=kind), k)


def _brute(rows, movies, profile, need, margin=1e-9):
    norm = np.sqrt((profile ** 2).sum())
    score = np.array([5 * sum(profile[g - 1] for g in r) / (norm * np.sqrt(max(1, len(r)))) for r in rows])
    order = np.argsort(-score, kind="stable")
    held = np.cumsum(np.asarray(movies)[order])
    first = int(np.searchsorted(held, need))
    tau = score[order[first]] if first < len(rows) else -np.inf
    return {int(i): score[i] for i in np.flatnonzero(score >= tau - margin)}


@pytest.mark.parametrize("k, n, most", [(5, 40, 5), (20, 400, 8), (200, 3000, 8)])
def test_best_sets_against_all_scores(k, n, most):
    rng = np.random.default_rng(k)
    rows = _catalogue(rng, k, n, most) + [()]
    movies = rng.integers(1, 6, len(rows))
    sets = _sets(rows, movies, k)
    for trial in range(60):
        profile = np.zeros(k)
        liked = rng.choice(k, size=rng.integers(1, min(k, 12) + 1), replace=False)
        profile[liked] = rng.integers(6, 51, len(liked)) / 2
        if trial % 10 == 9:
            profile[liked[0]] = -3.0
        need = int(rng.choice([1, 20, 60, 10**6]))
        at, got, touched = sets.best(profile, need, 5.0, 1e-9)
        want = _brute(rows, movies, profile, need)
        assert dict(zip(at.tolist(), np.round(got, 9))) == {i: round(x, 9) for i, x in want.items()}
        assert len(set(at.tolist())) == len(at) and touched <= len(rows)


def test_few_sets_are_touched_with_200_genres():
    rng = np.random.default_rng(1)
    rows = _catalogue(rng, 200, 20_000, most=5)
    sets = _sets(rows, np.ones(len(rows), int), 200)
    share = []
    for _ in range(200):
        # five liked movies of a few genres each, ratings 3 to 5
        profile = np.zeros(200)
        for r in rng.choice(len(rows), 5):
            profile[np.array(rows[r]) - 1] += rng.integers(6, 11) / 2
        share.append(sets.best(profile, 60, 5.0, 1e-9)[2] / len(rows))
    assert np.mean(share) < 0.1


def test_content_scores_with_200_genres(spark):
    rng = np.random.default_rng(2)
    vocab = [f"genre{i}" for i in range(200)]
    m = pd.DataFrame([(i, f"t{i}", "|".join(vocab[g - 1] for g in r)) for i, r in enumerate(_catalogue(rng, 200, 250))],
                     columns=["movieId", "title", "genres"])
    m.loc[3, "genres"] = "(no genres listed)"
    r = pd.DataFrame([(u, int(i), float(rng.integers(1, 11)) / 2, int(rng.integers(0, 9)))
                      for u in range(25) for i in rng.choice(len(m), size=1 + u * 8, replace=False)],
                     columns=["userId", "movieId", "rating", "timestamp"])
    sr = spark.createDataFrame(r, "userId long, movieId long, rating double, timestamp long")
    sm = spark.createDataFrame(m, "movieId long, title string, genres string")
    got = C.content_scores(sr, sm, vocabulary=vocab).select("userId", "rank", "movieId", F.round("score", 6).alias("score")).toPandas()
    want = brute_force(r, m, vocab, 20)
    want["score"] = want.score.round(6)
    key = ["userId", "rank"]
    got, want = (x.sort_values(key).reset_index(drop=True) for x in (got, want))
    pd.testing.assert_frame_equal(got, want.astype(got.dtypes.to_dict())[list(got.columns)], check_exact=False, atol=1e-6)
