"""Property tests on random small inputs (hypothesis)."""

from __future__ import annotations

import re

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marquee.functions import answers as A
from marquee.operators import content as C
from marquee.operators import feedback as FB
from test_content import brute_force

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])

TOKENS = ["1", "2", "3", "4", "5", "6", "0", "7", "-1", "+4", " 3", "x", "4.5", "", "99999999999",
          "5\n", "\u0663"]


def walk_console(rows: list[tuple], max_accepted: int) -> dict[tuple, str]:
    """Plain walk of one user's answers: candidates by rank, attempts in order."""
    out = {}
    accepted = 0
    by_rank: dict[int, list] = {}
    for rank, attempt, answer in sorted(rows):
        by_rank.setdefault(rank, []).append((attempt, answer))
    for rank in sorted(by_rank):
        decided = False
        for attempt, answer in by_rank[rank]:
            key = (rank, attempt)
            if decided:               # later attempts of a decided candidate
                out[key] = A.AFTER_DECISION
                continue
            if accepted >= max_accepted:  # candidates after the last accepted one
                out[key] = A.AFTER_LIMIT
                continue
            ok = re.fullmatch(r"[+-]?[0-9]+", answer) is not None and abs(int(answer)) <= 2**31 - 1
            if not ok:
                out[key] = A.NOT_INTEGER
            elif int(answer) == 6:
                out[key], decided = A.SKIPPED, True
            elif 1 <= int(answer) <= 5:
                out[key], decided = A.ACCEPTED, True
                accepted += 1
            else:
                out[key] = A.OUT_OF_RANGE
    return out


answer_tables = st.lists(
    st.tuples(st.integers(1, 3), st.integers(1, 12), st.integers(1, 3), st.sampled_from(TOKENS)),
    min_size=1, max_size=40, unique_by=lambda t: (t[0], t[1], t[2]))


@SETTINGS
@given(rows=answer_tables, limit=st.integers(1, 6))
def test_answer_log_equals_console_walk(spark, rows, limit):
    df = spark.createDataFrame([(u, r, a, 100 + r, s) for u, r, a, s in rows],
                               "userId long, candidate_rank long, attempt long, movieId long, answer string")
    got = {(x.userId, x.candidate_rank, x.attempt): x.status
           for x in FB.answer_log(df, max_accepted=limit).collect()}
    exp = {}
    for u in {r[0] for r in rows}:
        for (rank, attempt), status in walk_console([(r, a, s) for uu, r, a, s in rows if uu == u],
                                                    limit).items():
            exp[(u, rank, attempt)] = status
    assert got == exp


VOC = ["a", "b", "c", "d"]
genre_sets = st.sampled_from(["a", "b", "c", "d", "a|b", "a|c", "b|d", "a|b|c", "c|d", "a|b|c|d",
                              "(no genres listed)"])
movie_tables = st.lists(genre_sets, min_size=1, max_size=14)
rating_tables = st.lists(
    st.tuples(st.integers(1, 4), st.integers(0, 13), st.integers(0, 10), st.integers(0, 3)),
    min_size=1, max_size=30, unique_by=lambda t: (t[0], t[1]))


@SETTINGS
@given(movies=movie_tables, ratings=rating_tables, n=st.integers(1, 4))
def test_pruned_content_equals_brute_force(spark, movies, ratings, n):
    m = pd.DataFrame({"movieId": range(len(movies)), "title": [f"t{i}" for i in range(len(movies))],
                      "genres": movies})
    r = pd.DataFrame([(u, mv % len(movies), h / 2, ts) for u, mv, h, ts in ratings],
                     columns=["userId", "movieId", "rating", "timestamp"]).drop_duplicates(["userId", "movieId"])
    sm = spark.createDataFrame(m, "movieId long, title string, genres string")
    sr = spark.createDataFrame(r, "userId long, movieId long, rating double, timestamp long")
    got = (C.content_scores(sr, sm, vocabulary=VOC, n=n)
           .select("userId", "rank", "movieId", F.round("score", 6).alias("score")).toPandas())
    exp = brute_force(r, m, VOC, n)
    if exp.empty:
        assert got.empty
        return
    exp["score"] = exp.score.astype(float).round(6)
    key = ["userId", "rank"]
    got = got.sort_values(key).reset_index(drop=True)
    exp = exp.sort_values(key).reset_index(drop=True)
    assert got[["userId", "rank", "movieId"]].values.tolist() == exp[["userId", "rank", "movieId"]].values.tolist()
    assert (got.score - exp.score).abs().max() < 1e-6 if len(got) else True


def neighbours_reference(r: pd.DataFrame, m: pd.DataFrame, target: int, n: int):
    """Per-row formulation: distinct co-rated rows, each rating divided by its
    window norm (target: over all its co-rated rows; neighbour: over its rows),
    products summed per pair; predictions over the neighbours' rating rows."""
    t = r[r.userId == target][["userId", "movieId", "rating"]].drop_duplicates()
    o = r[["userId", "movieId", "rating"]].drop_duplicates()
    co = t.merge(o, on="movieId", suffixes=("1", "2"))
    co = co[co.userId1 != co.userId2].copy()
    if co.empty:
        return {}, {}, []
    c = (co.rating1 ** 2).sum() ** 0.5
    n2 = co.groupby("userId2").rating2.apply(lambda x: (x ** 2).sum() ** 0.5)
    co["p"] = (co.rating1 / c if c else 0.0) * co.apply(
        lambda x: x.rating2 / n2[x.userId2] if n2[x.userId2] else 0.0, axis=1)
    sim = co.groupby("userId2").p.sum().to_dict()
    seen = set(r[r.userId == target].movieId)
    rows = r[r.userId.isin(sim) & ~r.movieId.isin(seen) & r.movieId.isin(m.movieId)].copy()
    rows["cosSim"] = rows.userId.map(sim)
    g = rows.assign(sp=rows.rating * rows.cosSim).groupby("movieId")[["sp", "cosSim"]].sum()
    pred = {mv: v.sp / v.cosSim for mv, v in g.iterrows() if v.cosSim != 0}
    top = (rows[rows.movieId.isin(pred)][["movieId", "cosSim", "rating"]].drop_duplicates()
           .assign(pred=lambda d: d.movieId.map(pred)))
    top = top.assign(k1=-top.cosSim.round(9), k2=-top.pred.round(9)).sort_values(
        ["k1", "k2", "movieId", "rating"]).head(n)
    return sim, pred, list(zip(top.movieId, top.rating))


neighbour_tables = st.lists(
    st.tuples(st.integers(0, 5), st.integers(0, 8), st.integers(0, 10)), min_size=2, max_size=35)


@SETTINGS
@given(ratings=neighbour_tables, n=st.integers(1, 6))
def test_neighbourhood_equals_per_row_formulation(spark, ratings, n):
    from marquee.operators import neighbours as N
    r = pd.DataFrame([(u, mv, h / 2) for u, mv, h in ratings], columns=["userId", "movieId", "rating"])
    m = pd.DataFrame({"movieId": range(8), "title": [f"t{i}" for i in range(8)], "genres": "x"})
    sr = spark.createDataFrame(r, "userId long, movieId long, rating double")
    sm = spark.createDataFrame(m, "movieId long, title string, genres string")
    sim, pred, top = neighbours_reference(r, m, 0, n)
    got_sim = {x.userId2: x.cosineSim for x in N.cosine_similarity(sr, 0).collect()}
    assert got_sim.keys() == sim.keys()
    assert all(abs(got_sim[k] - sim[k]) < 1e-9 for k in sim)
    got_pred = {x.movieId: x.ratingPredicted for x in N.predicted_ratings(sr, sm, 0).collect()}
    assert got_pred.keys() == pred.keys()
    assert all(abs(got_pred[k] - pred[k]) < 1e-9 for k in pred)
    got_top = [(x.movieId, x.rating) for x in
               N.neighbour_recommendations(sr, sm, 0, n=n).orderBy("rank").collect()]
    assert got_top == top
