"""O10-O14, O27 (no SQL oracle: properties of the model)."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, physical_plan
from marquee.operators import factors as FA
from marquee.operators import feedback as FB
from marquee.sources import testdata as TD


@pytest.fixture(scope="module")
def fitted(spark):
    r = TD.ratings(spark, SF_SMALL).persist()
    m = TD.movies(spark, SF_SMALL)
    return r, m, FA.train_als(r)


def test_prediction_is_factor_dot_product(fitted):
    r, _, model = fitted
    one = FA.score_known(model, r).first()
    u = model.user_factors().where(F.col("userId") == one.userId).first().features
    i = model.item_factors().where(F.col("movieId") == one.movieId).first().features
    assert one.prediction == pytest.approx(sum(a * b for a, b in zip(u, i)), rel=1e-5)


def _numpy_als(r, mask, rank, reg, seed, rounds=300):
    """Alternating least squares with the ratings' count as weight of the penalty, from a random start."""
    rng = np.random.default_rng(seed)
    u, v = rng.normal(size=(r.shape[0], rank)), rng.normal(size=(r.shape[1], rank))

    def half(fixed, ratings, there):
        return np.array([np.linalg.solve(fixed[t].T @ fixed[t] + reg * t.sum() * np.eye(rank), fixed[t].T @ x[t])
                         for x, t in zip(ratings, there)])
    for _ in range(rounds):
        v = half(u, r.T, mask.T)
        u = half(v, r, mask)
    error = ((r - u @ v.T) ** 2 * mask).sum()
    return error + reg * ((mask.sum(1) * (u ** 2).sum(1)).sum() + (mask.sum(0) * (v ** 2).sum(1)).sum()), u @ v.T


def test_agrees_with_an_independent_numpy_als(spark):
    rng = np.random.default_rng(11)
    n, m, reg = 24, 15, 0.05
    r = rng.uniform(0.5, 2, (n, 2)) @ rng.uniform(0.5, 1.5, (2, m)) + rng.normal(0, 0.1, (n, m))
    mask = rng.random((n, m)) < 0.7
    data = [(u, i, float(r[u, i])) for u in range(n) for i in range(m) if mask[u, i]]
    model = FA.train_als(spark.createDataFrame(data, "userId int, movieId int, rating double"), rank=2, max_iter=60, reg_param=reg, blocks=2)
    u = np.array([x.features for x in model.user_factors().orderBy("userId").collect()])
    v = np.array([x.features for x in model.item_factors().orderBy("movieId").collect()])
    loss = ((r - u @ v.T) ** 2 * mask).sum() + reg * ((mask.sum(1) * (u ** 2).sum(1)).sum() + (mask.sum(0) * (v ** 2).sum(1)).sum())
    best, want = min((_numpy_als(r, mask, 2, reg, s) for s in range(5)), key=lambda x: x[0])
    assert loss == pytest.approx(best, rel=1e-3)
    assert np.abs(u @ v.T - want).max() < 0.02


def test_last_half_step_equals_numpy_solve(fitted):
    """Each user's factors from the item factors by numpy's solver, for every user (also of a refreshed model)."""
    r, _, model = fitted
    v = {x.movieId: np.array(x.features, float) for x in model.item_factors().collect()}
    u = {x.userId: np.array(x.features, float) for x in model.user_factors().collect()}
    mine = {}
    for x in r.collect():
        mine.setdefault(x.userId, []).append((v[x.movieId], x.rating))
    assert set(mine) == set(u)
    for i, rows in mine.items():
        a, y = np.array([p[0] for p in rows]), np.array([p[1] for p in rows])
        want = np.linalg.solve(a.T @ a + 0.01 * len(y) * np.eye(a.shape[1]), a.T @ y)
        assert np.abs(u[i] - want).max() < 5e-3 * max(1.0, np.abs(want).max())


def test_requests_equal_products_of_exported_factors(fitted):
    r, m, model = fitted
    v = {x.movieId: np.array(x.features, float) for x in model.item_factors().collect()}
    u = {x.userId: np.array(x.features, float) for x in model.user_factors().collect()}
    titles = {x.movieId: x.title for x in m.collect()}
    got = FA.score_requests(model, r.select("userId", "movieId"), m).collect()
    assert len(got) == r.count()
    for x in got:
        p = float(u[x.userId] @ v[x.movieId])
        assert x.prediction == pytest.approx(p, abs=1e-5) and x.title == titles[x.movieId]
        assert x.rounded in {int(np.floor(p + 0.5 - 1e-5)), int(np.floor(p + 0.5 + 1e-5))}


def test_mse_beats_the_mean(fitted):
    r, _, model = fitted
    scored = FA.score_known(model, r)
    assert scored.count() == r.count()  # one row per rating
    mse = FA.mean_squared_error(scored).first().mse
    var = r.agg(F.var_pop("rating")).first()[0]
    assert mse < var


def _factors(model):
    return {x.userId: list(x.features) for x in model.user_factors().collect()}


def test_refit_is_deterministic_also_after_repartitioning(fitted):
    r, _, model = fitted
    a = _factors(model)
    for again in (r, r.repartition(13)):
        b = _factors(FA.train_als(again))
        assert set(a) == set(b)
        assert max(abs(x - y) for u in a for x, y in zip(a[u], b[u])) < 1e-3


def test_last_half_step_solves_the_users(fitted):
    r, _, model = fitted
    got = FA.normal_equation_residuals(model, r)
    assert got.count() == r.select("userId").distinct().count()
    assert got.agg(F.max("residual")).first()[0] < 1e-4
    wrong = r.withColumn("rating", F.col("rating") + 1)  # the check can fail
    assert FA.normal_equation_residuals(model, wrong).agg(F.max("residual")).first()[0] > 1e-2


def test_nothing_scores_above_the_list(fitted, spark):
    r, m, model = fitted
    users = spark.createDataFrame([(0,), (3,)], "userId long")
    top = FA.top_for_users(model, users, m, n=20)
    every = FA.score_requests(model, users.crossJoin(r.select("movieId").distinct()), m)
    low = {x.userId: x.s for x in top.groupBy("userId").agg(F.min("score").alias("s")).collect()}
    for x in every.groupBy("userId").agg(F.sort_array(F.collect_list("prediction"), asc=False).alias("p")).collect():
        assert x.p[19] == pytest.approx(low[x.userId], abs=1e-5)


def test_exclude_seen(fitted, spark):
    r, m, model = fitted
    users = spark.createDataFrame([(0,), (3,)], "userId long")
    got = FA.top_for_users(model, users, m, n=7, seen=r)
    assert got.join(r, ["userId", "movieId"], "left_semi").isEmpty()
    every = FA.score_requests(model, users.crossJoin(m.select("movieId")), m).join(r, ["userId", "movieId"], "left_anti")
    for u in (0, 3):
        best = sorted((-x.prediction, x.movieId) for x in every.where(F.col("userId") == u).collect())[:7]
        mine = sorted((-x.score, x.movieId) for x in got.where(F.col("userId") == u).collect())
        assert [i for _, i in mine] == [i for _, i in best]


def test_ids_beyond_32_bits(spark):
    base = 3_000_000_000
    data = [(base + u * 7, -base + i, float(1 + (u * 3 + i) % 5)) for u in range(8) for i in range(9)]
    r = spark.createDataFrame(data, "userId long, movieId long, rating double")
    m = spark.createDataFrame([(-base + i, f"t{i}") for i in range(9)], "movieId long, title string")
    model = FA.train_als(r, blocks=2)
    got = FA.score_known(model, r)
    assert {(x.userId, x.movieId) for x in got.collect()} == {(u, i) for u, i, _ in data}
    top = FA.top_for_users(model, r.select("userId").limit(1), m, n=3).collect()
    assert len(top) == 3 and all(x.movieId < -base + 9 and x.title for x in top)


def test_top_n_sorted_and_bounded(fitted, spark):
    _, m, model = fitted
    top = FA.top_for_users(model, spark.createDataFrame([(0,), (1,)], "userId long"), m)
    for u in (0, 1):
        rs = top.where(F.col("userId") == u).orderBy("rank").collect()
        assert len(rs) == 20 and [x["rank"] for x in rs] == list(range(1, 21))
        assert all(rs[i].score >= rs[i + 1].score for i in range(19))
        assert all(x.title is not None for x in rs)


def test_requests_rounding_and_cold_start_drop(fitted, spark):
    _, m, model = fitted
    req = spark.createDataFrame([(0, 5), (-99, 5)], "userId long, movieId long")
    out = FA.score_requests(model, req, m).collect()
    assert len(out) == 1  # unknown user gives no row
    assert out[0].rounded == int(out[0].prediction + 0.5) or out[0].prediction < 0


def test_refresh_appends_and_retrains(fitted, spark):
    r, m, _ = fitted
    new = FB.accepted_ratings(TD.answers(spark, SF_SMALL))
    updated, model = FA.refresh(r, new)
    assert updated.count() == r.count() + new.count()
    cold = new.select("userId").distinct()
    top = FA.top_for_users(model, cold, m)
    assert top.select("userId").distinct().count() == cold.count()


def test_top_n_may_include_rated_movies(spark):
    # one user rated every movie: the top-n is drawn from rated movies (not excluded)
    data = [(u, i, float(1 + (u * 7 + i) % 5)) for u in range(6) for i in range(12)]
    r = spark.createDataFrame(data, "userId int, movieId int, rating double")
    m = spark.createDataFrame([(i, f"t{i}", "x") for i in range(12)], "movieId int, title string, genres string")
    model = FA.train_als(r)
    top = FA.top_for_users(model, spark.createDataFrame([(0,)], "userId long"), m, n=5).collect()
    assert len(top) == 5


def test_top20_plans_cover_all_their_users(spark):
    """O13 lists every user with ratings, O27 every new user with accepted answers."""
    from marquee.operators import feedback
    from marquee.plans import registry
    from marquee.sources import testdata

    folder = "/root/testdata/sf0.001"
    users = lambda df: {r.userId for r in df.select("userId").distinct().collect()}
    assert users(registry.o13_als_top20(spark, folder)) == users(testdata.ratings(spark, folder))
    new = users(feedback.accepted_ratings(testdata.answers(spark, folder)))
    assert new and users(registry.o27_refresh_top20(spark, folder)) == new


def test_products_lie_by_user_for_the_checks(spark):
    """The checks group products by user; joined by movie last, every row was shuffled once more for it."""
    from types import SimpleNamespace

    from conftest import physical_plan, rows
    from marquee.plans import registry as R
    key = "spark.sql.autoBroadcastJoinThreshold"
    kept = spark.conf.get(key)
    spark.conf.set(key, "-1")  # as at sizes where no side is broadcast
    try:
        u = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(4)], "userId long, features array<float>")
        v = spark.createDataFrame([(i, [2.0, float(i)]) for i in range(3)], "movieId long, features array<float>")
        pairs = spark.createDataFrame([(i, j) for i in range(4) for j in range(3)] + [(1, 1), (None, 1), (9, 9)], "userId long, movieId long")
        x = R._with_product(SimpleNamespace(user_factors=lambda: u, item_factors=lambda: v), pairs)
        grouped = x.groupBy("userId").agg(F.sum("product").alias("s"), F.count(F.lit(1)).alias("n"))
        assert physical_plan(grouped).count("Exchange hashpartitioning") == physical_plan(x).count("Exchange hashpartitioning") == 4
        assert rows(grouped) == [(i, 6.0 + 3 * i + (3.0 if i == 1 else 0.0), 3 + (i == 1)) for i in range(4)]
    finally:
        spark.conf.set(key, kept)


def test_residuals_shuffle_the_ratings_twice(spark):
    """They were joined by user, by movie and once more with the movies' factors, and the sums were shuffled by user again."""
    rows = [(u, m, float((u * m) % 5 + 1)) for u in range(12) for m in range(9) if (u + m) % 3]
    ratings = spark.createDataFrame(rows, "userId long, movieId long, rating double")
    model = FA.train_als(ratings, blocks=2)
    keep = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        out = FA.normal_equation_residuals(model, ratings)
        plan = physical_plan(out)
    finally:
        for c, v in keep.items():
            spark.conf.set(c, v)
    assert plan.count("Exchange hashpartitioning") == 4  # the ratings by movie and by user, the factors of both
    got = {r["userId"]: r for r in out.collect()}
    u, v = ({r[0]: np.array(r[1]) for r in f.collect()} for f in (model.user_factors(), model.item_factors()))
    for user, r in got.items():
        own = [(m, s) for a, m, s in rows if a == user]
        g = sum((np.float32(u[user] @ v[m]) - s) * v[m] for m, s in own) / len(own) + FA.ALS_REG_PARAM * u[user]
        assert r["n_ratings"] == len(own) and abs(r["residual"] - np.abs(g).max()) < 1e-5
    assert set(got) == {a for a, _, _ in rows}


def test_factor_blocks_follow_the_ratings(spark, monkeypatch):
    """One block per core put all ratings into as many tasks as there are cores, however many ratings there were."""
    r = TD.ratings(spark, SF_SMALL).persist()
    monkeypatch.setattr(FA, "BLOCK_RATINGS", r.count() // 100)
    model = FA.train_als(r)
    assert model.model.userFactors.rdd.getNumPartitions() >= 100
    assert model.model.itemFactors.rdd.getNumPartitions() >= 100
    left = FA.normal_equation_residuals(model, r)
    assert left.count() == r.select("userId").distinct().count()
    assert left.where("residual is null or residual > 1e-4").count() == 0
