"""Hot keys: one user who rated most movies, one movie everybody rated, one
cold-start user with a third of all answers.  Results must stay exact."""

from __future__ import annotations

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from marquee.operators import content as C
from marquee.operators import feedback as FB
from marquee.operators import neighbours as N
from marquee.plans import oracle as O
from marquee.sources import testdata as TD
from test_content import brute_force
from oracle_check import compare

HOT_USER = 10**9


@pytest.fixture(scope="module")
def skewed(spark):
    r = TD.ratings(spark, SF_SMALL)
    m = TD.movies(spark, SF_SMALL)
    hot_user = m.select(
        F.lit(HOT_USER).cast("bigint").alias("userId"), "movieId",
        ((F.col("movieId") % 10 + 1) / F.lit(2.0)).alias("rating"),
        (F.lit(900_000_000) + F.col("movieId") % 7).cast("bigint").alias("timestamp"),
    ).where(F.col("movieId") % 10 != 3)                       # ~90% of the catalogue
    hot_movie = (r.select("userId").distinct()
                 .select("userId", F.lit(1).cast("bigint").alias("movieId"),
                         F.lit(4.0).alias("rating"), F.lit(950_000_000).cast("bigint").alias("timestamp")))
    skewed = (r.join(hot_movie.select("userId", "movieId"), ["userId", "movieId"], "left_anti")
              .unionByName(hot_movie).unionByName(hot_user))
    return skewed.persist(), m


def test_content_exact_with_hot_user_and_movie(skewed):
    r, m = skewed
    got = C.content_scores(r, m, vocabulary=TD.ADAPTER_GENRES).select(
        "userId", "rank", "movieId", F.round("score", 6).alias("score")).toPandas()
    exp = brute_force(r.toPandas(), m.toPandas(), TD.ADAPTER_GENRES, 20)
    exp["score"] = exp.score.round(6)
    key = ["userId", "rank"]
    got = got.sort_values(key).reset_index(drop=True)
    exp = exp.sort_values(key).reset_index(drop=True).astype(got.dtypes.to_dict())
    pd.testing.assert_frame_equal(got, exp, check_exact=False, atol=1e-6)
    # the hot user has fewer than 20 unseen movies with genres: all of them
    unseen = (m.where(F.col("genres") != "(no genres listed)")
              .join(r.where(F.col("userId") == HOT_USER), "movieId", "left_anti").count())
    assert (got.userId == HOT_USER).sum() == min(20, unseen) > 0


def test_neighbours_exact_for_hot_target(skewed):
    r, m = skewed
    con = duckdb.connect()
    con.register("rat", r.toPandas())
    con.register("mov", m.toPandas())
    sim_sql = O._SIM.replace(f"userId = {O.TARGET_USER}", f"userId = {HOT_USER}")
    exp = con.execute("WITH" + sim_sql + """
        SELECT userId, rank, movieId, title, round(cosSim, 6) AS cosSim, rating,
               round(ratingPredicted, 6) AS ratingPredicted FROM ntop""").df()
    got = N.neighbour_recommendations(r, m, HOT_USER).select(
        "userId", "rank", "movieId", "title", F.round("cosSim", 6).alias("cosSim"), "rating",
        F.round("ratingPredicted", 6).alias("ratingPredicted")).toPandas()
    ok, msg = compare(got, exp)
    assert ok, msg
    sims = con.execute("WITH" + sim_sql + " SELECT userId1, userId2, round(cosineSim, 6) AS cosineSim FROM sim").df()
    got_s = N.cosine_similarity(r, HOT_USER).select(
        "userId1", "userId2", F.round("cosineSim", 6).alias("cosineSim")).toPandas()
    ok, msg = compare(got_s, sims)
    assert ok, msg


def test_answers_with_one_hot_session(spark):
    a = TD.answers(spark, SF_SMALL)
    n = a.count()
    hot = (a.limit(n // 2).select(F.lit(-(10**12)).cast("bigint").alias("userId"), "candidate_rank", "attempt",
                                  "movieId", "answer"))
    both = a.unionByName(hot)
    acc = FB.accepted_ratings(both)
    assert acc.where(F.col("userId") == -(10**12)).count() == 20
    # the other users are unaffected by the hot one
    assert rows(acc.where(F.col("userId") != -(10**12))) == rows(FB.accepted_ratings(a))


@pytest.fixture
def splits(monkeypatch, spark):
    """Small shares, so that the hot movie and user of the fixture count as heavy; sort-merge joins only, no adaptive execution."""
    from marquee.functions import skew

    monkeypatch.setattr(skew, "PARTS", 128)
    monkeypatch.setattr(skew, "LEAST_ROWS", 40)
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield skew
    for k, v in before.items():
        spark.conf.set(k, v)


def test_heavy_keys_are_dealt_evenly(skewed, splits):
    r, _ = skewed
    heavy = splits.heavy_keys(r, "movieId")
    n = r.count()
    share = max(-(-n // 128), 40)
    assert 0 < heavy.count() <= 128
    by_split = splits.dealt(r, "movieId", "userId", heavy).groupBy("movieId", splits.SPLIT).count()
    assert by_split.agg(F.max("count")).first()[0] < 2 * share < r.where("movieId = 1").count()
    pairs = splits.repeated(r.select("movieId").distinct(), "movieId", heavy)
    assert by_split.join(pairs, ["movieId", splits.SPLIT], "left_anti").count() == 0
    assert splits.dealt(r, "movieId", "userId", heavy).count() == n


def test_neighbours_same_with_split_movies_and_users(spark, skewed, splits, monkeypatch):
    r, m = skewed
    targets = [0, 3, HOT_USER]

    def results():
        return [rows(N.co_rated(r, targets)),
                rows(N.cosine_similarity(r, targets).select("userId1", "userId2", F.round("cosineSim", 9))),
                rows(N.predicted_ratings(r, m, targets).select("userId", "movieId", F.round("ratingPredicted", 9))),
                rows(N.neighbour_recommendations(r, m, targets), "userId", "rank", "movieId", "rating")]
    split = results()
    monkeypatch.setattr(splits, "LEAST_ROWS", 10**9)
    assert results() == split


def test_first_rows_by_counted_prefix(skewed, spark):
    """The nearest neighbours' rows hold the same first rows as all neighbours' rows do."""
    from pyspark.sql import Window

    r, m = skewed
    r = r.unionByName(r.where("userId % 5 = 0")).unionByName(r.where("userId = 7").withColumn("rating", F.col("rating") + 0.25))
    targets = [0, 1, 2, 7, 11, HOT_USER]
    got = rows(N.neighbour_recommendations(r, m, targets).select("userId", "rank", "movieId", "rating", F.round("ratingPredicted", 9)))
    every = N.neighbour_ratings(r, m, N.cosine_similarity(r, targets), targets)
    whole = every.select("userId", "movieId", "title", "cosSim", "rating").distinct().join(
        N.predict_from_neighbours(every), ["userId", "movieId"])
    w = Window.partitionBy("userId").orderBy(F.round("cosSim", 9).desc(), F.round("ratingPredicted", 9).desc(), "movieId", "rating")
    want = rows(whole.withColumn("rank", F.row_number().over(w)).where("rank <= 20").select(
        "userId", "rank", "movieId", "rating", F.round("ratingPredicted", 9)))
    assert got == want
