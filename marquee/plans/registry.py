"""Named plans over the driver's tables, one per operator of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
adapter tables.  Floating outputs whose last bits depend on summation order
are rounded to 6 places here (the operators return full precision).
The target user of the per-user operators is user 0, the user the original
program always recommends for.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.functions.ranking import round6
from marquee.operators import content as C
from marquee.operators import factors as FA
from marquee.operators import feedback as FB
from marquee.operators import neighbours as N
from marquee.operators import popularity as P
from marquee.operators import seen as SE
from marquee.session import checkpoint_dir
from marquee.sources import testdata as TD
from marquee.sources.rating_store import RatingStore
from marquee.sources.tables import materialize, memoize, shared_folder

TARGET_USER = 0
#: Users with at most this many ratings are the target set of the ``_set`` plans.
LIGHT_USER_RATINGS = 20
VOCAB = TD.ADAPTER_GENRES
#: Buckets of the rating store: as many as the largest append needs to be files of about 128 MB.
STORE_BUCKETS = 16


def _ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter ratings, derived once per application (see sources.tables)."""
    return materialize(TD.ratings(spark, sf_dir), f"ratings@{sf_dir}")


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(TD.answers(spark, sf_dir), f"answers@{sf_dir}")


def _data(spark: SparkSession, sf_dir: str):
    return _ratings(spark, sf_dir), TD.movies(spark, sf_dir)


#: Largest residual of the normal equations per rating (single precision factors).
ALS_TOLERANCE = 1e-4


def light_users(ratings: DataFrame, most: int = LIGHT_USER_RATINGS) -> DataFrame:
    """``(userId)`` of the users with few ratings: those a system recommends to first."""
    return ratings.groupBy("userId").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= most).select("userId")


def _light(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(light_users(_ratings(spark, sf_dir)), f"light-users@{sf_dir}")


def _r6(c: str) -> F.Column:
    return round6(F.col(c)).alias(c)


def o01_ratings(spark, sf_dir):
    return _ratings(spark, sf_dir)


def o02_movies(spark, sf_dir):
    return TD.movies(spark, sf_dir)


def o03_titles(spark, sf_dir):
    r, m = _data(spark, sf_dir)
    return P.attach_titles(r.select("userId", "movieId", "rating"), m)


def o04_popularity(spark, sf_dir):
    r, m = _data(spark, sf_dir)
    return P.popularity(r, m).select("movieId", "title", "score")


def o05_popular_candidates(spark, sf_dir):
    r, m = _data(spark, sf_dir)
    return P.popular_candidates(r, m)


def o06_unseen_movies(spark, sf_dir):
    r, m = _data(spark, sf_dir)
    return P.unseen_movies(r, m, TARGET_USER)


def o06_unseen_movies_set(spark, sf_dir):
    r, m = _data(spark, sf_dir)
    return P.unseen_movies(r, m, _light(spark, sf_dir))


def o07_random_candidates(spark, sf_dir):
    r, m = _data(spark, sf_dir)
    return P.random_candidates(r, m, TARGET_USER)


def o07_random_candidates_set(spark, sf_dir):
    r, m = _data(spark, sf_dir)
    return P.random_candidates(r, m, _light(spark, sf_dir))


def o08_accepted_ratings(spark, sf_dir):
    return FB.accepted_ratings(_answers(spark, sf_dir))


def o08_answer_log(spark, sf_dir):
    return FB.answer_log(_answers(spark, sf_dir))


def o09_appended_ratings(spark, sf_dir):
    r = _ratings(spark, sf_dir)
    return FB.append_ratings(r, FB.accepted_ratings(_answers(spark, sf_dir)))


def o09_rating_store(spark, sf_dir):
    """O9 through the store: the ratings and the accepted answers as two appends, read back by user."""
    r = _ratings(spark, sf_dir)

    def filled() -> RatingStore:
        folder = shared_folder(spark)
        if not folder and spark.sparkContext.master.startswith("local"):
            folder = "file:" + tempfile.mkdtemp(prefix="marquee-store-")  # one machine: tests and bench
        store = RatingStore(spark, f"{folder or checkpoint_dir(spark)}/marquee-store/{uuid.uuid4().hex}", r.schema, STORE_BUCKETS)
        store.append(r)
        store.append(FB.accepted_ratings(_answers(spark, sf_dir)))
        return store

    return memoize(spark, f"store@{sf_dir}", filled).read("userId")


def _model(spark, sf_dir):
    """The model is trained once per application and shared by O10-O14, as
    the original trains once and then scores, evaluates and recommends."""
    r, m = _data(spark, sf_dir)
    return r, m, memoize(spark, f"als@{sf_dir}", lambda: FA.train_als(r))


def _scored(spark, sf_dir):
    """Every rating with its prediction, scored once per application and shared by O11, O12 and O14."""
    r, m, model = _model(spark, sf_dir)
    return r, m, model, materialize(FA.score_known(model, r), f"scored@{sf_dir}")


def o10_als_user_factors(spark, sf_dir):
    _, _, model = _model(spark, sf_dir)
    return model.user_factors()


def o10_als_check(spark, sf_dir):
    """Per user: the normal equations of the last half step hold."""
    r, _, model = _model(spark, sf_dir)
    return FA.normal_equation_residuals(model, r).select(
        "userId", "n_ratings", (F.col("residual") < ALS_TOLERANCE).alias("solved"))


def o11_als_scored(spark, sf_dir):
    return _scored(spark, sf_dir)[3]


def o12_als_requests(spark, sf_dir):
    r, m, model = _model(spark, sf_dir)
    return FA.score_requests(model, r.select("userId", "movieId"), m)


def o13_als_top20(spark, sf_dir):
    """Every user who has ratings."""
    r, m, model = _model(spark, sf_dir)
    return FA.top_for_users(model, r.select("userId"), m)


def o13_als_top20_unseen(spark, sf_dir):
    r, m, model = _model(spark, sf_dir)
    return FA.top_for_users(model, _light(spark, sf_dir), m, seen=r)


def o13_als_check(spark, sf_dir):
    """Per user: 20 movies in falling order, each scored by its factors' product."""
    r, m, model = _model(spark, sf_dir)
    top = FA.top_for_users(model, None, m)
    x = _with_product(model, top).withColumn("n", F.row_number().over(Window.partitionBy("userId").orderBy("rank")))
    w = Window.partitionBy("userId").orderBy("rank")
    x = x.withColumn("ok", (F.abs(F.col("product") - F.col("score")) < ALS_TOLERANCE) & (F.col("n") == F.col("rank"))
                     & (F.coalesce(F.lag("score").over(w), F.col("score")) >= F.col("score")))
    return x.groupBy("userId").agg(F.count(F.lit(1)).alias("n_items"), F.bool_and("ok").alias("sound"))


def _with_product(model, pairs: DataFrame) -> DataFrame:
    """``pairs`` with ``product``, the product of their factors by higher-order functions (not by the scoring code)."""
    # movies first: scored pairs with titles lie by movie already, and the result lies by user as the checks group it
    x = pairs.join(model.item_factors().withColumnRenamed("features", "v"), "movieId").join(
        model.user_factors().withColumnRenamed("features", "u"), "userId")
    each = F.zip_with("u", "v", lambda a, b: a.cast("double") * b)
    return x.withColumn("product", F.aggregate(each, F.lit(0.0), lambda a, b: a + b)).drop("u", "v")


def o11_als_check(spark, sf_dir):
    """Per user: every rating has one prediction, and it is the product of the factors."""
    _, _, model, scored = _scored(spark, sf_dir)
    return _with_product(model, scored).groupBy("userId").agg(
        F.count(F.lit(1)).alias("n_scored"),
        F.bool_and(F.abs(F.col("product") - F.col("prediction")) < ALS_TOLERANCE).alias("sound"))


def o12_als_check(spark, sf_dir):
    """Per user: every request is answered, by the product of its factors and that rounded half up; the titles as one digest."""
    r, m, model = _model(spark, sf_dir)
    x = _with_product(model, FA.score_requests(model, r.select("userId", "movieId"), m))
    p = F.col("product")
    near = F.abs(p - F.col("prediction")) < ALS_TOLERANCE
    # a product this close to a half may round either way
    rounds = (F.col("rounded") == F.floor(p + 0.5)) | (F.abs(p + 0.5 - F.round(p + 0.5)) < ALS_TOLERANCE)
    said = F.array_join(F.array_sort(F.collect_list(F.concat(F.col("movieId").cast("string"), F.lit(" "), F.coalesce("title", F.lit(""))))), "\n")
    return x.groupBy("userId").agg(F.count(F.lit(1)).alias("n_requests"), F.md5(said).alias("titles_md5"),
                                   F.bool_and(near & rounds).alias("sound"))


def o14_als_check(spark, sf_dir):
    """The error is the mean of the squared differences of o11, and below the variance of the ratings."""
    r, _, _, scored = _scored(spark, sf_dir)
    by_user = scored.groupBy("userId").agg(F.sum(F.pow(F.col("rating") - F.col("prediction"), 2)).alias("s"))
    total = by_user.agg(F.sum("s")).scalar()
    spread = r.agg(F.var_pop("rating")).scalar()
    return FA.mean_squared_error(scored).select(
        "n", (F.abs(total / F.col("n") - F.col("mse")) < 1e-9).alias("is_mean"), (F.col("mse") < spread).alias("beats_mean"))


def o14_als_mse(spark, sf_dir):
    return FA.mean_squared_error(_scored(spark, sf_dir)[3])


def o15_co_rated(spark, sf_dir):
    r, _ = _data(spark, sf_dir)
    return N.co_rated(r, TARGET_USER)


def o16_user_cosine(spark, sf_dir):
    r, _ = _data(spark, sf_dir)
    return N.cosine_similarity(r, TARGET_USER).select("userId1", "userId2", _r6("cosineSim"))


def o16_user_cosine_corated(spark, sf_dir):
    r, _ = _data(spark, sf_dir)
    return N.cosine_similarity(r, TARGET_USER, norm="corated").select(
        "userId1", "userId2", _r6("cosineSim"))


def o16_user_cosine_set(spark, sf_dir):
    r, _ = _data(spark, sf_dir)
    return N.cosine_similarity(r, _light(spark, sf_dir)).select("userId1", "userId2", _r6("cosineSim"))


def o17_neighbour_predictions(spark, sf_dir):
    r, m = _data(spark, sf_dir)
    return N.predicted_ratings(r, m, TARGET_USER).select("userId", "movieId", _r6("ratingPredicted"))


def o18_neighbour_top20(spark, sf_dir):
    r, m = _data(spark, sf_dir)
    return N.neighbour_recommendations(r, m, TARGET_USER).select(
        "userId", "rank", "movieId", "title", _r6("cosSim"), "rating", _r6("ratingPredicted"))


def o18_neighbour_top20_set(spark, sf_dir):
    r, m = _data(spark, sf_dir)
    return N.neighbour_recommendations(r, m, _light(spark, sf_dir)).select(
        "userId", "rank", "movieId", "title", _r6("cosSim"), "rating", _r6("ratingPredicted"))


def o19_recommendations_as_ratings(spark, sf_dir):
    r, m = _data(spark, sf_dir)
    recs = N.recommendations_as_ratings(N.neighbour_recommendations(r, m, TARGET_USER))
    return FB.append_ratings(r, recs).select("userId", "movieId", _r6("rating"), "timestamp")


def o20_liked_ratings(spark, sf_dir):
    r, m = _data(spark, sf_dir)
    return C.liked_ratings(r, m)


def o21_genre_matrix(spark, sf_dir):
    _, m = _data(spark, sf_dir)
    return C.genre_matrix(m, VOCAB).select("movieId", F.col("mask").alias("genre_mask"), "n_genres")


def o22_user_profiles(spark, sf_dir):
    r, m = _data(spark, sf_dir)
    prof = C.user_profiles(C.liked_ratings(r, m), C.genre_matrix(m, VOCAB), len(VOCAB))
    vocab = F.array(*[F.lit(g) for g in VOCAB])
    return prof.select("userId", F.posexplode("profile").alias("i", "weight")).select(
        "userId", F.element_at(vocab, F.col("i") + 1).alias("genre"), "weight")


def o23_seen_items(spark, sf_dir):
    r, _ = _data(spark, sf_dir)
    return C.seen_items(r)


def o23_seen_containers(spark, sf_dir):
    """Every user's containers; the positions as text and the bitmap in hexadecimal."""
    r, _ = _data(spark, sf_dir)
    return SE.seen_containers(r).select(
        "userId", "bucket", "n_seen", F.array_join(F.transform("positions", lambda p: p.cast("string")), ",").alias("positions"),
        F.hex("bits").alias("bits"))


def o24_content_scores(spark, sf_dir):
    """Requested pairs: every (user, movie) that was rated."""
    r, m = _data(spark, sf_dir)
    return C.score_pairs(r.select("userId", "movieId"), r, m, vocabulary=VOCAB).select("userId", "movieId", _r6("score"))


def o24_content_top_scores(spark, sf_dir):
    r, m = _data(spark, sf_dir)
    return C.content_scores(r, m, vocabulary=VOCAB).select("userId", "movieId", _r6("score"))


def o25_content_top20(spark, sf_dir):
    r, m = _data(spark, sf_dir)
    return C.content_recommendations(r, m, vocabulary=VOCAB).select(
        "userId", "rank", "movieId", "title", _r6("score"))


def o26_content_report(spark, sf_dir):
    r, m = _data(spark, sf_dir)
    return C.content_report(r, m, vocabulary=VOCAB)


def _refreshed(spark, sf_dir):
    """The ratings with the new users' answers and the model trained on them, once per application."""
    r, m = _data(spark, sf_dir)
    new = materialize(FB.accepted_ratings(_answers(spark, sf_dir)), f"accepted@{sf_dir}")
    both, model = memoize(spark, f"als-refreshed@{sf_dir}", lambda: FA.refresh(r, new))
    return new, m, both, model


def o27_refresh_top20(spark, sf_dir):
    """Every new user with accepted answers."""
    new, m, _, model = _refreshed(spark, sf_dir)
    return FA.top_for_users(model, new.select("userId"), m)


def o27_refresh_check(spark, sf_dir):
    """Per user of the appended ratings, old or new: the normal equations hold for the retrained model."""
    _, _, both, model = _refreshed(spark, sf_dir)
    return FA.normal_equation_residuals(model, both).select(
        "userId", "n_ratings", (F.col("residual") < ALS_TOLERANCE).alias("solved"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: fn for name, fn in sorted(globals().items()) if name[:1] == "o" and name[1:3].isdigit()
}
