"""Content-based recommendation from genres and user taste profiles.

Scores depend on a movie only through its genre set, so movies are grouped
into *signatures* (distinct genre sets; the vocabulary may have any size).  The exact top-n per user is found without a cross join and without
emitting every (user, movie) pair:

1. users meet the signature catalogue by inverted lists with bounds
   (``genre_index``), which touch only the sets that can be among a user's best;
   packed users and the catalogue's chunks meet by an equi-join on (chunk, salt);
2. these, a prefix by score whose movies number at least ``n`` plus the user's
   seen ones, are rows (at most n + seen of them per user); the seen counts join them, and a running sum keeps the signatures
   before which fewer than n unseen movies stand (ties kept whole);
3. a kept signature needs at most ``n + seen(user, signature)`` of its movies,
   taken in id order: positions 1..K are generated and equi-joined to the
   movies' position inside their signature (computed without one task per
   signature, see ``rank_within``);
4. seen movies are removed by the user's containers (``seen``) and ``row_number <= n`` (partial
   WindowGroupLimit) picks the final list; ties are broken by movie id.

A user whose profile is all zeros scores 0 everywhere, so the list is the first
unseen movies by id: one pseudo signature that holds every movie with genres,
of which n + seen positions are needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions import vectors as V
from marquee.functions.ranking import rank_within, round6, top_k
from marquee.functions.targets import restrict_to
from marquee.operators.genre_index import best_sets
from marquee.operators.popularity import attach_titles
from marquee.operators.seen import seen_containers, without_seen
from marquee.schema import (
    DEFAULT_GENRES, EXCLUDE_LABEL, LIKED_THRESHOLD, N_LIKED, N_RECOMMENDATIONS, NO_GENRE_LABEL,
    REPORT_ITEM_FORMAT, REPORT_ITEM_SEPARATOR, REPORT_USER_PREFIX, REPORT_USER_SUFFIX,
    REPORT_USERS, SCORE_SCALE,
)
from marquee.sources.tables import materialize

# Signatures per catalogue row (bounds the array one row carries).
CHUNK_SIGNATURES = 1 << 14
# Ranking keys are scores rounded to 9 places (|error| <= 5e-10): a raw score
# this far below a bound may still tie with it after rounding.
RANK_ROUNDING_MARGIN = 1e-9
# Pseudo signature of the users without any taste: every movie with genres.
EVERY_MOVIE = -1


def liked_ratings(ratings: DataFrame, movies: DataFrame, n: int = N_LIKED,
                  threshold: float = LIKED_THRESHOLD, exclude_label: str = EXCLUDE_LABEL) -> DataFrame:
    """Per user the ``n`` latest ratings >= ``threshold`` whose movie is
    not labelled ``exclude_label``; ties on time by movie id.
    ``(userId, movieId, rating, timestamp, recency)``."""
    excluded = movies.where(F.col("genres") == exclude_label).select("movieId")
    liked = ratings.where(F.col("rating") >= threshold).join(excluded, "movieId", "left_anti")
    return top_k(liked, ["userId"], [F.col("timestamp").desc(), F.col("movieId").asc()], n,
                 rank_col="recency").select("userId", "movieId", "rating", "timestamp", "recency")


def genre_matrix(movies: DataFrame, vocabulary: Sequence[str] = DEFAULT_GENRES,
                 no_genre_label: str = NO_GENRE_LABEL, unknown: str = "error") -> DataFrame:
    """One row per movie with genres: ``(movieId, g, mask, n_genres)``.

    ``g`` is the multi-hot ``array<double>`` over ``vocabulary``, ``mask`` the
    same set as bits.  A genre outside the vocabulary fails the job
    (``unknown="error"``) or is ignored (``"ignore"``).  Movies labelled
    ``no_genre_label`` are left out.  All per-movie expressions are codegen'd;
    the error message is built only for a failing row.
    """
    m = movies.where(F.col("genres").isNotNull() & (F.col("genres") != no_genre_label))
    m = m.select("movieId", V.genre_list(F.col("genres")).alias("_names"))
    m = m.withColumn("mask", V.genre_mask(F.col("_names"), vocabulary))
    mask = F.col("mask")
    if unknown == "error":
        # more distinct names than recognised bits means an unknown name
        bad = F.size(F.array_distinct("_names")) > V.mask_size(mask, vocabulary)
        mask = F.when(bad, F.raise_error(F.concat(
            F.lit("genre not in vocabulary: "), F.element_at(V.unknown_genres(F.col("_names"), vocabulary), 1),
            F.lit(" (movie "), F.col("movieId").cast("string"), F.lit(")")))).otherwise(mask)
    elif unknown != "ignore":
        raise ValueError(f"unknown={unknown!r}")
    return m.select("movieId", V.multi_hot(F.col("_names"), vocabulary).alias("g"), mask.alias("mask"),
                    V.mask_size(F.col("mask"), vocabulary).alias("n_genres"))


def user_profiles(liked: DataFrame, matrix: DataFrame, k: int) -> DataFrame:
    """``(userId, profile)`` with profile = Σ rating · G(movie) over the
    liked ratings; a liked movie without a genre row adds a zero vector."""
    x = liked.select("userId", "movieId", "rating").join(matrix.select("movieId", "g"), "movieId", "left")
    sums = [F.sum(F.col("rating") * F.coalesce(F.element_at("g", i + 1), F.lit(0.0))).alias(f"_p{i}")
            for i in range(k)]
    return x.groupBy("userId").agg(*sums).select(
        "userId", F.array(*[F.col(f"_p{i}") for i in range(k)]).alias("profile"))


def seen_items(ratings: DataFrame) -> DataFrame:
    """The seen relation, distinct ``(userId, movieId)``.

    (The original built a set per user on the driver; ``seen.seen_containers`` is that
    set in rows of at most 4 KB.)
    """
    return ratings.select("userId", "movieId").distinct()


def _signatures(matrix: DataFrame, k: int) -> DataFrame:
    """Distinct genre sets ``(mask, size, idx)``; ``idx`` lists the
    1-based vocabulary positions of the set, computed once per set."""
    sigs = matrix.groupBy("mask").agg(F.count(F.lit(1)).alias("size"))
    return sigs.select("mask", "size", V.mask_positions("mask", k).alias("idx"))


def _catalogue(matrix: DataFrame, k: int, salt: int) -> tuple[DataFrame, F.Column]:
    """Signature lists ``(chunk, salt, sigs)`` and the number of chunks (computed inside the query)."""
    sigs = _signatures(matrix, k)
    n_sig = sigs.agg(F.count(F.lit(1))).scalar()
    chunks = F.greatest(F.lit(1), F.ceil(n_sig / F.lit(CHUNK_SIGNATURES))).cast("int")
    lists = (sigs.withColumn("chunk", F.pmod(F.xxhash64("mask"), chunks).cast("int")).groupBy("chunk")
             .agg(F.collect_list(F.struct("mask", "size", "idx")).alias("sigs")))
    return lists.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1)))), chunks


def _kept_signatures(profiles: DataFrame, seen: DataFrame, matrix: DataFrame, n: int, k: int,
                     salt: int | None = None) -> DataFrame:
    """Steps 1-2: ``(userId, mask, score, rscore, k_take)`` per kept signature."""
    salt = salt or max(1, int(profiles.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    catalogue, chunks = _catalogue(matrix, k, salt)
    # seen movies with genres, by signature and by user (<= #signatures rows per user)
    seen_sig = (seen.join(matrix.select("movieId", "mask"), "movieId")
                .groupBy("userId", "mask").agg(F.count(F.lit(1)).alias("seen")))
    seen_user = seen_sig.groupBy("userId").agg(F.sum("seen").alias("seen_total"))
    users = (profiles.join(seen_user, "userId", "left")
             .withColumn("need", F.lit(n) + F.coalesce("seen_total", F.lit(0).cast("bigint")))
             .withColumn("norm_p", V.norm(F.col("profile"))))

    # The sets down to the score at which n + (the user's seen movies) movies are reached hold at
    # least n unseen ones, so no set that scores below that (minus the rounding margin) can be kept.
    x = best_sets(users.where(F.col("norm_p") > 0).select("userId", "need", "profile"), catalogue, chunks, salt, k,
                  SCORE_SCALE, RANK_ROUNDING_MARGIN)

    # The exact threshold: unseen movies of strictly better signatures number fewer than n.
    x = x.join(seen_sig, ["userId", "mask"], "left").withColumn("seen", F.coalesce("seen", F.lit(0).cast("bigint")))
    x = x.withColumn("rscore", F.round("score", 9)).withColumn("_unseen", F.col("size") - F.col("seen"))
    up_to = Window.partitionBy("userId").orderBy(F.col("rscore").desc())  # ties included
    tie = Window.partitionBy("userId", "rscore")
    better = F.sum("_unseen").over(up_to) - F.sum("_unseen").over(tie)
    kept = x.withColumn("_better", better).where((F.col("_better") < n) & (F.col("_unseen") > 0)).select(
        "userId", "mask", "score", "rscore", F.least(F.col("size"), F.lit(n) + F.col("seen")).cast("long").alias("k_take"))
    flat = users.where(F.col("norm_p") == 0).select(
        "userId", V.mask_literal(EVERY_MOVIE, k).alias("mask"), F.lit(0.0).alias("score"), F.lit(0.0).alias("rscore"),
        F.col("need").cast("long").alias("k_take"))
    return kept.unionByName(flat)


def content_scores(ratings: DataFrame, movies: DataFrame, *, vocabulary: Sequence[str] = DEFAULT_GENRES,
                   n: int = N_RECOMMENDATIONS, users: DataFrame | None = None,
                   n_liked: int = N_LIKED, threshold: float = LIKED_THRESHOLD,
                   exclude_label: str = EXCLUDE_LABEL, no_genre_label: str = NO_GENRE_LABEL,
                   unknown: str = "error", salt: int | None = None) -> DataFrame:
    """O24 for a ranking (scoring pruned to what the top-n needs):
    ``(userId, rank, movieId, score, rscore)``.

    score = 5 · cos(P(user), G(movie)) for unseen movies with genres; a zero
    norm gives 0.  ``rscore`` is the score rounded to 9 places, the ranking
    key.  Rows are the exact top ``n`` per user (ties broken by movie id),
    ``rank`` gives the position.  ``users`` restricts the profiled users.
    """
    if users is not None:  # before anything is computed for anybody
        ratings = restrict_to(ratings, users.select("userId"))
    # few bytes, much work: the catalogue's genre sets are read once, in as many tasks as a shuffle has
    tasks = int(movies.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = movies.select("movieId", "genres").repartition(tasks, "movieId")
    matrix = materialize(genre_matrix(spread, vocabulary, no_genre_label, unknown), "genre-matrix")
    liked = liked_ratings(ratings, movies, n_liked, threshold, exclude_label)
    profiles = user_profiles(liked, matrix, len(vocabulary))
    seen = seen_items(ratings)
    kept = _kept_signatures(profiles, seen, matrix, n, len(vocabulary), salt)
    members = matrix.select("movieId", F.explode(F.array("mask", V.mask_literal(EVERY_MOVIE, len(vocabulary)))).alias("mask"))
    positions = rank_within(members, "mask", "movieId", "pos")
    cand = (kept.withColumn("pos", F.explode(F.sequence(F.lit(1).cast("long"), F.col("k_take"))))
            .join(positions, ["mask", "pos"]))
    cand = without_seen(cand, seen_containers(ratings))
    return top_k(cand, ["userId"], [F.col("rscore").desc(), F.col("movieId").asc()], n).select(
        "userId", "rank", "movieId", "score", "rscore")


def score_pairs(requests: DataFrame, ratings: DataFrame, movies: DataFrame, *,
                vocabulary: Sequence[str] = DEFAULT_GENRES, n_liked: int = N_LIKED,
                threshold: float = LIKED_THRESHOLD, exclude_label: str = EXCLUDE_LABEL,
                no_genre_label: str = NO_GENRE_LABEL, unknown: str = "error") -> DataFrame:
    """O24 for given pairs: ``(userId, movieId, score)`` for every request whose
    user has a profile and whose movie has genres, seen or not, as often as it is
    requested.  A pair meets its two vectors by equi-joins."""
    matrix = genre_matrix(movies, vocabulary, no_genre_label, unknown)
    asked = requests.select("userId", "movieId")
    liked = liked_ratings(restrict_to(ratings, asked.select("userId")), movies, n_liked, threshold, exclude_label)
    profiles = user_profiles(liked, matrix, len(vocabulary)).withColumn("norm_p", V.norm(F.col("profile")))
    x = asked.join(matrix.select("movieId", "g", "n_genres"), "movieId").join(profiles, "userId")
    score = V.scaled_cosine(V.dot(F.col("profile"), F.col("g")), F.col("norm_p"), F.sqrt(F.col("n_genres").cast("double")),
                            SCORE_SCALE)
    return x.select("userId", "movieId", score.alias("score"))


def content_recommendations(ratings: DataFrame, movies: DataFrame, **kw) -> DataFrame:
    """``(userId, rank, movieId, title, score)``, the top n per profiled user."""
    top = content_scores(ratings, movies, **kw)
    return attach_titles(top, movies).select("userId", "rank", "movieId", "title", "score")


def report_users(ratings: DataFrame, movies: DataFrame, n_users: int = REPORT_USERS, *,
                 vocabulary: Sequence[str] = DEFAULT_GENRES, n_liked: int = N_LIKED,
                 threshold: float = LIKED_THRESHOLD, exclude_label: str = EXCLUDE_LABEL,
                 no_genre_label: str = NO_GENRE_LABEL, unknown: str = "error") -> DataFrame:
    """The ``n_users`` lowest user ids that receive recommendations: users with
    a profile and at least one unseen movie with genres."""
    matrix = genre_matrix(movies, vocabulary, no_genre_label, unknown)
    # any liked rating gives a profile: the latest ones need not be picked for that
    excluded = movies.where(F.col("genres") == exclude_label).select("movieId")
    profiled = ratings.where(F.col("rating") >= threshold).join(excluded, "movieId", "left_anti").select("userId").distinct()
    n_g = matrix.agg(F.count(F.lit(1))).scalar()
    seen_g = (seen_items(ratings).join(matrix.select("movieId"), "movieId", "left_semi")
              .groupBy("userId").agg(F.count(F.lit(1)).alias("n_seen")))
    eligible = (profiled.join(seen_g, "userId", "left")
                .where(F.coalesce(F.col("n_seen"), F.lit(0)) < n_g))
    return eligible.select("userId").orderBy("userId").limit(n_users)


def format_report(recs: DataFrame) -> DataFrame:
    """O26 formatting: one line per user,
    ``utente: <id> -> \\t1)'<title>' score: <s>/5;\\t2)...`` (scores rounded to 6)."""
    item = F.struct("rank", "title", round6(F.col("score")).cast("string").alias("s"))
    lines = recs.groupBy("userId").agg(F.sort_array(F.collect_list(item)).alias("items"))
    text = F.array_join(F.transform("items", lambda it: F.format_string(
        REPORT_ITEM_FORMAT, it["rank"], F.coalesce(it["title"], F.lit("null")), it["s"])),
        REPORT_ITEM_SEPARATOR)
    return lines.select("userId", F.concat(F.lit(REPORT_USER_PREFIX), F.col("userId").cast("string"),
                                           F.lit(REPORT_USER_SUFFIX), text).alias("line"))


def content_report(ratings: DataFrame, movies: DataFrame, n_users: int = REPORT_USERS,
                   n: int = N_RECOMMENDATIONS, **kw) -> DataFrame:
    """The report for the ``n_users`` lowest user ids, ``n`` items each.
    The user restriction is applied before scoring."""
    sel = {k: v for k, v in kw.items() if k in ("vocabulary", "n_liked", "threshold", "exclude_label",
                                                  "no_genre_label", "unknown")}
    users = report_users(ratings, movies, n_users, **sel)
    recs = content_recommendations(ratings, movies, n=n, users=users, **kw)
    return format_report(recs)
