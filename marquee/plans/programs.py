"""The two end-to-end programs, composed from the operators.

* ``content_based``: ratings + movies files → the content-based report
  (5 lowest user ids, 20 recommendations each) and the full top-N table.
* ``collaborative``: ratings + movies files (+ optional answers of cold-start
  users) → ALS model, in-sample MSE, top-N for the target users, the popular
  and random candidate lists, and the cosine-neighbourhood recommendations.

Everything returned is a lazy DataFrame except the model (ALS fit) and the
MSE, which are computed here.  ``python -m marquee.plans.programs --help``
runs either program on files and prints its report.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from marquee.operators import content as C
from marquee.operators import factors as FA
from marquee.operators import feedback as FB
from marquee.operators import neighbours as N
from marquee.operators import popularity as P
from marquee.schema import DEFAULT_GENRES, DEFAULT_SEED, N_RECOMMENDATIONS, REPORT_USERS
from marquee.sources.files import read_movies, read_ratings


@dataclass
class ContentResult:
    recommendations: DataFrame  # (userId, rank, movieId, title, score)
    report: DataFrame           # (userId, line)


@dataclass
class CollaborativeResult:
    ratings: DataFrame              # ratings plus accepted cold-start answers
    model: FA.Als
    mse: float
    top_n: DataFrame                # ALS top-N for the targets
    popular: DataFrame              # popular candidates for a new user
    random: DataFrame               # random unseen candidates for every target
    neighbours: DataFrame           # cosine-neighbourhood recommendations
    answer_log: DataFrame | None    # status of every answer, when answers were given


def content_based(ratings: DataFrame, movies: DataFrame, *, vocabulary: Sequence[str] = DEFAULT_GENRES,
                  n: int = N_RECOMMENDATIONS, report_users: int = REPORT_USERS) -> ContentResult:
    recs = C.content_recommendations(ratings, movies, vocabulary=vocabulary, n=n)
    report = C.content_report(ratings, movies, report_users, n, vocabulary=vocabulary)
    return ContentResult(recs, report)


def collaborative(ratings: DataFrame, movies: DataFrame, targets: Sequence[int], *,
                  answers: DataFrame | None = None, n: int = N_RECOMMENDATIONS,
                  seed: int = DEFAULT_SEED, norm: str = "pooled") -> CollaborativeResult:
    log = None
    if answers is not None:
        log = FB.answer_log(answers)
        ratings = FB.append_ratings(ratings, FB.accepted_ratings(answers))
    model = FA.train_als(ratings, seed=seed)
    mse = FA.mean_squared_error(FA.score_known(model, ratings)).first()["mse"]
    spark = ratings.sparkSession
    users = spark.createDataFrame([(int(t),) for t in targets], "userId long")
    return CollaborativeResult(
        ratings=ratings, model=model, mse=mse,
        top_n=FA.top_for_users(model, users, movies, n),
        popular=P.popular_candidates(ratings, movies),
        random=P.random_candidates(ratings, movies, list(targets), seed=seed),
        neighbours=N.neighbour_recommendations(ratings, movies, list(targets), n=n, norm=norm),
        answer_log=log,
    )


def main(argv: Sequence[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="python -m marquee.plans.programs")
    ap.add_argument("program", choices=["content", "collaborative"])
    ap.add_argument("--ratings", required=True)
    ap.add_argument("--movies", required=True)
    ap.add_argument("--format", default="csv", choices=["csv", "parquet"])
    ap.add_argument("--no-header", action="store_true", help="headerless files")
    ap.add_argument("--target", type=int, action="append", default=None,
                    help="target user id (repeatable), collaborative only; default 0")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("marquee").getOrCreate()
    header = not args.no_header
    ratings = read_ratings(spark, args.ratings, header=header, fmt=args.format)
    movies = read_movies(spark, args.movies, header=header, fmt=args.format)
    if args.program == "content":
        # the report is the feature: at most REPORT_USERS lines reach the driver
        for row in content_based(ratings, movies).report.orderBy("userId").collect():
            print(row.line)
        return
    res = collaborative(ratings, movies, args.target or [0])
    print(f"ALS in-sample MSE: {res.mse}")
    # targets x n rows: the size the caller asked for
    for row in res.top_n.orderBy("userId", "rank").collect():
        print(f"user {row.userId} #{row['rank']}: {row.title} ({row.score:.3f})")
    for row in res.neighbours.orderBy("userId", "rank").collect():
        print(f"user {row.userId} neighbour pick #{row['rank']}: {row.title} "
              f"~{row.ratingPredicted:.3f}")


if __name__ == "__main__":
    main()
