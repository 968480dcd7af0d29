"""Validating cold-start answers and appending ratings.

The original asked on the console, one movie after the other.  Here the
answers are a table ``(userId, candidate_rank, attempt, movieId, answer)``
and the same rules run as one job for any number of users:

* per candidate, the first attempt whose answer is an integer in 1..6 decides:
  6 skips the movie, 1..5 rates it; earlier attempts are rejected (not an
  integer / out of range), later ones were never needed;
* candidates are walked by ``candidate_rank``; after the ``max_accepted``-th
  rating nothing more is read;
* fewer accepted answers than ``max_accepted`` is fine: what was accepted is
  returned.

``answer_log`` keeps every input row with its status, so nothing is dropped
silently; ``accepted_ratings`` is the rating table for the new users.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions import answers as A
from marquee.functions.ranking import top_k
from marquee.schema import MAX_ACCEPTED


def _decisions(a: DataFrame) -> DataFrame:
    """The deciding answer of each candidate: the first (attempt, answer) whose
    class is accepted or skipped (one partial aggregate per candidate)."""
    d = (a.where(F.col("cls").isin(A.ACCEPTED, A.SKIPPED))
         .groupBy("userId", "candidate_rank")
         .agg(F.min(F.struct("attempt", "answer", "cls", "value", "movieId")).alias("d")))
    return d.select("userId", "candidate_rank",
                    F.col("d.attempt").alias("decision_attempt"), F.col("d.answer").alias("decision_answer"),
                    F.col("d.cls").alias("decision"), F.col("d.value").alias("dvalue"),
                    F.col("d.movieId").alias("dmovie"))


def _classified(answers: DataFrame) -> DataFrame:
    return answers.select("userId", "candidate_rank", "attempt", "movieId", "answer",
                          A.answer_value(F.col("answer")).alias("value"),
                          A.answer_class(F.col("answer")).alias("cls"))


def _first_accepted(decided: DataFrame, max_accepted: int) -> DataFrame:
    """The first ``max_accepted`` accepted candidates per user (partial top-k)."""
    return top_k(decided.where(F.col("decision") == A.ACCEPTED), ["userId"],
                 [F.col("candidate_rank").asc()], max_accepted, rank_col="_n")


def answer_log(answers: DataFrame, max_accepted: int = MAX_ACCEPTED) -> DataFrame:
    """Every answer row plus ``value`` (int or null) and ``status``."""
    a = _classified(answers)
    decided = _decisions(a)
    # rank of the last candidate read: the max_accepted-th acceptance
    cutoff = (_first_accepted(decided, max_accepted).groupBy("userId")
              .agg(F.max("candidate_rank").alias("last_rank"), F.count(F.lit(1)).alias("n_acc"))
              .where(F.col("n_acc") >= max_accepted).select("userId", "last_rank"))
    x = (a.join(decided, ["userId", "candidate_rank"], "left")
         .join(cutoff, "userId", "left"))
    later = (F.col("attempt") > F.col("decision_attempt")) | (
        (F.col("attempt") == F.col("decision_attempt")) & ~F.col("answer").eqNullSafe(F.col("decision_answer")))
    status = (F.when(F.col("last_rank").isNotNull() & (F.col("candidate_rank") > F.col("last_rank")),
                     F.lit(A.AFTER_LIMIT))
              .when(F.col("decision_attempt").isNotNull() & later, F.lit(A.AFTER_DECISION))
              .otherwise(F.col("cls")))
    return x.select("userId", "candidate_rank", "attempt", "movieId", "answer", "value",
                    status.alias("status"))


def accepted_ratings(answers: DataFrame, max_accepted: int = MAX_ACCEPTED,
                     keep_rank: bool = False) -> DataFrame:
    """``(userId, movieId, rating)``, one row per accepted candidate
    (``keep_rank`` adds ``candidate_rank``: a movie can be offered twice)."""
    first = _first_accepted(_decisions(_classified(answers)), max_accepted)
    cols = ["userId"] + (["candidate_rank"] if keep_rank else [])
    return first.select(*cols, F.col("dmovie").alias("movieId"),
                        F.col("dvalue").cast("double").alias("rating"))


def append_ratings(ratings: DataFrame, new: DataFrame) -> DataFrame:
    """Bag union by column name; missing columns (e.g. timestamp) are null."""
    return ratings.unionByName(new, allowMissingColumns=True)
