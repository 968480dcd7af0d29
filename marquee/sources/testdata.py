"""Adapter: ratings, movies and cold-start answers derived from the driver's
TPC-H-like tables, so every query reads (and scales with) the given data.

* ratings: customer = user, part = movie, one rating per (user, movie): the
  latest line wins (ties: the higher rating); rating = ceil(quantity / 5) / 2,
  i.e. 0.5 .. 5.0 in halves; timestamp = order date as epoch seconds.
* movies: part = movie, title = part name, genres = lower-cased part type plus
  the words of the name, '|'-separated; parts of size <= 2 have no genres.
* answers: every line item is one candidate shown to a cold-start user
  ``-1 - custkey`` (negative, so it never collides with a real customer); the
  candidate order is a hash of the line (a shuffled list), the answer tokens
  come from the quantity and the part key and cover every answer class.

The same definitions are written as DuckDB SQL in ``marquee/plans/oracle.py``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.schema import NO_GENRE_LABEL

# Genre vocabulary of the adapter's movies: the six part types, then the
# sixteen part-name words ("large" and "small" occur in both), 20 names.
ADAPTER_GENRES = (
    "economy", "large", "medium", "promo", "small", "standard",
    "anvil", "blue", "bolt", "cold", "gear", "gizmo", "hot", "new", "old",
    "plate", "red", "ring", "rod", "widget",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    od = table(spark, sf_dir, "orders")
    return li.join(od, li.l_orderkey == od.o_orderkey)


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(userId bigint, movieId bigint, rating double, timestamp bigint)``."""
    x = _lines(spark, sf_dir).select(
        F.col("o_custkey").alias("userId"),
        F.col("l_partkey").alias("movieId"),
        (F.ceil(F.col("l_quantity") / 5) / F.lit(2.0)).alias("rating"),
        F.unix_timestamp("o_orderdate").alias("ts"),
    )
    return x.groupBy("userId", "movieId").agg(
        F.max_by("rating", F.struct("ts", "rating")).alias("rating"),
        F.max("ts").alias("timestamp"),
    )


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(movieId bigint, title string, genres string)``."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("movieId"),
        F.col("p_name").alias("title"),
        F.when(F.col("p_size") <= 2, F.lit(NO_GENRE_LABEL))
        .otherwise(F.concat(F.lower("p_type"), F.lit("|"), F.replace("p_name", F.lit(" "), F.lit("|"))))
        .alias("genres"),
    )


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(userId, candidate_rank, attempt, movieId, answer)`` for cold-start users."""
    base = _lines(spark, sf_dir).select(
        (F.lit(-1) - F.col("o_custkey")).alias("userId"),
        F.conv(F.substring(F.md5(F.concat_ws(
            ":", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            F.col("l_quantity").cast("bigint"), F.unix_timestamp("l_shipdate"))), 1, 15), 16, 10)
        .cast("bigint").alias("candidate_rank"),
        F.col("l_partkey").alias("movieId"),
        (F.col("l_quantity").cast("bigint") % 9).alias("q9"),
        F.col("l_partkey"),
    )
    first = base.select(
        "userId", "candidate_rank", F.lit(1).cast("bigint").alias("attempt"), "movieId",
        F.when(F.col("q9") == 0, F.lit("x"))
        .when(F.col("q9") == 7, F.lit("0"))
        .when(F.col("q9") == 8, F.lit("4.5"))
        .when(F.col("l_partkey") % 13 == 0, F.concat(F.lit(" "), F.col("q9").cast("string")))
        .otherwise(F.col("q9").cast("string")).alias("answer"),
        "q9", "l_partkey",
    )
    # a rejected first answer is followed by a second one ('1'..'7')
    second = first.where((F.col("q9").isin(0, 7, 8)) | (F.col("l_partkey") % 13 == 0)).select(
        "userId", "candidate_rank", F.lit(2).cast("bigint").alias("attempt"), "movieId",
        (F.lit(1) + F.col("l_partkey") % 7).cast("string").alias("answer"),
    )
    return first.drop("q9", "l_partkey").unionByName(second)
