"""Column helpers in marquee.functions."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from conftest import rows
from marquee.functions import answers as A
from marquee.functions import vectors as V
from marquee.functions.ranking import seeded_order, top_k


def test_answer_tokens(spark):
    cases = {"5": (5, A.ACCEPTED), "+1": (1, A.ACCEPTED), "6": (6, A.SKIPPED), "0": (0, A.OUT_OF_RANGE),
             "-3": (-3, A.OUT_OF_RANGE), "7": (7, A.OUT_OF_RANGE), " 4": (None, A.NOT_INTEGER),
             "4 ": (None, A.NOT_INTEGER), "4.0": (None, A.NOT_INTEGER), "": (None, A.NOT_INTEGER),
             "2147483648": (None, A.NOT_INTEGER), "2147483647": (2147483647, A.OUT_OF_RANGE),
             "٣": (None, A.NOT_INTEGER), "5\n": (None, A.NOT_INTEGER)}
    df = spark.createDataFrame([(k,) for k in cases], "answer string")
    got = {r.answer: (r.v, r.c) for r in df.select(
        "answer", A.answer_value(F.col("answer")).alias("v"), A.answer_class(F.col("answer")).alias("c")).collect()}
    assert got == cases


def test_seeded_order_is_md5_of_id_and_seed(spark):
    df = spark.createDataFrame([(7,), (12,)], "movieId long")
    got = {r.movieId: r.k for r in df.select("movieId", seeded_order("movieId", 42).alias("k")).collect()}
    assert got == {i: hashlib.md5(f"{i}:42".encode()).hexdigest() for i in (7, 12)}


def test_top_k_numbers_ties_by_the_given_order(spark):
    df = spark.createDataFrame([(1, 5, 3.0), (1, 2, 3.0), (1, 9, 4.0), (1, 1, 1.0), (2, 4, 2.0)],
                               "g int, id int, s double")
    got = rows(top_k(df, ["g"], [F.col("s").desc(), F.col("id").asc()], 3), "g", "rank", "id")
    assert got == [(1, 1, 9), (1, 2, 2), (1, 3, 5), (2, 1, 4)]


def test_mask_and_multi_hot_agree(spark):
    vocab = ["a", "b", "c", "d"]
    df = spark.createDataFrame([("a|c",), ("d|d|b",), ("c",)], "genres string")
    arr = V.genre_list(F.col("genres"))
    out = df.select(V.genre_mask(arr, vocab).alias("m"), V.multi_hot(arr, vocab).alias("g")).collect()
    for r in out:
        assert r.m == sum(1 << i for i, x in enumerate(r.g) if x == 1.0)
    assert [r.m for r in out] == [0b0101, 0b1010, 0b0100]


def test_scaled_cosine_zero_norm(spark):
    df = spark.createDataFrame([(0.0, 0.0, 3.0), (2.0, 2.0, 1.0)], "d double, a double, b double")
    got = [r.s for r in df.select(V.scaled_cosine(F.col("d"), F.col("a"), F.col("b"), 5.0).alias("s")).collect()]
    assert got == [0.0, 5.0]
