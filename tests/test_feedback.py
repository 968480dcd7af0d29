"""Answer validation rules and appending."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from marquee.functions import answers as A
from marquee.operators import feedback as FB
from marquee.sources import testdata as TD

SCHEMA = "userId long, candidate_rank long, attempt long, movieId long, answer string"


def test_fixture_answers(spark):
    # (candidate_rank, attempt, answer) from FIXTURES.md section 4
    data = [(1, 1, "x"), (1, 2, "4"), (2, 1, "6"), (3, 1, "0"), (3, 2, "5"),
            (4, 1, "4.5"), (4, 2, "7"), (4, 3, "1")]
    ans = spark.createDataFrame([(-1, r, a, 10 * r, s) for r, a, s in data], SCHEMA)
    assert rows(FB.accepted_ratings(ans)) == [(-1, 10, 4.0), (-1, 30, 5.0), (-1, 40, 1.0)]
    log = {(x.candidate_rank, x.attempt): x.status for x in FB.answer_log(ans).collect()}
    assert log[(2, 1)] == A.SKIPPED
    assert log[(1, 1)] == A.NOT_INTEGER and log[(4, 1)] == A.NOT_INTEGER
    assert log[(3, 1)] == A.OUT_OF_RANGE and log[(4, 2)] == A.OUT_OF_RANGE
    assert FB.answer_log(ans).count() == len(data)  # nothing dropped


def test_blanks_signs_and_overflow(spark):
    data = [(1, 1, " 3"), (1, 2, "+3"), (2, 1, "99999999999"), (2, 2, "-2"), (2, 3, "2 "), (2, 4, "2")]
    ans = spark.createDataFrame([(-1, r, a, r, s) for r, a, s in data], SCHEMA)
    log = {(x.candidate_rank, x.attempt): x.status for x in FB.answer_log(ans).collect()}
    assert log[(1, 1)] == A.NOT_INTEGER        # a blank is not accepted
    assert log[(1, 2)] == A.ACCEPTED           # a sign is
    assert log[(2, 1)] == A.NOT_INTEGER        # does not fit an int
    assert log[(2, 2)] == A.OUT_OF_RANGE
    assert log[(2, 3)] == A.NOT_INTEGER
    assert log[(2, 4)] == A.ACCEPTED


def test_stop_after_twenty_accepted(spark):
    data = [(-7, r, 1, 100 + r, "3") for r in range(1, 26)]
    data += [(-7, 3, 2, 103, "5")]            # a later attempt after the decision
    ans = spark.createDataFrame(data, SCHEMA)
    acc = FB.accepted_ratings(ans)
    assert acc.count() == 20
    assert rows(acc.agg(F.max("movieId"))) == [(120,)]
    st = dict(rows(FB.answer_log(ans).groupBy("status").count()))
    assert st == {A.ACCEPTED: 20, A.AFTER_LIMIT: 5, A.AFTER_DECISION: 1}


def test_fewer_than_twenty_is_fine(spark):
    ans = spark.createDataFrame([(-2, 1, 1, 5, "6"), (-2, 2, 1, 6, "2")], SCHEMA)
    assert rows(FB.accepted_ratings(ans)) == [(-2, 6, 2.0)]


def test_append_is_bag_union(spark):
    r = TD.ratings(spark, SF_SMALL)
    new = FB.accepted_ratings(TD.answers(spark, SF_SMALL))
    out = FB.append_ratings(r, new)
    assert out.count() == r.count() + new.count()
    assert out.where(F.col("timestamp").isNull()).count() == new.count()
    assert FB.append_ratings(r, r).count() == 2 * r.count()  # no de-duplication


def test_answers_cover_every_class(spark):
    st = {x.status for x in FB.answer_log(TD.answers(spark, SF_SMALL)).select("status").distinct().collect()}
    assert {A.ACCEPTED, A.SKIPPED, A.NOT_INTEGER, A.OUT_OF_RANGE} <= st
