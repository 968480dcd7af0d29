"""End-to-end programs over MovieLens-style CSV files."""

from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from marquee.plans import programs as PR
from marquee.sources.files import read_movies, read_ratings

MOVIES = """movieId,title,genres
1,m1,Action|Comedy
2,m2,Drama
3,m3,Action
4,m4,Action
5,m5,Action|Comedy|Drama
6,m6,Drama
7,m7,(no genres listed)
8,"Movie, The (1999)",Comedy
"""
RATINGS = """userId,movieId,rating,timestamp
100,1,4.0,30
100,2,3.0,20
100,3,2.5,10
200,1,5.0,5
200,8,4.5,6
200,5,1.0,7
300,2,3.5,1
300,8,4.0,2
300,6,2.0,3
"""


@pytest.fixture(scope="module")
def files():
    d = tempfile.mkdtemp(prefix="marquee-prog-")
    paths = {}
    for name, text in (("movies.csv", MOVIES), ("ratings.csv", RATINGS)):
        paths[name] = os.path.join(d, name)
        with open(paths[name], "w") as f:
            f.write(text)
    return paths


def test_content_program(spark, files):
    r = read_ratings(spark, files["ratings.csv"], header=True)
    m = read_movies(spark, files["movies.csv"])
    res = PR.content_based(r, m, vocabulary=["Action", "Comedy", "Drama"])
    lines = {x.userId: x.line for x in res.report.collect()}
    assert set(lines) == {100, 200, 300}
    assert lines[100].startswith("utente: 100 -> \t1)'m5' score: 4.959183/5;")
    assert res.recommendations.where(F.col("userId") == 200).count() == 4  # 4 unseen genre movies


def test_collaborative_program(spark, files, capsys):
    r = read_ratings(spark, files["ratings.csv"], header=True)
    m = read_movies(spark, files["movies.csv"])
    answers = spark.createDataFrame([(-1, 1, 1, 2, "5"), (-1, 2, 1, 6, "x"), (-1, 2, 2, 6, "4")],
                                    "userId long, candidate_rank long, attempt long, movieId long, answer string")
    res = PR.collaborative(r, m, [100], answers=answers, n=3)
    assert res.ratings.count() == 11
    assert res.mse >= 0.0
    assert res.top_n.count() == 3
    assert res.popular.count() == 6  # rated catalogue movies
    assert res.neighbours.count() > 0
    assert res.answer_log.where("status = 'rejected_not_integer'").count() == 1


def test_command_line(spark, files, capsys):
    PR.main(["content", "--ratings", files["ratings.csv"], "--movies", files["movies.csv"]])
    out = capsys.readouterr().out.splitlines()
    assert [x.split(" -> ")[0] for x in out] == ["utente: 100", "utente: 200", "utente: 300"]
    assert out[0].startswith("utente: 100 -> \t1)'m5' score: 4.959183/5;")
