"""O1-O2 readers and the testdata adapter."""

from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from marquee.sources import files as S
from marquee.sources import testdata as TD


def _write(text: str, name: str) -> str:
    d = tempfile.mkdtemp(prefix="marquee-src-")
    p = os.path.join(d, name)
    with open(p, "w") as f:
        f.write(text)
    return p


def test_headerless_ratings_ignore_extra_fields(spark):
    p = _write("1,10,4.5,964982703,extra\n2,20,3\n\n", "r.csv")
    got = rows(S.read_ratings(spark, p))
    assert got == [(1, 10, 4.5, 964982703), (2, 20, 3.0, None)]


def test_headerless_ratings_fail_on_bad_number(spark):
    p = _write("1,abc,4.5\n", "bad.csv")
    with pytest.raises(Exception):
        S.read_ratings(spark, p).collect()


def test_header_ratings_and_quoted_titles(spark):
    rp = _write("userId,movieId,rating,timestamp\n1,11,4.0,10\n", "ratings.csv")
    mp = _write('movieId,title,genres\n11,"American President, The (1995)",Comedy|Drama|Romance\n',
                "movies.csv")
    assert rows(S.read_ratings(spark, rp, header=True)) == [(1, 11, 4.0, 10)]
    assert rows(S.read_movies(spark, mp)) == [(11, "American President, The (1995)", "Comedy|Drama|Romance")]


def test_parquet_reader_projects_schema(spark):
    d = tempfile.mkdtemp(prefix="marquee-pq-")
    spark.createDataFrame([(1, 2, 3.5)], "userId long, movieId long, rating double").write.parquet(d + "/r")
    df = S.read_ratings(spark, d + "/r", fmt="parquet")
    assert df.columns == ["userId", "movieId", "rating", "timestamp"] and rows(df) == [(1, 2, 3.5, None)]


def test_unique_movie_ids_checked(spark):
    m = spark.createDataFrame([(1, "a", "x"), (1, "b", "y")], "movieId int, title string, genres string")
    with pytest.raises(ValueError, match="not unique"):
        S.assert_unique(m)
    S.assert_unique(TD.movies(spark, SF_SMALL))
    mp = _write("movieId,title,genres\n1,a,x\n1,b,y\n", "dup.csv")
    with pytest.raises(ValueError, match="not unique"):
        S.read_movies(spark, mp)
    assert S.read_movies(spark, mp, check_unique=False).count() == 2


def test_adapter_shapes(spark):
    r = TD.ratings(spark, SF_SMALL)
    assert r.groupBy("userId", "movieId").count().where("count > 1").count() == 0
    lo, hi = r.agg(F.min("rating"), F.max("rating")).first()
    assert 0.5 <= lo and hi <= 5.0
    assert r.where((F.col("rating") * 2) != F.floor(F.col("rating") * 2)).count() == 0
    a = TD.answers(spark, SF_SMALL)
    assert a.groupBy("userId", "candidate_rank", "attempt").count().where("count > 1").count() == 0
    assert a.where("userId >= 0").count() == 0


def test_header_columns_are_found_by_name(spark):
    p = _write("movieId,userId,rating,timestamp\n1,2,4.0,10\n", "order.csv")
    assert rows(S.read_ratings(spark, p, header=True)) == [(2, 1, 4.0, 10)]
    p = _write("extra,rating,userId,movieId,timestamp\nx,4.5,1,2,3\n", "extra.csv")
    assert rows(S.read_ratings(spark, p, header=True)) == [(1, 2, 4.5, 3)]
    p = _write("userId,movieId,rating\n1,2,3\n", "short.csv")
    assert rows(S.read_ratings(spark, p, header=True)) == [(1, 2, 3.0, None)]
    p = _write("userId,rating\n1,2\n", "missing.csv")
    with pytest.raises(ValueError, match="movieId"):
        S.read_ratings(spark, p, header=True)
    p = _write('genres,movieId,title,year\nDrama,4,"A, B",1999\n', "movies.csv")
    assert rows(S.read_movies(spark, p)) == [(4, "A, B", "Drama")]


def test_files_with_different_headers_fail(spark):
    a = _write("userId,movieId,rating\n1,2,3\n", "a.csv")
    b = _write("movieId,userId,rating\n1,2,3\n", "b.csv")
    with pytest.raises(Exception):
        S.read_ratings(spark, [a, b], header=True).collect()


@pytest.mark.parametrize("line,want", [("7,Title", (7, "Title", None)), ("7,Title,Drama,x,y", (7, "Title", "Drama")),
                                       ('7,"A, B",Drama', (7, "A, B", "Drama"))])
def test_headerless_movies_of_any_width(spark, line, want):
    p = _write(line + "\n", "m.csv")
    assert rows(S.read_movies(spark, p, header=False)) == [want]


@pytest.mark.parametrize("header,text", [(False, " 1,2,3.0\n"), (False, "1,2,x\n"), (False, "1,2\n"), (True, "userId,movieId,rating\nx,2,3\n"),
                                         (True, "userId,movieId,rating\n1,2,\n"), (True, "userId,movieId,rating,timestamp\n1,2,3,soon\n")])
def test_numbers_must_be_numbers(spark, header, text):
    p = _write(text, "bad.csv")
    with pytest.raises(Exception):
        S.read_ratings(spark, p, header=header).collect()


def test_movie_ids_must_be_numbers(spark):
    with pytest.raises(Exception):
        S.read_movies(spark, _write("x,Title\n", "m.csv"), header=False, check_unique=False).collect()


def test_materialize_knows_the_plan_not_only_the_name(spark):
    from marquee.sources.tables import materialize, release
    a, b = spark.range(3), spark.range(99)
    assert materialize(a, "clash").count() == 3 and materialize(b, "clash").count() == 99
    assert materialize(spark.range(3), "clash").count() == 3
    assert release(spark, "clash") == 2 and release(spark, "clash") == 0


def test_materialize_raises_what_the_write_raises(spark, monkeypatch, tmp_path):
    from marquee.sources import tables
    monkeypatch.setattr(tables, "shared_folder", lambda s: str(tmp_path))
    bad = spark.range(1).select(F.raise_error(F.lit("broken input")).cast("int").alias("x"))
    with pytest.raises(Exception, match="broken input"):
        tables.materialize(bad, "bad")
    good = tables.materialize(spark.range(5), "good")
    assert good.count() == 5 and list((tmp_path / "marquee-tables").rglob("*.parquet"))
    tables.release(spark, "good")
    assert not list((tmp_path / "marquee-tables").rglob("*.parquet"))


def test_a_stored_table_leaves_no_shuffle_files(spark, tmp_path):
    """Shuffle files of a finished write stayed until the driver collected garbage, beside those of later steps."""
    from marquee.sources.tables import CLEANUP_CONF, materialize, release
    shuffles = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    set_before = spark.conf.get(CLEANUP_CONF, None)

    def files():
        blocks = shuffles.getAllBlocks()
        return {b for b in (blocks.apply(i).name() for i in range(blocks.size())) if b.startswith("shuffle_")}
    before = files()
    table = materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "no shuffle files")
    assert not files() - before
    assert table.count() == 7 and spark.conf.get(CLEANUP_CONF, None) == set_before
    release(spark, "no shuffle files")
