"""The append-only rating store: whole appends, conflicts, placement."""

import pytest
from conftest import physical_plan, rows
from pyspark.sql import functions as F

from marquee.operators import content, popularity
from marquee.sources.rating_store import RatingStore

SCHEMA = "userId bigint, movieId bigint, rating double, timestamp bigint"
A = [(1, 10, 4.0, 5), (1, 10, 4.0, 5), (2, 11, 3.0, 6), (None, 10, 1.0, 7)]
B = [(1, 12, 5.0), (3, 10, 2.0)]


def key(t):
    return tuple((x is None, x or 0) for x in t)


def both(store, version=None):
    got = [sorted((tuple(r) for r in store.read(k, version).collect()), key=key) for k in ("userId", "movieId")]
    assert got[0] == got[1]
    return got[0]


@pytest.fixture
def store(spark, tmp_path):
    return RatingStore(spark, f"file:{tmp_path}/store", spark.createDataFrame([], SCHEMA).schema, buckets=4)


def test_appends_are_whole(spark, store):
    assert store.version() == 0 and both(store) == []
    assert store.append(spark.createDataFrame(A, SCHEMA)) == 1
    first = sorted(A, key=key)
    assert both(store) == first
    new = spark.createDataFrame(B, "userId bigint, movieId bigint, rating double").withColumn("other", F.lit(1))
    staged = store.stage(new)  # a crash here leaves files that no manifest names
    assert both(store) == first
    assert store.publish(staged) == 2
    both_rows = sorted(A + [(*b, None) for b in B], key=key)
    assert both(store) == both_rows and both(store, 1) == first
    assert store.append(spark.createDataFrame([], SCHEMA)) == 3 and both(store) == both_rows
    again = RatingStore(spark, store.root, store.schema, buckets=4)
    for name in again.appends():  # another session knows no tables
        for k in ("userid", "movieid"):
            spark.sql(f"DROP TABLE ratings_{name}_{k}")
    assert both(again) == both_rows
    assert again.compact() == 4 and len(again.appends()) == 1 and both(again) == both_rows and both(again, 1) == first


def test_publishing_at_the_same_time(spark, store):
    one, two = store.stage(spark.createDataFrame(A, SCHEMA)), store.stage(spark.createDataFrame(A, SCHEMA))
    assert store._publish(1, [one]) and not store._publish(1, [two])  # the number is taken
    assert store.publish(two) == 2 and store.appends() == [one, two]


def test_no_shuffle_of_the_ratings(spark, store):
    store.append(spark.range(4000).selectExpr("id % 97 userId", "id % 53 movieId", "double(id % 5) rating", "id timestamp"))
    seen = content.seen_items(store.read("userId"))
    assert len(seen.collect()) == 4000
    assert "Exchange" not in physical_plan(seen)
    popular = popularity.popularity(store.read("movieId"), spark.range(53).selectExpr("id movieId", "string(id) title"))
    by_movie = store.read("movieId").groupBy("movieId").agg(F.count(F.lit(1)).alias("n"))
    by_movie.collect()
    assert "Exchange" not in physical_plan(by_movie)
    assert popular.count() == 53 and rows(by_movie)[0] == (0, 76)
