"""O23 containers: same movies as the relation, in both forms, and their size."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from marquee.operators import content as C
from marquee.operators import seen as S
from marquee.sources import testdata as TD

CATALOGUE = 100_000


@pytest.fixture(scope="module")
def ratings(spark):
    hot = spark.range(CATALOGUE).where("id % 3 = 0").select(F.lit(1).cast("long").alias("userId"), "id")
    few = spark.createDataFrame([(2, i) for i in (-70_000, -32_768, -1, 0, 1, 32_768, 32_769, 65_536, 2**40)] + [(3, 5), (3, 5), (4, None)],
                                "userId long, id long")
    edge = spark.range(1, 1 + S.DENSE).select(F.lit(5).cast("long").alias("userId"), "id").unionByName(
        spark.range(1, S.DENSE).select(F.lit(6).cast("long").alias("userId"), "id"))
    return hot.unionByName(few).unionByName(edge).withColumnRenamed("id", "movieId").persist()


def test_containers_hold_the_relation(spark, ratings):
    c = S.seen_containers(ratings.unionByName(ratings.where("userId < 4")).repartition(5)).persist()
    known = ratings.where("movieId is not null").distinct()
    assert c.agg(F.sum("n_seen")).first()[0] == known.count()
    assert c.where("(positions is null) = (bits is null)").count() == 0
    assert {(r.userId, r.bits is not None) for r in c.where("userId > 4").collect()} == {(5, True), (6, False)}
    assert S.without_seen(known, c).count() == 0  # everything seen is held
    every = spark.range(-40_000, CATALOGUE + 40_000).select(
        F.explode(F.array(*[F.lit(u).cast("long") for u in (1, 2, 3, 5, 99)])).alias("userId"), F.col("id").alias("movieId"), F.lit("x").alias("more"))
    left = S.without_seen(every, c)
    assert left.columns == every.columns
    want = every.join(known, ["userId", "movieId"], "left_anti")
    assert left.count() == want.count() and left.exceptAll(want).count() == 0


def test_sizes(ratings):
    size = {r.userId: (r.bytes, r.relation_bytes) for r in S.container_bytes(S.seen_containers(ratings)).collect()}
    assert all(b <= r for b, r in size.values())
    assert size[1][0] * 5 < size[1][1]  # a third of the catalogue


def test_one_shuffle(ratings):
    from conftest import physical_plan

    df = S.seen_containers(ratings)
    df.collect()
    plan = physical_plan(df).split("Initial Plan")[0]
    fresh = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "Reused" not in x]
    assert len({x.split("hashpartitioning")[1].split(",")[0].split("#")[0] for x in fresh}) == 1 and len(fresh) <= 2


def test_same_rows_as_o23(spark):
    r = TD.ratings(spark, SF_SMALL)
    c = S.seen_containers(r, dense=3)  # most containers are bitmaps
    assert c.where("bits is not null").count() > 0
    pairs = C.seen_items(r)
    assert rows(S.without_seen(pairs, c)) == []
    movies = TD.movies(spark, SF_SMALL).select("movieId").crossJoin(spark.createDataFrame([(0,), (3,), (7,)], "userId long"))
    assert rows(S.without_seen(movies.select("userId", "movieId"), c)) == rows(
        movies.select("userId", "movieId").join(pairs, ["userId", "movieId"], "left_anti"))
