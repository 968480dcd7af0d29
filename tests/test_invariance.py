"""Results do not depend on the input partitioning or the shuffle width."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from marquee.operators import content as C
from marquee.operators import feedback as FB
from marquee.operators import neighbours as N
from marquee.operators import popularity as P
from marquee.sources import testdata as TD


def _all(r, m, a):
    return {
        "popular": rows(P.popular_candidates(r, m, n=30).select("rank", "movieId")),
        "random": rows(P.random_candidates(r, m, 0, n=30).select("rank", "movieId")),
        "cosine": rows(N.cosine_similarity(r, 0).select("userId2", F.round("cosineSim", 9))),
        "neighbour": rows(N.neighbour_recommendations(r, m, 0).select("rank", "movieId", "rating")),
        "content": rows(C.content_recommendations(r, m, vocabulary=TD.ADAPTER_GENRES)
                        .select("userId", "rank", "movieId")),
        "answers": rows(FB.answer_log(a).select("userId", "candidate_rank", "attempt", "status")),
    }


@pytest.mark.parametrize("width,parts", [(3, 7), (17, 2)])
def test_same_results_under_other_partitioning(spark, width, parts):
    r = TD.ratings(spark, SF_SMALL)
    m = TD.movies(spark, SF_SMALL)
    a = TD.answers(spark, SF_SMALL)
    base = _all(r, m, a)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(width))
    try:
        other = _all(r.repartition(parts), m.repartition(parts), a.repartition(parts))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert other == base


LARGE_DATA_PLANS = {
    # no automatic broadcasts: the sort-merge joins a cluster would run
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    # make AQE split "skewed" partitions even at this size
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_same_results_with_sort_merge_joins_and_skew_splits(spark):
    r = TD.ratings(spark, SF_SMALL)
    m = TD.movies(spark, SF_SMALL)
    a = TD.answers(spark, SF_SMALL)
    base = _all(r, m, a)
    old = {k: spark.conf.get(k, None) for k in LARGE_DATA_PLANS}
    for k, v in LARGE_DATA_PLANS.items():
        spark.conf.set(k, v)
    try:
        other = _all(r, m, a)
        probe = N.neighbour_recommendations(r, m, 0)
        probe.collect()
        plan = probe._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert other == base
    assert "SortMergeJoin(skew=true)" in plan  # AQE really split a hot partition
