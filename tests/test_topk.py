"""Exact top-n by norm bounds against a full product and against Spark ML's own lists."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, physical_plan
from marquee.functions.ranking import top_k
from marquee.operators import factors as FA
from marquee.operators import topk as K
from marquee.sources import testdata as TD


def _frame(spark, name, vectors, **more):
    rows = [(i * 3 - 5, [float(x) for x in v], *[m[i] for m in more.values()]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, f"{name} long, features array<float>" + "".join(f", {m} long" for m in more))


def _expected(u, v, tops):
    s = (u.astype(np.float32).astype(float) @ v.astype(np.float32).astype(float).T).astype(np.float32)
    ids = np.arange(len(v)) * 3 - 5
    return {(i * 3 - 5, r + 1): (int(ids[c]), float(s[i, c]))
            for i in range(len(u)) for r, c in enumerate(np.lexsort((ids, -s[i]))[:tops[i]])}


def _run(spark, u, v, tops, name):
    users, items = _frame(spark, "user", u, top=tops), _frame(spark, "item", v)
    found = K.best_products(users.repartition(3), items, K.item_blocks(items, name))
    ranked = top_k(found, ["user"], [F.col("score").desc(), F.col("item").asc()], max(tops, default=1))
    want = dict(zip(range(-5, 3 * len(u) - 5, 3), tops))
    return {(r["user"], r["rank"]): (r["item"], r["score"]) for r in ranked.collect() if r["rank"] <= want[r["user"]]}


@pytest.mark.parametrize("case", ["spread", "equal norms", "copies", "negative", "zero users"])
def test_against_the_full_product(spark, monkeypatch, case):
    monkeypatch.setattr(K, "BLOCK_ITEMS", 16)
    rng = np.random.default_rng(len(case))
    u, v = rng.normal(size=(40, 5)), rng.normal(size=(150, 5)) * rng.uniform(0.1, 5, (150, 1))
    if case == "equal norms":
        v /= np.linalg.norm(v, axis=1, keepdims=True)
    if case == "copies":
        v = v[np.arange(150) % 6]
    if case == "negative":
        u, v = np.abs(u), -np.abs(v)
    if case == "zero users":
        u[::2] = 0
    tops = [1 + 7 * i % 160 for i in range(40)]  # some ask for more than a block, some for more than there is
    assert _run(spark, u, v, tops, f"case {case}") == _expected(u, v, tops)


def test_few_blocks_are_scored_where_norms_differ():
    rng = np.random.default_rng(5)
    v = rng.normal(size=(4096, 6)) * np.geomspace(10, 0.01, 4096)[:, None]
    size = np.sort(np.linalg.norm(v, axis=1))[::-1]
    first = v[np.argsort(-np.linalg.norm(v, axis=1))[:64]]
    import pyarrow as pa
    u = rng.normal(size=(50, 6))
    batch = pa.RecordBatch.from_pydict({"user": pa.array(range(50), pa.int64()), "features": pa.array(u.tolist(), pa.list_(pa.float32())),
                                        "top": pa.array([20] * 50, pa.int64())})

    class Context:
        partitionId = staticmethod(lambda: 0)
    K.TaskContext, kept = type("T", (), {"get": staticmethod(lambda: Context)}), K.TaskContext
    try:
        work = list(K._plan(6, first, size[::64], np.arange(64))([batch]))
    finally:
        K.TaskContext = kept
    assert 0 < len(work) < 32  # of 64 blocks


def test_empty_sides(spark):
    none_u, none_i = (spark.createDataFrame([], f"{n} long, features array<float>{t}") for n, t in (("user", ", top long"), ("item", "")))
    users, items = _frame(spark, "user", np.ones((2, 3)), top=[1, 1]), _frame(spark, "item", np.ones((2, 3)))
    assert K.best_products(none_u, items, K.item_blocks(items, "e1")).count() == 0
    assert K.best_products(users, none_i, K.item_blocks(none_i, "e2")).count() == 0


def test_equal_to_spark_ml_for_all_users(spark):
    r, m = TD.ratings(spark, SF_SMALL).persist(), TD.movies(spark, SF_SMALL)
    model = FA.train_als(r)
    mine = FA.top_for_users(model, None, m)
    theirs = model.user_ids.decode(model.model.recommendForAllUsers(20)).select(
        "userId", F.posexplode("recommendations").alias("at", "x")).select("userId", (F.col("at") + 1).alias("rank"), F.col("x.rating").alias("s"))
    both = mine.join(theirs, ["userId", "rank"], "full")
    assert both.where("s is null or score is null or abs(score - s) > 2e-6").count() == 0
    assert both.count() == 20 * model.user_factors().count()
    plan = physical_plan(mine)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_users_are_shuffled_once(monkeypatch):
    """A pack of users was sent to every block that it needed; now each user is in one packed row."""
    import pyarrow as pa
    rng = np.random.default_rng(5)
    v, u = rng.normal(size=(512, 6)), rng.normal(size=(700, 6))
    v /= np.linalg.norm(v, axis=1, keepdims=True)  # equal norms: every block is needed
    batch = pa.RecordBatch.from_pydict({"user": pa.array(range(700), pa.int64()), "features": pa.array(u.tolist(), pa.list_(pa.float32())),
                                        "top": pa.array([20] * 700, pa.int64())})

    class Context:
        partitionId = staticmethod(lambda: 0)
    monkeypatch.setattr(K, "TaskContext", type("T", (), {"get": staticmethod(lambda: Context)}))
    work = list(K._plan(6, v[:64], np.ones(8), np.arange(8))([batch]))
    names = "users" if "users" in work[0].schema.names else "ids"
    assert sum(len(b.column(names)[0].as_py()) for b in work) == 700 * 8


def test_users_drop_out_where_norms_fall():
    rng = np.random.default_rng(5)
    v = rng.normal(size=(4096, 6)) * np.geomspace(10, 0.01, 4096)[:, None]
    v = v[np.argsort(-np.linalg.norm(v, axis=1))]
    s = K.Slice(np.arange(50), rng.normal(size=(50, 6)), np.full(50, 20), np.full(50, -np.inf))
    for at in range(0, 4096, 64):
        if not s.take(np.arange(at, at + 64), v[at:at + 64], float(np.linalg.norm(v[at]))):
            break
    assert 0 < s.scored < 32  # of 64 blocks


def test_blocks_go_only_to_groups_that_need_them(spark, monkeypatch):
    """Every block went to as many groups as a shuffle has partitions."""
    def received(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_pydict({"user": pa.array([b.num_rows - b.column(1).null_count], pa.int64()),
                                              "item": pa.array([0], pa.int64()), "score": pa.array([0.0], pa.float32())})
    monkeypatch.setattr(K, "_search", received)
    rng = np.random.default_rng(5)
    v = rng.normal(size=(8192, 6))
    v *= (np.geomspace(10, 0.01, 8192) / np.linalg.norm(v, axis=1))[:, None]
    u = rng.normal(size=(50, 6))
    users, items = _frame(spark, "user", u, top=[5] * 50), _frame(spark, "item", v)
    blocks = K.item_blocks(items, "falling norms")
    assert blocks.count() >= 8
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "97")
    try:
        found = K.best_products(users, items, blocks)
        assert found.rdd.getNumPartitions() < 97 or spark.sparkContext.defaultParallelism >= 97
        sent = found.agg(F.sum("user")).first()[0]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    packs = -(-50 // K.PACK_USERS) * users.rdd.getNumPartitions()
    assert 0 < sent <= packs * 4  # a group without a pack gets none, the others no block that none of its users needs
