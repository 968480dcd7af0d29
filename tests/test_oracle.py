"""Every registered plan against its DuckDB twin at sf0.01 (the driver's gate),
plus plan-shape checks at sf0.001."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from conftest import SF_ORACLE, SF_SMALL, physical_plan
from oracle_check import compare, duck

#: The inventory's plans; the training-data queries have their own tests.
QUERIES = {n: f for n, f in E.queries().items() if n[0] == "o" and n[1:3].isdigit()}
ORACLE = {n: s for n, s in E.oracle_sql().items() if n in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_query_is_registered_with_inventory_id():
    ids = {name[:3] for name in QUERIES}
    assert ids == {f"o{i:02d}" for i in range(1, 28)}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF_ORACLE).toPandas()
    exp = con.execute(ORACLE[name]).df()
    ok, msg = compare(got, exp)
    assert ok, msg


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_non_sql_queries_run(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["userId", "rank", "movieId", "title", "score"]
    assert df.count() > 0


BAD = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shapes(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    plan = physical_plan(df)
    for bad in BAD:
        assert bad not in plan, f"{name}: {bad}"


@pytest.mark.parametrize("name", ["o06_unseen_movies", "o15_co_rated", "o16_user_cosine"])
def test_target_filter_reaches_the_scan(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    df.collect()
    plan = physical_plan(df)
    assert "EqualTo(userId,0)" in plan, "target filter not pushed into the Parquet scan"


def test_projection_is_pruned_at_the_scan(spark):
    df = QUERIES["o04_popularity"](spark, SF_SMALL)
    df.collect()
    plan = physical_plan(df)
    # ratings scan reads only the two columns the aggregate needs
    assert "ReadSchema: struct<movieId:bigint,rating:double>" in plan


_DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_types_match_oracle(spark, con, name):
    got = {f.name: _DUCK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
           for f in QUERIES[name](spark, SF_ORACLE).schema.fields}
    rel = con.sql(ORACLE[name])
    assert got == dict(zip(rel.columns, [str(t) for t in rel.types]))
