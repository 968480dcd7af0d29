"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import stored

ROUNDS = 64


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)``; the root is the component's smallest node.

    Alternating large-star and small-star steps: every step is a minimum by
    node and a join on the node, and halves the depth of the trees, so the
    number of rounds grows with the logarithm of the longest path.  Each round
    is written to the shared folder; only counts reach the driver.
    """
    e = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "edges")
    last = None
    for _ in range(ROUNDS):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        # large star: greater neighbours move to the smallest of the neighbourhood
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
        # small star: the node and its smaller neighbours move to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        near = large.join(low, "a")
        small = near.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("a", F.col("m").alias("b"))).distinct()
        e = stored(small, "edges")
        now = e.agg(F.count("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"no fixed point after {ROUNDS} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
