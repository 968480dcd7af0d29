"""Ranking building blocks.

Every ranking ends with an id so ties are deterministic.  ``top_k`` filters
directly on ``row_number`` so Catalyst plans a partial ``WindowGroupLimit``
before the shuffle: a group with a third of all rows is cut to ``k`` rows per
map task before it reaches one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ColumnLike = str | Column


def top_k(df: DataFrame, partition_by: Sequence[ColumnLike], order_by: Sequence[Column], k: int,
          rank_col: str = "rank") -> DataFrame:
    """Keep the first ``k`` rows of each group, numbered 1..k in ``rank_col``."""
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def round6(x: Column) -> Column:
    """Round a non-negative double to 6 places through whole 1e-9 units:
    ``floor((round(x * 1e9) + 500) / 1000) / 1e6``.

    Summation noise in the last bits cannot flip a value that is exactly a
    6-place half (say a mean of halves), and every step is exact or correctly
    rounded, so any SQL engine evaluating the same formula gets the same double.
    """
    units = F.round(x * F.lit(1e9))
    return F.floor((units + F.lit(500)) / F.lit(1000)) / F.lit(1e6)


def seeded_order(col: ColumnLike, seed: int) -> Column:
    """Reproducible pseudo-random sort key: md5 of ``'<id>:<seed>'``.

    The same key is computable in any SQL engine, unlike ``rand(seed)`` whose
    values depend on the partitioning.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.md5(F.concat(c.cast("string"), F.lit(f":{seed}")))


def rank_within(df: DataFrame, key: str, order_col: str, rank_col: str = "pos", *,
                ties: Sequence[str] = (), level_bits: int = 16) -> DataFrame:
    """Dense 1-based position of each row inside its ``key`` group, ordered by
    ``order_col`` (any integers, sparse or dense) and then by ``ties``.

    A plain ``row_number() over (partition by key)`` sends a whole group to one
    task.  Here the 64 bits of ``order_col`` are read ``level_bits`` at a time,
    like the digits of a number: rows are numbered among those that differ in
    the last digit only, and every digit above adds the count of the rows with
    a smaller one.  Each window partition so has at most ``2**level_bits``
    distinct values, whatever the ids look like, and the counts above the first
    level are partial aggregates.
    """
    shifts = [level_bits * (i + 1) for i in range((64 + level_bits - 1) // level_bits - 1)]
    names = [f"_r{i}" for i in range(len(shifts))]
    # a shift keeps the order, also of negative numbers
    x = df.select("*", *[F.shiftright(F.col(order_col).cast("bigint"), s).alias(c) for s, c in zip(shifts, names)])
    offsets = None
    for i in reversed(range(len(names))):  # from the highest digit down
        above = names[i + 1:]
        counts = x.groupBy(key, *names[i:]).agg(F.count(F.lit(1)).alias("_n"))
        w = Window.partitionBy(key, *above).orderBy(names[i]).rowsBetween(Window.unboundedPreceding, -1)
        here = counts.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0).cast("bigint"))).drop("_n")
        if offsets is not None:
            here = here.join(offsets.withColumnRenamed("_off", "_above"), [key, *above]).withColumn(
                "_off", F.col("_off") + F.col("_above")).drop("_above")
        offsets = here
    inside = Window.partitionBy(key, *names).orderBy(order_col, *ties)
    return (x.withColumn("_in", F.row_number().over(inside)).join(offsets, [key, *names])
            .withColumn(rank_col, (F.col("_off") + F.col("_in")).cast("long")).drop("_in", "_off", *names))


def dense_index(ids: DataFrame, col: str, index_col: str) -> DataFrame:
    """``(col, index_col)``: the distinct non-null ids numbered 0, 1, ... in their order, as ``int``."""
    x = ids.select(col).where(F.col(col).isNotNull()).distinct().withColumn("_all", F.lit(0))
    return rank_within(x, "_all", col, index_col).select(col, (F.col(index_col) - 1).cast("int").alias(index_col))
