"""O23 as containers: a user's seen movies by id range, sorted positions while few and a bitmap once many.

A container covers the 32,768 ids of one of Spark's bitmap buckets (``bitmap_bucket_number``,
``bitmap_bit_position``).  With up to ``DENSE`` - 1 ids it keeps their positions, sorted, 2 bytes each;
from ``DENSE`` ids on, where that would exceed a bitmap's 4,096 bytes, it keeps the bitmap.  So a
container is never larger than the rows of the relation that it stands for (16 bytes each), and no row grows
beyond 4 KB however many movies a user has seen.  Both forms come from one shuffle by
(user, bucket), whose groups have at most 32,768 different positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: From so many ids on a bitmap is smaller than the list of positions.
DENSE = 2048
BUCKET, POSITION = "_bucket", "_position"


def _bucket(movie: str) -> Column:
    return F.bitmap_bucket_number(F.col(movie)).cast("int")


def _position(movie: str) -> Column:
    return F.bitmap_bit_position(F.col(movie)).cast("smallint")


def seen_containers(ratings: DataFrame, dense: int = DENSE) -> DataFrame:
    """``(userId, bucket, n_seen, positions, bits)``: one of ``positions`` (sorted) and ``bits`` is null."""
    x = ratings.select("userId", _bucket("movieId").alias("bucket"), _position("movieId").alias("p")).where(
        F.col("userId").isNotNull() & F.col("bucket").isNotNull())
    sets = x.groupBy("userId", "bucket").agg(F.collect_set("p").alias("ps")).withColumn("n_seen", F.size("ps"))
    few = sets.where(F.col("n_seen") < dense).select(
        "userId", "bucket", "n_seen", F.sort_array("ps").alias("positions"), F.lit(None).cast("binary").alias("bits"))
    # grouped by the same columns again: no second shuffle
    many = sets.where(F.col("n_seen") >= dense).select("userId", "bucket", F.explode("ps").alias("p")).groupBy("userId", "bucket").agg(
        F.count(F.lit(1)).cast("int").alias("n_seen"), F.lit(None).cast("array<smallint>").alias("positions"),
        F.bitmap_construct_agg(F.col("p").cast("long")).alias("bits"))
    return few.unionByName(many)


def holds(position: Column, positions: Column, bits: Column) -> Column:
    """Whether a container holds a position (false without a container)."""
    p = position.cast("int")
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(p, 3) + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("getbit", byte, p.bitwiseAND(F.lit(7))) == 1
    return F.coalesce(F.array_contains(positions, position), bit, F.lit(False))


def without_seen(candidates: DataFrame, containers: DataFrame) -> DataFrame:
    """The rows of ``candidates (userId, movieId, ...)`` whose movie the user has not seen."""
    x = candidates.withColumns({BUCKET: _bucket("movieId"), POSITION: _position("movieId")})
    c = containers.select(F.col("userId"), F.col("bucket").alias(BUCKET), F.col("positions").alias("_ps"), F.col("bits").alias("_bits"))
    x = x.join(c, ["userId", BUCKET], "left").where(~holds(F.col(POSITION), F.col("_ps"), F.col("_bits")))
    return x.select(*candidates.columns)


def container_bytes(containers: DataFrame) -> DataFrame:
    """``(userId, bytes, relation_bytes)``: what a user's containers take, and the rows they stand for (two longs each)."""
    own = F.lit(8 + 4) + F.coalesce(2 * F.size("positions"), F.octet_length("bits"))
    return containers.groupBy("userId").agg(F.sum(own).alias("bytes"), F.sum(F.col("n_seen") * 16).alias("relation_bytes"))
