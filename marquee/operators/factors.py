"""Latent-factor model (Spark ML ALS), scoring and evaluation.

Spark ML's ALS takes 32-bit ids only.  Ids whose range fits are shifted to begin at
0 (``Numbering``); wider ones are numbered densely by a distributed count over the
distinct ids.  Either way ids of any integral type and size go in and come back unchanged.

With the seed, a refit on the same ratings gives the same factors up to the
order in which Spark sums floating-point numbers, whatever the partitioning of
the input (tested within a tolerance), so no shuffle is spent on ordering it.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from marquee.functions.ranking import dense_index, top_k
from marquee.functions.targets import restrict_to
from marquee.operators.feedback import append_ratings
from marquee.operators.popularity import attach_titles
from marquee.operators.seen import seen_containers, without_seen
from marquee.operators.topk import best_products, item_blocks
from marquee.schema import ALS_MAX_ITER, ALS_RANK, ALS_REG_PARAM, DEFAULT_SEED, N_RECOMMENDATIONS
from marquee.session import CHECKPOINT_CONF, checkpoint_dir
from marquee.sources.tables import materialize

USER, ITEM = "_user", "_item"

#: Ratings that a factor block has on average at most: Spark ML builds and solves a block in one task, whole.
BLOCK_RATINGS = 2_000_000


@dataclass
class Numbering:
    """32-bit numbers for the ids of one column: ``id - first``, or those of ``table (col, index)``."""

    col: str
    index: str
    kind: DataType
    first: int | None = None
    table: DataFrame | None = None

    @classmethod
    def of(cls, ids: DataFrame, *names: tuple[str, str]) -> list["Numbering"]:
        """One numbering for each ``(col, index)``."""
        ends = ids.agg(*[f(c) for c, _ in names for f in (F.min, F.max)]).first()
        out = []
        for i, (col, index) in enumerate(names):
            low, high, kind = ends[2 * i], ends[2 * i + 1], ids.schema[col].dataType
            if low is None or high - low < 1 << 31:
                out.append(cls(col, index, kind, first=low or 0))
            else:
                distinct = materialize(ids.select(col).distinct(), f"als-{col}-ids")
                out.append(cls(col, index, kind, table=materialize(dense_index(distinct, col, index), f"als-{col}-numbers")))
        return out

    def encode(self, df: DataFrame) -> DataFrame:
        """``df`` with the number of each id; rows with a null id (or one that is not in the table) drop out."""
        if self.table is not None:
            return df.join(self.table, self.col)
        return df.where(F.col(self.col).isNotNull()).withColumn(
            self.index, (F.col(self.col).cast("long") - F.lit(self.first).cast("long")).cast("int"))

    def decode(self, df: DataFrame) -> DataFrame:
        """``df`` with the id of each number."""
        if self.table is not None:
            return df.join(self.table, self.index)
        return df.withColumn(self.col, (F.col(self.index).cast("long") + F.lit(self.first).cast("long")).cast(self.kind))


@dataclass
class Als:
    """A fitted model with the numberings of its users and movies.

    What scoring needs is stored once for a model: the factors by real id and the
    item blocks (``sources.tables.materialize``; ``release`` frees them).
    """

    model: ALSModel
    user_ids: Numbering
    item_ids: Numbering
    _kept: dict[str, DataFrame] = field(default_factory=dict)
    _name: str = field(default_factory=lambda: f"als-{uuid.uuid4().hex[:8]}")

    def _keep(self, name: str, build) -> DataFrame:
        if name not in self._kept:
            self._kept[name] = materialize(build(), f"{self._name}-{name}")
        return self._kept[name]

    def user_factors(self) -> DataFrame:
        """``(userId, features)``."""
        return self._keep("users", lambda: self.user_ids.decode(
            self.model.userFactors.withColumnRenamed("id", USER)).select("userId", "features"))

    def item_factors(self) -> DataFrame:
        """``(movieId, features)``."""
        return self._keep("items", lambda: self.item_ids.decode(
            self.model.itemFactors.withColumnRenamed("id", ITEM)).select("movieId", "features"))

    def item_blocks(self) -> DataFrame:
        """The item factors as packed blocks by norm."""
        if "blocks" not in self._kept:
            self._kept["blocks"] = item_blocks(self.item_factors().withColumnRenamed("movieId", "item"), f"{self._name}-blocks")
        return self._kept["blocks"]

    def scored(self, pairs: DataFrame, by_user: bool = False) -> DataFrame:
        """``pairs`` with a ``prediction``; pairs of an unknown user or movie give no row.

        The rows lie by movie, or ``by_user``: by user, with both factors, ``_u`` and ``_v``.
        """
        u, v = self.user_factors().withColumnRenamed("features", "_u"), self.item_factors().withColumnRenamed("features", "_v")
        x = pairs.join(v, "movieId").join(u, "userId") if by_user else pairs.join(u, "userId").join(v, "movieId")
        x = x.withColumn("prediction", product(F.col("_u"), F.col("_v"), self.model.rank).cast("float"))
        return x if by_user else x.drop("_u", "_v")


def product(u: Column, v: Column, rank: int) -> Column:
    """Inner product of two factors, summed in double precision."""
    out = F.lit(0.0)
    for i in range(rank):
        out = out + u[i].cast("double") * v[i].cast("double")
    return out


def _parallelism(spark) -> int:
    """Cores of the cluster (one ALS block per core, as Spark ML advises)."""
    return max(1, spark.sparkContext.defaultParallelism)


def factor_blocks(n_ratings: int) -> int:
    """The factor blocks that so many ratings need at least."""
    return max(1, -(-n_ratings // BLOCK_RATINGS))


def train_als(ratings: DataFrame, *, rank: int = ALS_RANK, max_iter: int = ALS_MAX_ITER,
              reg_param: float = ALS_REG_PARAM, seed: int = DEFAULT_SEED, blocks: int | None = None) -> Als:
    """Explicit-feedback ALS (rank 6, 5 iterations, λ 0.01 by default).

    Factor blocks default to the cluster's parallelism (total cores), so the
    solve spreads over every core whatever ``spark.sql.shuffle.partitions`` is, and to more
    where a block would have over ``BLOCK_RATINGS``.  Then the blocks are also kept on the
    executors' disks (a task streams its own), as together they would fill the memory beside the tasks.
    Where ``spark.checkpoint.dir`` names a folder, it is registered, and such a run stores the
    movies' factors there in every iteration, which frees the shuffle files of the one before (they
    would pile up otherwise, each nearly as large as the ratings); others cut their lineage every 10 iterations.
    """
    spark = ratings.sparkSession
    if spark.conf.get(CHECKPOINT_CONF, None):
        checkpoint_dir(spark)
    parts, large = blocks or _parallelism(spark), {}
    if not blocks and (needed := factor_blocks(ratings.count())) > parts:
        parts, large = needed, {"intermediateStorageLevel": "DISK_ONLY", "checkpointInterval": 1}
    users, items = Numbering.of(ratings, ("userId", USER), ("movieId", ITEM))
    data = items.encode(users.encode(ratings.select("userId", "movieId", "rating")))
    als = ALS(rank=rank, maxIter=max_iter, regParam=reg_param, implicitPrefs=False, seed=seed,
              userCol=USER, itemCol=ITEM, ratingCol="rating", coldStartStrategy="drop",
              numUserBlocks=parts, numItemBlocks=parts, **large)
    return Als(als.fit(data.select(USER, ITEM, "rating")), users, items)


def score_known(model: Als, ratings: DataFrame) -> DataFrame:
    """``(userId, movieId, rating, prediction)``, one row per rating."""
    return model.scored(ratings.select("userId", "movieId", "rating")).select("userId", "movieId", "rating", "prediction")


def score_requests(model: Als, requests: DataFrame, movies: DataFrame) -> DataFrame:
    """``(userId, movieId, title, prediction, rounded)`` for requested
    pairs; ``rounded`` rounds half up to a whole rating.  Pairs with an unknown
    user or movie give no row."""
    pred = model.scored(requests.select("userId", "movieId"))
    pred = pred.withColumn("rounded", F.floor(F.col("prediction") + F.lit(0.5)).cast("long"))
    return attach_titles(pred, movies).select("userId", "movieId", "title", "prediction", "rounded")


def top_for_users(model: Als, users: DataFrame | None, movies: DataFrame, n: int = N_RECOMMENDATIONS,
                  seen: DataFrame | None = None) -> DataFrame:
    """The ``n`` highest predicted movies per user ``(userId, rank, movieId,
    title, score)``, ties by the smaller movie id.

    ``users=None`` takes every user of the model.  Only the blocks of movies whose norms allow a
    score above the user's n-th best so far are scored (``operators.topk``).  Movies the user already rated are not
    excluded (as in the original) unless ``seen`` gives the ratings: then a user with s seen
    movies looks for the n + s best, and the seen ones drop out.
    """
    factors = model.user_factors()
    if users is not None:
        factors = restrict_to(factors, users.select("userId"))
    top = F.lit(n)
    if seen is not None:
        # read three times below
        containers = materialize(seen_containers(restrict_to(seen.select("userId", "movieId"), factors.select("userId"))),
                                 f"{model._name}-seen")
        counts = containers.groupBy("userId").agg(F.sum("n_seen").alias("_seen"))
        factors = factors.join(counts, "userId", "left")
        top = F.lit(n) + F.coalesce("_seen", F.lit(0))
    items = model.item_factors().withColumnRenamed("movieId", "item")
    found = best_products(factors.select(F.col("userId").alias("user"), "features", top.alias("top")), items, model.item_blocks())
    found = found.select(F.col("user").cast(model.user_ids.kind).alias("userId"),
                         F.col("item").cast(model.item_ids.kind).alias("movieId"), "score")
    if seen is not None:
        found = without_seen(found, containers)
    best = top_k(found, ["userId"], [F.col("score").desc(), F.col("movieId").asc()], n)
    return attach_titles(best, movies).select("userId", "rank", "movieId", "title", "score")


def mean_squared_error(scored: DataFrame) -> DataFrame:
    """One row ``(mse, n)`` over scored ratings (in-sample when the
    scored ratings are the training ratings)."""
    err = F.col("rating") - F.col("prediction")
    return scored.agg(F.avg(err * err).alias("mse"), F.count(F.lit(1)).alias("n"))


def refresh(ratings: DataFrame, new_ratings: DataFrame, **als_kw) -> tuple[DataFrame, Als]:
    """Append new ratings and retrain; returns ``(ratings, model)``.  The appended
    ratings are stored, since training reads them twice and the caller goes on with them."""
    updated = materialize(append_ratings(ratings, new_ratings), "appended-ratings")
    return updated, train_als(updated, **als_kw)


def normal_equation_residuals(model: Als, ratings: DataFrame, reg_param: float = ALS_REG_PARAM) -> DataFrame:
    """Check of a fit: ``(userId, n_ratings, residual)``.

    The last half step solves the user side, so for every user
    Σ (prediction − rating) · v + λ · n · u is zero up to single precision;
    ``residual`` is its largest component per rating.
    """
    k = model.model.rank
    # by movie first, then by user: the sums, and the user's factor beside every row, need no further shuffle
    x = model.scored(ratings.select("userId", "movieId", "rating"), by_user=True).select(
        "userId", (F.col("prediction") - F.col("rating")).alias("e"), F.col("_u").alias("u"), F.col("_v").alias("v"))
    g = x.groupBy("userId").agg(F.count(F.lit(1)).alias("n_ratings"), F.first("u").alias("u"), *[
        F.sum(F.col("e") * F.col("v")[i]).alias(f"_g{i}") for i in range(k)])
    worst = F.greatest(*[F.abs(F.col(f"_g{i}") / F.col("n_ratings") + reg_param * F.col("u")[i]) for i in range(k)])
    return g.select("userId", "n_ratings", worst.alias("residual"))
