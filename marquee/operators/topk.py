"""Exact top-n by inner product without scoring every user against every item.

Items are kept as packed blocks in falling order of their norm.  For a user u
no item of a block can score above ``|u| * (largest norm of the block)``
(Cauchy-Schwarz), so a user is done with the first block whose bound is below the
user's k-th best score so far.  The first threshold comes from the ``BLOCK_ITEMS`` items
of the largest norms, the only factors that reach the driver:

1. items → blocks of at most ``BLOCK_ITEMS`` rows (one range partitioning), stored;
2. users, in Arrow batches → packed rows of users that need about as many blocks, each once, stored;
   the packs are dealt to groups, and a group gets the blocks that one of its users needs at least: what is
   shuffled is the users once and those blocks once for each group;
3. a group's task holds its users with their best k so far and takes the blocks in falling
   order of their norm; a matrix product gives the scores, and a user whose k-th best is above
   the bound takes no part any more (a users × items table never exists);
4. the caller ranks the rows by user.

As blocks are sent to every group, their number is that of the cluster's cores, more only where the best
lists of a group would hold over ``GROUP_BEST`` rows (20 bytes each).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.sources.tables import materialize

BLOCK_ITEMS = 1024
#: Blocks that one task packs.
TASK_BLOCKS = 64
#: Users in one packed row.
PACK_USERS = 256
#: Users scored at once inside a task, and the most rows of their best lists (one user's excepted).
SLICE_USERS, SLICE_BEST = 1024, 1 << 20
GROUP_BEST = 5_000_000
#: Relative slack of the bound: scores are ranked as single-precision numbers.
SLACK = 2.0 ** -20

_BLOCKS = "block long, norm double, ids binary, vectors binary"
_PACKS = "ids binary, vectors binary, tops binary, thresholds binary, reach double, asked long"
_FOUND = "user long, item long, score float"


def _matrix(col: pa.Array, rank: int) -> np.ndarray:
    return np.asarray(col.flatten(), np.float64).reshape(len(col), rank)


def _pack_items(rank: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        for b in batches:
            for at in range(0, b.num_rows, BLOCK_ITEMS):
                x = b.slice(at, BLOCK_ITEMS)
                v = _matrix(x.column(1), rank)
                norm = float(np.sqrt((v * v).sum(axis=1)).max())
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([(part << 32) + n], pa.int64()), "norm": pa.array([norm], pa.float64()),
                    "ids": pa.array([np.asarray(x.column(0), np.int64).tobytes()], pa.binary()),
                    "vectors": pa.array([v.astype(np.float32).tobytes()], pa.binary())})
                n += 1
    return run


class Slice:
    """Some users with their best so far, as rows of scores (falling) and ids (rising among equals)."""

    def __init__(self, users: np.ndarray, vectors: np.ndarray, tops: np.ndarray, least: np.ndarray) -> None:
        self.users, self.vectors, self.tops = users, vectors, tops
        self.size = np.sqrt((vectors * vectors).sum(axis=1))
        self.least = least.copy()
        self.live = np.arange(len(users))
        self.owner = np.zeros(0, np.int64)
        self.scores, self.items = np.zeros(0, np.float32), np.zeros(0, np.int64)
        self.scored = 0

    def take(self, items: np.ndarray, v: np.ndarray, norm: float) -> bool:
        """Scores a block whose vectors are no longer than ``norm``; whether later blocks can matter."""
        bound = self.size[self.live] * norm
        self.live = self.live[bound + SLACK * bound >= self.least[self.live]]
        if not len(self.live):
            return False
        self.scored += 1
        s = (self.vectors[self.live] @ v.T).astype(np.float32)
        r, c = np.nonzero(s >= self.least[self.live, None])
        if not len(r):
            return True
        # only the lists of the users who found something are sorted again
        touched = np.zeros(len(self.users), bool)
        touched[self.live[r]] = True
        again, who = touched[self.owner], np.flatnonzero(touched)
        owner = np.append(self.owner[again], self.live[r])
        scores, ids = np.append(self.scores[again], s[r, c]), np.append(self.items[again], items[c])
        order = np.lexsort((ids, -scores, owner))
        owner, scores, ids = owner[order], scores[order], ids[order]
        starts = np.searchsorted(owner, who)
        many = np.diff(np.append(starts, len(owner)))
        best = np.arange(len(owner)) - np.repeat(starts, many) < self.tops[owner]
        full = many >= self.tops[who]
        self.least[who[full]] = scores[starts[full] + self.tops[who[full]] - 1]
        self.owner, self.scores, self.items = (np.append(x[~again], y[best]) for x, y in (
            (self.owner, owner), (self.scores, scores), (self.items, ids)))
        return True

    def found(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(self.users[self.owner], pa.int64()), pa.array(self.items, pa.int64()),
                                           pa.array(self.scores, pa.float32())], names=["user", "item", "score"])


def _cut(users: np.ndarray, vectors: np.ndarray, tops: np.ndarray, least: np.ndarray) -> list[Slice]:
    out, at = [], 0
    while at < len(users):
        end = min(len(users), at + SLICE_USERS)
        end = max(at + 1, at + int(np.searchsorted(np.cumsum(tops[at:end]), SLICE_BEST, side="right")))
        out.append(Slice(users[at:end], vectors[at:end], tops[at:end], least[at:end]))
        at = end
    return out


def _search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by group: its users, then the blocks in falling order of their norm."""
    number, users, live, done = None, [], None, []

    def end() -> Iterator[pa.RecordBatch]:
        for s in [*done, *(live or [])]:
            yield s.found()

    for b in batches:
        groups, norms = np.asarray(b.column(0)), np.asarray(b.column(1).fill_null(np.nan))
        for i in range(b.num_rows):
            if groups[i] != number:
                yield from end()
                number, users, live, done = groups[i], [], None, []
            if np.isnan(norms[i]):  # users, packed
                users.append(tuple(b.column(c)[i].as_py() for c in (2, 3, 4, 5)))
                continue
            if live is None:
                ids, flat, tops, least = (np.concatenate([np.frombuffer(u[k], t) for u in users] or [np.zeros(0, t)]) for k, t in enumerate(
                    (np.int64, np.float32, np.int64, np.float64)))
                live, users = _cut(ids, flat.astype(np.float64).reshape(max(len(ids), 1), -1), tops, least) if len(ids) else [], []
            if live:
                items = np.frombuffer(b.column(2)[i].as_py(), np.int64)
                v = np.frombuffer(b.column(3)[i].as_py(), np.float32).astype(np.float64).reshape(len(items), -1)
                more = [s.take(items, v, norms[i]) for s in live]
                done += [s for s, m in zip(live, more) if not m]
                live = [s for s, m in zip(live, more) if m]
    yield from end()


def _plan(rank: int, first: np.ndarray, norms: np.ndarray, blocks: np.ndarray):
    """Step 2: ``norms`` fall, ``blocks`` are their numbers."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows or not len(blocks):
                continue
            users, tops = (np.asarray(b.column(i), np.int64) for i in (0, 2))
            v = _matrix(b.column(1), rank)
            size = np.sqrt((v * v).sum(axis=1))
            least = np.full(len(users), -np.inf)
            for at in range(0, len(users), SLICE_USERS):
                part = slice(at, at + SLICE_USERS)
                s = np.sort(v[part] @ first.T, axis=1)
                enough = np.flatnonzero(tops[part] <= len(first))
                least[part][enough] = s[enough, len(first) - tops[part][enough]]
            least -= SLACK * size * norms[0]
            # the blocks whose bound reaches the threshold are the first ones
            with np.errstate(divide="ignore", invalid="ignore"):
                need = np.searchsorted(-norms, np.where(size > 0, -least / size, np.inf), side="right")
            order = np.argsort(need, kind="stable")
            for at in range(0, len(order), PACK_USERS):
                some = order[at:at + PACK_USERS]
                yield pa.RecordBatch.from_pydict({
                    "ids": pa.array([users[some].tobytes()], pa.binary()), "vectors": pa.array([v[some].astype(np.float32).tobytes()], pa.binary()),
                    "tops": pa.array([tops[some].tobytes()], pa.binary()), "thresholds": pa.array([least[some].tobytes()], pa.binary()),
                    # the norm of the last block that one of them needs
                    "reach": pa.array([norms[need[some[-1]] - 1] if need[some[-1]] else np.inf], pa.float64()),
                    "asked": pa.array([int(tops[some].sum())], pa.int64())})
    return run


def item_blocks(items: DataFrame, name: str) -> DataFrame:
    """``(item, features)`` as packed blocks ``(block, norm, ids, vectors)``, stored."""
    norm = F.sqrt(F.aggregate("features", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    x = items.select("item", "features", norm.alias("_norm"))
    n, rank = x.agg(F.count(F.lit(1)), F.max(F.size("features"))).first()
    parts = max(1, -(-n // (BLOCK_ITEMS * TASK_BLOCKS)))
    x = x.repartitionByRange(parts, F.col("_norm").desc(), "item").sortWithinPartitions(F.col("_norm").desc(), "item")
    return materialize(x.select("item", "features").mapInArrow(_pack_items(rank or 1), _BLOCKS), name)


def best_products(users: DataFrame, items: DataFrame, blocks: DataFrame) -> DataFrame:
    """``(user, item, score)``: for every user the ``top`` highest inner products.

    ``users (user, features, top)`` and ``items (item, features)`` hold integer ids, unique on each
    side, and single-precision vectors; ``blocks`` are the ``item_blocks`` of the items.  At most
    ``top`` rows come for a user.  Scores are single-precision numbers; with ties by
    the smaller item id the first ``top`` rows by score are the exact result.
    """
    edges = blocks.select("norm", "block").orderBy(F.col("norm").desc(), "block").collect()  # one row for up to 1,024 items
    norm = F.sqrt(F.aggregate("features", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    first = items.select("features", norm.alias("_norm")).orderBy(F.col("_norm").desc()).limit(BLOCK_ITEMS).collect()
    rank = len(first[0]["features"]) if first else 1
    top = np.array([r["features"] for r in first], np.float64).reshape(len(first), rank)
    packs = materialize(users.select(F.col("user").cast("long"), "features", F.col("top").cast("long")).mapInArrow(
        _plan(rank, top, np.array([e["norm"] for e in edges]), np.array([e["block"] for e in edges], np.int64)), _PACKS),
        f"top-packs-{uuid.uuid4().hex[:8]}")
    asked = packs.agg(F.sum("asked")).first()[0] or 0
    groups = max(users.sparkSession.sparkContext.defaultParallelism, -(-asked // GROUP_BEST))
    packs = packs.select(F.pmod(F.xxhash64("ids"), F.lit(groups)).cast("int").alias("_group"), F.lit(None).cast("double").alias("norm"), "*")
    reach = {r["_group"]: r["reach"] for r in packs.groupBy("_group").agg(F.min("reach").alias("reach")).collect()}  # a number for a group
    least = F.array(*[F.lit(float(reach.get(g, np.inf))) for g in range(groups)])
    packs = packs.drop("reach", "asked")
    copies = blocks.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("_group"), "norm", "ids", "vectors",
                           *[F.lit(None).cast("binary").alias(c) for c in ("tops", "thresholds")])
    copies = copies.where(F.col("norm") >= F.element_at(least, F.col("_group") + 1))
    x = packs.unionByName(copies).repartitionById(groups, F.col("_group"))
    return x.sortWithinPartitions("_group", F.col("norm").desc_nulls_first()).mapInArrow(_search, _FOUND)
