"""The best genre sets of each user by inverted lists, without scoring every set.

A set's score for a user is the sum of the user's weights over its genres divided by the
square root of its size (times what is constant for the user).  The index lists, by size, the
sets that hold each genre and each pair of genres.  A user's genres are ordered by the length of
their lists.  A set of size s whose first two genres in that order are a and b scores at most

    (w_a + w_b + the (s - 2) highest weights after b) / sqrt(s),

and one with a single genre of the user scores w / sqrt(s).  So every cell (genre or pair,
size) has a bound.  The cells of the highest bounds are read first, until they hold some times the
movies the user needs; the score at which the need is met then rules out all cells with
a lower bound, and the others are read.  Sets without a genre of the user score 0
and are only returned where the rest holds too few movies.

Sets come in chunks (one packed row each) and users in packed batches; every batch
meets every chunk by an equi-join on (chunk, salt), and the caller merges the chunks.  A
set costs time only where it is touched, so vocabularies of hundreds of genres and very many
sets stay cheap.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: So many times the needed sets are read before the first threshold is taken.
LEAD = 4
#: Users in one packed row.
BATCH_USERS = 512
_USERS = "ids binary, needs binary, profiles binary"


def _pairs(length: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all pairs inside consecutive runs."""
    first, second = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for n in np.unique(length[length > 1]):
        a, b = np.triu_indices(n, 1)
        at = starts[length == n][:, None]
        first.append((at + a).ravel())
        second.append((at + b).ravel())
    return np.concatenate(first), np.concatenate(second)


class Sets:
    """One chunk: genre positions (from 0), movie counts, and the lists by genre and size."""

    def __init__(self, sets: pa.Array, k: int) -> None:
        idx = sets.field("idx")
        self.masks = sets.field("mask")
        self.movies = np.asarray(sets.field("size"), np.int64)
        ends = np.asarray(idx.offsets, np.int64)
        self.length = np.diff(ends)
        longest = int(self.length.max()) if len(self.length) else 0
        self.genres = np.full((len(self.length), longest), k, np.int64)  # position k weighs 0
        flat = np.asarray(idx.values, np.int64)[ends[0]:ends[-1]] - 1
        self.genres[np.arange(longest) < self.length[:, None]] = flat
        self.k, self.sizes = k, longest + 1
        owner = np.repeat(np.arange(len(self.length)), self.length)
        first, second = _pairs(self.length, ends[:-1] - ends[0])
        # one list for each (genre, size) and (lower genre, higher genre, size), all in one array by key
        low, high = np.minimum(flat[first], flat[second]), np.maximum(flat[first], flat[second])
        keys = np.append(self._key(flat, flat, self.length[owner]), self._key(low, high, self.length[owner[first]]))
        at = np.append(owner, owner[first])
        order = np.lexsort((at, keys))
        self.keys, self.listed = keys[order], at[order]
        self.postings = np.bincount(flat, minlength=k)
        self.root = np.sqrt(np.maximum(self.length, 1).astype(np.float64))
        self.roots = np.sqrt(np.arange(1, longest + 1, dtype=np.float64))

    def _key(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        return (a * self.k + b) * self.sizes + size

    def score(self, at: np.ndarray, padded: np.ndarray, norm: float, scale: float) -> np.ndarray:
        return scale * (padded[self.genres[at]].sum(axis=1) / (norm * self.root[at]))

    def best(self, profile: np.ndarray, need: int, scale: float, margin: float) -> tuple[np.ndarray, np.ndarray, int]:
        """Positions and scores of the sets down to the score at which ``need`` movies are reached
        (ties and ``margin`` included; all sets where they are not), and how many sets were scored."""
        norm = float(np.sqrt((profile * profile).sum()))
        padded = np.append(profile, 0.0)
        if profile.min() < 0:  # no bounds then
            every = np.arange(len(self.length))
            return self._cut(every, self.score(every, padded, norm, scale), need, margin) + (len(every),)
        liked = np.flatnonzero(profile > 0)
        liked = liked[np.argsort(self.postings[liked], kind="stable")]  # the shortest lists first
        starts, ends, bounds = self._cells(liked, profile[liked], scale / norm)
        order = np.argsort(-bounds, kind="stable")
        held = np.cumsum((ends - starts)[order])
        lead = order[:int(np.searchsorted(held, min(need, len(self.length)) * LEAD)) + 1]
        touched = np.zeros(len(self.length), bool)
        at = self._read(starts[lead], ends[lead], touched)
        got = self.score(at, padded, norm, scale)
        tau = self._threshold(at, got, need)
        left = np.ones(len(bounds), bool)
        left[lead] = False
        left = np.flatnonzero(left & (bounds >= tau - margin))
        more = self._read(starts[left], ends[left], touched)
        at, got = np.append(at, more), np.append(got, self.score(more, padded, norm, scale))
        tau = self._threshold(at, got, need)
        n = int(touched.sum())
        if tau == -np.inf:  # too few movies: the sets that score 0 follow
            rest = np.flatnonzero(~touched)
            at, got = np.append(at, rest), np.append(got, np.zeros(len(rest)))
        return self._cut(at, got, need, margin) + (n,)

    def _cells(self, liked: np.ndarray, weights: np.ndarray, factor: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the lists of the user's genres and pairs stand, and the highest score in each."""
        m, most = len(liked), self.sizes - 1
        after = np.zeros((m, most + 1))  # sums of the highest weights after each genre
        for j in range(m):
            top = np.sort(weights[j + 1:])[::-1][:most]
            after[j, 1:len(top) + 1] = np.cumsum(top)
            after[j, len(top) + 1:] = after[j, len(top)]
        a, b = np.triu_indices(m, 1)
        size = np.arange(1, most + 1)
        alone = weights[:, None] / self.roots[None, :]
        both = ((weights[a] + weights[b])[:, None] + after[b, :max(most - 1, 0)]) / self.roots[None, 1:]
        keys = np.append(self._key(liked[:, None], liked[:, None], size[None, :]).ravel(), self._key(
            np.minimum(liked[a], liked[b])[:, None], np.maximum(liked[a], liked[b])[:, None], size[None, 1:]).ravel())
        bounds = factor * np.append(alone.ravel(), both.ravel())
        return np.searchsorted(self.keys, keys, side="left"), np.searchsorted(self.keys, keys, side="right"), bounds

    def _read(self, starts: np.ndarray, ends: np.ndarray, touched: np.ndarray) -> np.ndarray:
        """The sets in some lists that were not touched yet; they are from now on."""
        size = ends - starts
        total = int(size.sum())
        if not total:
            return np.zeros(0, np.int64)
        new = self.listed[np.arange(total) + np.repeat(starts - (np.cumsum(size) - size), size)]
        new = np.unique(new[~touched[new]])
        touched[new] = True
        return new

    def _threshold(self, at: np.ndarray, got: np.ndarray, need: int) -> float:
        order = np.argsort(-got, kind="stable")
        held = np.cumsum(self.movies[at[order]])
        first = int(np.searchsorted(held, need))
        return float(got[order[first]]) if first < len(held) else -np.inf

    def _cut(self, at: np.ndarray, got: np.ndarray, need: int, margin: float) -> tuple[np.ndarray, np.ndarray]:
        keep = got >= self._threshold(at, got, need) - margin
        return at[keep], got[keep]


def _pack_users(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo in range(0, b.num_rows, BATCH_USERS):
            x = b.slice(lo, BATCH_USERS)
            yield pa.RecordBatch.from_pydict({
                "ids": pa.array([np.asarray(x.column(0), np.int64).tobytes()], pa.binary()),
                "needs": pa.array([np.asarray(x.column(1), np.int64).tobytes()], pa.binary()),
                "profiles": pa.array([np.asarray(x.column(2).flatten(), np.float64).tobytes()], pa.binary())})


def _search(k: int, scale: float, margin: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, sets = None, None
        for b in batches:
            ids, needs, profiles, chunks, lists = (b.column(c) for c in ("ids", "needs", "profiles", "chunk", "sigs"))
            for i in range(b.num_rows):
                if sets is None or chunks[i].as_py() != chunk:
                    chunk, sets = chunks[i].as_py(), Sets(lists[i].values, k)
                users, need = np.frombuffer(ids[i].as_py(), np.int64), np.frombuffer(needs[i].as_py(), np.int64)
                profile = np.frombuffer(profiles[i].as_py(), np.float64).reshape(-1, k)
                found = [sets.best(p, int(n), scale, margin) for p, n in zip(profile, need)]
                sizes = [len(f[0]) for f in found]
                at = np.concatenate([f[0] for f in found])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(users, sizes), pa.int64()), sets.masks.take(pa.array(at, pa.int64())),
                    pa.array(np.concatenate([f[1] for f in found]), pa.float64()), pa.array(sets.movies[at], pa.int64())],
                    names=["userId", "mask", "score", "size"])
    return run


def best_sets(users: DataFrame, catalogue: DataFrame, chunks: Column, salt: int, k: int, scale: float, margin: float) -> DataFrame:
    """``(userId, mask, score, size)``: per user and chunk the sets that can be among the best.

    ``users (userId, need, profile)`` need movies of that number; profiles are not all zero.
    ``catalogue (chunk, salt, sigs)`` holds lists of ``(mask, size, idx)``, ``idx`` from 1.
    """
    kinds = users.schema["userId"].dataType, catalogue.schema["sigs"].dataType.elementType["mask"].dataType
    packed = users.select(F.col("userId").cast("long"), F.col("need").cast("long"), "profile").mapInArrow(_pack_users, _USERS)
    packed = (packed.withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks - 1)))
              .withColumn("salt", F.pmod(F.xxhash64("ids"), F.lit(salt)).cast("int")))
    # few bytes, much work: the number of tasks must not follow the bytes
    tasks = int(users.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    joined = packed.repartition(tasks, "chunk", "salt").join(catalogue, ["chunk", "salt"]).select("ids", "needs", "profiles", "chunk", "sigs")
    found = joined.mapInArrow(_search(k, scale, margin), f"userId long, mask {kinds[1].simpleString()}, score double, size long")
    return found.withColumn("userId", F.col("userId").cast(kinds[0]))
