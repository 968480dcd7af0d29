"""Hard negatives for contrastive training, by Kronecker-packed integer products.

Components are quantised to whole numbers ``floor(scale * x)``; a row's score
for an anchor is the exact integer inner product.  An anchor's positives are
the rows of its label with the highest scores; for each positive the highest
rows of other labels inside a band below the positive's score are returned.

The products (``scores``): candidates' components are biased to be
non-negative and several candidates are packed into separate fields of one
wide integer, ``sum(c_i << (i * width))``, with fields so wide that no sum of
products can reach the next one.  Each component of the anchor is multiplied
once with the packed integer; the sum over the components holds the scores of
all packed candidates, which shifts and masks take apart, and the biases are
subtracted.  While two fields fit into 53 bits the wide integer is carried by
a double, in which every such product and sum is exact, so that the matrix
product of the linear algebra library does the work; beyond that it is a
Python integer with ``WIDE_FIELDS`` fields, exact at any size.

At scale: rows become blocks of about ``BLOCK_COMPONENTS`` components by a hash
of the id; the anchors (a stated query set) become smaller blocks.  Every
anchor block meets every candidate block by an equi-join on the block number,
as packed binary rows, and each pair is a product of two bounded matrices.  A
pair returns the best few rows for each anchor, and windows over those pick the
final ones (cut in each task before the shuffle).  Anchors are never collected:
their copies, one for each candidate block, are shuffled.

Awkward input: rows with a null id, label or vector, or with a null or
non-finite component take no part.  Of several rows with one id the one with
the smallest (label, quantised vector) stands for all.  Vectors of different
length are compared over the components both have; an empty vector scores 0.
Components are clipped to +-2**62 and scores to the range of a long.  Ties go
to the smaller id.  Anchors without another row of their label, and positives
without a row in the band, give no rows; empty tables give none.  Only the
named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.ranking import top_k
from marquee.llm.arrow import batch, column
from marquee.llm.common import stored

#: Components in a block of candidates (rows = this by the longest vector) and of anchors.
BLOCK_COMPONENTS, ANCHOR_COMPONENTS = 1 << 21, 1 << 17
#: Scores computed at once inside a task.
SLICE_SCORES = 1 << 21
#: Bits of an integer that a double holds exactly; fields of a wider integer.
DOUBLE_BITS, WIDE_FIELDS = 53, 64
COMPONENT_LIMIT = float(1 << 62)
NONE = np.iinfo(np.int64).min

_BLOCK = "block long, dim int, ids binary, labels binary, width int, q binary"
_PASS1 = "anchor_id long, positive_id long, score long"
_PASS2 = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"


def quantised(df: DataFrame, id_col: str, vec_col: str, label_col: str, scale: int) -> DataFrame:
    """``(id, label, q)`` of the rows that take part, one row for each id."""
    finite = F.forall(F.col(vec_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))

    def whole(x: Column) -> Column:
        y = x.cast("double") * F.lit(float(scale))
        return F.floor(F.least(F.greatest(y, F.lit(-COMPONENT_LIMIT)), F.lit(COMPONENT_LIMIT)))

    x = df.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vec_col).isNotNull() & finite)
    x = x.select(F.col(id_col).cast("long").alias("id"), F.struct(
        F.col(label_col).cast("long").alias("label"), F.transform(vec_col, whole).alias("q")).alias("r"))
    return x.groupBy("id").agg(F.min("r").alias("r")).select("id", "r.label", "r.q")


def _pack(table: pa.Table) -> pa.Table:
    """One block: rows by label and id, components as a matrix of the smallest integer type."""
    block = table.column("block")[0].as_py()
    ids, labels = (np.asarray(table.column(c), np.int64) for c in ("id", "label"))
    q = table.column("q").combine_chunks()
    if isinstance(q, pa.ChunkedArray):
        q = q.chunk(0)
    ends = np.asarray(q.offsets, np.int64)
    size = np.diff(ends)
    dim = int(size.max())
    m = np.zeros((len(ids), dim), np.int64)
    m[np.arange(dim) < size[:, None]] = np.asarray(q.values, np.int64)[ends[0]:ends[-1]]
    order = np.lexsort((ids, labels))
    m = m[order]
    kind = next(k for k in (np.int8, np.int16, np.int32, np.int64)
                if not m.size or (np.iinfo(k).min <= m.min() and m.max() <= np.iinfo(k).max))
    out = batch(column("block", [block], pa.int64()), column("dim", [dim], pa.int32()),
                column("ids", [ids[order].tobytes()], pa.binary()), column("labels", [labels[order].tobytes()], pa.binary()),
                column("width", [np.dtype(kind).itemsize], pa.int32()), column("q", [m.astype(kind).tobytes()], pa.binary()))
    return pa.Table.from_batches([out])


def blocks(rows: DataFrame, n_blocks: int) -> DataFrame:
    """The rows ``(id, label, q)`` as packed blocks 0 .. n_blocks - 1 (empty ones are absent)."""
    x = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("long"))
    return x.groupBy("block").applyInArrow(_pack, _BLOCK)


def _matrix(row: dict, prefix: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.frombuffer(row[prefix + "ids"], np.int64)
    labels = np.frombuffer(row[prefix + "labels"], np.int64)
    m = np.frombuffer(row[prefix + "q"], np.dtype(f"i{row[prefix + 'width']}"))
    return ids, labels, m.reshape(len(ids), row[prefix + "dim"]).astype(np.int64)


def scores(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact inner products, ``len(anchors)`` x ``len(candidates)``, clipped to longs."""
    d = min(anchors.shape[1], candidates.shape[1])
    n = len(candidates)
    if not d or not n or not len(anchors):
        return np.zeros((len(anchors), n), np.int64)
    a, c = anchors[:, :d], candidates[:, :d]
    bias_a, bias_c = min(int(a.min()), 0), min(int(c.min()), 0)
    top_a, top_c = int(a.max()) - bias_a, int(c.max()) - bias_c
    width = max(1, (d * top_a * top_c).bit_length())
    fields = DOUBLE_BITS // width
    if fields < 2:
        return _wide_scores(a.astype(object), c.astype(object), bias_a, bias_c, width)
    per = -(-n // fields)
    packed = np.zeros((per, d), np.float64)
    for i in range(fields):
        part = c[i * per:(i + 1) * per]
        packed[:len(part)] += ((part - bias_c) << (i * width)).astype(np.float64)
    product = ((a - bias_a).astype(np.float64) @ packed.T).astype(np.int64)
    out = np.empty((len(a), n), np.int64)
    for i in range(fields):
        got = out[:, i * per:(i + 1) * per]
        got[:] = (product[:, :got.shape[1]] >> (i * width)) & ((1 << width) - 1)
    # sum (a - A)(c - C) = sum ac - C sum a - A sum c + d A C
    out += (bias_c * a.sum(axis=1) - d * bias_a * bias_c)[:, None]
    out += (bias_a * c.sum(axis=1))[None, :]
    return out


def _wide_scores(a: np.ndarray, c: np.ndarray, bias_a: int, bias_c: int, width: int) -> np.ndarray:
    """The same on Python integers, for components of any size."""
    n, d = c.shape
    out = np.empty((len(a), n), object)
    sum_a, sum_c = a.sum(axis=1), c.sum(axis=1)
    for lo in range(0, n, WIDE_FIELDS):
        part = c[lo:lo + WIDE_FIELDS] - bias_c
        packed = np.zeros(d, object)
        for i, row in enumerate(part):
            packed = packed + row * (1 << (i * width))
        product = (a - bias_a) @ packed
        for i in range(len(part)):
            got = np.array([(int(p) >> (i * width)) & ((1 << width) - 1) for p in product], object)
            out[:, lo + i] = got + bias_c * sum_a + bias_a * sum_c[lo + i] - d * bias_a * bias_c
    return np.clip(out, NONE + 1, -(NONE + 1)).astype(np.int64)


def _segments(labels: np.ndarray) -> dict[int, slice]:
    if not len(labels):
        return {}
    cuts = np.flatnonzero(np.diff(labels)) + 1
    return {int(labels[a]): slice(int(a), int(z)) for a, z in zip(np.r_[0, cuts], np.r_[cuts, len(labels)])}


def _steps(n: int, columns: int) -> Iterator[slice]:
    step = max(1, SLICE_SCORES // max(1, columns))
    for lo in range(0, n, step):
        yield slice(lo, min(n, lo + step))


def _first(owner: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first ``k`` entries of each owner, by falling score and rising id."""
    order = np.lexsort((ids, -score, owner))
    own = owner[order]
    starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, np.int64)
    place = np.arange(len(own)) - np.repeat(starts, np.diff(np.r_[starts, len(own)]))
    return order[place < k]


def _positives(k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                a_ids, a_labels, a = _matrix(row, "a_")
                c_ids, c_labels, c = _matrix(row)
                there = _segments(c_labels)
                for label, own in _segments(a_labels).items():
                    if label not in there:
                        continue
                    ids, m = c_ids[there[label]], c[there[label]]
                    anchor_ids, anchors = a_ids[own], a[own]
                    for part in _steps(len(anchors), len(ids)):
                        s = scores(anchors[part], m)
                        s[anchor_ids[part][:, None] == ids[None, :]] = NONE
                        near = s > NONE
                        if len(ids) > k:
                            near &= s >= np.partition(s, len(ids) - k, axis=1)[:, len(ids) - k, None]
                        r, at = np.nonzero(near)
                        best = _first(r, s[r, at], ids[at], k)
                        r, at = r[best], at[best]
                        yield batch(column("anchor_id", anchor_ids[part][r], pa.int64()), column("positive_id", ids[at], pa.int64()),
                                    column("score", s[r, at], pa.int64()))
    return run


def _negatives(k: int, low: int, high: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                a_ids, a_labels, a = _matrix(row, "a_")
                c_ids, c_labels, c = _matrix(row)
                # (place of the anchor, positive, its score) and the band of whole scores below it
                known = np.frombuffer(row["a_positives"], np.int64).reshape(-1, 3)
                lo = np.array([-(-low * int(p) // 100) for p in known[:, 2]], np.int64)
                hi = np.array([high * int(p) // 100 for p in known[:, 2]], np.int64)
                there = _segments(c_labels)
                for part in _steps(len(a), len(c)):
                    mine = np.flatnonzero((known[:, 0] >= part.start) & (known[:, 0] < part.stop) & (lo <= hi))
                    if not len(mine):
                        continue
                    s = scores(a[part], c)
                    floor = np.full(len(s), -(NONE + 1), np.int64)
                    ceiling = np.full(len(s), NONE, np.int64)
                    at = known[mine, 0] - part.start
                    np.minimum.at(floor, at, lo[mine])
                    np.maximum.at(ceiling, at, hi[mine])
                    inside = (s >= floor[:, None]) & (s <= ceiling[:, None])
                    for i, label in enumerate(a_labels[part]):
                        if int(label) in there:
                            inside[i, there[int(label)]] = False
                    r, col = np.nonzero(inside)
                    got = s[r, col]
                    order = np.lexsort((c_ids[col], -got, r))
                    r, col, got = r[order], col[order], got[order]
                    edges = np.searchsorted(r, np.arange(len(s) + 1))
                    out = []
                    for j in mine:
                        i = int(known[j, 0] - part.start)
                        mine_scores = got[edges[i]:edges[i + 1]]
                        first = edges[i] + np.searchsorted(-mine_scores, -hi[j], side="left")
                        end = edges[i] + np.searchsorted(-mine_scores, -lo[j], side="right")
                        for x in range(int(first), int(min(end, first + k))):
                            out.append((int(a_ids[known[j, 0]]), int(known[j, 1]), int(known[j, 2]), int(c_ids[col[x]]), int(got[x])))
                    if out:
                        yield batch(*[column(n.split()[0], list(v), pa.int64()) for n, v in zip(_PASS2.split(", "), zip(*out))])
    return run


def _with_positives(table: pa.Table) -> pa.Table:
    """An anchor block with its anchors' positives: ``(place in the block, id, score)``."""
    packed = _pack(table.select(["block", "id", "label", "q"]))
    place = {i: n for n, i in enumerate(np.frombuffer(packed.column("ids")[0].as_py(), np.int64).tolist())}
    found = [(place[i], p["positive_id"], p["score"]) for i, ps in zip(table.column("id").to_pylist(), table.column("positives").to_pylist())
             for p in ps]
    return packed.append_column("positives", pa.array([np.array(sorted(found), np.int64).tobytes()], pa.binary()))


def hard_negatives(df: DataFrame, anchor: Column, *, id_col: str = "vec_id", vec_col: str = "embedding",
                   label_col: str = "label", scale: int = 256, positives: int = 5, negatives: int = 3, low: int = 50,
                   high: int = 95, block_components: int = BLOCK_COMPONENTS,
                   anchor_components: int = ANCHOR_COMPONENTS) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``anchor`` is a condition on the column ``id``.  A negative's score lies between
    ``low`` and ``high`` percent of the positive's (both included, in whole numbers).
    """
    spark = df.sparkSession
    rows = stored(quantised(df, id_col, vec_col, label_col, scale), "quantised")
    query = rows.where(anchor)
    n, dim = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("q")), F.lit(0))).first()
    n_anchors = query.count()
    cores = spark.sparkContext.defaultParallelism
    n_blocks = max(cores, -(-n * max(1, dim) // block_components))
    n_anchor_blocks = max(1, -(-n_anchors * max(1, dim) // anchor_components))
    candidates = stored(blocks(rows, n_blocks), "candidate-blocks")

    def meet(anchor_blocks: DataFrame) -> DataFrame:
        a = anchor_blocks.select(*[F.col(c).alias("a_" + c) for c in anchor_blocks.columns if c != "block"],
                                 F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))).alias("block"))
        return a.repartition(n_blocks, "block").join(candidates.repartition(n_blocks, "block"), "block")

    near = meet(blocks(query, n_anchor_blocks)).mapInArrow(_positives(positives), _PASS1)
    best = top_k(near, ["anchor_id"], [F.col("score").desc(), F.col("positive_id").asc()], positives, "_place")
    best = best.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(F.struct("positive_id", "score")).alias("positives"))
    known = query.join(best, "id").withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n_anchor_blocks)).cast("long"))
    known = stored(known.groupBy("block").applyInArrow(_with_positives, _BLOCK + ", positives binary"), "anchor-blocks")
    found = meet(known).mapInArrow(_negatives(negatives, low, high), _PASS2)
    return top_k(found, ["anchor_id", "positive_id"], [F.col("negative_score").desc(), F.col("negative_id").asc()], negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
