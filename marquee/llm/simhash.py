"""SimHash near-dedup with pivot distance tables (operator 6).

Fingerprints: the words of the text (A-Z in lower case) form shingles, repeats
included; a bit is set if more than half of the shingles' XXH64 values (seed
42) have it.  Equal fingerprints are merged first, by aggregation.

Links between different fingerprints at ``max_bits`` or fewer bits: every
fingerprint gets a table of its Hamming distances to ``PIVOTS`` reference
fingerprints.  By the triangle inequality two fingerprints within ``max_bits``
differ by no more than that in every coordinate.  The tables meet in blocks:
the 64 bits are cut into ``max_bits + 2`` parts, of which at least two are
equal in a linked pair.  Inside a block the pairs are discarded by their
largest coordinate difference, and the survivors are verified on the bits; a
task emits a spanning forest of a block's links, not all of its pairs.

A block of more than ``BLOCK_CAP`` fingerprints is handled exactly in another
way: two fingerprints are linked if and only if they become equal when some
``max_bits`` bits are cleared, so every member is keyed by its cleared forms
and linked with the smallest of each form, by a distributed minimum.

Defined cases: null, empty and blank texts have fingerprint zero and are linked
like any other; fewer words than a shingle form one shingle; a null id never
names a component that has another id (a component of null ids only has the id
null); repeated rows are linked like other copies, each returned; an empty table
gives an empty result; other columns, whatever their names, are not read
(``keep_one`` returns them unchanged).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations, repeat
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.arrow import batch, slices
from marquee.llm.common import broadcast_if_small, fresh, stored
from marquee.llm.components import components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
PIVOTS = 16
BLOCK_CAP = 4096


def _hashes(text: str | None, n: int) -> list[int]:
    from xxhash import xxh64_intdigest
    words = text.encode("utf-8").lower().split() if text else []
    if len(words) <= n:
        return [xxh64_intdigest(b" ".join(words), SEED)] if words else []
    line = b" ".join(words)
    sizes = list(map(len, words))
    starts = [0, *accumulate(map(add, sizes, repeat(1)))]
    ends = map(add, starts[n - 1:-1], sizes[n - 1:])
    return [xxh64_intdigest(line[a:z], SEED) for a, z in zip(starts, ends)]


def _majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprints of runs of hashes; zero for an empty run."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        starts = (np.cumsum(counts) - counts)[full]
        n = counts[full].astype(np.int64)
        octets = hashes.view(np.uint8).reshape(-1, 8)
        for k in range(8):
            bits = np.unpackbits(np.ascontiguousarray(octets[:, k])[:, None], axis=1, bitorder="little")
            ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
            for j in range(8):
                out[full] |= (2 * ones[:, j] > n).astype(np.uint64) << np.uint64(8 * k + j)
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``(id, text_hash, fp)``; ``fp`` is the 64 bits as a signed long."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("text_hash", T.LongType()),
                           T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2):
            per = [_hashes(t, shingle) for t in b.column(2).to_pylist()]
            counts = np.fromiter(map(len, per), np.int64, len(per))
            flat = np.fromiter((h for x in per for h in x), np.uint64, int(counts.sum()))
            yield batch(("id", b.column(0)), ("text_hash", b.column(1)),
                        ("fp", pa.array(_majority(flat, counts).view(np.int64))))

    return docs.select(F.col(id_col), F.xxhash64(F.col(text_col)), F.col(text_col)).mapInArrow(run, schema)


def as_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def pivots(n: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: fixed pseudo-random 64-bit patterns."""
    return np.random.default_rng(20240607).integers(0, 2**64, n, dtype=np.uint64)


def _parts(max_bits: int) -> list[int]:
    """Masks that cut the 64 bits into ``max_bits + 2`` parts."""
    cuts = np.linspace(0, 64, max_bits + 3).astype(int)
    return [((1 << int(z)) - 1) ^ ((1 << int(a)) - 1) for a, z in zip(cuts[:-1], cuts[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links with the same components as (a, b), one per node and without cycles."""
    nodes, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inverse[:len(a)], inverse[len(a):]
    root = np.arange(len(nodes))
    while True:
        rx, ry = root[x], root[y]
        low = np.minimum(rx, ry)
        before = root.copy()
        np.minimum.at(root, rx, low)
        np.minimum.at(root, ry, low)
        root = root[root]
        if np.array_equal(root, before):
            break
    keep = root != np.arange(len(nodes))
    return nodes[keep], nodes[root[keep]]


def _block_links(key: np.ndarray, fp: np.ndarray, table: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside the blocks of rows sorted by (key, first coordinate)."""
    a_out, b_out, held = [], [], 0
    live = np.arange(len(fp))
    step = 1
    while len(live):
        live = live[live + step < len(fp)]
        # pairs of one block whose first coordinate, by which a block is sorted, is near enough
        live = live[(key[live] == key[live + step]) & (table[live + step, 0] - table[live, 0] <= max_bits)]
        pair = live
        for c in range(1, table.shape[1]):
            pair = pair[np.abs(table[pair, c] - table[pair + step, c]) <= max_bits]
        pair = pair[np.bitwise_count(fp[pair] ^ fp[pair + step]) <= max_bits]
        if len(pair):
            a_out.append(fp[pair])
            b_out.append(fp[pair + step])
            held += len(pair)
            if held > 1_000_000:
                x, y = _forest(np.concatenate(a_out), np.concatenate(b_out))
                a_out, b_out, held = [x], [y], len(x)
        step += 1
    if not a_out:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return _forest(np.concatenate(a_out), np.concatenate(b_out))


def _linked(max_bits: int, n_pivots: int):
    """A function on Arrow batches of (block, part, fp) sorted by block: spanning links."""
    refs = pivots(n_pivots)

    def work(block: np.ndarray, fp: np.ndarray) -> pa.RecordBatch | None:
        table = np.bitwise_count(fp[:, None] ^ refs[None, :]).astype(np.int8)
        order = np.lexsort((table[:, 0], block))
        a, b = _block_links(block[order], fp[order], table[order], max_bits)
        if len(a):
            return batch(("a", pa.array(a.view(np.int64))), ("b", pa.array(b.view(np.int64))))
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, np.ndarray]] = []
        for rb in batches:
            block = rb.column(0).to_numpy(zero_copy_only=False)
            fp = rb.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            if not len(block):
                continue
            # the last block of a batch may go on in the next one
            last = int(np.searchsorted(block, block[-1]))
            if last > 0:
                kept.append((block[:last], fp[:last]))
                out = work(*(np.concatenate(x) for x in zip(*kept)))
                if out is not None:
                    yield out
                kept = []
            kept.append((block[last:], fp[last:]))
        if kept:
            out = work(*(np.concatenate(x) for x in zip(*kept)))
            if out is not None:
                yield out

    return run


def links(distinct: DataFrame, max_bits: int = MAX_BITS, n_pivots: int = PIVOTS, cap: int = BLOCK_CAP) -> DataFrame:
    """``(a, b)`` from the distinct fingerprints ``(fp)``: links that connect what linked pairs connect."""
    masks = [x | y for x, y in combinations(_parts(max_bits), 2)]
    fp = F.col("fp")
    keyed = distinct.select(fp, F.explode(F.array(*[
        F.struct(F.lit(i).alias("part"), fp.bitwiseAND(F.lit(_signed(m))).alias("bits")) for i, m in enumerate(masks)])).alias("k")) \
        .select(F.xxhash64("k.part", "k.bits").alias("block"), "k.part", fp)
    size = keyed.groupBy("block").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = stored(size, "simhash-blocks")  # few: blocks with a partner at all
    small = sizes.where(F.col("n") <= cap).select("block")
    members = keyed.join(broadcast_if_small(small, row_bytes=32), "block", "left_semi")
    n = distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")
    found = members.select("block", "fp").repartition(int(n), "block").sortWithinPartitions("block").mapInArrow(
        _linked(max_bits, n_pivots), "a bigint, b bigint")
    large = sizes.where(F.col("n") > cap).select("block")
    if large.isEmpty():
        return found
    # members of a large block agree on its bits: only the others can differ
    free = [[b for b in range(64) if not m >> b & 1] for m in masks]
    clear = [[~sum(1 << b for b in c) & (1 << 64) - 1 for c in combinations(f, max_bits)] for f in free]
    cases = None
    for i, c in enumerate(clear):
        forms = F.transform(F.array(*[F.lit(_signed(m)) for m in c]), lambda m: F.struct(m.alias("mask"), fp.bitwiseAND(m).alias("form")))
        cases = F.when(F.col("part") == i, forms) if cases is None else cases.when(F.col("part") == i, forms)
    rows = keyed.join(broadcast_if_small(large, row_bytes=32), "block", "left_semi").select(
        fp, F.explode(cases).alias("f")).select(fp, "f.mask", "f.form")
    low = rows.groupBy("mask", "form").agg(F.min("fp").alias("m"))
    far = rows.join(low, ["mask", "form"]).where("fp != m").select(F.col("fp").alias("a"), F.col("m").alias("b")).distinct()
    return found.unionByName(far)


def _with_roots(fps: DataFrame, max_bits: int) -> DataFrame:
    """``(fp, root)`` for the fingerprints that have a link."""
    distinct = stored(fps.select("fp").distinct(), "simhash-distinct")
    return stored(components(links(distinct, max_bits)), "simhash-roots").select(F.col("node").alias("fp"), "root")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """``(id, text_hash, fingerprint, root, component_id)``, one row per document.

    ``root`` is a fingerprint that names the component, ``component_id`` its smallest id.
    """
    fps = stored(fingerprints(docs, id_col, text_col, shingle), "simhash")
    roots = _with_roots(fps, max_bits)
    # ids meet by distinct fingerprint, so a fingerprint that many documents have is one row
    by_fp = fps.groupBy("fp").agg(F.min("id").alias("low")).join(roots, "fp", "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    by_fp = stored(by_fp, "simhash-classes")
    named = by_fp.join(by_fp.groupBy("root").agg(F.min("low").alias("component_id")), "root").select("fp", "root", "component_id")
    return fps.join(named, "fp").select("id", "text_hash", F.col("fp").alias("fingerprint"), "root", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             max_bits: int = MAX_BITS) -> DataFrame:
    """One row of every component: that with the smallest id (then text hash); null ids come last."""
    x = stored(near_duplicates(docs, id_col, text_col, shingle, max_bits), "simhash-components")
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")
    best = x.groupBy("root").agg(F.min(rank).alias("b"))
    kept = stored(best.select("b.id", "b.text_hash"), "simhash-kept")
    h, kid, kh = fresh(docs, "text_hash", "kept_id", "kept_hash")
    k = broadcast_if_small(kept.select(F.col("id").alias(kid), F.col("text_hash").alias(kh)), row_bytes=64)
    marked = docs.withColumn(h, F.xxhash64(F.col(text_col)))
    out = marked.join(k, (marked[h] == k[kh]) & marked[id_col].eqNullSafe(k[kid]), "left_semi")
    # rows that are equal in id and text are copies of each other: one of them stays
    again = x.groupBy("id", "text_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id", "text_hash")
    if again.isEmpty():
        return out.select(docs.columns)
    rid, rh = fresh(out, "again_id", "again_hash")
    r = broadcast_if_small(again.select(F.col("id").alias(rid), F.col("text_hash").alias(rh)), row_bytes=64)
    same = (out[h] == r[rh]) & out[id_col].eqNullSafe(r[rid])
    once = out.join(r, same, "left_anti").select(docs.columns)
    many = out.join(r, same, "left_semi").dropDuplicates([id_col, h]).select(docs.columns)
    return once.unionByName(many)
