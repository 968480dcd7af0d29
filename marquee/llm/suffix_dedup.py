"""Removal of long repeated byte strings with run-length suffix indexes (operator 3).

A byte is removed if it lies in a string of ``length`` bytes that also starts
at another place of the corpus, the same document included.

1. *Phrases.*  Every window of ``length`` bytes is known by the smallest hash of
   the ``KMER``-byte strings inside it.  Neighbouring windows with the same
   smallest hash form a phrase, so every window belongs to exactly one phrase
   and equal windows belong to phrases with the same smallest hash.  A phrase
   whose hash no other phrase has, and that does not hold it twice itself, has
   no repeat.  Equal phrases (by two further
   64-bit hashes) become one with a multiplicity, before any text is moved:
   that is where the copies of a text or passage, however many, collapse.
2. *Index.*  The distinct phrases are dealt out by their smallest hash.  A task
   concatenates whole hash groups up to ``INDEX_BYTES``, sorts the suffixes, and
   keeps the Burrows-Wheeler transform run by run with the suffix positions at
   both ends of every run.
3. *Matching statistics.*  Streamed in text order from the run ends alone: the
   common prefix of a suffix with its neighbour is one less than that of the
   suffix before it, except at a run boundary, where it is compared anew.  A
   window whose match (to either side) is at least ``length`` long, or whose
   phrase has a multiplicity over one, is marked.
4. The marks go back to all occurrences of a phrase and are merged by document.

A hash group of more than ``GROUP_CAP`` distinct phrases is not indexed in one
task: its windows are hashed one by one and their places summed by hash instead,
which is as exact and spreads over all tasks.

Defined cases: null and empty texts have no bytes and nothing removed; rows that
are equal in id and text are two places, so all their windows repeat; a null id
is an id of its own; an empty table gives an empty result; other columns,
whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.arrow import batch, slices
from marquee.llm.common import broadcast_if_small, stored

LENGTH = 400
KMER = 32
PIECE_BYTES = 1 << 20
INDEX_BYTES = 1 << 20
GROUP_CAP = 4000

U = np.uint64
_BASES = (U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93))  # odd, so that they have inverses


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(base, -1, 1 << 64)
    make = lambda b: np.multiply.accumulate(np.concatenate([np.ones(1, U), np.full(n - 1, b, U)]))
    return make(base), make(inverse)


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(20240229)
    return tuple(r.integers(1, 2**64, 256, dtype=np.uint64) for _ in _BASES)


def _prefixes(data: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each base: prefix sums, and the factors that move a difference of them to position 0."""
    size = max(PIECE_BYTES * 2, 1 << int(len(data) + 1).bit_length())
    out = []
    for base, letters in zip(_BASES, _letters()):
        power, inverse = _powers(int(base), size)
        p = np.zeros(len(data) + 1, U)
        np.cumsum(letters[data] * power[:len(data)], out=p[1:])
        out.append((p, inverse))
    return out


def _span_hash(prefix: tuple[np.ndarray, np.ndarray], a: np.ndarray, z: np.ndarray) -> np.ndarray:
    p, inverse = prefix
    return (p[z] - p[a]) * inverse[a]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(33))) * U(0xFF51AFD7ED558CCD)
    return h ^ (h >> U(29))


def _window_min(h: np.ndarray, w: int) -> np.ndarray:
    """The minimum of every ``w`` neighbours, from running minima within blocks of ``w``."""
    n = len(h)
    pad = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, U)
    pad[:n] = h
    blocks = pad.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - w + 1], ahead[w - 1:n])


def _pieces(texts: list[bytes | None], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Groups of (row, offset, bytes); a long text comes in pieces that share length - 1 bytes."""
    group, size = [], 0
    for row, t in enumerate(texts):
        if t is None or len(t) < length:
            continue
        for at in range(0, len(t) - length + 1, PIECE_BYTES):
            piece = t[at:at + PIECE_BYTES + length - 1]
            if group and size + len(piece) > PIECE_BYTES:
                yield group
                group, size = [], 0
            group.append((row, at, piece))
            size += len(piece)
    if group:
        yield group


def _phrases_of(group: list[tuple[int, int, bytes]], length: int):
    """(row, start, windows, smallest hash, whether it may repeat inside, two hashes) of the phrases of a group of pieces."""
    data = np.frombuffer(b"".join(p for _, _, p in group), np.uint8)
    sizes = np.array([len(p) for _, _, p in group], np.int64)
    ends = np.cumsum(sizes)
    prefix = _prefixes(data)
    at = np.arange(len(data) - KMER + 1)
    kmers = _mixed(_span_hash(prefix[0], at, at + KMER))
    low = _window_min(kmers, length - KMER + 1)
    piece = np.repeat(np.arange(len(group)), sizes)[:len(low)]
    valid = np.arange(len(low)) + length <= ends[piece]
    new = np.ones(len(low), bool)
    new[1:] = (low[1:] != low[:-1]) | (piece[1:] != piece[:-1])
    starts = np.flatnonzero(new & valid)
    stop = np.append(np.flatnonzero(new), len(low))
    n = stop[np.searchsorted(stop, starts, side="right")] - starts
    n = np.minimum(n, ends[piece[starts]] - length + 1 - starts)
    # no phrase has more windows than a window has k-mers
    most = length - KMER + 1
    parts = -(-n // most)
    nth = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
    starts, n = np.repeat(starts, parts) + nth * most, np.minimum(np.repeat(n, parts) - nth * most, most)
    z = starts + n + length - 1
    # two equal windows of one phrase overlap, so the text between is periodic: then the smallest
    # k-mer leaves some window of the phrase, and the next window has it again
    again = np.zeros(len(low) + 1, np.int64)
    np.cumsum(kmers[:len(low)] == low, out=again[1:])
    inside = again[starts + n - 1] > again[starts]
    own = piece[starts]
    rows = np.array([r for r, _, _ in group], np.int64)[own]
    offset = np.array([o for _, o, _ in group], np.int64)[own] - (ends - sizes)[own]
    return rows, starts + offset, n, low[starts], inside, _span_hash(prefix[0], starts, z), _span_hash(prefix[1], starts, z)


def phrases(docs: DataFrame, length: int) -> DataFrame:
    """``(id, text_hash, low, start, n, inside, p1, p2)`` of ``docs (id, text_hash, bytes)``."""
    schema = T.StructType([*docs.schema.fields[:2], *(T.StructField(c, T.LongType()) for c in ("low", "start")),
                           T.StructField("n", T.IntegerType()), T.StructField("inside", T.BooleanType()), T.StructField("p1", T.LongType()), T.StructField("p2", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2):
            for group in _pieces(b.column(2).to_pylist(), length):
                rows, start, n, low, inside, p1, p2 = _phrases_of(group, length)
                if len(rows):
                    i = pa.array(rows)
                    yield batch(("id", b.column(0).take(i)), ("text_hash", b.column(1).take(i)),
                                ("low", pa.array(low.view(np.int64))), ("start", pa.array(start)),
                                ("n", pa.array(n.astype(np.int32))), ("inside", pa.array(inside)), ("p1", pa.array(p1.view(np.int64))),
                                ("p2", pa.array(p2.view(np.int64))))

    return docs.mapInArrow(run, schema)


class RunLengthIndex:
    """The run-compressed Burrows-Wheeler transform of distinct strings, with sampled run ends.

    Every string ends in a terminator of its own, all smaller than any byte.
    ``first`` and ``last`` are the text positions of the suffixes at the two
    ends of every run.
    """

    PACK = 7  # symbols of 9 bits in one sorting key

    def __init__(self, strings: list[bytes]):
        sizes = np.array([len(s) + 1 for s in strings], np.int64)
        self.ends = np.cumsum(sizes) - 1  # of the terminators
        text = np.zeros(int(sizes.sum()), np.uint16)
        inside = np.ones(len(text), bool)
        inside[self.ends] = False
        text[inside] = np.frombuffer(b"".join(strings), np.uint8).astype(np.uint16) + 1
        # symbols before the terminator
        self.left = np.repeat(self.ends.astype(np.int32), sizes) - np.arange(len(text), dtype=np.int32)
        order = self._sorted(text)
        before = text[order - 1]
        same = (before[1:] == before[:-1]) & (before[1:] > 0)  # terminators differ from each other
        self.head = np.concatenate([[True], ~same])
        self.symbols = before[self.head]
        self.first = order[self.head]
        self.last = order[np.append(np.flatnonzero(self.head)[1:] - 1, len(order) - 1)]

    def _sorted(self, text: np.ndarray) -> np.ndarray:
        """The suffix array, by prefix doubling from packed keys; only undecided suffixes are sorted again."""
        n, pack = len(text), self.PACK
        key = np.zeros(n, np.int64)
        alive = np.ones(n, bool)
        padded = np.concatenate([text, np.zeros(pack, text.dtype)])
        for i in range(pack):
            symbol = padded[i:i + n] * alive
            key <<= 9
            key |= symbol
            alive &= symbol > 0
        self.key = key
        order = np.argsort(key, kind="stable").astype(np.int32)
        k = key[order]
        ended = self.left[order] < pack  # equal up to their terminators: in text order, and decided
        new = np.ones(n, bool)
        new[1:] = (k[1:] != k[:-1]) | ended[1:] | ended[:-1]
        rank = np.empty(n, np.int32)
        rank[order] = np.maximum.accumulate(np.where(new, np.arange(n, dtype=np.int32), 0))
        h, longest = pack, int(self.left.max())
        while h <= longest:
            single = new & np.append(new[1:], True)
            todo = np.flatnonzero(~single)  # places in the suffix array
            if not len(todo):
                break
            s = order[todo]
            second = rank[s + h]
            group = rank[s]
            by = np.argsort(group.astype(np.int64) * n + second, kind="stable")
            s, group, second = s[by], group[by], second[by]
            order[todo] = s
            ended = self.left[s] < 2 * h
            fresh = np.ones(len(s), bool)
            fresh[1:] = (group[1:] != group[:-1]) | (second[1:] != second[:-1]) | ended[1:] | ended[:-1]
            new[todo] = fresh
            rank[s] = np.maximum.accumulate(np.where(fresh, todo, 0))
            h *= 2
        return order

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the common prefixes of suffixes, terminators excluded."""
        out = np.zeros(len(a), np.int64)
        most = np.minimum(self.left[a], self.left[b])
        live = np.arange(len(a))
        while len(live):
            x = self.key[a[live] + out[live]] ^ self.key[b[live] + out[live]]
            equal = x == 0
            # symbols before the first that differs
            lead = sum((x < (1 << 9 * (self.PACK - j))).astype(np.int64) for j in range(1, self.PACK))
            out[live] += np.where(equal, self.PACK, lead)
            live = live[equal & (out[live] < most[live])]
        return np.minimum(out, most)

    def matching_statistics(self) -> np.ndarray:
        """For every position: the longest match of its suffix with any other suffix."""
        n = len(self.left)
        above, below = self.last[:-1], self.first[1:]  # neighbours across a run boundary
        common = self._common(above, below)
        longest = np.zeros(n, np.int32)
        for at in (above, below):
            reach = np.zeros(n, np.int32)
            reach[at] = at + common
            longest = np.maximum(longest, np.maximum.accumulate(reach))
        return np.maximum(longest - np.arange(n, dtype=np.int32), 0)


def _marked(strings: list[bytes], copies: np.ndarray, windows: np.ndarray, length: int) -> np.ndarray:
    """For each string, one after the other: whether each of its windows has another place."""
    index = RunLengthIndex(strings)
    long_enough = index.matching_statistics() >= length
    starts = np.append(0, index.ends[:-1] + 1)
    at = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows - starts, windows)
    return long_enough[at] | np.repeat(copies > 1, windows)


def _runs(marks: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, first window, number of windows) of the runs of marked windows."""
    string = np.repeat(np.arange(len(windows)), windows)
    at = np.arange(len(marks)) - np.repeat(np.cumsum(windows) - windows, windows)
    new = marks.copy()
    new[1:] &= ~marks[:-1] | (string[1:] != string[:-1])
    starts = np.flatnonzero(new)
    runs = np.add.reduceat(marks, starts, dtype=np.int64) if len(starts) else np.zeros(0, np.int64)
    return string[starts], at[starts], runs


MARKS = "low bigint, n int, p1 bigint, p2 bigint, at int, run int"


def _indexed(length: int):
    """A function on batches (low, n, p1, p2, copies, phrase) sorted by low: marked runs of windows."""

    def work(rows: list[tuple]) -> pa.RecordBatch | None:
        windows = np.array([r[1] for r in rows], np.int64)
        marks = _marked([r[5] for r in rows], np.array([r[4] for r in rows]), windows, length)
        string, at, run = _runs(marks, windows)
        if not len(string):
            return None
        pick = lambda c, kind: pa.array(np.array([r[c] for r in rows], np.int64)[string], kind)
        return batch(("low", pick(0, pa.int64())), ("n", pa.array(windows[string], pa.int32())), ("p1", pick(2, pa.int64())),
                     ("p2", pick(3, pa.int64())), ("at", pa.array(at, pa.int32())), ("run", pa.array(run, pa.int32())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        for b in batches:
            for r in zip(*(b.column(i).to_pylist() for i in range(6))):
                if size > INDEX_BYTES and rows[-1][0] != r[0]:  # whole groups only
                    out = work(rows)
                    rows, size = [], 0
                    if out is not None:
                        yield out
                rows.append(r)
                size += len(r[5]) + 1
        if rows and (out := work(rows)) is not None:
            yield out

    return run


def _window_rows(length: int):
    """A function on the same batches: two hashes of every single window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            windows = b.column(1).to_numpy().astype(np.int64)
            for i in range(b.num_rows):
                prefix = _prefixes(np.frombuffer(b.column(5)[i].as_py(), np.uint8))
                at = np.arange(windows[i])
                own = [pa.array(np.full(len(at), b.column(c)[i].as_py()), pa.int32() if c == 1 else pa.int64()) for c in range(5)]
                yield batch(*zip(("low", "n", "p1", "p2", "copies"), own), ("at", pa.array(at, pa.int32())),
                            *((f"w{j}", pa.array(_span_hash(prefix[j], at, at + length).view(np.int64))) for j in (0, 1)))

    return run


def repeats(docs: DataFrame, length: int = LENGTH, group_cap: int = GROUP_CAP) -> DataFrame:
    """``(id, text_hash, spans)`` of ``docs (id, text_hash, bytes)``: covered spans, not yet merged."""
    spark = docs.sparkSession
    n_tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    every = stored(phrases(docs, length), "phrases")
    often = stored(every.groupBy("low").agg(F.count(F.lit(1)).alias("c"), F.bool_or("inside").alias("inside")).where(
        "c > 1 or inside").select("low"), "repeated-hashes")
    found = stored(every.join(broadcast_if_small(often, row_bytes=32), "low", "left_semi"), "repeated-phrases")
    key = ("low", "n", "p1", "p2")
    distinct = stored(found.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"),
                                              F.min(F.struct("id", "text_hash", "start")).alias("place")), "distinct-phrases")
    # one place of every distinct phrase is read from its document
    wanted = distinct.select(*key, "copies", "place.*").groupBy("id", "text_hash").agg(
        F.collect_list(F.struct(*key, "copies", "start")).alias("wanted"))
    texts = docs.withColumnRenamed("id", "doc").withColumnRenamed("text_hash", "doc_hash")
    cut = texts.join(wanted, (F.col("doc_hash") == F.col("text_hash")) & F.col("doc").eqNullSafe(F.col("id"))).select(
        "bytes", F.explode("wanted").alias("w")).select(
        "w.low", "w.n", "w.p1", "w.p2", "w.copies",
        F.substring("bytes", (F.col("w.start") + 1).cast("int"), F.col("w.n") + length - 1).alias("phrase"))
    # a document that is there twice yields its phrases twice
    sizes = distinct.groupBy("low").agg(F.count(F.lit(1)).alias("c"))
    large = stored(sizes.where(F.col("c") > group_cap).select("low"), "large-groups")
    any_large = not large.isEmpty()
    big = broadcast_if_small(large, row_bytes=32)
    kept = stored(cut, "phrase-texts") if any_large else cut
    index_rows = kept.join(big, "low", "left_anti") if any_large else kept
    marks = index_rows.repartition(n_tasks, "low").sortWithinPartitions(*key).mapInArrow(_once(_indexed(length)), MARKS)
    if any_large:
        single = kept.join(big, "low", "left_semi").dropDuplicates(list(key)).mapInArrow(
            _window_rows(length), "low bigint, n int, p1 bigint, p2 bigint, copies bigint, at int, w0 bigint, w1 bigint")
        places = F.sum("copies").over(W.partitionBy("low", "w0", "w1"))
        marks = marks.unionByName(single.withColumn("places", places).where("places > 1").select(*key, "at", F.lit(1).alias("run")))
    spans = found.join(marks, list(key)).select("id", "text_hash", F.struct(
        (F.col("start") + F.col("at")).alias("a"), (F.col("start") + F.col("at") + F.col("run") + length - 1).alias("z")).alias("s"))
    return spans.groupBy("id", "text_hash").agg(F.collect_list("s").alias("spans"))


def _once(work):
    """``work`` on rows sorted by key, of which equal neighbours come once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def distinct():
            last = None
            for b in batches:
                keys = list(zip(*(b.column(i).to_pylist() for i in range(4))))
                keep = [k != p for k, p in zip(keys, [last, *keys])]
                last = keys[-1] if keys else last
                yield b if all(keep) else b.filter(pa.array(keep))
        yield from work(distinct())

    return run


def _merged(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, z in sorted((s["a"], s["z"]) for s in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], z)
        else:
            out.append([a, z])
    return [(a, z) for a, z in out]


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                 group_cap: int = GROUP_CAP) -> DataFrame:
    """``(id, n_bytes, removed, kept)``: removed spans ``array<struct<start, length>>`` and the remaining bytes."""
    x = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_hash"),
                    F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("bytes"))
    found = stored(repeats(x, length, group_cap), "repeats").select(F.col("id").alias("rid"), F.col("text_hash").alias("rh"), "spans")
    y = x.join(found, (F.col("text_hash") == F.col("rh")) & F.col("id").eqNullSafe(F.col("rid")), "left").select("id", "bytes", "spans")
    schema = T.StructType([T.StructField("id", x.schema["id"].dataType), T.StructField("n_bytes", T.LongType()),
                           *T._parse_datatype_string("removed array<struct<start:bigint,length:bigint>>, kept binary").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
        for b in slices(batches, 1):
            removed, kept, sizes = [], [], []
            for data, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                gone = _merged(spans or ())
                edges = [0, *(e for s in gone for e in s), len(data)]
                removed.append([{"start": a, "length": z - a} for a, z in gone])
                kept.append(b"".join(data[a:z] for a, z in zip(edges[::2], edges[1::2])) if gone else data)
                sizes.append(len(data))
            yield batch(("id", b.column(0)), ("n_bytes", pa.array(sizes, pa.int64())), ("removed", pa.array(removed, kind)),
                        ("kept", pa.array(kept, pa.binary())))

    return y.mapInArrow(run, schema)
