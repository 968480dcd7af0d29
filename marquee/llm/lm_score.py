"""Language-model scores from a log-frequency Bloom filter (operator 2).

Tokens are the words of a text (A-Z in lower case) and one end after them.  The
model holds the counts of single tokens and of pairs of neighbours (the end of
a text stands before its first word).  Counts are quantised to levels, the steps
of a ladder 1, 2, 3, ... whose steps grow by ``STEP`` once that is more than one;
an n-gram of level q is in the filter q times, as (n-gram, 1) ... (n-gram, q), and
a count is read by probing the levels until one is missing.  The probability of a
token w after h mixes the pair's share with the token's own, with more weight on
the latter the fewer h was seen:

    p(w)   = (c(w) + 1) / Z,  Z = the sum of c + 1 over the training words and the unknown word
    p(w|h) = (c(h w) + k p(w)) / (c(h) + SURPLUS + k),  k = c(h) ** VARIETY;  p(w) where h is unknown

c(w) and c(h w) are read from the filter; the true counts, which the base score needs
anyway, normalise: Z sums the levels' values, c(h) is true, and c(h w) is at most
c(h) and the true c(w), so a pair with an unknown word has none.  A pair that was never
seen but is found in the filter would add to the sum of p(w|h) over w.  The first level
therefore has as many probes as keep the expected number of such pairs at ``SURPLUS``
for a history, whatever the vocabulary (``first_words``), and that number is part of
the denominator.  So the probabilities sum to 1 but for the rounding of counts.

The base score is exact: ``sum log10((c + 1) / (N + V + 1))`` with the true
training counts of the words.

How it runs: texts are packed into chunks of about ``CHUNK_BYTES`` with a
dictionary and compressed token numbers, written once.  The dictionaries are
exploded, one row per chunk and word; the counts of a word are summed over its
rows and go back to the chunks, one list per chunk.  The distinct n-grams
of a chunk, with their counts in its training texts, are shuffled once as sorted binary
blocks, one per chunk and shard.  Every shard adds them up to its own part of the filter
and writes that and the blocks to the shared folder, by runs of shards of up to
``PASS_BYTES``; the filter grows with the distinct n-grams.  The runs are sent to the
workers one after the other, and the pass of a run reads the blocks of that run only and
writes one level for each n-gram; the texts are scored from the levels.  So the passes
together read every block once, however many passes there are.

Defined cases: null and empty texts consist of the end; without training rows
all counts are zero; rows are scored one by one, so repeated rows, null ids and
other columns need no rule; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.arrow import batch
from marquee.llm.common import new_folder, read_back, remove, stored, written

CHUNK_BYTES = 32 << 20
STEP = 1.2  # the ratio of neighbouring levels
VARIETY = 0.8
#: Expected number of pairs that a history was never seen with, but that the filter holds.
SURPLUS = 1 / 32
#: Bits of one 64-bit word that an entry sets, and bits of the filter for each such word: about half are set.
MARKS = 6
WORD_BITS = 9
#: About 1 in 2 ** SIEVE absent entries passes one word (measured: 1 in 38).
SIEVE = 5.2
#: Bytes of the filter that are sent to the workers at once.
PASS_BYTES = 128 << 20
SHARD_KEYS = 1 << 20
#: Tokens scored at once.
BLOCK = 1 << 18
#: Bytes of a key in a block of n-grams, below the bits that name the shard.
KEY_BYTES = 6
END = "\n"  # no word has white space in it

U = np.uint64


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x ^ U(salt)) * U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return _mix(before * U(0xC2B2AE3D27D4EB4F) + word, 2)


def _ladder() -> np.ndarray:
    out = [1]
    while out[-1] < 1 << 45:
        out.append(max(out[-1] + 1, math.ceil(out[-1] * STEP)))
    return np.array(out, np.int64)


LADDER = _ladder()
#: The count that stands for a level: the middle of the counts that have it.
VALUES = np.concatenate([[0.0], (LADDER[:-1] + LADDER[1:] - 1) / 2])


def levels(counts: np.ndarray) -> np.ndarray:
    """The number of steps of the ladder that are not above the count."""
    return np.minimum(np.searchsorted(LADDER, counts, side="right"), len(VALUES) - 1)


def first_words(vocabulary: int) -> int:
    """Words that the first level of an n-gram is probed in, so that ``SURPLUS`` false pairs a history are expected."""
    return max(1, math.ceil(math.log2(max(2, vocabulary) / SURPLUS) / SIEVE))


class Filter:
    """Shards of the Bloom filter, one after the other in ``words``; an n-gram of another shard has level 0."""

    def __init__(self, parts: list[tuple[int, bytes]], shift: int, first: int):
        sizes = np.zeros(1 << shift, np.int64)
        for shard, data in parts:
            sizes[shard] = len(data) // 8
        self.shift, self.first = shift, first
        self.at, self.size = np.cumsum(sizes) - sizes, sizes.astype(np.uint64)
        self.words = np.zeros(int(sizes.sum()), np.uint64)
        for shard, data in parts:
            a = int(self.at[shard])
            self.words[a:a + len(data) // 8] = np.frombuffer(data, np.uint64)

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """Dequantised counts."""
        return VALUES[self.levels(keys)]

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Levels are probed until one is missing."""
        if len(keys) > BLOCK:
            return np.concatenate([self.levels(keys[i:i + BLOCK]) for i in range(0, len(keys), BLOCK)])
        level = np.zeros(len(keys), np.int64)
        shard = shard_of(keys, self.shift)
        at, size = self.at[shard], self.size[shard]
        live = np.flatnonzero(size > 0)
        n = 0
        while len(live) and n < len(VALUES) - 1:
            n += 1
            for j in range(self.first if n == 1 else 1):
                place, marks = probe(keys[live], n, j, size[live])
                live = live[(self.words[at[live] + place] & marks) == marks]
            level[live] = n
        return level


def shard_of(keys: np.ndarray, shift: int) -> np.ndarray:
    return (keys >> U(64 - shift)).astype(np.int64) if shift else np.zeros(len(keys), np.int64)


def probe(keys: np.ndarray, level, j: int, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ``j``-th word of (n-gram, level) among ``size`` words (up to 2 ** 32), and the bits it sets there."""
    k = keys + np.asarray(level).astype(np.uint64) * U(0xA0761D6478BD642F)
    h, m = _mix(k, 11 + 36 * j), _mix(k, 29 + 36 * j)
    marks = np.zeros(len(keys), np.uint64)
    for i in range(MARKS):
        marks |= U(1) << ((m >> U(6 * i)) & U(63))
    return (((h >> U(32)) * size) >> U(32)).astype(np.int64), marks


def shard_bits(keys: np.ndarray, counts: np.ndarray, first: int) -> bytes:
    """One shard's part of the filter from distinct keys and their counts: ``WORD_BITS`` for each word of each level."""
    q = levels(counts)
    words = np.zeros((int(q.sum()) + (first - 1) * len(keys)) * WORD_BITS // 64 + 1, np.uint64)
    size = np.full(len(keys), len(words), np.uint64)
    for n in range(1, int(q.max(initial=0)) + 1):
        has = q >= n
        for j in range(first if n == 1 else 1):
            place, marks = probe(keys[has], n, j, size[has])
            np.bitwise_or.at(words, place, marks)
    return words.tobytes()


CHUNKS = "n_words array<bigint>, numbers binary, words array<string>, hashes binary, counts array<bigint>, n_tokens bigint"


def chunks(docs: DataFrame) -> DataFrame:
    """Chunks of ``docs (id, train, text)``: ``(chunk, ids, train, n_words, numbers, words, hashes, counts, n_tokens)``.

    ``numbers``: places in ``words`` of all words of all texts, compressed;
    ``counts``: training counts of ``words``, whose first entry is the end.
    """
    kind = docs.schema["id"].dataType
    schema = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("ids", T.ArrayType(kind)),
                           T.StructField("train", T.ArrayType(T.BooleanType())), *T._parse_datatype_string(CHUNKS).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from xxhash import xxh64_intdigest
        ids, train, place, per_doc, size = [], [], {END.encode(): 0}, [], 0

        def flush() -> pa.RecordBatch:
            n = np.fromiter(map(len, per_doc), np.int64, len(per_doc))
            numbers = np.concatenate(per_doc) if per_doc else np.zeros(0, np.uint32)
            learn = np.array(train, bool)
            counts = np.bincount(numbers[np.repeat(learn, n)], minlength=len(place))
            counts[0] = learn.sum()
            words = list(place)
            hashes = np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))
            one = lambda x, t: pa.array([x], t)
            return batch(
                ("chunk", one(random.getrandbits(63), pa.int64())), ("ids", pa.ListArray.from_arrays(pa.array([0, len(n)], pa.int32()), pa.concat_arrays(ids))),
                ("train", one(train, pa.list_(pa.bool_()))), ("n_words", one(n, pa.list_(pa.int64()))),
                ("numbers", one(zstandard.compress(numbers.astype("<u4").tobytes(), 1), pa.binary())),
                ("words", one([w.decode("utf-8", "replace") for w in words], pa.list_(pa.string()))),
                ("hashes", one(hashes.tobytes(), pa.binary())), ("counts", one(counts, pa.list_(pa.int64()))),
                ("n_tokens", one(int(n.sum()) + len(n), pa.int64())))

        for b in batches:
            for i, (flag, text) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist())):
                words = text.encode("utf-8").lower().split() if text else []
                for w in dict.fromkeys(words):
                    place.setdefault(w, len(place))
                per_doc.append(np.fromiter(map(place.__getitem__, words), np.uint32, len(words)))
                ids.append(b.column(0).slice(i, 1))
                train.append(bool(flag))
                size += len(text) if text else 1
                if size >= CHUNK_BYTES:
                    yield flush()
                    ids, train, place, per_doc, size = [], [], {END.encode(): 0}, [], 0
        if ids:
            yield flush()

    return docs.mapInArrow(run, schema)


def _unpacked(numbers: bytes, n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, word before, text) of every token of a chunk, the ends included; the end is number 0."""
    import zstandard
    raw = np.frombuffer(zstandard.decompress(numbers), "<u4")
    n = n_words + 1
    total = int(n.sum())
    doc = np.repeat(np.arange(len(n), dtype=np.int32), n)
    word = np.zeros(total, np.int32)
    inner = np.ones(total, bool)
    inner[np.cumsum(n) - 1] = False
    word[inner] = raw
    before = np.zeros(total, np.int32)
    before[1:] = word[:-1]  # before a text's first word stands the end of the text before, number 0
    return word, before, doc


def _grams(hashes: np.ndarray, word: np.ndarray, before: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct n-grams of a chunk (sorted), where its words are among them, and where the pairs of its tokens are."""
    one = rounded(_mix(hashes, 1), shift)
    two = rounded(pair_keys(hashes[before], hashes[word]), shift)
    keys, place = np.unique(np.concatenate([one, two]), return_inverse=True)
    return keys, place[:len(one)], place[len(one):]


def gram_blocks(packed: DataFrame, shift: int) -> DataFrame:
    """``(chunk, shard, keys, counts)``: the distinct n-grams of a chunk in a shard, and how often its training texts hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                learn = np.array(b.column(1)[i].as_py(), bool)
                n_words = np.array(b.column(2)[i].as_py(), np.int64)
                hashes = np.frombuffer(b.column(4)[i].as_py(), np.uint64)
                own = np.array(b.column(5)[i].as_py(), np.int64)
                word, before, doc = _unpacked(b.column(3)[i].as_py(), n_words)
                keys, at_one, at_two = _grams(hashes, word, before, shift)
                counts = np.bincount(at_two[learn[doc]], minlength=len(keys))
                np.add.at(counts, at_one, own)
                cuts = np.searchsorted(shard_of(keys, shift), np.arange((1 << shift) + 1))
                for shard in np.flatnonzero(np.diff(cuts)):
                    a, z = cuts[shard], cuts[shard + 1]
                    yield batch(("chunk", b.column(0).slice(i, 1)), ("shard", pa.array([shard], pa.int32())),
                                ("keys", pa.array([squeezed(keys[a:z], shift)], pa.binary())),
                                ("counts", pa.array([planes(counts[a:z], 6)], pa.binary())))

    return packed.select("chunk", "train", "n_words", "numbers", "hashes", "counts").mapInArrow(
        run, "chunk bigint, shard int, keys binary, counts binary")


def planes(x: np.ndarray, width: int) -> bytes:
    """Whole numbers below 256 ** width, byte plane after byte plane, compressed."""
    import zstandard
    return zstandard.compress(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes(), 1)


def from_planes(data: bytes, width: int) -> np.ndarray:
    import zstandard
    raw = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(width, -1)
    out = np.zeros((raw.shape[1], 8), np.uint8)
    out[:, :width] = raw.T
    return out.view("<u8").ravel()


def squeezed(keys: np.ndarray, shift: int) -> bytes:
    """Sorted keys as differences of the ``KEY_BYTES`` below the shard's bits (modulo their range, where a shard ends)."""
    low = keys << U(shift) >> U(64 - 8 * KEY_BYTES)
    return planes(np.diff(low, prepend=U(0)) & U((1 << 8 * KEY_BYTES) - 1), KEY_BYTES)


def full_keys(shard: int, data: bytes, shift: int) -> np.ndarray:
    """The keys of a block, without the bits that ``rounded`` drops."""
    low = np.cumsum(from_planes(data, KEY_BYTES), dtype=np.uint64) & U((1 << 8 * KEY_BYTES) - 1)
    keys = low << U(64 - 8 * KEY_BYTES) >> U(shift)
    return keys | (U(shard) << U(64 - shift) if shift else U(0))


def rounded(keys: np.ndarray, shift: int) -> np.ndarray:
    """The bits of a key that the blocks keep."""
    drop = max(0, 64 - 8 * KEY_BYTES - shift)
    return keys >> U(drop) << U(drop)


def build_filter(packed: DataFrame, first: int, pass_bytes: int = PASS_BYTES) -> tuple[DataFrame, str, int]:
    """``(shard, chunk, keys, bits, run)`` in a new folder, that folder, and the number of bits that name a shard.

    Rows with ``bits`` are the filter of the training texts of all chunks, those with ``keys`` the
    n-grams that a chunk asks for.  A run is as many neighbouring shards as ``pass_bytes`` allows.
    """
    tokens = packed.agg(F.sum("n_tokens")).first()[0] or 0
    shift = max(0, math.ceil(math.log2(max(1, tokens) / SHARD_KEYS)))
    together = max(1, pass_bytes // (SHARD_KEYS * WORD_BITS * (first + 1) // 8))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, keys, counts = None, [], []

        def row(shard: int, chunk, asked: bytes | None, bits: bytes | None) -> pa.RecordBatch:
            return batch(("shard", pa.array([shard], pa.int32())), ("chunk", pa.array([chunk], pa.int64())),
                         ("keys", pa.array([asked], pa.binary())), ("bits", pa.array([bits], pa.binary())),
                         ("run", pa.array([shard // together], pa.int32())))

        def part() -> pa.RecordBatch:
            k, c = np.concatenate(keys), np.concatenate(counts)
            distinct, inverse = np.unique(k, return_inverse=True)
            total = np.bincount(inverse, c).astype(np.int64)
            return row(last, None, None, shard_bits(distinct, total, first))

        for b in batches:
            for i in range(b.num_rows):
                shard, asked = b.column(1)[i].as_py(), b.column(2)[i].as_py()
                if shard != last and last is not None:
                    yield part()
                    keys, counts = [], []
                last = shard
                k, c = full_keys(shard, asked, shift), from_planes(b.column(3)[i].as_py(), 6).astype(np.int64)
                keys.append(k[c > 0])
                counts.append(c[c > 0])
                yield row(shard, b.column(0)[i].as_py(), asked, None)
        if last is not None:
            yield part()

    n = int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = gram_blocks(packed, shift).repartition(n, "shard").sortWithinPartitions("shard").mapInArrow(
        run, "shard int, chunk bigint, keys binary, bits binary, run int")
    path = written(parts, "lm-filter", partition_by="run")
    return read_back(parts, path), path, shift


def loaded(parts: DataFrame, shift: int, first: int, run: int | None = None) -> Filter:
    """The filter of one run of shards (None: of all)."""
    parts = parts.where(F.col("bits").isNotNull() & (F.lit(True) if run is None else F.col("run") == run))
    got = parts.select("shard", "bits").toArrow()
    return Filter(list(zip(got.column("shard").to_pylist(), got.column("bits").to_pylist())), shift, first)


def pass_levels(asked: DataFrame, filt: Broadcast) -> DataFrame:
    """``(chunk, shard, levels)``: one byte for each n-gram that a chunk asks of a shard."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        f: Filter = filt.value
        for b in batches:
            for i in range(b.num_rows):
                found = f.levels(full_keys(b.column(1)[i].as_py(), b.column(2)[i].as_py(), f.shift)).astype(np.uint8)
                yield batch(("chunk", b.column(0).slice(i, 1)), ("shard", b.column(1).slice(i, 1)),
                            ("levels", pa.array([zstandard.compress(found.tobytes(), 1)], pa.binary())))

    return asked.where(F.col("keys").isNotNull()).select("chunk", "shard", "keys").mapInArrow(
        look, "chunk bigint, shard int, levels binary")


def probabilities(one, two, alone_total: float, past: np.ndarray, own: np.ndarray) -> np.ndarray:
    """p(w|h) from the filter's counts of w and of the pair, and the true counts of h (``past``) and w (``own``)."""
    alone = (one + 1) / alone_total
    pair = np.minimum(two, np.minimum(past, own))
    k = past ** VARIETY
    return np.where(past > 0, (pair + k * alone) / np.maximum(past + SURPLUS + k, 1), alone)


def _value_sum(exact: DataFrame) -> float:
    """The sum over the training words of the counts that their levels stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = b.column(0).flatten().to_numpy(zero_copy_only=False)
            yield batch(("value", pa.array([float(VALUES[levels(own.astype(np.int64))].sum())], pa.float64())))

    return exact.select("own").mapInArrow(run, "value double").agg(F.sum("value")).first()[0] or 0.0


def lm_score(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text",
             pass_bytes: int = PASS_BYTES) -> DataFrame:
    """``(id, n_tokens, n_known, train_tokens, base_score, score)``; rows where ``train`` is true are learned from."""
    x = docs.select(F.col(id_col).alias("id"), F.coalesce(train, F.lit(False)).alias("train"), F.col(text_col).alias("text"))
    packed = stored(chunks(x), "lm-chunks")
    sc = docs.sparkSession.sparkContext
    words = packed.select("chunk", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "w")).select(
        "chunk", "at", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    # a word has one row per chunk: its count is summed where these rows meet, and one of them names it
    by_word = W.partitionBy("word")
    words = words.select("chunk", "at", F.sum("n").over(by_word).alias("c"),
                         (F.row_number().over(by_word.orderBy("chunk")) == 1).alias("first")).where("c > 0")
    exact = stored(words.groupBy("chunk").agg(F.collect_list("at").alias("known_at"), F.collect_list("c").alias("known"),
                                              F.collect_list(F.when(F.col("first"), F.col("c"))).alias("own")), "lm-counts")
    types = exact.agg(F.sum(F.size("own"))).first()[0] or 0
    sums = packed.select(F.aggregate("counts", F.lit(0).cast("long"), lambda a, v: a + v).alias("n")).agg(F.sum("n")).first()[0] or 0
    alone_total = _value_sum(exact) + types + 1
    first = first_words(types)
    parts, filter_path, shift = build_filter(packed, first, pass_bytes)
    spark = docs.sparkSession
    found_path = new_folder(spark, "lm-levels")
    for r in sorted(x.run for x in parts.select("run").distinct().collect()):
        sent = sc.broadcast(loaded(parts, shift, first, r))
        pass_levels(parts.where(F.col("run") == r), sent).write.parquet(f"{found_path}/run={r}", compression="uncompressed")
        sent.destroy()
    remove(spark, filter_path)
    found = spark.read.schema("chunk bigint, shard int, levels binary, run int").parquet(found_path) if packed.take(1) \
        else spark.createDataFrame([], "chunk bigint, shard int, levels binary, run int")
    every = found.groupBy("chunk").agg(F.collect_list(F.struct("shard", "levels")).alias("found"))
    rows = packed.select("chunk", "ids", "n_words", "numbers", "hashes").join(exact.drop("own"), "chunk", "left").join(every, "chunk", "left")
    rows = rows.select("ids", "n_words", "numbers", "hashes", "known_at", "known", "found")
    schema = T.StructType([T.StructField("id", x.schema["id"].dataType), *T._parse_datatype_string(
        "n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        floor = math.log10(sums + types + 1)
        for b in batches:
            for i in range(b.num_rows):
                n_words = b.column(1)[i].values.to_numpy().astype(np.int64)
                hashes = np.frombuffer(b.column(3)[i].as_py(), np.uint64)
                true = np.zeros(len(hashes))
                if b.column(4)[i].is_valid:
                    true[b.column(4)[i].values.to_numpy()] = b.column(5)[i].values.to_numpy()
                word, before, doc = _unpacked(b.column(2)[i].as_py(), n_words)
                n = len(n_words)
                _, at_one, at_two = _grams(hashes, word, before, shift)
                by_shard = sorted((x["shard"], x["levels"]) for x in b.column(6)[i].as_py())
                level = np.frombuffer(b"".join(zstandard.decompress(x) for _, x in by_shard), np.uint8)
                one = VALUES[level[at_one]]
                base, known, score, total = np.log10(true + 1) - floor, np.zeros(n), np.zeros(n), np.zeros(n)
                for a in range(0, len(word), BLOCK):
                    w, h, d = word[a:a + BLOCK], before[a:a + BLOCK], doc[a:a + BLOCK]
                    p = probabilities(one[w], VALUES[level[at_two[a:a + BLOCK]]], alone_total, true[h], true[w])
                    low, size = int(d[0]), int(d[-1]) - int(d[0]) + 1
                    for out, v in ((score, np.log10(p)), (total, base[w]), (known, (true > 0)[w])):
                        out[low:low + size] += np.bincount(d - low, v, size)
                yield batch(("id", b.column(0)[i].values), ("n_tokens", pa.array(n_words + 1)),
                            ("n_known", pa.array(known.astype(np.int64))), ("train_tokens", pa.array([sums] * n, pa.int64())),
                            ("base_score", pa.array(total)), ("score", pa.array(score)))

    return rows.mapInArrow(run, schema)
