"""Training-order materialisation of token sequences (operator 4).

Texts are encoded, closed by an end-of-text token, and cut into sequences of
``seq_len`` tokens (the last one of a text is filled up with that token).  The
sequences are numbered 0 to N - 1, and a keyed Feistel permutation of the
numbers, walked along its cycles until the value is below N, gives every
sequence its global slot: a training order that needs no sort by random values
and can be computed, or inverted, for any single sequence.

Range partitions of the slots write the shards.  A shard holds ``per_shard``
neighbouring slots as one binary value of fixed stride, ``seq_len`` times
``width`` bytes (2 for vocabularies up to 65,536 ids, else 4; little-endian), so
slot s is at byte ``(s - first_slot) * stride`` of shard ``s // per_shard`` and
a reader resumes at any slot with one seek.  Shards are rows of a Parquet
folder, committed by Spark, so a lost executor leaves no torn shard.

The numbering follows the order in which the table is read (task, then row);
it is written once with the tokens, so repeated tasks cannot change it.

Defined cases: null and empty texts are one sequence with the end token only;
repeated rows are sequences of their own; a null id is kept as it is; an empty
table writes no shard and gives an empty index; other columns, whatever their
names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.arrow import batch, binary, slices
from marquee.llm.bpe import Encoder, load_vocabulary
from marquee.llm.common import broadcast_if_small, stored

SEQ_LEN = 512
PER_SHARD = 4096
ROUNDS = 6
END_TOKEN = "<|endoftext|>"


def _round(x: np.ndarray, key: int, r: int, mask: np.uint64) -> np.ndarray:
    h = (x + np.uint64((key * 0x9E3779B97F4A7C15 + r * 0xD1B54A32D192ED03) % 2**64)) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return (h ^ (h >> np.uint64(29))) & mask


def permuted(numbers: np.ndarray, n: int, key: int, inverse: bool = False) -> np.ndarray:
    """The keyed permutation of 0 .. n - 1, or its inverse."""
    half = max(1, ((max(n - 1, 1)).bit_length() + 1) // 2)
    shift, mask = np.uint64(half), np.uint64((1 << half) - 1)
    out = numbers.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> shift, out[todo] & mask
        for r in reversed(range(ROUNDS)) if inverse else range(ROUNDS):
            if inverse:
                left, right = right ^ _round(left, key, r, mask), left
            else:
                left, right = right, left ^ _round(right, key, r, mask)
        out[todo] = left << shift | right
        todo = todo[out[todo] >= n]  # outside: one step further along the cycle
    return out.astype(np.int64)


def sequences(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", seq_len: int = SEQ_LEN) -> DataFrame:
    """``(task, row, id, seq, n_tokens, ids)``; ids: the tokens as little-endian integers, not filled up."""
    v = docs.sparkSession.sparkContext.broadcast(load_vocabulary(docs.sparkSession, path))
    end, width = v.value["special"][END_TOKEN], id_width(v.value)
    schema = T.StructType([T.StructField("task", T.IntegerType()), T.StructField("row", T.LongType()),
                           T.StructField("id", docs.schema[id_col].dataType), T.StructField("seq", T.IntegerType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, task, row = Encoder(v.value), TaskContext.get().partitionId(), 0
        for b in slices(batches, 1):
            ids, ends = e.encode(b.column(1).to_pylist())
            ids = np.insert(ids, ends, end)  # behind every text
            n = np.diff(ends, prepend=0) + 1
            count = -(-n // seq_len)
            doc = np.repeat(np.arange(len(n)), count)
            seq = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            size = np.minimum(seq_len, n[doc] - seq * seq_len)
            yield batch(("task", pa.array(np.full(len(doc), task), pa.int32())), ("row", pa.array(row + np.arange(len(doc)))),
                        ("id", b.column(0).take(pa.array(doc))), ("seq", pa.array(seq, pa.int32())),
                        ("n_tokens", pa.array(size, pa.int64())),
                        ("ids", binary(ids.astype(f"<u{width}").tobytes(), np.cumsum(size) * width)))
            row += len(doc)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def id_width(vocabulary: dict) -> int:
    return 2 if max(vocabulary["vocab"]) < 1 << 16 else 4


def write_shards(docs: DataFrame, path: str, out: str, key: int, id_col: str = "doc_id", text_col: str = "text",
                 seq_len: int = SEQ_LEN, per_shard: int = PER_SHARD) -> DataFrame:
    """Writes the shards to the folder ``out``; returns the index ``(id, seq, n_tokens, slot, shard)``."""
    spark = docs.sparkSession
    v = load_vocabulary(spark, path)
    width, fill = id_width(v), v["special"][END_TOKEN]
    stride = seq_len * width
    tokens = stored(sequences(docs, path, id_col, text_col, seq_len), "sequences", "zstd")
    by_task = tokens.groupBy("task").agg(F.count(F.lit(1)).alias("n"))  # one row per task
    offset = by_task.select("task", (F.sum("n").over(W.orderBy("task")) - F.col("n")).alias("offset"))
    total = tokens.count()

    @F.pandas_udf(T.LongType())
    def slot_of(number):
        return type(number)(permuted(number.to_numpy(), total, key))

    number = (F.col("offset") + F.col("row"))
    offset = broadcast_if_small(stored(offset, "task-offsets"), row_bytes=64)
    placed = tokens.join(offset, "task").withColumn("slot", slot_of(number)).withColumn(
        "shard", F.floor(F.col("slot") / per_shard).cast("long"))
    index = stored(placed.select("id", "seq", "n_tokens", "slot", "shard"), "shard-index")
    pad = np.full(seq_len, fill, f"<u{width}").tobytes()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, first, parts = None, 0, []

        def done() -> pa.RecordBatch:
            return batch(("shard", pa.array([shard], pa.int64())), ("first_slot", pa.array([first], pa.int64())),
                         ("n", pa.array([len(parts)], pa.int32())), ("stride", pa.array([stride], pa.int32())),
                         ("payload", pa.array([b"".join(parts)], pa.binary())))

        for b in batches:
            for s, slot, ids in zip(*(b.column(i).to_pylist() for i in range(3))):
                if s != shard:
                    if parts:
                        yield done()
                    shard, first, parts = s, slot, []
                parts.append(ids + pad[len(ids):])
        if parts:
            yield done()

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed.select("shard", "slot", "ids").repartitionByRange(n, "shard").sortWithinPartitions("slot").mapInArrow(
        pack, "shard bigint, first_slot bigint, n int, stride int, payload binary").write.parquet(out, compression="zstd")
    return index


def read_slots(spark: SparkSession, out: str, first: int = 0, last: int | None = None) -> DataFrame:
    """``(slot, ids)`` of the slots from ``first`` to before ``last``; ids: one stride of bytes."""
    x = spark.read.schema("shard bigint, first_slot bigint, n int, stride int, payload binary").parquet(out)
    x = x.where((F.col("first_slot") + F.col("n") > first) & (F.lit(True) if last is None else F.col("first_slot") < last))
    y = x.select("first_slot", "stride", "payload", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("k"))
    z = y.select((F.col("first_slot") + F.col("k")).alias("slot"),
                 F.substring("payload", F.col("k") * F.col("stride") + 1, F.col("stride")).alias("ids"))
    return z.where((F.col("slot") >= first) & (F.lit(True) if last is None else F.col("slot") < last))
