"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"

#: Largest estimated size of a side that is sent to every executor.
BROADCAST_BYTES = 64 << 20

#: The white space that ends a word: space and the ASCII codes 9 to 13.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_CLASS = r"[\x20\x09-\x0D]"
WORD_CHAR_CLASS = r"[^\x20\x09-\x0D]"


def scratch_folder(spark: SparkSession) -> str:
    """The folder all executors share: the session's ``spark.checkpoint.dir``.

    Only where that setting is unset *and* the session is a single local JVM
    (tests) a temporary folder is registered instead; otherwise this raises.
    """
    sc = spark.sparkContext
    folder = sc.getConf().get(CHECKPOINT_CONF, None) or spark.conf.get(CHECKPOINT_CONF, None)
    if folder:
        return folder.rstrip("/")
    if sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="marquee-llm-"))
    return sc.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other call gets."""
    return f"{scratch_folder(spark)}/marquee-llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """``df`` written once as Parquet in the shared folder, and read from there.

    This cuts the lineage: what follows survives lost executors without
    repeating the work behind ``df``, and several readers share it.
    """
    return read_back(df, written(df, name, codec))


def written(df: DataFrame, name: str, codec: str = "snappy", partition_by: str | None = None) -> str:
    """The new folder to which ``df`` was written; ``remove`` frees it once it was read."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path, partitionBy=partition_by, compression=codec)
    return path


def read_back(df: DataFrame, path: str) -> DataFrame:
    """What ``written`` wrote, without a look at the files for the schema."""
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete one folder that ``new_folder`` named, through the file system that holds it."""
    if "/marquee-llm/" not in path:
        raise ValueError(f"not a scratch folder: {path}")
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names made from ``names`` that ``df`` does not have (in any case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def let(value: Column, body) -> Column:
    """``body(v)`` with ``v`` evaluated once, however often the body uses it.

    An expression that a higher-order function refers to would otherwise be
    evaluated again for every element.
    """
    return F.transform(F.array(value), lambda v: body(v))[0]


def words_of(text: Column) -> Column:
    """The words of a text, an empty array for null or blank text."""
    t = F.btrim(text, F.lit(BLANKS))
    return F.when(F.length(F.coalesce(t, F.lit(""))) == 0, F.array().cast("array<string>")) \
            .otherwise(F.split(t, BLANK_CLASS + "+"))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def broadcast_if_small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if a count proves that it fits, else as it is.

    ``row_bytes`` is the largest size of one row.  Without the mark the join
    is planned as usual (sort merge, skew split by adaptive execution).
    """
    top = limit // row_bytes
    few = df.limit(top + 1).count() <= top
    return F.broadcast(df) if few else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
