"""Materialising derived tables once per application.

A derived input (e.g. ratings built from a join and an aggregate) that several
branches of a plan read would otherwise be recomputed by each branch: column
pruning and pushed filters make the branches differ, so Spark cannot reuse one
shuffle for all of them.  ``materialize`` writes the table once:

* to ``<spark.checkpoint.dir>/marquee-tables/<application id>/<name>-<plan>``
  when the cluster names a shared checkpoint folder (survives lost executors,
  and the read-back scan gets Parquet pushdown and column pruning);
* otherwise it persists the DataFrame (memory, then the executors' own disks,
  as Spark's cache does; a lost block is recomputed from lineage).

Stored tables are known by the session's application, the name and the plan, so
two different frames under one name are two tables.  The files behind a plan
are taken as fixed while the application runs; after a change call ``release``,
which also frees what was stored.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from marquee.session import CHECKPOINT_CONF

_LOCK = threading.RLock()
#: Spark's own clean-up of an execution's shuffle files when it ends (from 4.1 on; others ignore it).
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@dataclass
class _Stored:
    source: DataFrame
    table: DataFrame
    path: str | None


_TABLES: dict[tuple[str, str], list[_Stored]] = {}
_MEMOS: dict[tuple[str, str], object] = {}


def shared_folder(spark) -> str | None:
    """The shared folder the session names, or None."""
    sc = spark.sparkContext
    return spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()


@contextmanager
def _freed_shuffles(spark) -> Iterator[None]:
    """What is written inside leaves no shuffle files behind (else they stay until the driver happens to collect
    its garbage, and pile up beside those of later steps)."""
    before = spark.conf.get(CLEANUP_CONF, None)
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_CONF)
        else:
            spark.conf.set(CLEANUP_CONF, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Compute ``df`` once per application and plan; return the stored table.

    A failing write is raised: what it says about the data or the folder must
    not be hidden behind a second computation.
    """
    spark = df.sparkSession
    key = (spark.sparkContext.applicationId, name)
    with _LOCK:
        same = _TABLES.setdefault(key, [])
        for s in same:
            if s.source.sameSemantics(df):
                return s.table
        folder, path = shared_folder(spark), None
        if folder:
            safe = "".join(c if c.isalnum() or c in "-_." else "_" for c in name)
            path = f"{folder.rstrip('/')}/marquee-tables/{key[0]}/{safe}-{len(same)}"
            with _freed_shuffles(spark):
                df.write.mode("overwrite").parquet(path)
            out = spark.read.schema(df.schema).parquet(path)
        else:
            out = df.persist(StorageLevel.MEMORY_AND_DISK)
        same.append(_Stored(df, out, path))
        return out


def release(spark, name: str | None = None) -> int:
    """Forget and delete the stored tables of this application (all, or those under ``name``)."""
    app, n = spark.sparkContext.applicationId, 0
    with _LOCK:
        for key in [k for k in _TABLES if k[0] == app and name in (None, k[1])]:
            for s in _TABLES.pop(key):
                n += 1
                if s.path is None:
                    s.table.unpersist()
                else:
                    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(s.path)
                    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        for key in [k for k in _MEMOS if k[0] == app and name in (None, k[1])]:
            del _MEMOS[key]
    return n


def memoize(spark, name: str, build):
    """Per-application memo for non-table artefacts (e.g. a trained model)."""
    key = (spark.sparkContext.applicationId, name)
    with _LOCK:
        if key not in _MEMOS:
            _MEMOS[key] = build()
        return _MEMOS[key]
