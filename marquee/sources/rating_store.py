"""An append-only store of ratings, placed by user and by movie, with whole appends.

Every append writes its rows twice, bucketed and sorted by ``userId`` and by
``movieId``, into folders of its own, and then publishes a manifest, a numbered file
that names all appends that count.  Readers take the newest manifest: an append that
failed half way is in no manifest, so nobody sees a part of it, and of two appends that
publish at the same time one finds its number taken and publishes after the other.

Rows of one user (of one movie) are in one bucket of every append, so what groups or
joins by that column needs no shuffle of the ratings.  ``compact`` writes all appends
as one; readers that hold the old manifest keep its files.

Defined cases: null ids are rows of one bucket; repeated rows stay; columns that an
append lacks are null, others are ignored; an empty append is an append of no rows; an
empty store reads as an empty table.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEYS = ("userId", "movieId")


class RatingStore:
    """The store in the folder ``root``; ``schema`` holds ``userId``, ``movieId`` and further columns."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, buckets: int = 64):
        self.spark, self.root, self.schema, self.buckets = spark, root.rstrip("/"), schema, buckets
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    # -- manifests
    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def version(self) -> int:
        """The number of the newest manifest, 0 before the first."""
        folder = self._path("manifest")
        fs = folder.getFileSystem(self._conf)
        if not fs.exists(folder):
            return 0
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=0)

    def appends(self, version: int | None = None) -> list[str]:
        """The appends that the manifest names, oldest first."""
        version = self.version() if version is None else version
        if version == 0:
            return []
        return json.loads(self.spark.read.text(f"{self.root}/manifest/{version:012d}.json", wholetext=True).first()[0])

    def _publish(self, number: int, appends: list[str]) -> bool:
        """Writes manifest ``number`` as a whole; False if there is one."""
        temp, target = self._path(f"manifest/_{uuid.uuid4().hex}"), self._path(f"manifest/{number:012d}.json")
        out = temp.getFileSystem(self._conf).create(temp, False)
        out.write(bytearray(json.dumps(appends).encode()))
        out.close()
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        try:
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(temp.toUri(), self._conf).rename(temp, target, options)
        except Exception as e:
            temp.getFileSystem(self._conf).delete(temp, False)
            if isinstance(e, PySparkException) or "FileAlreadyExists" not in str(e):
                raise
            return False
        return True

    # -- writing
    def stage(self, rows: DataFrame) -> str:
        """Writes the files of an append; it counts only after ``publish``."""
        name = uuid.uuid4().hex
        have = set(rows.columns)
        rows = rows.select([(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.schema])
        for key in KEYS:
            (rows.repartition(self.buckets, key).write.bucketBy(self.buckets, key).sortBy(key)
             .option("path", f"{self.root}/appends/{name}/{key}").format("parquet").saveAsTable(self._table(name, key)))
        return name

    def publish(self, name: str) -> int:
        """Makes a staged append visible; the number of its manifest."""
        while True:
            now = self.version()
            if self._publish(now + 1, [*self.appends(now), name]):
                return now + 1

    def append(self, rows: DataFrame) -> int:
        return self.publish(self.stage(rows))

    def compact(self) -> int:
        """All appends as one; raises if another append was published meanwhile (nothing is lost, repeat it)."""
        now = self.version()
        if not self._publish(now + 1, [self.stage(self.read("userId", now))]):
            raise RuntimeError("an append was published during the compaction")
        return now + 1

    # -- reading
    @staticmethod
    def _table(name: str, key: str) -> str:
        return f"ratings_{name}_{key.lower()}"

    def _open(self, name: str, key: str) -> DataFrame:
        table = self._table(name, key)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) "
                       f"INTO {self.buckets} BUCKETS LOCATION '{self.root}/appends/{name}/{key}'")
        return self.spark.table(table)

    def read(self, key: str = "userId", version: int | None = None) -> DataFrame:
        """All ratings of a manifest (the newest), placed by ``key``."""
        if key not in KEYS:
            raise ValueError(f"key must be one of {KEYS}")
        parts = [self._open(name, key) for name in self.appends(version)]
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], self.schema)
