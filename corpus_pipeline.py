"""A corpus pipeline over ``documents``: five stages, each one operator of ``marquee.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that its
predecessor kept.  All but the last return the columns of ``docs``.  ``run``
writes each stage's result to the shared folder before the next stage reads
it, so a lost executor never costs more than the stage it was in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import bpe, decontaminate, line_dedup, quality_rules, simhash
from marquee.llm.common import stored, table
from marquee.llm.queries import VOCABULARY


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality rules or their host's verdict reject."""
    return quality_rules.keep_good(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes cross-site boilerplate lines; every document stays."""
    out = line_dedup.line_dedup(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of every group of near copies."""
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that contain a benchmark item."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces the text by its token ids, and says whether they decode to it."""
    return bpe.tokenized(docs, VOCABULARY)


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", simhash_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("bpe", bpe_stage),
]

#: SimHash and BPE are not expressible in SQL; tests/llm/test_pipeline.py holds the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
