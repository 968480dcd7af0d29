"""Removal of lines that many sites share (operator 8).

A line is identified by the MD5 of its text without surrounding blanks.  The
sites of each line are counted by HyperLogLog sketches, which are built before
the shuffle and merge by aggregation, so a line that a third of all documents
has is one small sketch per task.  Lines whose estimate lies within ``BAND`` of
the threshold are counted exactly.  A line on at least ``min_sites`` sites is
boilerplate: its first occurrence (smallest id, text hash and position) stays,
so that of a document copied to many sites one copy keeps its text; every
other occurrence is removed.

Defined cases: null text stays null; lines of fewer than ``min_words`` words
(blank ones among them) are never removed; a null site is no site; a null id
comes first; rows that are equal in id and text are one document and keep the
same lines; an empty table gives an empty result; other columns, whatever
their names, stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import BLANK_CLASS, BLANKS, broadcast_if_small, fresh, let, stored

MIN_SITES = 5
MIN_WORDS = 3
LG_K = 10
#: Share of the threshold within which a sketch does not decide: three times
#: the relative error of a sketch with 2**LG_K registers (1.04 / sqrt(k)).
BAND = 3 * 1.04 / 2 ** (LG_K / 2)


def _lines(docs: DataFrame, id_col: str, text_col: str, site_col: str, min_words: int) -> DataFrame:
    x = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_hash"),
                    F.col(site_col).cast("string").alias("site"),
                    F.posexplode(F.split(F.col(text_col), "\n")).alias("pos", "line"))
    line = F.btrim("line", F.lit(BLANKS))
    return x.select("id", "text_hash", "site", "pos", F.unhex(F.md5(line)).alias("key"),
                    F.size(F.split(line, BLANK_CLASS + "+")).alias("n")).where(
        F.col("n") >= min_words).drop("n")


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``(key, sites, first)`` of the lines on at least ``min_sites`` sites."""
    first = F.min(F.struct("id", "text_hash", "pos")).alias("first")
    by_key = lines.groupBy("key").agg(F.hll_sketch_agg("site", LG_K).alias("sketch"), first,
                                      F.count("site").alias("n")).where(F.col("n") >= min_sites)
    est = stored(by_key.select("key", "first", F.hll_sketch_estimate("sketch").alias("sites")), "line-spread")
    low, high = min_sites * (1 - BAND) - 1, min_sites * (1 + BAND) + 1
    near = est.where(F.col("sites").between(low, high))
    # distinct (line, site) pairs first: a hot line leaves each task as few rows
    exact = lines.join(broadcast_if_small(near.select("key"), row_bytes=64), "key", "left_semi").select(
        "key", "site").where(F.col("site").isNotNull()).distinct().groupBy("key").agg(F.count("site").alias("exact"))
    counted = near.join(exact, "key").select("key", "first", F.col("exact").alias("sites"))
    return est.where(F.col("sites") > high).unionByName(counted).where(F.col("sites") >= min_sites)


def removed_positions(docs: DataFrame, id_col: str, text_col: str, site_col: str,
                      min_sites: int = MIN_SITES, min_words: int = MIN_WORDS) -> DataFrame:
    """``(id, text_hash, gone)``: sorted 0-based positions of the lines to remove, per document that has any."""
    lines = stored(_lines(docs, id_col, text_col, site_col, min_words), "lines")
    bad = stored(boilerplate(lines, min_sites), "boilerplate")
    hit = lines.join(broadcast_if_small(bad, row_bytes=128), "key").where(
        ~F.struct("id", "text_hash", "pos").eqNullSafe(F.col("first")))
    return hit.groupBy("id", "text_hash").agg(F.sort_array(F.collect_set("pos")).alias("gone"))


def _kept(text: Column, gone: Column) -> Column:
    """The lines between the removed positions, joined again; linear in the text."""
    def cut(lines: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.size(gone)), lambda k: F.slice(
            lines, F.coalesce(F.get(gone, k - 1), F.lit(-1)) + 2,
            F.coalesce(F.get(gone, k), F.size(lines)) - F.coalesce(F.get(gone, k - 1), F.lit(-1)) - 1))
        return F.array_join(F.flatten(parts), "\n")

    return F.when(gone.isNull(), text).otherwise(let(F.split(text, "\n"), cut))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
               min_sites: int = MIN_SITES, min_words: int = MIN_WORDS, removed_col: str | None = None) -> DataFrame:
    """``docs`` with the boilerplate lines removed from the text; all rows and columns stay.

    ``removed_col`` names an additional column with the number of removed lines.
    """
    gone = stored(removed_positions(docs, id_col, text_col, site_col, min_sites, min_words), "removed-lines")
    h, gid, gh, gp = fresh(docs, "text_hash", "gone_id", "gone_hash", "gone_at")
    # the documents with lines to remove are a share of all: one sort-merge join at every size
    g = gone.hint("merge").select(F.col("id").alias(gid), F.col("text_hash").alias(gh), F.col("gone").alias(gp))
    x = docs.withColumn(h, F.xxhash64(F.col(text_col)))
    x = x.join(g, (x[h] == g[gh]) & x[id_col].eqNullSafe(g[gid]), "left")
    out = [(_kept(F.col(text_col), F.col(gp)).alias(c) if c == text_col else F.col(c)) for c in docs.columns]
    if removed_col:
        out.append(F.coalesce(F.size(F.col(gp)), F.lit(0)).cast("long").alias(removed_col))
    return x.select(*out)
