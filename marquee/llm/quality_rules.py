"""Quality rules with host verdicts (operator 7).  DataFrame functions only.

Every document is measured in its own row (no shuffle).  The failures of each
rule are summed by host; a host's failure rate is shrunk towards the rate of
all hosts with an empirical beta prior (method of moments over the hosts'
rates), so that a host with three pages is not judged on three pages.  A host
whose shrunk rate of any rule is above ``host_limit`` is bad.  The verdicts,
one row per host, are joined back to the documents.

A document is kept if it fails neither a base rule (fewer than ``min_words``
words, more than half of the words in repeated 3-word windows) nor the symbol
rule (more than ``max_symbol_ratio`` of ``# * $ % & | < >`` per word), and its
host is not bad.

Defined cases: null text has no words and fails; an empty table gives an empty
result; null hosts share no site, so they get no host verdict and are judged
by their own rules; repeated rows are each measured and each returned; other
columns, whatever their names, are neither read nor returned.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import (BLANK_CLASS, WORD_CHAR_CLASS, broadcast_if_small, fresh, let,
                                stored, words_of)

SYMBOLS = "#*$%&|<>"
WINDOW = 3
MIN_WORDS = 50
MAX_SYMBOL_RATIO = 0.1
MAX_DUP_LINE_RATIO = 0.3
HOST_LIMIT = 0.5
RULES = ("few_words", "repeats", "symbols", "dup_lines")


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur at least twice in the array.

    The windows' 64-bit hashes are compared within one text.  Only a text
    that has a repeated hash is sorted; the positions of its repeated windows
    then give the covered words, each counted once.
    """
    def covered(hashes: Column) -> Column:
        by_hash = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(s: Column) -> Column:
            twice = F.filter(s, lambda x, k: F.coalesce(x["h"] == F.get(s, k - 1)["h"], F.lit(False))
                             | F.coalesce(x["h"] == F.get(s, k + 1)["h"], F.lit(False)))
            return F.sort_array(F.transform(twice, lambda x: x["i"]))

        def union_length(p: Column) -> Column:
            steps = F.transform(p, lambda x, k: F.least(
                F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW))).cast("long"))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

        return let(let(by_hash, positions), union_length)

    def of_words(w: Column) -> Column:
        last = F.size(w) - WINDOW + 1
        hashes = F.slice(F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))),
                         F.lit(1), F.greatest(last, F.lit(0)))
        return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long"))
                   .otherwise(covered(h)))

    return let(words, of_words)


def measures(text: Column) -> Column:
    """A struct of what the rules need from one text."""
    t = F.coalesce(text, F.lit(""))
    words = words_of(t)
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD_CHAR_CLASS))
    word_chars = F.length(F.regexp_replace(t, BLANK_CLASS + "+", "")).cast("long")
    symbols = F.length(F.regexp_replace(t, "[^#*$%&|<>]+", "")).cast("long")
    n_words = F.size(words).cast("long")
    return F.struct(
        n_words.alias("n_words"), word_chars.alias("word_chars"), symbols.alias("n_symbols"),
        let(lines, lambda v: F.struct(
            F.size(v).cast("long").alias("n"),
            (F.size(v) - F.size(F.array_distinct(v))).cast("long").alias("dup"))).alias("lines"),
        _repeat_words(words).alias("n_repeat_words"))


def base_failed(m: Column, min_words: int = MIN_WORDS) -> Column:
    return (m["n_words"] < min_words) | (m["n_repeat_words"] * 100 > m["n_words"] * 50)


def failures(m: Column, min_words: int = MIN_WORDS, max_symbols: float = MAX_SYMBOL_RATIO,
             max_dup_lines: float = MAX_DUP_LINE_RATIO) -> dict[str, Column]:
    """One boolean per rule, never null."""
    return {
        "few_words": m["n_words"] < min_words,
        "repeats": m["n_repeat_words"] * 100 > m["n_words"] * 50,
        "symbols": m["n_symbols"] > m["n_words"] * F.lit(max_symbols),
        "dup_lines": m["lines"]["dup"] > m["lines"]["n"] * F.lit(max_dup_lines),
    }


def host_verdicts(measured: DataFrame, host: str, m: str, host_limit: float = HOST_LIMIT) -> DataFrame:
    """``(host, n_docs, <rule>_rate..., bad)``: shrunk failure rates by host.

    The prior of a rule has mean ``mu`` (failures of all hosts over all their
    documents) and the strength that the spread of the hosts' raw rates
    implies: ``mu (1 - mu) / var - 1``, within [1, 10^6].  One row with the
    priors is attached to the hosts; nothing is collected.
    """
    rules = failures(F.col(m))
    hosts = measured.where(F.col(host).isNotNull()).groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("n_docs"),
        *[F.sum(c.cast("long")).alias(f"{r}_n") for r, c in rules.items()])
    prior = hosts.agg(*[c for r in rules for c in (
        (F.sum(f"{r}_n") / F.sum("n_docs")).alias(f"{r}_mu"),
        F.var_pop(F.col(f"{r}_n") / F.col("n_docs")).alias(f"{r}_var"))])
    x = hosts.join(F.broadcast(prior), F.lit(True))  # one row: not a cross join that grows
    rates = []
    for r in rules:
        mu, var = F.col(f"{r}_mu"), F.col(f"{r}_var")
        strength = F.when(var > 0, F.greatest(F.lit(1.0), F.least(F.lit(1e6), mu * (1 - mu) / var - 1))) \
                    .otherwise(F.lit(1e6))
        rates.append(((F.col(f"{r}_n") + strength * mu) / (F.col("n_docs") + strength)).alias(f"{r}_rate"))
    x = x.select("host", "n_docs", *rates)
    return x.withColumn("bad", reduce(lambda a, b: a | b, [F.col(f"{r}_rate") > host_limit for r in rules]))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  host_col: str = "source", host_limit: float = HOST_LIMIT) -> DataFrame:
    """One row per document: its measures, ``base_failed``, the host's verdict and ``kept``."""
    m = stored(docs.select(F.col(id_col).alias("id"), F.col(host_col).alias("host"),
                           measures(F.col(text_col)).alias("m")), "quality")
    bad = _bad_hosts(m, "host", "m", host_limit)
    out = m.join(bad, m["host"] == bad["bad_host"], "left")
    mm = F.col("m")
    failed = base_failed(mm)
    return out.select(
        F.col("id").alias(id_col), mm["n_words"].alias("n_words"), mm["word_chars"].alias("word_chars"),
        mm["n_symbols"].alias("n_symbols"), mm["lines"]["dup"].alias("n_dup_lines"),
        mm["n_repeat_words"].alias("n_repeat_words"), failed.alias("base_failed"),
        F.col("bad_host").isNotNull().alias("host_bad"),
        (~failed & ~failures(mm)["symbols"] & F.col("bad_host").isNull()).alias("kept"))


def _bad_hosts(measured: DataFrame, host: str, m: str, host_limit: float) -> DataFrame:
    bad = host_verdicts(measured, host, m, host_limit).where("bad").select(F.col("host").alias("bad_host"))
    return broadcast_if_small(stored(bad, "bad-hosts"), row_bytes=512)


def keep_good(docs: DataFrame, text_col: str = "text", host_col: str = "source",
              host_limit: float = HOST_LIMIT) -> DataFrame:
    """The rows of ``docs`` that are kept, with the columns of ``docs``.

    The measures are written beside the rows once, so that the second pass
    (after the host verdicts) does not measure again.
    """
    col, = fresh(docs, "measures")
    m = stored(docs.withColumn(col, measures(F.col(text_col))), "measured")
    bad = _bad_hosts(m, host_col, col, host_limit)
    good = m.where(~base_failed(F.col(col)) & ~failures(F.col(col))["symbols"])
    return good.join(bad, good[host_col] == bad["bad_host"], "left_anti").select(docs.columns)
