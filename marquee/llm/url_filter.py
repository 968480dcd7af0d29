"""URL verdicts: rules by host and path, then a list of canonical URLs behind a blocked Bloom filter.

``url_filter`` gives every row of a table of pages one verdict:

1. The address is split into host and path.  The longest rule that fits
   decides.  Rules are configuration (a Python list) and become literals of
   the plan.
2. An address without a rule is brought to canonical form (``canonical``) and
   looked up in ``listed``, a table of listed canonical URLs of any size.  A
   blocked Bloom filter of the list (one block of 512 bits for a key, one bit
   in each of its 8 words) is asked first.  Only possible hits go on to an
   exact hash join with the list, which removes the filter's false positives.

At scale: the filter is built by aggregation (an OR by block), so neither the
list nor the filter passes through the driver.  Its blocks reach the pages by
a broadcast join if their number, which follows from the counted list, proves
that they fit into ``BROADCAST_BYTES``; a longer list is joined without the
filter, with the same result.  A page that the filter turns away is never
shuffled.  The exact join is a broadcast if count and longest key prove that
the list is small; otherwise pages are salted and the list is repeated
``SALTS`` times, so that a listed address with a third of all rows is spread.

Awkward input: a null address, or one without ``://``, has empty host and path,
no rule and no canonical form, and is allowed.  The same holds for an address
with an empty host, except that rules never fit it.  Repeated rows stay and
get one verdict each; null ids are kept.  Repeated and null keys of the list
count once or not at all.  Of rules of equal length the one with the longer
host wins, then a block.  Empty tables give no rows.  Only the named columns
are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import BROADCAST_BYTES, lower_ascii, stored

ALLOW, BLOCK = "allow", "block"
WORDS = 8
#: Bits of the filter for each listed key.
KEY_BITS = 16
#: Odd multipliers, one for each word of a block: the powers of one odd number.
MULTIPLIERS = tuple(pow(0x9E3779B1, i, 1 << 32) for i in range(1, WORDS + 1))
#: What a block costs in a broadcast hash table, at most.
BLOCK_BYTES = 256
#: Ways in which rows of one key are spread in a shuffled join.
SALTS = 16
#: Host labels that name a variant of the same site.
MIRRORS = ("www.", "m.")
#: Query parameters that do not select content: names, or beginnings of names that end in ``*``.
TRACKING = ("utm_*", "ref", "gclid", "fbclid")


def split_url(url: Column) -> tuple[Column, Column, Column]:
    """Host (A-Z in lower case), path and query of an address."""
    # the host ends at the first of / ? #; what precedes "://" may hold any of them
    after = F.when(url.contains("://"), url.substr(F.instr(url, "://") + 3, F.length(url)))
    after = F.coalesce(after, F.lit(""))
    host = lower_ascii(F.regexp_extract(after, r"\A([^/?#]*)", 1))
    path = F.regexp_extract(after, r"\A[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(after, r"\A[^?#]*\?([^#]*)", 1)
    return host, path, query


def canonical(url: Column) -> Column:
    """Canonical form, null for an address without a host.

    No scheme and fragment; the host in lower case without a mirror label and
    a default port; the path without ``index.html``, ``.html`` and a final
    slash; the query without tracking parameters and empty ones, sorted.
    """
    host, path, query = split_url(url)
    host = F.regexp_replace(host, r":(80|443)\z", "")
    host = F.regexp_replace(host, r"\A(" + "|".join(m.replace(".", r"\.") for m in MIRRORS) + ")", "")
    path = F.regexp_replace(path, r"/index\.html\z", "/")
    path = F.regexp_replace(F.regexp_replace(path, r"\.html\z", ""), r"/+\z", "")

    def tracks(p):
        name = F.substring_index(p, "=", 1)
        tests = [name.startswith(t[:-1]) if t.endswith("*") else name == t for t in TRACKING]
        out = p == ""
        for t in tests:
            out = out | t
        return out

    kept = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda p: ~tracks(p))), "&")
    key = F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit("")))
    return F.when(host != "", key)


def rule_order(rules: Sequence[tuple[str, str]]) -> list[tuple[str, str, str, str]]:
    """Rules ``(host/path, verdict)`` as ``(rule, host, path, verdict)``, the one that wins first."""
    parts = []
    for rule, verdict in rules:
        host, slash, path = rule.partition("/")
        if not host or not slash or verdict not in (ALLOW, BLOCK):
            raise ValueError(f"not a rule: {rule!r}, {verdict!r}")
        parts.append((rule, host.translate(_LOWER), slash + path, verdict))
    return sorted(parts, key=lambda p: (-len(p[0]), -len(p[1]), p[3] != BLOCK))


_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict (nulls without one)."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule, at, start, says in reversed(rule_order(rules)):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(start)
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def _block(h: Column, n_blocks: int) -> Column:
    """The block of a 64-bit hash: its upper half scaled to the number of blocks."""
    return F.shiftrightunsigned(F.shiftrightunsigned(h, 32) * F.lit(n_blocks).cast("bigint"), 32)


def _bits(h: Column) -> list[Column]:
    """For each word of a block the one bit that a hash sets, as a mask."""
    low = h.bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint"))
    out = []
    for m in MULTIPLIERS:
        mixed = (low.bitwiseAND(F.lit(0xFFFF).cast("bigint")) * F.lit(m).cast("bigint")
                 + F.shiftleft((F.shiftrightunsigned(low, 16) * F.lit(m).cast("bigint")).bitwiseAND(
                     F.lit(0xFFFF).cast("bigint")), 16)).bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint"))
        at = F.shiftrightunsigned(mixed, 26).cast("int")
        out.append(F.call_function("shiftleft", F.lit(1).cast("bigint"), at))
    return out


def bloom_blocks(keys: DataFrame, key: str, n_blocks: int) -> DataFrame:
    """The filter as a table ``(block, w0 .. w7)``: one row for each block with a key."""
    h = F.xxhash64(F.col(key))
    x = keys.select(_block(h, n_blocks).alias("block"), *[b.alias(f"w{i}") for i, b in enumerate(_bits(h))])
    return x.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def may_hold(df: DataFrame, key: str, blocks: DataFrame, n_blocks: int, out: str) -> DataFrame:
    """``df`` with a boolean ``out``: false only if no listed key equals ``key``."""
    h = F.xxhash64(F.col(key))
    x = df.withColumn("_block", F.when(F.col(key).isNotNull(), _block(h, n_blocks)))
    x = x.join(F.broadcast(blocks.withColumnRenamed("block", "_block")), "_block", "left")
    held = F.col(key).isNotNull()
    for i, b in enumerate(_bits(h)):
        held = held & (F.coalesce(F.col(f"w{i}"), F.lit(0).cast("bigint")).bitwiseAND(b) != 0)
    return x.withColumn(out, held).drop("_block", *[f"w{i}" for i in range(WORDS)])


def url_filter(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str]] = (), *, id_col: str = "page_id",
               url_col: str = "url", key_col: str = "key", key_bits: int = KEY_BITS,
               limit: int = BROADCAST_BYTES) -> DataFrame:
    """``(id, url, host, path, rule, key, listed, verdict)``, one row for each page.

    ``listed`` holds canonical URLs in ``key_col`` (see ``canonical``).  ``listed``
    in the result is true if the page has no rule and its canonical URL is on
    the list; ``verdict`` is the rule's, else ``block`` for a listed address
    and ``allow`` for any other.
    """
    keys = stored(listed.select(F.col(key_col).alias("key")).where(F.col("key").isNotNull()).distinct(), "listed-urls")
    n, longest = keys.agg(F.count(F.lit(1)), F.coalesce(F.max(F.octet_length("key")), F.lit(0))).first()

    url = F.col("url")
    host, path, _ = split_url(url)
    x = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")).withColumns({"host": host, "path": path})
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    x = x.withColumns({"rule": rule, "_says": says, "key": canonical(url)})
    x = x.withColumn("_ask", F.when(F.col("rule").isNull(), F.col("key")))

    n_blocks = max(1, -(-n * key_bits // (64 * WORDS)))
    if n_blocks * BLOCK_BYTES <= limit:
        x = may_hold(x, "_ask", bloom_blocks(keys, "key", n_blocks), n_blocks, "_possible")
    else:
        x = x.withColumn("_possible", F.col("_ask").isNotNull())
    out = ["id", "url", "host", "path", "rule", "_says", "key"]
    away = x.where(~F.col("_possible")).select(*out, F.lit(False).alias("listed"))
    near = x.where("_possible").select(*out, "_ask")
    found = keys.select(F.col("key").alias("_ask"), F.lit(True).alias("_on"))
    if n * (longest + BLOCK_BYTES) <= limit:
        near = near.join(F.broadcast(found), "_ask", "left")
    else:
        near = near.withColumn("_salt", F.pmod(F.xxhash64("id", "url"), F.lit(SALTS)).cast("int"))
        found = found.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        near = near.join(found, ["_ask", "_salt"], "left")
    near = near.select(*out, F.coalesce("_on", F.lit(False)).alias("listed"))
    both = away.unionByName(near)
    verdict = F.coalesce("_says", F.when(F.col("listed"), F.lit(BLOCK)).otherwise(F.lit(ALLOW)))
    return both.select("id", "url", "host", "path", "rule", "key", "listed", verdict.alias("verdict"))


def junk_urls(pages: DataFrame, pattern: str, least: int, *, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(key)``: canonical URLs of the pages whose markup matches ``pattern`` at least ``least`` times."""
    hits = F.regexp_count(F.coalesce(F.col(html_col), F.lit("")), F.lit(pattern))
    return pages.where(hits >= least).select(canonical(F.col(url_col)).alias("key")).where(F.col("key").isNotNull()).distinct()
