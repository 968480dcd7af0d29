"""Op 11 against a brute-force version, with and without the filter, and on awkward addresses."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from marquee.llm import url_filter as U

RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
LISTED = ["example.com/bad", "example.com", "a.org/x?page=2", "blog.example.com/b/c", None, "example.com/bad"]
URLS = [
    "https://example.com/bad", "http://WWW.Example.com:80/bad/#x", "https://m.example.com/bad.html?utm_source=a&ref=x",
    "https://example.com/bad?page=2", "http://a.org/x?utm_id=1&page=2&", "http://a.org/x?page=3", "https://example.com",
    "https://example.com/index.html", "https://example.com?ref=1", "https://example.net", "https://example.net/", "https://a.example.net/en/1",
    "https://notexample.net/en/1", "https://xnet/", "https://net/", "http://b.example.com/de/9", "http://b.example.com/deu/9",
    "ftp://x.org/fr/", "ftp://x.org/FR/", "no address", "", None, "://", ":///p", "a?b://c.net/d", "https://c.net:8080/d", "https://c.net?x=/y",
    "https://blog.example.com/b/c//", "https://Ä.net/ö", "https://a.b/\n/c\n", "https://example.com/" + "x" * 100_000, "mailto:x@example.net",
] + [f"https://h{i}.example.com/p{i % 7}/{i}" for i in range(300)]


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.split(r"[/?#]", rest)[0]
    path = re.split(r"[?#]", rest[len(host):])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(r, v) for r, v in RULES
            if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/"):])]
    rule, says = max(fits, key=lambda f: len(f[0]), default=(None, None))
    query = rest.split("#")[0].partition("?")[2]
    kept = [p for p in query.split("&") if p and not (p.startswith("utm_") or p.split("=")[0] in ("ref", "gclid", "fbclid"))]
    at = re.sub(r"^(www\.|m\.)", "", re.sub(r":(80|443)\Z", "", host))
    at += re.sub(r"/+\Z", "", re.sub(r"\.html\Z", "", re.sub(r"/index\.html\Z", "/", path)))
    key = (at + ("?" + "&".join(sorted(kept)) if kept else "")) if host else None
    return host, path, rule, key, says or ("block" if key in LISTED and key is not None else "allow")


@pytest.mark.parametrize("options", [{}, {"limit": 0}, {"limit": 1000}, {"key_bits": 1}])
def test_against_brute_force(spark, options):
    rows = [(i % 50 if i % 9 else None, u, "clash", "clash") for i, u in enumerate(URLS * 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string").repartition(3)
    listed = spark.createDataFrame([(k,) for k in LISTED + [f"site{i}.com/x" for i in range(200)]], "key string")
    got = U.url_filter(pages, listed, RULES, **options)
    assert got.columns == ["id", "url", "host", "path", "rule", "key", "listed", "verdict"]
    have = sorted(((r["id"], r["url"], r["host"], r["path"], r["rule"], r["key"], r["verdict"]) for r in got.collect()), key=repr)
    want = sorted(((r[0], r[1], *brute(r[1])) for r in rows), key=repr)
    assert have == want
    assert {r["verdict"] for r in got.collect() if r["listed"]} == {"block"}


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    n_blocks = -(-20_000 * U.KEY_BITS // 512)
    blocks = U.bloom_blocks(keys, "key", n_blocks)
    assert blocks.count() <= n_blocks
    assert U.may_hold(keys, "key", blocks, n_blocks, "p").where("not p").count() == 0
    others = spark.range(20_000).select(F.concat(F.lit("other"), "id").alias("key"))
    wrong = U.may_hold(others, "key", blocks, n_blocks, "p").where("p").count()
    assert wrong < 200  # about 0.1 % expected at 16 bits a key


def test_empty_tables_and_rules(spark):
    pages = spark.createDataFrame([(1, "https://a.net/")], "page_id long, url string")
    none = spark.createDataFrame([], "key string")
    assert U.url_filter(pages, none).first()["verdict"] == "allow"
    assert U.url_filter(pages.limit(0), none, RULES).count() == 0
    with pytest.raises(ValueError):
        U.rule_order([("nohost", "block")])


def test_rule_order():
    order = [r[0] for r in U.rule_order([("c/x/yy/", "allow"), ("bb.c/x/", "block"), ("C/", "block")])]
    assert order == ["bb.c/x/", "c/x/yy/", "C/"]
