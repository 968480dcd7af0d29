"""The corpus pipeline's rows against a brute-force version of its five stages, on planted copies, lines and passages."""

from __future__ import annotations

import random
import re

import corpus_pipeline
import duckdb
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marquee.llm.line_dedup import MIN_SITES, MIN_WORDS
from marquee.llm.oracle import ORACLE
from marquee.llm.queries import VOCABULARY
from test_llm_operators import brute_simhash, words

BLANKS = " \t\n\x0b\x0c\r"


def _text(rnd, n):
    return " ".join("".join(rnd.choice("abcdefghijklm") for _ in range(rnd.randint(2, 9))) for _ in range(n))


def _tables():
    rnd = random.Random(12)
    bench = [(i, _text(rnd, 20 + i)) for i in range(12)]
    lines = [_text(rnd, 6) for _ in range(5)]
    docs = []
    for i in range(160):
        body = [_text(rnd, 30) for _ in range(4)]
        if i % 4 == 0:  # boilerplate of many sites, blanks around it
            body.insert(rnd.randint(0, 4), "  " + rnd.choice(lines) + "\t")
        if i % 9 == 0:  # a passage of the benchmark
            body[1] += " " + bench[i % 12][1] + " " + _text(rnd, 3)
        docs.append((i, "\n".join(body), f"site{i % 8}"))
    docs += [(1000 + i, docs[5 + i % 3][1], f"site{i % 5}") for i in range(30)]  # copies
    docs += [(1100 + i, docs[20 + i][1].replace(" ", "  ", 5).upper(), "site1") for i in range(10)]  # copies but for case and blanks
    docs += [(1200 + i, docs[40 + i][1] + " tail", "site2") for i in range(5)]  # near copies
    docs += [(1300 + i, _text(rnd, 8), "site3") for i in range(10)] + [(1400, None, "site4"), (1401, "", None)]
    docs += [(1500 + i, "again and again " * 40, "bad") for i in range(12)] + [(1600, _text(rnd, 90), "bad")]
    rnd.shuffle(docs)
    return [(i, t, "en", s, len(t) if t is not None else None) for i, t, s in docs], bench


def _good(docs):
    """Stage 1 by the SQL of operator 7."""
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, lang varchar, source varchar, n_chars bigint)")
    con.executemany("insert into documents values (?, ?, ?, ?, ?)", docs)
    kept = {r[0] for r in con.execute(f"select doc_id from ({ORACLE['op7_quality_rules']}) where kept").fetchall()}
    return [d for d in docs if d[0] in kept]


def _without_boilerplate(docs):
    sites, first = {}, {}
    for i, t, _, s, _ in docs:
        for pos, line in enumerate((t or "").split("\n")):
            key = line.strip(BLANKS)
            if len(words(key)) >= MIN_WORDS:
                sites.setdefault(key, set()).add(s)
                first[key] = min(first.get(key, (i, pos)), (i, pos))
    bad = {k for k, v in sites.items() if len(v - {None}) >= MIN_SITES}
    out = []
    for i, t, lang, s, _ in docs:
        kept = [x for pos, x in enumerate(t.split("\n")) if x.strip(BLANKS) not in bad or first[x.strip(BLANKS)] == (i, pos)]
        out.append((i, "\n".join(kept), lang, s, len("\n".join(kept))))
    return out


def _one_each(docs):
    group = brute_simhash([(d[0], d[1]) for d in docs])
    return [d for d in docs if group[d[0]][1] == d[0]]


def _clean(docs, bench):
    flat = lambda t: " " + " ".join(re.findall(r"[^\W\d_]+|\d+", t.lower())) + " "
    return [d for d in docs if not any(flat(t) in flat(d[1]) for _, t in bench)]


def test_rows_against_brute_force(spark, tmp_path):
    docs, bench = _tables()
    folder = str(tmp_path)
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(
        f"{folder}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")

    stages = [_good(docs)]
    stages.append(_without_boilerplate(stages[-1]))
    stages.append(_one_each(stages[-1]))
    stages.append(_clean(stages[-1], bench))
    sizes = [len(docs), *map(len, stages)]
    assert sizes[0] > sizes[1] == sizes[2] > sizes[3] > sizes[4] > 100  # every stage had something to do
    assert sum(len(a[1]) < len(b[1]) for a, b in zip(stages[1], stages[0])) > 20

    encoder = Tokenizer.from_file(VOCABULARY)
    encoder.no_truncation()
    encoder.no_padding()
    want = {i: (lang, s, n, encoder.encode(t, add_special_tokens=False).ids) for i, t, lang, s, n in stages[-1]}
    got = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id: (r.lang, r.source, r.n_chars, list(r.ids)) for r in got} == want
    assert len(got) == len(want) and all(r.lossless and r.n_tokens == len(r.ids) for r in got)


def test_stages_one_by_one(spark, tmp_path):
    """Each stage works on what its predecessor kept, also when it is written and read in between."""
    docs, bench = _tables()
    folder = str(tmp_path)
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    now = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    want = docs
    for (name, stage), brute in zip(corpus_pipeline.STAGES[:-1], (_good, _without_boilerplate, _one_each, lambda d: _clean(d, bench))):
        want = brute(want)
        stage(spark, now, folder).write.parquet(f"{folder}/{name}")
        now = spark.read.parquet(f"{folder}/{name}")
        assert sorted(map(tuple, now.collect())) == sorted(want), name
        assert now.where(F.col("text").isNull()).count() == 0
