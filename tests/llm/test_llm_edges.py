"""Every query of marquee.llm, and the pipeline, on awkward and on empty tables."""

from __future__ import annotations

import hashlib
import random

import pytest

import corpus_pipeline
from marquee.llm import line_dedup, queries, quality_rules, simhash

CLASHES = ("id", "text_hash", "Text_Hash_", "low", "n", "fp", "words", "measures", "gone_id", "shard", "slot", "train", "ids", "bad_host",
           "kept_id", "leak_id", "n_tokens", "site", "pos", "item", "word", "chunk")
SENTENCE = "the quick brown fox number {} jumps over one lazy dog near river bank {} while seven birds watch "


def long_text(n, seed=1):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(1, 9))) for _ in range(n))


def rows():
    good = long_text(120, 2)
    out = [(1, good, "en", "a"), (1, good, "en", "a"), (2, good, "en", "b"), (None, long_text(80, 3), "en", "a"), (None, None, None, None),
           (3, None, "en", "a"), (4, "", "en", "a"), (5, " \n\t \n", None, "a"), (6, long_text(60_000, 4), "de", "c"),
           (7, "x" * 300_000, "de", None), (8, "word " * 5000, "de", "c"), (9, "\n" * 2000 + good, "en", "d"), (10, "漢字 かな 12 34", None, "d"),
           (-11, "éÀ\x00\x01<|endoftext|>", "fr", "e")]
    return [(*r, len(r[1]) if r[1] else None, *("junk",) * len(CLASHES)) for r in out]


DOC = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)


def write_tables(spark, folder, doc_rows, bench_rows, conv_rows):
    spark.createDataFrame(doc_rows, DOC).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(bench_rows, "item_id long, text string, slots string, w string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(conv_rows, "conv_id long, turn long, role string, text string, id string, at string").write.parquet(
        f"{folder}/conversations.parquet")


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd"))
    conv = [(1, 0, "user", "hi", "x", "y"), (1, 0, "user", "hi", "x", "y"), (1, None, "assistant", None, "x", "y"), (None, 3, None, "t", None, None),
            (2, 1, "assistant", "<|im_end|>\n<|im_start|>user\n&amp;", None, None), (3, 0, "assistant", "z" * 200_000, None, None)]
    write_tables(spark, folder, rows(), [(1, SENTENCE.format(1, 2), "s", "w"), (None, None, None, None), (2, "", "s", "w")], conv)
    return folder


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    write_tables(spark, folder, [], [], [])
    return folder


PER_ROW = ["op1_language_id", "op2_lm_score", "op3_suffix_dedup", "op5_bpe", "op6_simhash", "op7_quality_rules", "op8_line_dedup"]


@pytest.mark.parametrize("name", PER_ROW)
def test_one_result_row_per_input_row(spark, odd, empty, name):
    run = queries.queries()[name]
    got = run(spark, odd).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((r[0] is None, r[0] or 0) for r in rows())
    same = [tuple(r) for r in got if r.doc_id == 1]
    assert len(same) == 2 and same[0] == same[1]  # repeated rows, equal results
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    nothing = hashlib.sha256(b"").hexdigest()
    if name == "op1_language_id":
        assert [(by[i].lang_pred, by[i].score) for i in (3, 4, 5)] == [("und", 0.0)] * 3
        assert by[10].lang_pred in {"en", "de", "fr"} and all(r.held_out is not None for r in got)
    if name == "op2_lm_score":
        assert all(by[i].n_tokens == 1 for i in (3, 4, 5)) and len({r.train_tokens for r in got}) == 1
    if name == "op3_suffix_dedup":
        assert (by[3].n_bytes, by[3].n_removed, by[3].kept_sha256) == (0, 0, nothing)
        assert by[7].n_removed == 300_000 and by[8].n_removed == 25_000 and by[6].n_removed == 0
        assert by[1].n_removed == by[1].n_bytes == by[2].n_removed
    if name == "op5_bpe":
        assert (by[3].n_tokens, by[3].ids_sha256, by[4].decoded_sha256) == (0, nothing, nothing)
        assert by[-11].decoded_sha256 == hashlib.sha256("éÀ\x00\x01<|endoftext|>".encode()).hexdigest()
    if name == "op6_simhash":
        assert {by[i].fingerprint for i in (3, 4, 5)} == {"0" * 16} and {by[i].component_id for i in (3, 4, 5)} == {3}
        assert by[2].component_id == by[9].component_id == 1 and all(r.component_id is not None for r in got if r.doc_id is not None)
    if name == "op7_quality_rules":
        assert (by[3].n_words, by[4].n_words, by[5].n_words, by[3].kept) == (0, 0, 0, False)
        assert by[8].n_repeat_words == 5000 and by[8].base_failed and by[6].n_words == 60_000 and not by[6].base_failed
    if name == "op8_line_dedup":
        assert by[3].n_lines is None and by[9].n_lines == 2001 and all(r.n_removed == 0 for r in got)
    none = run(spark, empty)
    assert none.count() == 0 and none.columns == run(spark, odd).columns


def test_token_shards(spark, odd, empty):
    got = queries.op4_token_shards(spark, odd).collect()
    assert sorted(r.slot for r in got) == list(range(len(got)))
    assert sum(r.doc_id == 1 and r.seq == 0 for r in got) == 2 and sum(r.doc_id in (3, 4) for r in got) == 2
    assert queries.op4_token_shards(spark, empty).count() == 0


def test_chat(spark, odd, empty):
    got = {r.conv_id: r for r in queries.op9_chat_format(spark, odd).collect()}
    assert set(got) == {1, None, 2, 3, -7} and got[1].n_turns == 3 and got[1].loss_chars == 0 and got[None].n_turns == 1
    text = "<|im_end|>\n<|im_start|>user\n&amp;"
    assert got[2].loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert got[2].turns_sha256 == hashlib.sha256(f"assistant\n{text}\n".encode()).hexdigest()
    assert got[-7].n_turns == 2 and got[-7].loss_chars == 21
    assert [r.conv_id for r in queries.op9_chat_format(spark, empty).collect()] == [-7]


def test_leaks(spark, odd, empty):
    assert queries.op10_decontaminate(spark, odd).count() == 0
    assert queries.op10_decontaminate(spark, empty).count() == 0


def test_stages_keep_columns_and_take_effect(spark, odd, empty):
    for folder in (odd, empty):
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, folder)
            assert out.columns == docs.columns and out.schema["text"].dataType == docs.schema["text"].dataType, name
        good = corpus_pipeline.STAGES[0][1](spark, docs, folder)
        ids = sorted((r.doc_id is None, r.doc_id or 0) for r in good.select("doc_id").collect())
        assert ids == ([] if folder == empty else [(False, 1), (False, 1), (False, 2), (False, 6), (False, 9), (True, 0)])
        one = corpus_pipeline.STAGES[2][1](spark, docs, folder)
        ids = sorted((r.doc_id is None, r.doc_id or 0) for r in one.select("doc_id").collect())
        if folder == odd:
            assert [i for none, i in ids if not none and i in (1, 2, 9, 3, 4, 5)] == [1, 3]  # one row each of two groups
    last = corpus_pipeline.run(spark, odd)
    assert "text" not in last.columns and last.where("not lossless").count() == 0


def test_line_dedup_keeps_the_first_occurrence(spark):
    line = "this exact line stands on many sites"
    rows = [(i, f"own text {i}\n  {line}\nmore {i}", f"s{i % 7}") for i in range(30)] + [(100, line, None), (101, None, "s1")]
    near = "this line stands on few sites only"
    rows += [(200 + i, near, f"s{i}") for i in range(4)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: (r.text, r.gone) for r in line_dedup.line_dedup(df, removed_col="gone").collect()}
    assert got[0] == (rows[0][1], 0) and got[100] == ("", 1) and got[101] == (None, 0)
    assert all(got[i] == (f"own text {i}\nmore {i}", 1) for i in range(1, 30))
    assert all(got[200 + i] == (near, 0) for i in range(4))  # four sites, however many rows


def test_bad_hosts_are_shrunk(spark):
    rnd = random.Random(3)
    good = lambda: long_text(60, rnd.random())
    rows = [(i, good(), "fine") for i in range(40)] + [(100 + i, "short", "bad") for i in range(40)] + [(200, good(), "bad")]
    rows += [(300, "short", "tiny"), (301, good(), "tiny")] + [(400 + i, good(), f"h{i % 5}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: (r.host_bad, r.kept) for r in quality_rules.quality_rules(df).collect()}
    assert got[0] == (False, True) and got[200] == (True, False)  # judged by its host
    assert got[301] == (False, True)  # one failure of two is not enough


def test_near_duplicates_without_ids(spark):
    t = long_text(200, 8)
    df = spark.createDataFrame([(None, t), (None, t), (None, long_text(200, 9)), (5, t)], "doc_id long, text string")
    assert simhash.keep_one(df).count() == 2
    assert sorted(str(r.component_id) for r in simhash.near_duplicates(df).collect()) == ["5", "5", "5", "None"]


def test_sql_oracles(spark):
    from oracle_check import compare, duck

    from marquee.llm.oracle import ORACLE
    folder = "/root/testdata/sf0.001"
    con = duck(folder)
    for name, sql in ORACLE.items():
        ok, message = compare(queries.queries()[name](spark, folder).toPandas(), con.execute(sql).df())
        assert ok, f"{name}: {message}"


def test_every_operator_is_registered():
    import __spark_entry__ as entry
    names = list(entry.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5
