"""Op 12 against a brute-force tree, for several block sizes, and the multiproof's coordinates."""

from __future__ import annotations

import hashlib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from marquee.llm import merkle as T


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        out.append((i % 2 == 0, level[i ^ 1] if i ^ 1 < len(level) else None))
        i //= 2
    return out


def fold(h, path):
    for right, s in path:
        h = H(h) if s is None else H(h, s) if right else H(s, h)
    return h


def brute(rows):
    groups = {}
    for g, i, leaf, claimed in rows:
        groups.setdefault(g, []).append((i is not None, i or 0, leaf, claimed))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([r[2] for r in sorted(groups[g])]) for g in names}
    top = tree([trees[g][-1][0] for g in names])
    out = []
    for place, g in enumerate(names):
        for at, (there, i, leaf, claimed) in enumerate(sorted(groups[g])):
            path = siblings(trees[g], at) + siblings(top, place)
            root = top[-1][0]
            folded = fold(claimed, path)
            out.append((i if there else None, leaf, trees[g][-1][0], root, H(*[s for _, s in path if s]), folded, folded == root))
    return sorted(out, key=repr)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "clash") for r in rows], "group string, id long, leaf string, claimed string, key string")
    got = T.manifest(df.repartition(3), **kw)
    assert got.columns[:7] == ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def rows_of(sizes, seed=1):
    rnd = random.Random(seed)
    out = []
    for g, n in sizes:
        for i in rnd.sample(range(-2 * n, 2 * n), n):
            leaf = H(str(g), str(i))
            out.append((g, i, leaf, H("forged", leaf) if i % 7 == 0 else leaf))
    return out


@pytest.mark.parametrize("sizes, kw", [
    ([("en", 300), (None, 7), ("", 1), ("Zu", 2), ("éa", 33)], {"levels": 2, "range_rows": 50}),
    ([("en", 300), ("de", 64)], {"levels": 3, "range_rows": 7}),
    ([(f"l{i}", 1 + i % 5) for i in range(40)], {"levels": 2}),
    ([("one", 1)], {}), ([("x", 130)], {}), ([], {}),
])
def test_against_brute_force(spark, sizes, kw):
    rows = rows_of(sizes)
    got = run(spark, rows, **kw)
    assert got == brute(rows)
    assert all(r[6] == (r[0] % 7 != 0) for r in got)


def test_repeated_rows_and_null_ids(spark):
    leaf = H("x")
    rows = [("a", 5, leaf, leaf)] * 9 + [("a", None, H("n"), H("n"))] * 2 + [("a", 5, H("y"), H("y")), ("a", 4, H("z"), H("z"))]
    assert run(spark, rows, levels=2, range_rows=3) == brute(rows)


def test_proofs_fold_to_the_root(spark):
    rows = rows_of([("a", 21), ("b", 3), (None, 2)])
    df = spark.createDataFrame(rows, "group string, id long, leaf string, claimed string")
    for r in T.manifest(df, levels=2, with_proofs=True).collect():
        path = [(p["right"], p["hash"]) for p in r["proof"]]
        assert fold(r["leaf"], path) == r["root"]
        assert H(*[h for _, h in path if h]) == r["proof_sha256"]


def test_octopus_is_sufficient_and_minimal():
    for n in (1, 2, 5, 8, 11):
        levels = tree([H(str(i)) for i in range(n)])
        for known in itertools.chain.from_iterable(itertools.combinations(range(n), k) for k in (1, 2, 3)):
            asked = T.octopus(known, n)
            assert len(asked) == len(set(asked))
            have = {(0, i) for i in known} | set(asked)
            derivable = {(0, i) for i in known}
            for lv in range(len(levels) - 1):
                now = {i for v, i in have if v == lv}
                for i in range(len(levels[lv + 1])):
                    kids = [k for k in (2 * i, 2 * i + 1) if k < len(levels[lv])]
                    if all(k in now for k in kids) and (lv + 1, i) not in have:
                        have.add((lv + 1, i))
                        derivable.add((lv + 1, i))
                # a node that was asked for follows from nothing else
                assert not derivable & set(asked)
            assert (len(levels) - 1, 0) in have


def test_leaf_hash(spark):
    df = spark.createDataFrame([(1, "é", None, ""), (-12, None, 3, "a:b")], "i long, s string, n long, t string")
    got = [r[0] for r in df.select(T.leaf_hash([F.col(c) for c in df.columns])).collect()]
    assert got == [H("1:1", "2:é", "-", "0:"), H("3:-12", "-", "1:3", "3:a:b")]
