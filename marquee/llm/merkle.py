"""Merkle manifest of a data set, with a proof for every row by octopus multiproofs.

Every row is a leaf.  The leaves of a group (a language, say) form a binary
tree in the order of their ids, and the roots of the groups another one in the
order of the groups.  A proof of a leaf is the list of its siblings on the way
to the last root.

Octopus multiproof: the leaves of a tree are cut into aligned partitions of
``2**levels`` leaves.  A partition computes the smallest set of node
coordinates that its own leaves cannot give (``octopus``), fetches these nodes
once by a join with the table of nodes, derives the interior nodes that its
proofs share, and expands the single proofs locally.  Only the few nodes above
the partitions are ever moved; no proof is shuffled.

The nodes above the partitions are made in the same way, ``levels`` levels at a
time (``_forest``), so a tree of any size takes ``log(n) / levels`` rounds
and no task holds more than ``2**levels`` nodes of one tree.

At scale: texts are read once, to hash the leaves.  Positions come from a range
partitioning of the stored leaves and counts by partition, so that a group with
a third of all rows, and an id that occurs many times, spread over many tasks.  A
node near the root is asked for by many partitions; it is repeated once for
every ``2**levels`` of them, so that no join key is hot.  The driver sees two
counts and the length of the longest path.

Awkward input: a null field is ``-``, an empty text ``0:``.  A null group is a group
of its own and the first; a null id comes first in its group; equal ids are ordered
by leaf, and rows with equal leaves by their place in the table, so that repeated
rows each have a place and a proof (which of them has which does not matter to any
root).  A group of one leaf has that leaf as its root.  An empty table gives no
rows.  Columns other than the named ones are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.arrow import batch, column
from marquee.llm.common import stored

#: Levels of a tree inside one partition of leaves, and of each round above.
LEVELS = 12
#: Rows of a range partition while positions are computed.
RANGE_ROWS = 1 << 16


def digest(*parts: str) -> str:
    """The node over some nodes: SHA-256 of their hexadecimal texts, one after the other."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_hash(fields: Sequence[Column]) -> Column:
    """SHA-256 of the fields: ``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    def part(c: Column) -> Column:
        s = c.cast("string")
        return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))
    return F.sha2(F.concat(*[part(c) for c in fields]), 256)


def height(n: int) -> int:
    """Levels above the leaves of a tree with ``n`` leaves."""
    return max(0, n - 1).bit_length()


def octopus(known: Sequence[int], width: int) -> list[tuple[int, int]]:
    """The fewest ``(level, index)`` from which, with the ``known`` leaves, the root follows."""
    out, level, now = [], 0, sorted(set(known))
    while width > 1:
        have = set(now)
        out += [(level, i ^ 1) for i in now if i ^ 1 < width and i ^ 1 not in have]
        now = sorted({i >> 1 for i in now})
        level, width = level + 1, (width + 1) >> 1
    return out


def derive(nodes: Sequence[str], up: int) -> list[list[str]]:
    """The levels over aligned neighbours: themselves, then ``up`` levels of parents."""
    out = [list(nodes)]
    for _ in range(up):
        below = out[-1]
        out.append([digest(*below[i:i + 2]) for i in range(0, len(below), 2)])
    return out


def numbered(df: DataFrame, key: str, order: Sequence[str], name: str, rows: int = RANGE_ROWS) -> DataFrame:
    """``df`` (a stored table) with ``idx``, the place by ``order`` from 0 within ``key``, and ``n``, the rows of ``key``."""
    parts = max(1, -(-df.count() // rows))
    x = df.withColumn("_tie", F.monotonically_increasing_id())
    x = stored(x.repartitionByRange(parts, key, *order, "_tie").withColumn("_part", F.spark_partition_id()), name + "-ranges")
    counts = x.groupBy("_part", key).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_part", key, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                           F.sum("_n").over(Window.partitionBy(key)).alias("n"))
    inside = F.row_number().over(Window.partitionBy("_part", key).orderBy(*order, "_tie"))
    x = x.withColumn("_in", inside).join(counts, ["_part", key])
    return x.withColumn("idx", F.col("_before") + F.col("_in") - 1).drop("_part", "_in", "_before", "_tie")


_TIER = "key string, n long, block long, missing boolean, level int, idx long, hash string"


def _tier(base: int, levels: int):
    """For a block of nodes of level ``base``: the nodes above them that it covers; for leaves only the
    highest of these, and the coordinates that the block misses."""
    def run(table: pa.Table) -> pa.Table:
        key, n, block = (table.column(c)[0].as_py() for c in ("key", "n", "block"))
        rows = sorted(zip(table.column("idx").to_pylist(), table.column("hash").to_pylist()))
        made = derive([h for _, h in rows], min(levels, height(n) - base))
        out = [(False, base + u, (block << (levels - u)) + i, h) for u, nodes in enumerate(made) for i, h in enumerate(nodes)
               if (u > 0 if base else u == len(made) - 1)]
        if not base:
            out += [(True, lv, i, None) for lv, i in octopus([i for i, _ in rows], n)]
        m = len(out)
        return pa.Table.from_batches([batch(
            column("key", [key] * m, pa.string()), column("n", [n] * m, pa.int64()), column("block", [block] * m, pa.int64()),
            *[column(c, v, k) for c, k, v in zip(("missing", "level", "idx", "hash"), (pa.bool_(), pa.int32(), pa.int64(), pa.string()),
                                                 zip(*out) if out else [[]] * 4)])])
    return run


def _forest(leaves: DataFrame, levels: int, name: str) -> tuple[DataFrame, DataFrame]:
    """The trees of stored ``leaves (key, n, idx, hash)``: ``(key, n, root)``, and for every block of leaves
    ``(key, block, fetched)`` with the nodes that it misses."""
    def over(nodes: DataFrame, base: int) -> DataFrame:
        x = nodes.select("key", "n", "idx", "hash", F.shiftright("idx", levels).alias("block"))
        return stored(x.groupBy("key", "block").applyInArrow(_tier(base, levels), _TIER), f"{name}-nodes")

    first = over(leaves, 0)
    made = first.where("not missing")
    known, last, base = made, made, levels
    top = leaves.agg(F.max("n")).first()[0] or 0
    while base < height(top):
        last = over(last.where(F.col("level") == base), base)
        known, base = known.unionByName(last), base + levels
    wide = F.expr("shiftright(n - 1, level)")  # the last index of the level
    roots = known.where(wide == 0).select("key", "n", F.col("hash").alias("root"))

    # a node goes to the partitions below its sibling, 2**levels of them for each copy
    sibling = F.col("idx").bitwiseXOR(F.lit(1).cast("long"))
    up = F.col("level") - F.lit(levels)
    low = F.call_function("shiftleft", sibling, up)
    high = F.least(F.call_function("shiftleft", sibling + 1, up) - 1, F.shiftright(F.col("n") - 1, levels))
    offered = known.where((wide > 0) & (F.col("level") >= levels) & (sibling <= wide)).select(
        "key", "level", "idx", "hash",
        F.explode(F.sequence(F.shiftright(low, levels), F.shiftright(high, levels))).alias("far"))
    asked = first.where("missing").select("key", "block", "level", "idx", F.shiftright("block", levels).alias("far"))
    fetched = asked.join(offered, ["key", "level", "idx", "far"]).groupBy("key", "block").agg(
        F.collect_list(F.struct("level", "idx", "hash")).alias("fetched"))  # one for each level at most
    return roots, made.select("key", "block").join(fetched, ["key", "block"], "left")


def _expand(levels: int, columns: Sequence[tuple[str, pa.DataType]], emit):
    """Proofs of one block of leaves from its fetched nodes.

    ``emit(row, root, path, above)`` gives the values of ``columns`` for one leaf;
    ``path`` and ``above`` are lists of ``(sibling on the right, hash or None)``.
    """
    def run(leaves: pa.Table, info: pa.Table) -> pa.Table:
        one = info.to_pylist()[0]
        n, known = one["n"], {(f["level"], f["idx"]): f["hash"] for f in one["fetched"] or []}
        rows = sorted(leaves.to_pylist(), key=lambda r: r["idx"])
        tall, first = height(n), rows[0]["idx"]
        own = derive([r["hash"] for r in rows], min(levels, tall))
        shared = []
        for lv in range(len(own) - 1, tall):
            at = first >> lv
            shared.append((at % 2 == 0, known[(lv, at ^ 1)] if at ^ 1 <= (n - 1) >> lv else None))
        above = [(a["right"], a["hash"]) for a in one["above"] or []]
        out = []
        for r in rows:
            path = []
            for lv in range(len(own) - 1):
                at = r["idx"] >> lv
                other = (at ^ 1) - (first >> lv)
                path.append((at % 2 == 0, own[lv][other] if other < len(own[lv]) else None))
            out.append(emit(r, one, path + shared, above))
        return pa.Table.from_batches([batch(*[column(c, list(v), k) for (c, k), v in zip(columns, zip(*out))])])
    return run


def fold(node: str, path: Sequence[tuple[bool, str | None]]) -> str:
    """The root that a leaf and its siblings give."""
    for right, sibling in path:
        node = digest(node) if sibling is None else digest(node, sibling) if right else digest(sibling, node)
    return node


_ABOVE = "array<struct<right boolean, hash string>>"
_PATH = pa.list_(pa.struct([("right", pa.bool_()), ("hash", pa.string())]))


def _top_row(r: dict, one: dict, path: list, above: list) -> tuple:
    return r["name"], one["root"], [{"right": a, "hash": b} for a, b in path]


def _leaf_row(with_proofs: bool):
    def emit(r: dict, one: dict, path: list, above: list) -> tuple:
        whole = path + above
        siblings = [h for _, h in whole if h is not None]
        folded = fold(r["claimed"], whole)
        out = (r["id"], r["hash"], one["subroot"], one["root"], digest(*siblings), folded, folded == one["root"])
        return out + ([{"right": a, "hash": b} for a, b in whole],) if with_proofs else out
    return emit


def manifest(leaves: DataFrame, *, levels: int = LEVELS, range_rows: int = RANGE_ROWS, with_proofs: bool = False) -> DataFrame:
    """Roots and proofs of ``leaves (group string, id long, leaf string, claimed string)``.

    Returns ``(id, leaf, subroot, root, proof_sha256, folded_root, verified)``: ``proof_sha256`` is the
    digest of the siblings from the leaf to the root; ``folded_root`` is what ``claimed`` (a
    leaf as somebody else computed it) gives with these siblings, and ``verified`` whether it is the
    root.  ``with_proofs`` adds ``proof``, one ``(right, hash)`` for each level; ``hash`` is null where a
    node has no sibling.
    """
    key = F.when(F.col("group").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), "group"))
    flat = stored(leaves.select(key.alias("key"), F.col("id").cast("long").alias("id"), F.col("leaf").alias("hash"), "claimed"), "leaves")
    placed = stored(numbered(flat, "key", ["id", "hash"], "leaves", range_rows), "placed-leaves")
    roots, fetched = _forest(placed, levels, "group")
    roots = stored(roots, "subroots")

    names = stored(roots.select(F.lit("").alias("key"), F.col("key").alias("name"), F.col("root").alias("hash")), "groups")
    over = stored(numbered(names, "key", ["name"], "groups", range_rows), "placed-groups")
    last, above = _forest(over, levels, "top")
    info = _spread(above, last.withColumn("above", F.lit(None).cast(_ABOVE)), levels)
    top = stored(_cogrouped(over, info, levels, _expand(
        levels, [("key", pa.string()), ("root", pa.string()), ("above", _PATH)], _top_row), f"key string, root string, above {_ABOVE}"), "top-paths")

    info = _spread(fetched, roots.withColumnRenamed("root", "subroot").join(top, "key"), levels)
    columns = [("id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()), ("proof_sha256", pa.string()),
               ("folded_root", pa.string()), ("verified", pa.bool_())] + ([("proof", _PATH)] if with_proofs else [])
    schema = ("id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
              + (f", proof {_ABOVE}" if with_proofs else ""))
    return _cogrouped(placed, info, levels, _expand(levels, columns, _leaf_row(with_proofs)), schema)


def _spread(blocks: DataFrame, trees: DataFrame, levels: int) -> DataFrame:
    """Blocks with the columns of their tree; a tree is repeated for every ``2**levels`` of its blocks."""
    copies = trees.withColumn("_far", F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright(F.col("n") - 1, 2 * levels))))
    return blocks.withColumn("_far", F.shiftright("block", levels)).join(copies, ["key", "_far"]).drop("_far")


def _cogrouped(leaves: DataFrame, info: DataFrame, levels: int, run, schema: str) -> DataFrame:
    x = leaves.withColumn("block", F.shiftright("idx", levels))
    return x.groupBy("key", "block").cogroup(info.groupBy("key", "block")).applyInArrow(run, schema)
