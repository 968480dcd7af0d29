"""Chat formatting by schema fingerprints (operator 9).  DataFrame functions only.

Prompt, instruction and message layouts are told apart by a fingerprint: the
SHA-256 of the sorted nested field paths of a record (``messages[].role``,
``prompt``, ...), restricted for each layout to the paths that it knows, so that ids,
metadata and fields of other layouts do not matter.  The first layout whose required
fields are there (in the order of ``LAYOUTS``) gives the declarative mapping to
canonical turns ``(id, turn, role, text)``.  Typed tables are fingerprinted
once by their schema, JSON records one by one.

``format_chat`` renders the turns of a conversation as one string in which
``<|im_start|>`` and ``<|im_end|>`` mark turns.  ``&`` and the first character
of every control string inside a text become entities, which ``read_back``
reverses exactly.  The loss mask is a list of character spans, one per
assistant text.

Defined cases: null texts and roles are empty strings; turns are ordered by
(turn, role, text), null turn numbers first, and repeated rows are repeated
turns; a null id is an id of its own; a JSON record that is null, unreadable or
of unknown layout comes back with ``layout`` null and no turns; a conversation
without turns is formatted as the empty string; an empty table gives an empty
result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import let

START, END = "<|im_start|>", "<|im_end|>"
CONTROL = (START, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
ENTITIES = {"<": "&lt;", "[": "&lsqb;"}
LOSS_ROLE = "assistant"


@dataclass(frozen=True)
class Layout:
    """A declarative mapping of one record layout to turns.

    ``items`` names an array of objects with the fields ``role`` and ``text``;
    without it, ``fields`` lists (role, field path) in the order of the turns,
    where fields of the same role are joined by a line break.  ``rename``
    maps the layout's role names to the canonical ones.
    """

    name: str
    items: str | None = None
    role: str = "role"
    text: str = "text"
    fields: tuple[tuple[str, str], ...] = ()
    optional: frozenset[str] = frozenset()
    rename: dict[str, str] = field(default_factory=dict)
    rows: bool = False

    def path_sets(self) -> list[tuple[str, ...]]:
        if self.items:
            need = {f"{self.items}[].{self.role}", f"{self.items}[].{self.text}"}
        elif self.rows:
            need = {"turn", self.role, self.text}
        else:
            need = {p for _, p in self.fields} - self.optional
        extra = sorted(self.optional)
        return [tuple(sorted(need | set(c))) for n in range(len(extra) + 1) for c in combinations(extra, n)]


SHARE = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
LAYOUTS = (
    Layout("turn rows", rows=True),
    Layout("messages", items="messages", text="content", optional=frozenset({"system"})),
    Layout("turns", items="turns"),
    Layout("shared conversation", items="conversations", role="from", text="value", rename=SHARE,
           optional=frozenset({"system"})),
    Layout("prompt and completion", fields=(("user", "prompt"), ("assistant", "completion"))),
    Layout("prompt and response", fields=(("system", "system"), ("user", "prompt"), ("assistant", "response")),
           optional=frozenset({"system"})),
    Layout("instruction", fields=(("user", "instruction"), ("user", "input"), ("assistant", "output")),
           optional=frozenset({"input"})),
    Layout("question and answer", fields=(("user", "question"), ("assistant", "answer"))),
)


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def known_paths(layouts=LAYOUTS) -> set[str]:
    return {p for x in layouts for s in x.path_sets() for p in s}


def schema_paths(schema: T.StructType) -> list[str]:
    """Nested field paths of a typed table."""
    out = []
    for f in schema.fields:
        kind = f.dataType
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            out += [f"{f.name}[].{g.name}" for g in kind.elementType.fields]
        else:
            out.append(f.name)
    return out


def _prefixed(prefix: str, names: Column) -> Column:
    return F.transform(names, lambda s: F.concat(F.lit(prefix), s))


def json_fingerprint(record: Column, layouts=LAYOUTS) -> Column:
    """The fingerprint by which the first layout that a JSON record has knows it (null without one, and for null or
    unreadable records).  Layouts are tried in their order; a layout is there if its required fields are."""
    known = known_paths(layouts)
    tops = sorted(p for p in known if "[]" not in p)
    lists = sorted({p.split("[].")[0] for p in known if "[]" in p})

    def of(v: Column) -> Column:
        parts = [F.when(F.try_variant_get(v, f"$.{p}", "variant").isNotNull(), F.lit(p)) for p in tops]
        found = F.filter(F.array(*parts), lambda x: x.isNotNull())
        for a in lists:
            names = F.array(*[F.lit(p.split("[].")[1]) for p in sorted(known) if p.startswith(f"{a}[].")])
            # the schema of the array's elements names every field that any of them has
            seen = F.coalesce(F.schema_of_variant(F.try_variant_get(v, f"$.{a}", "variant")), F.lit(""))
            here = F.when(seen.startswith("ARRAY<OBJECT<"),
                          F.array_intersect(F.regexp_extract_all(seen, F.lit("[<, ]([A-Za-z_]+): "), F.lit(1)), names))
            found = F.concat(found, _prefixed(f"{a}[].", F.coalesce(here, F.array().cast("array<string>"))))
        # of each layout the fields that it knows are fingerprinted, so fields of others do not matter
        def choose(found: Column) -> Column:
            out = F.lit(None).cast("string")
            for layout in reversed(layouts):
                own = F.array(*[F.lit(p) for p in sorted(known_paths([layout]))])
                fp = F.sha2(F.array_join(F.array_sort(F.array_intersect(found, own)), "\n"), 256)
                out = F.when(fp.isin(*[fingerprint(s) for s in layout.path_sets()]), fp).otherwise(out)
            return out

        return F.when(v.isNotNull(), let(found, choose))

    return let(F.try_parse_json(record), of)


def _text_at(v: Column, path: str) -> Column:
    return F.coalesce(F.try_variant_get(v, f"$.{path}", "string"), F.lit(""))


def _renamed(role: Column, rename: dict[str, str]) -> Column:
    out = F.coalesce(role, F.lit(""))
    for old, new in rename.items():
        out = F.when(role == old, F.lit(new)).otherwise(out)
    return out


TURNS = "array<struct<turn:bigint,role:string,text:string>>"


def _turn(i, role: Column, text: Column) -> Column:
    return F.struct(F.lit(i).cast("bigint").alias("turn") if isinstance(i, int) else i.cast("bigint").alias("turn"),
                    role.alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _turns(v: Column, layout: Layout, paths: tuple[str, ...]) -> Column:
    """Canonical turns of one record with exactly these known paths."""
    if layout.rows:
        return F.array(_turn(0, _text_at(v, layout.role), _text_at(v, layout.text))).cast(TURNS)
    lead = [_turn(-1, F.lit("system"), _text_at(v, "system"))] if layout.items and "system" in paths else []
    if layout.items:
        kind = f"array<struct<{layout.role}:string,{layout.text}:string>>"
        body = F.transform(F.try_variant_get(v, f"$.{layout.items}", kind),
                           lambda x, i: _turn(i, _renamed(x[layout.role], layout.rename), x[layout.text]))
        return F.concat(F.array(*lead).cast(TURNS), body.cast(TURNS)) if lead else body.cast(TURNS)
    by_role: dict[str, list[Column]] = {}
    for role, path in layout.fields:
        if path in paths:
            by_role.setdefault(role, []).append(F.try_variant_get(v, f"$.{path}", "string"))
    return F.array(*[_turn(i, F.lit(role), F.concat_ws("\n", *cols)) for i, (role, cols) in enumerate(by_role.items())]).cast(TURNS)


def turns_from_json(records: DataFrame, id_col: str, json_col: str, layouts=LAYOUTS) -> DataFrame:
    """``(id, layout, turn, role, text)`` of JSON records in any known layout, mixed as they are.

    A record without turns gives one row with a null turn, role and text.
    """
    x = records.select(F.col(id_col).alias("id"), F.try_parse_json(F.col(json_col)).alias("v"),
                       json_fingerprint(F.col(json_col), layouts).alias("fp"))
    name, turns = F.lit(None).cast("string"), F.array().cast(TURNS)
    for layout in layouts:
        for paths in layout.path_sets():
            hit = F.col("fp") == fingerprint(paths)
            name = F.when(hit, F.lit(layout.name)).otherwise(name)
            turns = F.when(hit, _turns(F.col("v"), layout, paths)).otherwise(turns)
    return x.select("id", name.alias("layout"), F.explode_outer(turns).alias("t")).select(
        "id", "layout", "t.turn", "t.role", "t.text")


def turns_from_table(rows: DataFrame, id_col: str, layouts=LAYOUTS) -> DataFrame:
    """The same for a typed table, whose schema's fingerprint selects the mapping."""
    here = [p for p in schema_paths(rows.schema) if p != id_col]
    own = [(x, sorted(set(here) & known_paths([x]))) for x in layouts]
    found = [(x, p) for x, p in own if fingerprint(p) in {fingerprint(s) for s in x.path_sets()}]
    if not found:
        raise ValueError(f"no layout has the field paths {sorted(here)}")
    layout, here = found[0]
    if layout.rows:
        return rows.select(F.col(id_col).alias("id"), F.lit(layout.name).alias("layout"),
                           F.col("turn").cast("bigint").alias("turn"),
                           F.coalesce(F.col(layout.role), F.lit("")).alias("role"),
                           F.coalesce(F.col(layout.text), F.lit("")).alias("text"))
    tops = sorted({p.split("[]")[0] for p in here})
    return turns_from_json(rows.select(F.col(id_col).alias("id"), F.to_json(F.struct(*tops), {"ignoreNullFields": "false"}).alias("json")),
                           "id", "json", layouts)


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("&"), F.lit("&amp;"))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(ENTITIES[c[0]] + c[1:]))
    return out


def unescape(text: Column) -> Column:
    out = F.replace(text, F.lit("&nl;"), F.lit("\n"))
    for plain, entity in ENTITIES.items():
        out = F.replace(out, F.lit(entity), F.lit(plain))
    return F.replace(out, F.lit("&amp;"), F.lit("&"))


def format_chat(turns: DataFrame) -> DataFrame:
    """``(id, formatted, loss_spans)`` from canonical turns.

    ``loss_spans`` is ``array<struct<start, length>>``: 0-based character
    positions of the (escaped) assistant texts in ``formatted``.
    """
    head = F.concat(F.lit(START), F.replace(escape(F.col("role")), F.lit("\n"), F.lit("&nl;")), F.lit("\n"))
    there = F.col("text").isNotNull()
    order = ("turn", "role", "text")
    x = turns.select("id", *order, F.when(there, head).alias("head"), F.when(there, escape(F.col("text"))).alias("body"))
    x = x.withColumn("part", F.concat("head", "body", F.lit(END + "\n")))
    w = W.partitionBy("id").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    x = x.withColumn("at", F.coalesce(F.sum(F.length("part").cast("long")).over(w), F.lit(0)))
    span = F.when(F.col("role") == LOSS_ROLE, F.struct(
        (F.col("at") + F.length("head")).alias("start"), F.length("body").cast("long").alias("length")))
    g = x.groupBy("id").agg(
        F.sort_array(F.collect_list(F.when(there, F.struct("at", "part")))).alias("parts"),
        F.sort_array(F.collect_list(F.when(there, span))).alias("loss_spans"))
    return g.select("id", F.array_join(F.col("parts")["part"], "").alias("formatted"), "loss_spans")


def read_back(formatted: Column) -> Column:
    """``array<struct<role, text>>`` from a formatted string: the exact inverse."""
    blocks = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda b: b != "")

    def turn(b: Column) -> Column:
        role = F.substring_index(b, "\n", 1)
        skip = F.length(role) + 1
        text = F.substr(b, skip + 1, F.length(b) - skip - len(END) - 1)
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(blocks, turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def digests(formatted: DataFrame, id_name: str = "conv_id") -> DataFrame:
    """What the formatted strings say when they are read back."""
    x = formatted.select(F.col("id").alias(id_name), "formatted", read_back(F.col("formatted")).alias("turns"),
                         loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return x.select(id_name, F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                    F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars"))
