"""Benchmark decontamination by templates (operator 10).  DataFrame functions only.

Texts become sequences of tokens (numbers or runs of letters) in which numbers,
names and units (after a number) are replaced by typed placeholders; the rest is
lower-cased.  Which capitalised words are names cannot be told for sure, so
every window of ``WINDOW`` tokens has a form per entry of ``VARIANTS``: without
names, with those inside a sentence, and with every capitalised word as one.

Seeds: hashes of the item's windows are joined with those of the documents.
A window form with fewer than ``MIN_LITERAL`` plain words is too common to be
evidence; such a window, and an item that is shorter than one, is joined by its
real tokens instead.  Every seed names a diagonal (document position minus item
position), on which the item and the document are then compared token by token.
Tokens match if they are equal but for case or both placeholders of one type.
Matching windows that cover at least ``MIN_COVER`` tokens of the item, or all of
it, are a leak, if the slots are consistent (every value of the item's slots
stands for one value in the document) and ``MIN_LITERAL`` plain words are among
them, or if the real tokens are equal.  So a question whose numbers or names
were exchanged throughout is found, and one that only shares the template's
words in another relation is not.  Capitalised words at the start of a sentence
are compared both as words and as names.

An item of fewer than ``MIN_LITERAL`` tokens is no evidence and matches nothing.

Defined cases: null or empty texts match nothing; a null id is returned as it
is; rows that are equal in id and text are one document (one result row), all
of them dropped together by ``drop_leaks``; several items with the same text
give one row each; empty tables give an empty result; other columns, whatever
their names, are not read (``drop_leaks`` returns them unchanged).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import BROADCAST_BYTES, broadcast_if_small, fresh, let, stored

WINDOW = 8
MIN_COVER = 13
MIN_LITERAL = 4

UNITS = ("kg", "g", "mg", "lb", "lbs", "oz", "tons", "ton", "km", "m", "cm", "mm", "mi", "mile", "miles", "feet",
         "foot", "ft", "inch", "inches", "yards", "l", "ml", "litres", "liters", "gallons", "s", "sec", "second",
         "seconds", "min", "minute", "minutes", "h", "hour", "hours", "day", "days", "week", "weeks", "month",
         "months", "year", "years", "dollars", "dollar", "cents", "euros", "euro", "percent", "mph", "kmh",
         "degrees", "meters", "metres", "grams", "kilograms", "kilometers", "kilometres")
MARK = "\x01"
NUMBER, NAME, START, UNIT = MARK + "d", MARK + "n", MARK + "s", MARK + "u"
#: The placeholders that stand as a name in each form of a window; the others of these two stay words.
VARIANTS = ((), (NAME,), (NAME, START))

_NUMBER = r"\p{Nd}+(?:[.,:/]\p{Nd}+)*"
_LETTERS = r"[\p{L}\p{M}]"
_TOKEN = f"{_NUMBER}|{_LETTERS}+"
_CANONICAL = rf"{MARK}[dnsu]|{_LETTERS}+"
_NAME = rf"(?<=[\p{{Ll}}\p{{Nd}},;]\s)\p{{Lu}}\p{{Ll}}+(?!{_LETTERS})"
_START = rf"(?<!{_LETTERS})\p{{Lu}}\p{{Ll}}+(?!{_LETTERS})"
_UNIT = rf"(?<={MARK}d\s{{1,2}})(?i:{'|'.join(UNITS)})(?!{_LETTERS})"


def tokens(text: Column) -> Column:
    """The plain tokens; as many as ``canonical_tokens`` gives, position by position."""
    return F.regexp_extract_all(F.replace(F.coalesce(text, F.lit("")), F.lit(MARK), F.lit(" ")), F.lit(_TOKEN), F.lit(0))


def canonical_tokens(text: Column) -> Column:
    t = F.replace(F.coalesce(text, F.lit("")), F.lit(MARK), F.lit(" "))
    t = F.regexp_replace(t, _NAME, NAME)
    t = F.regexp_replace(t, _START, START)
    t = F.regexp_replace(t, _NUMBER, f" {NUMBER} ")
    t = F.regexp_replace(t, _UNIT, UNIT)
    return F.regexp_extract_all(F.lower(t), F.lit(_CANONICAL), F.lit(0))


def _form(c: Column, real: Column, names: tuple[str, ...]) -> Column:
    """The canonical tokens with ``names`` as names and other capitalised words as plain words."""
    words = [x for x in (NAME, START) if x not in names]
    if not words:
        return F.transform(c, lambda x: F.when(x == START, NAME).otherwise(x))
    return F.zip_with(c, real, lambda x, r: F.when(x.isin(words), r).otherwise(x))


def _each(c: Column) -> Column:
    """Every token as a number; windows are hashed from these."""
    return F.transform(c, lambda x: F.xxhash64(x))


def _hash(each: Column, at: Column | int, length: int, *salt: Column) -> Column:
    """Hash of the window at ``at`` of the numbers of ``_each``."""
    return F.xxhash64(*salt, *[F.get(each, at + k) for k in range(length)])


def _real_hash(each: Column, at: Column | int, length: int) -> Column:
    return _hash(each, at, length, F.lit(MARK), F.lit(length))


def _with_tokens(text: Column, body) -> Column:
    """``body(canonical, real)``, both evaluated once; real: the plain tokens in lower case."""
    real = F.transform(tokens(text), lambda x: F.lower(x))
    return let(canonical_tokens(text), lambda c: let(real, lambda r: body(c, r)))


def _window_hashes(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """``(id, text_hash, pos, h)`` of ``docs (id, text_hash, text)``: the hashes of the window at ``pos`` in all forms, and of
    the ``lengths`` real tokens at its start.

    Higher-order functions number the tokens, once; the windows, eight times as many, come from plain expressions over rows.
    """
    def numbered(c: Column, real: Column) -> Column:
        return F.struct(F.size(c).alias("n"), *[_each(_form(c, real, v)).alias(f"f{k}") for k, v in enumerate(VARIANTS)],
                        _each(real).alias("real"))

    x = docs.select("id", "text_hash", _with_tokens(F.col("text"), numbered).alias("t")).select("id", "text_hash", "t.*")
    last = F.col("n") - min([WINDOW, *lengths])
    # explode_outer: before explode() Spark puts a filter that evaluates the argument once more
    x = x.withColumn("pos", F.explode_outer(F.when(last >= 0, F.sequence(F.lit(0), last)))).where("pos is not null")
    forms = [f"h{k}" for k in range(len(VARIANTS))]
    x = x.select("id", "text_hash", "pos", *[_hash(F.col(f"f{k}"), F.col("pos"), WINDOW).alias(h) for k, h in enumerate(forms)],
                 *[_real_hash(F.col("real"), F.col("pos"), n).alias(f"r{n}") for n in lengths])
    # a window without such words is the same in the next form
    new = [F.col(forms[0]), *[F.when(F.col(h) != F.col(before), F.col(h)) for before, h in zip(forms, forms[1:])]]
    return x.select("id", "text_hash", "pos", F.explode_outer(F.array(*new, *[F.col(f"r{n}") for n in lengths])).alias("h"))


def item_texts(benchmark: DataFrame, text_col: str) -> DataFrame:
    """``(item_hash, item_tokens, ic, iv)``: the different item texts, their canonical and real tokens."""
    t = _with_tokens(F.col(text_col), lambda c, r: F.struct(c.alias("c"), r.alias("r")))
    x = benchmark.select(F.xxhash64(F.col(text_col)).alias("item_hash"), t.alias("t"))
    return x.dropDuplicates(["item_hash"]).select("item_hash", F.size("t.c").alias("item_tokens"), F.col("t.c").alias("ic"),
                                                  F.col("t.r").alias("iv")).where(F.col("item_tokens") >= MIN_LITERAL)


def item_seeds(texts: DataFrame) -> DataFrame:
    """``(item_hash, item_tokens, item_pos, h, length)``; length: that of a seed of real tokens, null for a template."""
    n, c, real = F.col("item_tokens"), F.col("ic"), F.col("iv")
    few = lambda form, i: F.size(F.filter(F.slice(form, i + 1, WINDOW), lambda x: ~x.startswith(MARK))) < MIN_LITERAL
    none = F.lit(None).cast("int")

    def one(i: Column) -> Column:
        def seed(form: Column) -> Column:
            return F.when(~few(form, i), F.struct(i.alias("pos"), _hash(_each(form), i, WINDOW).alias("h"), none.alias("length")))
        plain = _form(c, real, ())
        exact = F.when(few(plain, i), F.struct(i.alias("pos"), _real_hash(_each(real), i, WINDOW).alias("h"), F.lit(WINDOW).alias("length")))
        return F.filter(F.array(*[seed(_form(c, real, v)) for v in VARIANTS], exact), lambda x: x.isNotNull())

    short = F.array()
    for k in range(WINDOW - 1, MIN_LITERAL - 1, -1):
        whole = F.array(F.struct(F.lit(0).alias("pos"), _real_hash(_each(real), F.lit(0), k).alias("h"), F.lit(k).alias("length")))
        short = F.when(n == k, whole).otherwise(short) if k < WINDOW - 1 else whole
    seeds = F.when(n < WINDOW, short).otherwise(F.flatten(F.transform(F.sequence(F.lit(0), F.greatest(n - WINDOW, F.lit(0))), one)))
    return texts.select("item_hash", "item_tokens", F.explode_outer(seeds).alias("s")).select(
        "item_hash", "item_tokens", F.col("s.pos").alias("item_pos"), "s.h", "s.length").where("h is not null").distinct()


def _compared(x: DataFrame) -> DataFrame:
    """``x (item_tokens, ic, iv, dc, dv)`` with ``(covered, n_slots, n_changed)`` as ``b``, null where the aligned tokens are no leak."""
    def kind(t: Column, names: tuple[str, ...]) -> Column:
        return F.when(t.isin(*names), "n").when(t == NUMBER, "d").when(t == UNIT, "u")

    def token(i: Column, k: Column) -> Column:
        d, iv, dv = F.get("dc", k), F.get("iv", k), F.get("dv", k)
        same = F.coalesce(iv == dv, F.lit(False))
        out = [same.alias("same"), (same & ~i.isin(NUMBER, UNIT)).alias("plain"), (same & ~i.isin(NAME, NUMBER, UNIT)).alias("literal"),
               (same & (i == START) & (d == START)).alias("starter")]
        for rule, names in (("strict", (NAME,)), ("loose", (NAME, START))):
            a = kind(i, names)
            both = F.coalesce(a == kind(d, names), F.lit(False))
            pair = F.struct(F.concat(a, F.lit(":"), iv).alias("i"), F.concat(a, F.lit(":"), dv).alias("d"))
            out += [(same | both).alias(rule), F.when(both, pair).alias(rule + "_pair")]
        return F.struct(*out)

    length = F.least(F.lit(WINDOW), F.col("item_tokens"))
    last = F.col("item_tokens") - length

    def inside(good) -> Column:
        """The tokens in windows that are good."""
        w = F.transform(F.sequence(F.lit(0), last), lambda j: good(F.slice("t", j + 1, length)))

        def of(w: Column) -> Column:
            def hit(_: Column, k: Column) -> Column:
                first = F.greatest(k - length + 1, F.lit(0))
                return F.exists(F.slice(w, first + 1, F.least(k, last) - first + 1), lambda y: y)
            return F.filter("t", hit)
        return let(w, of)

    need = F.least(F.lit(MIN_COVER), F.col("item_tokens"))
    x = x.withColumn("t", F.transform("ic", token))
    found = []
    for rule in ("strict", "loose"):
        pair = rule + "_pair"
        for part, good in (("all", lambda s: F.forall(s, lambda y: y[rule])),
                           ("rich", lambda s: F.forall(s, lambda y: y[rule]) & (F.size(F.filter(s, lambda y: y["literal"])) >= MIN_LITERAL))):
            name = f"{rule}_{part}"
            x = x.withColumn(name, inside(good))
            pairs = F.array_distinct(F.transform(F.filter(name, lambda y: y[pair].isNotNull()), lambda y: y[pair]))
            shown = F.array_distinct(F.transform(F.filter(name, lambda y: y[pair].isNotNull() & ~y["starter"]), lambda y: y[pair]))
            x = x.withColumn(name + "_shown", shown).withColumn(
                name + "_sound", let(pairs, lambda p: F.size(F.array_distinct(F.transform(p, lambda y: y["i"]))) == F.size(p)))
            ok = F.col(name + "_sound") & (F.size(name) >= need) & (F.size(F.filter(name, lambda y: y["plain"])) >= MIN_LITERAL)
            found.append((ok, F.size(name), F.col(name + "_shown")))
    x = x.withColumn("exact", inside(lambda s: F.forall(s, lambda y: y["same"])))
    found.append((F.col("strict_all_sound") & (F.size("exact") >= need), F.size("exact"), F.col("strict_all_shown")))
    best = F.array_max(F.array(*[F.when(ok, F.struct(
        covered.alias("covered"), F.size(shown).alias("n_slots"),
        F.size(F.filter(shown, lambda p: p["i"] != p["d"])).alias("n_changed"))) for ok, covered, shown in found]))
    return x.withColumn("b", best)


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(id, text_hash, item, item_tokens, covered, n_slots, n_changed)``: one row per leaked pair."""
    texts = stored(item_texts(benchmark, item_text_col), "item-texts")
    seeds = stored(item_seeds(texts), "item-seeds")
    lengths = sorted(r[0] for r in seeds.where("length is not null").select("length").distinct().collect())  # WINDOW numbers at most
    text = F.col(text_col)
    d = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    x = _window_hashes(d, lengths)
    hits = stored(x.join(broadcast_if_small(seeds.drop("length"), row_bytes=64), "h").select(
        "id", "text_hash", "item_hash", "item_tokens", (F.col("pos") - F.col("item_pos")).alias("diagonal")).distinct(), "leak-hits")
    by_doc = hits.groupBy(F.col("id").alias("hit_id"), F.col("text_hash").alias("hit_hash")).agg(
        F.collect_list(F.struct("item_hash", "item_tokens", "diagonal")).alias("hits"))
    top = BROADCAST_BYTES // 64
    if hits.limit(top + 1).count() <= top:
        by_doc = F.broadcast(by_doc)
    d = d.join(by_doc, (F.col("text_hash") == F.col("hit_hash")) & F.col("id").eqNullSafe(F.col("hit_id")))
    aligned = _with_tokens(F.col("text"), lambda c, r: F.transform("hits", lambda h: let(
        F.sequence(h["diagonal"], h["diagonal"] + h["item_tokens"] - 1), lambda at: F.struct(
            h["item_hash"].alias("item_hash"), F.transform(at, lambda k: F.get(c, k)).alias("dc"),
            F.transform(at, lambda k: F.get(r, k)).alias("dv")))))
    pairs = d.select("id", "text_hash", F.explode_outer(aligned).alias("a")).select("id", "text_hash", "a.*").join(
        broadcast_if_small(texts, row_bytes=4096), "item_hash")
    g = _compared(pairs).groupBy("id", "text_hash", "item_hash", "item_tokens").agg(F.max("b").alias("b")).where("b is not null")
    names = benchmark.select(F.col(item_col).alias("item"), F.xxhash64(F.col(item_text_col)).alias("item_hash")).distinct()
    return g.join(broadcast_if_small(names, row_bytes=256), "item_hash").select(
        "id", "text_hash", "item", "item_tokens", "b.covered", "b.n_slots", "b.n_changed")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that leak no item, with the columns of ``docs``."""
    found = stored(leaks(docs, benchmark, id_col, text_col).select("id", "text_hash").distinct(), "leaks")
    h, = fresh(docs, "text_hash")
    key_id, key_hash = fresh(docs, "leak_id", "leak_hash")
    bad = broadcast_if_small(found.select(F.col("id").alias(key_id), F.col("text_hash").alias(key_hash)), row_bytes=64)
    marked = docs.withColumn(h, F.xxhash64(F.col(text_col)))
    return marked.join(bad, (marked[h] == bad[key_hash]) & marked[id_col].eqNullSafe(bad[key_id]),
                       "left_anti").select(docs.columns)
