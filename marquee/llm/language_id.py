"""Language identification of mixed-language text (operator 1).

Words are runs of letters of one script.  The script (Unicode ranges) narrows
the candidates to the languages that were seen in that script; each candidate
scores the word by its hashed character bigrams and trigrams, word ends
included.  A Viterbi search over the words, in which a change of language costs
``SWITCH``, labels spans; the document's language is the one whose spans have
the most letters, and its score is their share of all letters.

The search is exact but skips what it can prove.  Let no stretch of words in another
language beat the document's best single language by more than g.  A path with p
stretches of other languages gains p g at most and has p - 1 changes at least (for
p = 1 one change, or it is a single language itself), so with g up to half a ``SWITCH`` the single
language is the best path.  Only the other documents are searched, word by word, all
documents of a slice in lockstep.

The classifier is fitted on a bounded sample of labelled rows: about
``sample_docs`` different texts of every language, chosen by the hash of the text
(documented bound; whole texts; copies count once).  The fitted tables have ``BUCKETS`` rows and a
column per language, whatever the corpus.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
letters of a script that no language was seen in give no evidence (score 0 if
there are no others); ties go to the first language by name; without any
labelled row everything is ``und``; rows are handled one by one, so null ids,
repeated rows and other columns need no rule; an empty table gives an empty
result.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.arrow import SLICE_BYTES, batch, slices, spans
from marquee.llm.common import broadcast_if_small, stored

BUCKETS = 1 << 16
SAMPLE_DOCS = 5000
SWITCH = 8.0
#: Cost of a language that was not seen in a word's script.
FOREIGN = 20.0
#: Share of a language's letters that a script needs to be one of its scripts.
SCRIPT_SHARE = 0.005
CACHE_TOKENS = 300_000

# fixed values: first code point of each Unicode range of letters, and its script
SCRIPTS = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0700, "Syriac"), (0x0750, "Arabic"), (0x0780, "Thaana"), (0x07C0, "Nko"),
    (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B00, "Oriya"),
    (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"), (0x0D80, "Sinhala"),
    (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"), (0x10A0, "Georgian"),
    (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "Cherokee"), (0x1400, "Canadian"), (0x1780, "Khmer"),
    (0x1800, "Mongolian"), (0x1C80, "Cyrillic"), (0x1D00, "Latin"), (0x1F00, "Greek"), (0x2000, "Latin"),
    (0x2D00, "Georgian"), (0x2DE0, "Cyrillic"), (0x2E80, "Han"), (0x3040, "Kana"), (0x3100, "Bopomofo"),
    (0x3130, "Hangul"), (0x31F0, "Kana"), (0x3400, "Han"), (0xA000, "Yi"), (0xA640, "Cyrillic"), (0xA720, "Latin"),
    (0xAC00, "Hangul"), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFF00, "Latin"),
    (0xFF66, "Kana"), (0x10000, "Other"), (0x20000, "Han"), (0x40000, "Other"),
)
_STARTS = [s for s, _ in SCRIPTS]
SCRIPT_NAMES = sorted({n for _, n in SCRIPTS})
_SCRIPT = [SCRIPT_NAMES.index(n) for _, n in SCRIPTS]
_LATIN = SCRIPT_NAMES.index("Latin")


def script_of(c: str) -> int:
    return _SCRIPT[bisect_right(_STARTS, ord(c)) - 1]


def words_of_token(token: str) -> list[tuple[str, int]]:
    """(letters, script) of the runs of one script in a token in lower case."""
    letters = token if token.isalpha() else "".join(filter(str.isalpha, token))
    if not letters:
        return []
    if max(letters) < "Ͱ":
        return [(letters, _LATIN)]
    return [("".join(g), s) for s, g in groupby(letters, script_of)]


def _grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the bigrams and trigrams of all words, and how many each word has."""
    text = "".join(f"\x01{w}\x01" for w in words)
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    n = np.fromiter(map(len, words), np.int64, len(words)) + 2
    at = np.cumsum(n) - n
    two = spans(at, n - 1)
    three = spans(at, n - 2)
    a, b, c = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
    h2 = code[two] * a ^ code[two + 1] * b
    h3 = code[three] * b ^ code[three + 1] * c ^ code[three + 2] * a
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    mix = np.uint64(0xFF51AFD7ED558CCD)
    # the bigrams of a word, then its trigrams: 2 n - 3 places
    out = np.zeros(int((2 * n - 3).sum()), np.int64)
    start = np.cumsum(2 * n - 3) - (2 * n - 3)
    out[spans(start, n - 1)] = (h2 * mix >> shift).astype(np.int64)
    out[spans(start + n - 1, n - 2)] = ((h3 ^ np.uint64(1)) * mix >> shift).astype(np.int64)
    return out, 2 * n - 3


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) to sparse sums (lang, kind, bucket, n); kind 0: character grams, 1: scripts."""
    total: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for b in slices(batches, 1):
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            grams, scripts = total.setdefault(lang, (np.zeros(BUCKETS, np.int64), np.zeros(len(SCRIPT_NAMES), np.int64)))
            words = [w for t in (text or "").lower().split() for w in words_of_token(t)]
            if words:
                buckets, _ = _grams([w for w, _ in words])
                grams += np.bincount(buckets, minlength=BUCKETS)
                scripts += np.bincount([s for _, s in words], [len(w) for w, _ in words], len(SCRIPT_NAMES)).astype(np.int64)
    for lang, counts in total.items():
        for kind, c in enumerate(counts):
            at = np.flatnonzero(c)
            if len(at):
                yield batch(("lang", pa.array([lang] * len(at), pa.string())), ("kind", pa.array([kind] * len(at), pa.int32())),
                            ("bucket", pa.array(at, pa.int32())), ("n", pa.array(c[at], pa.int64())))


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS) -> dict:
    """Fitted tables from rows with a non-null language (a bounded sample, see above)."""
    x = labelled.where(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    sizes = broadcast_if_small(stored(x.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages"), row_bytes=512)
    part = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = x.join(sizes, "lang").where(part * F.col("n") < sample_docs).select("lang", "text").distinct()
    sums = sample.mapInArrow(_count, "lang string, kind int, bucket int, n bigint").groupBy("lang", "kind", "bucket").agg(F.sum("n").alias("n"))
    got = sums.toArrow()  # languages x (buckets + scripts) rows at most
    langs = sorted(set(got.column("lang").to_pylist()))
    place = {v: i for i, v in enumerate(langs)}
    lang = np.array([place[v] for v in got.column("lang").to_pylist()], np.int64)
    kind, bucket, n = (got.column(c).to_numpy() for c in ("kind", "bucket", "n"))
    grams, scripts = np.zeros((BUCKETS, len(langs))), np.zeros((len(SCRIPT_NAMES), len(langs)))
    for k, m in ((0, grams), (1, scripts)):
        here = kind == k
        m[bucket[here], lang[here]] = n[here]
    logs = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * BUCKETS)) if langs else grams
    share = scripts / np.maximum(scripts.sum(axis=0), 1)
    return {"langs": langs, "logs": logs.astype(np.float32), "uses": share >= SCRIPT_SHARE}


class Labeller:
    def __init__(self, model: dict):
        self.langs, self.logs, self.uses = model["langs"], model["logs"], model["uses"]
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.at = np.zeros(0, np.int64)
        self.len = np.zeros(0, np.int64)
        self.score = np.zeros((0, len(self.langs)), np.float32)
        self.letters = np.zeros(0, np.int64)

    def _learn(self, tokens: list[str]) -> None:
        per = [words_of_token(t) for t in tokens]
        n = np.fromiter(map(len, per), np.int64, len(per))
        base = len(self.at)
        self.at = np.concatenate([self.at, len(self.score) + np.cumsum(n) - n])
        self.len = np.concatenate([self.len, n])
        self.known.update(zip(tokens, range(base, base + len(tokens))))
        words = [w for x in per for w in x]
        if words:
            buckets, count = _grams([w for w, _ in words])
            score = np.empty((len(words), len(self.langs)), np.float32)
            start = np.cumsum(count) - count
            for lang in range(len(self.langs)):
                score[:, lang] = np.add.reduceat(self.logs[buckets, lang], start)
            uses = self.uses[[s for _, s in words]]
            nobody = ~uses.any(axis=1)
            worst = np.where(uses, score, np.inf).min(axis=1, initial=np.inf)
            score = np.where(uses, score, (worst - FOREIGN)[:, None])
            score[nobody] = 0
            self.score = np.concatenate([self.score, score])
            self.letters = np.concatenate([self.letters, np.fromiter((len(w) for w, _ in words), np.int64, len(words))])

    def words(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(known words of all texts, one after the other; the end of each text's words)."""
        if len(self.known) > CACHE_TOKENS:
            self._clear()
        tokens: list[str] = []
        ends = np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            if t:
                tokens += t.lower().split()
            ends[i] = len(tokens)
        new = set(tokens).difference(self.known)
        if new:
            self._learn(sorted(new))
        if not tokens:
            return np.zeros(0, np.int64), ends
        index = np.fromiter(map(self.known.__getitem__, tokens), np.int64, len(tokens))
        n = self.len[index]
        return spans(self.at[index], n), np.concatenate([[0], np.cumsum(n)])[ends]

    def label(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language of every word, the words, the end of each text's words)."""
        words, ends = self.words(texts)
        score = self.score[words].astype(np.float64)
        n = np.diff(ends, prepend=0)
        doc = np.repeat(np.arange(len(texts)), n)
        total = np.stack([np.bincount(doc, score[:, k], len(texts)) for k in range(len(self.langs))], axis=1)
        best = total.argmax(axis=1)
        path = best[doc]
        # the largest sum of any stretch by which another language beats the best one
        gain = np.zeros(len(texts))
        own = score[np.arange(len(words)), path] if len(words) else np.zeros(0)
        far = 4 * (np.abs(score).sum() + 1)
        for k in range(len(self.langs)):
            c = np.cumsum(score[:, k] - own)
            down = np.arange(len(texts)) * -far
            # running minimum of the sums before a word; each text starts far below the one before
            before = np.concatenate([[0], c])[:-1] + down[doc] if len(c) else c
            low = np.minimum.accumulate(before) if len(c) else c
            if len(c):
                np.maximum.at(gain, doc, c + down[doc] - low)
        mixed = np.flatnonzero(gain > SWITCH / 2)
        if len(mixed):
            self._search(score, mixed, ends - n, n, path)
        return path, words, ends

    def _search(self, score: np.ndarray, docs: np.ndarray, start: np.ndarray, n: np.ndarray, path: np.ndarray) -> None:
        """Viterbi over the words of ``docs`` in lockstep; writes their labels into ``path``."""
        docs = docs[np.argsort(-n[docs], kind="stable")]
        size, first = n[docs], start[docs]
        steps = int(size[0])
        live = np.searchsorted(-size, -np.arange(steps), side="left")  # texts with a word number t
        value = np.zeros((len(docs), score.shape[1]))
        moved = np.zeros((steps, len(docs), score.shape[1]), bool) if steps * len(docs) < 4_000_000 else None
        if moved is None and len(docs) > 1:  # the longest texts on their own: memory follows the text
            half = max(1, len(docs) // 2)
            self._search(score, docs[:half], start, n, path)
            self._search(score, docs[half:], start, n, path)
            return
        if moved is None:
            moved = np.zeros((steps, 1, score.shape[1]), bool)
        source = np.zeros((steps, len(docs)), np.int32)
        for t in range(steps):
            m = live[t]
            v = value[:m]
            top = v.argmax(axis=1)
            change = v[np.arange(m), top] - SWITCH
            moved[t, :m] = change[:, None] > v
            source[t, :m] = top
            value[:m] = np.maximum(v, change[:, None]) + score[first[:m] + t] if t else score[first[:m]]
        state = np.zeros(len(docs), np.int64)
        for t in range(steps - 1, -1, -1):
            m = live[t]
            ending = size[:m] == t + 1
            state[:m][ending] = value[:m][ending].argmax(axis=1)
            path[first[:m] + t] = state[:m]
            if t:
                go = moved[t, np.arange(m), state[:m]]
                state[:m] = np.where(go, source[t, :m], state[:m])


def identify(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, lang_pred, score, spans)``; spans: ``array<struct<word, words, lang>>`` in text order."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *T._parse_datatype_string(
        "lang_pred string, score double, spans array<struct<word:bigint,words:bigint,lang:string>>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Labeller(shared.value)
        names = np.array([*m.langs, "und"], object)
        kind = pa.struct([("word", pa.int64()), ("words", pa.int64()), ("lang", pa.string())])
        for b in slices(batches, 1, max(1 << 18, 4 * SLICE_BYTES // max(4, len(m.langs)))):
            if not m.langs:
                k = b.num_rows
                yield batch(("id", b.column(0)), ("lang_pred", pa.array(["und"] * k)), ("score", pa.array([0.0] * k)),
                            ("spans", pa.array([[]] * k, pa.list_(kind))))
                continue
            path, words, ends = m.label(b.column(1).to_pylist())
            n = np.diff(ends, prepend=0)
            doc = np.repeat(np.arange(b.num_rows), n)
            letters = m.letters[words]
            sums = np.zeros((b.num_rows, len(m.langs)))
            np.add.at(sums, (doc, path), letters)
            best = sums.argmax(axis=1)
            evidence = np.bincount(doc, np.ptp(m.score[words], axis=1) > 0, b.num_rows) > 0 if len(m.langs) > 1 else n > 0
            score = np.where(evidence, sums[np.arange(b.num_rows), best] / np.maximum(sums.sum(axis=1), 1), 0.0)
            new = np.ones(len(path), bool)
            new[1:] = (path[1:] != path[:-1]) | (doc[1:] != doc[:-1])
            at = np.flatnonzero(new)
            run_len = np.diff(np.append(at, len(path)))
            flat = pa.StructArray.from_arrays([pa.array(at - (ends - n)[doc[at]]), pa.array(run_len), pa.array(names[path[at]], pa.string())],
                                              fields=list(kind))
            offsets = np.concatenate([[0], np.cumsum(np.bincount(doc[at], minlength=b.num_rows))]).astype(np.int32)
            yield batch(("id", b.column(0)), ("lang_pred", pa.array(names[np.where(n > 0, best, len(m.langs))], pa.string())),
                        ("score", pa.array(score)), ("spans", pa.ListArray.from_arrays(pa.array(offsets), flat)))

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)
