"""Byte-pair encoding and decoding with a public byte-level vocabulary (operator 5).

The pre-tokenizer's words are cut from the code points of many texts at once: a
word starts where the class of the characters changes (letters, numbers, white
space, others), and three corrections for a space before a word, for the other
white space before it and for contractions give the rule of ``PATTERN``.  Words
are found again by a hash over their code points, and every word found is held
against the one that was remembered, so equal hashes never stand for equality.

A word of the pre-tokenizer is encoded by a contiguous rank array: the ids of
its parts stand side by side with the rank of every adjacent pair.  The array
is scanned for the smallest rank (the leftmost of equals), that boundary is
deleted, the parts behind it move up, and the two neighbouring ranks are
refreshed, until no pair can be merged.  All distinct words of a slice that
have similar lengths are rows of one matrix, so every scan is one vector
operation.  Words of more than ``LONG`` bytes keep their pairs in a heap
instead (same order of merges).  A text's ids are gathered from its words';
decoding gathers the bytes of the ids.

The result equals that of the ``tokenizers`` library on the same file without
added special tokens; the string of a special token inside a text becomes that
token, as there.

Defined cases: null and empty texts have no ids and decode to the empty text;
null ids decode like no ids; rows are handled one by one, so repeated rows,
null ids of documents and other columns need no rule; an empty table gives an
empty result.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.arrow import batch, binary, slices, spans
from marquee.llm.common import fresh

#: The pre-tokenizer of the byte-level vocabularies (white space as in Unicode); ``_word_starts`` does the same.
PATTERN = (r"'(?:[stmd]|re|ve|ll)| ?(?:\p{L}++|\p{N}++|[^\p{White_Space}\p{L}\p{N}]++)"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
LONG = 96
#: Distinct words a worker remembers before it starts anew.
CACHE_WORDS = 400_000
#: Characters whose words are cut and looked up at once.
BLOCK = 1 << 20
#: Leading bits of a hash by which most words are found without a search.
SLOT_BITS = 20
NONE = np.int32(1 << 30)


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write the 256 bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


#: Classes of characters.
OTHER, LETTER, NUMBER, WHITE = range(4)


@lru_cache(maxsize=1)
def character_classes() -> np.ndarray:
    """The class of every code point."""
    import regex
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, of in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (WHITE, r"\p{White_Space}+")):
        for m in regex.finditer(of, every):
            out[ord(every[m.start()]):ord(every[m.end() - 1]) + 1] = kind
    return out


def _word_starts(codes: np.ndarray, kind: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where the words of ``PATTERN`` start in texts that stand one after the other, none of them empty."""
    n = len(codes)
    text = np.zeros(n + 3, bool)  # a text starts here
    text[starts] = text[n:] = True
    new = text.copy()
    new[1:n] |= kind[1:] != kind[:-1]
    # the last white space before a word stands alone, or is the word's if it is a space
    white = kind == WHITE
    last = np.flatnonzero(white[:-1] & ~white[1:] & ~text[1:n])
    new[last] = True
    new[last[codes[last] == 32] + 1] = False
    # contractions
    mark = np.flatnonzero(codes == 39)
    mark = mark[new[mark] & ~text[mark + 1]]
    one, two = (np.append(codes, [0, 0])[mark + k] for k in (1, 2))
    short = mark[np.isin(one, [ord(c) for c in "stmd"])]
    new[short + 1], new[short + 2] = False, True
    both = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    both = mark[both & ~text[mark + 2]]
    new[both + 1], new[both + 3] = False, True
    return np.flatnonzero(new[:n])


def load_vocabulary(spark: SparkSession, path: str) -> dict:
    """The parsed vocabulary file (a size fixed by the vocabulary, whatever the corpus)."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    letters = byte_letters()
    vocab, model = {}, file["model"]
    for token, i in model["vocab"].items():
        vocab[i] = bytes(letters[c] for c in token)
    special = {t["content"]: t["id"] for t in file["added_tokens"]}
    for content, i in special.items():
        vocab[i] = content.encode()
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = model["vocab"]
    left, right, made = (np.array(x, np.int64) for x in zip(*[(ids[a], ids[b], ids[a + b]) for a, b in merges]))
    single = np.zeros(256, np.int64)
    for c, b in letters.items():
        single[b] = ids[c]
    return {"vocab": vocab, "special": special, "left": left, "right": right, "made": made, "single": single,
            "classes": character_classes()}


class Encoder:
    """Encodes and decodes slices of texts; lives in one Python worker."""

    def __init__(self, v: dict):
        import regex
        key = v["left"] << 20 | v["right"]
        order = np.argsort(key)
        self.keys, self.ranks, self.made = key[order], order.astype(np.int32), v["made"][order].astype(np.int32)
        self.single = v["single"].astype(np.int32)
        self.first = self._pair(np.repeat(self.single, 256), np.tile(self.single, 256))  # of every two bytes
        self.classes = v["classes"]
        self.seam = regex.compile(r"(?<=\P{White_Space})\p{White_Space}").search
        self.special = v["special"]
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")").split \
            if self.special else None
        size = max(v["vocab"]) + 1
        self.token_len = np.zeros(size, np.int64)
        for i, b in v["vocab"].items():
            self.token_len[i] = len(b)
        self.token_at = np.cumsum(self.token_len) - self.token_len
        self.token_bytes = np.frombuffer(b"".join(v["vocab"].get(i, b"") for i in range(size)), np.uint8)
        self._clear(0)

    def _clear(self, seed: int) -> None:
        self.seed = seed
        self.factors = np.zeros(0, np.uint64)
        self.hashes = np.zeros(0, np.uint64)  # sorted, and the numbers of their words
        self.number = np.zeros(0, np.int64)
        # the number of the first word with the leading bits of its hash, and all hashes by number
        self.slots, self.hash_of = np.full(1 << SLOT_BITS, -1, np.int32), np.zeros(1, np.uint64)
        # by number: where a word's ids and its code points stand
        self.at, self.len, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.code_at, self.code_len, self.codes = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _pair(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of pairs (NONE where there is no merge) and the ids they become."""
        k = a.astype(np.int64) << 20 | b
        i = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
        hit = (self.keys[i] == k) & (a >= 0) & (b >= 0)
        return np.where(hit, self.ranks[i], NONE), self.made[i]

    def _short(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, one after the other; their numbers), words of similar length."""
        n = np.array([len(w) for w in words], np.int64)
        width = int(n.max())
        part = np.full((len(words), width + 1), -1, np.int32)
        filled = np.arange(width)[None, :] < n[:, None]
        letters = np.zeros((len(words), width + 1), np.int32)
        letters[:, :width][filled] = np.frombuffer(b"".join(words), np.uint8)
        part[:, :width][filled] = self.single[letters[:, :width][filled]]
        out = part.copy()
        rows, count = np.arange(len(words)), n.copy()
        two = letters[:, :-1] << 8 | letters[:, 1:]
        rank, made = np.where(part[:, 1:] >= 0, self.first[0][two], NONE), self.first[1][two]
        live = rows
        while len(live):
            best = rank.argmin(axis=1)
            go = rank[np.arange(len(live)), best] < NONE
            if not go.all():  # rows without a pair left are done
                out[live[~go]] = np.pad(part[~go], ((0, 0), (0, out.shape[1] - part.shape[1])), constant_values=-1)
                live, part, rank, made, best = live[go], part[go], rank[go], made[go], best[go]
                if not len(live):
                    break
                keep = int(count[live].max())  # parts only get fewer
                part, rank, made = part[:, :keep + 1], rank[:, :keep], made[:, :keep]
            r = np.arange(len(live))
            new = made[r, best]
            width = rank.shape[1]
            move = np.arange(width)[None, :] > best[:, None]
            # delete the boundary behind the merged part: everything behind it moves up
            part[:, :-1] = np.where(move, part[:, 1:], part[:, :-1])
            part[:, -1] = -1
            rank[:, :-1] = np.where(move[:, :-1], rank[:, 1:], rank[:, :-1])
            made[:, :-1] = np.where(move[:, :-1], made[:, 1:], made[:, :-1])
            rank[:, -1] = NONE
            part[r, best] = new
            count[live] -= 1
            rank[r, best], made[r, best] = self._pair(new, part[r, best + 1])
            before = np.flatnonzero(best > 0)
            j = best[before] - 1
            rank[before, j], made[before, j] = self._pair(part[before, j], new[before])
        keep = np.arange(out.shape[1])[None, :] < count[:, None]
        return out[keep], count

    def _one_long(self, word: bytes) -> np.ndarray:
        """The same merges, lowest rank and then leftmost first, from a heap."""
        part = self.single[np.frombuffer(word, np.uint8)].tolist()
        n = len(part)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        lookup = getattr(self, "merge", None)
        if lookup is None:
            lookup = self.merge = {int(k): (int(r), int(m)) for k, r, m in zip(self.keys, self.ranks, self.made)}
        heap = []

        def push(i: int) -> None:
            j = after[i]
            if j < n and (hit := lookup.get(part[i] << 20 | part[j])):
                heapq.heappush(heap, (hit[0], i, part[i], part[j], hit[1]))

        for i in range(n - 1):
            push(i)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if part[i] != a or j >= n or part[j] != b:
                continue
            part[i], part[j] = new, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return np.array([p for p in part if p >= 0], np.int64)

    def _learn(self, raw: list[bytes]) -> None:
        """Remembers the ids of new words."""
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        order = np.argsort(size, kind="stable")
        ids, counts = [], []
        at = 0
        while at < len(order):
            first = size[order[at]]
            if first > LONG:
                got = self._one_long(raw[order[at]])
                ids.append(got)
                counts.append(np.array([len(got)], np.int64))
                at += 1
                continue
            end = min(at + 20_000, int(np.searchsorted(size, min(LONG, first + 3), side="right", sorter=order)))
            flat, count = self._short([raw[i] for i in order[at:end]])
            ids.append(flat)
            counts.append(count)
            at = end
        count = np.concatenate(counts)
        place = np.empty(len(raw), np.int64)
        place[order] = np.arange(len(raw))
        self.at = np.concatenate([self.at, (len(self.flat) + np.cumsum(count) - count)[place]])
        self.len = np.concatenate([self.len, count[place]])
        self.flat = np.concatenate([self.flat, *ids]).astype(np.int32)

    def _hashes(self, codes: np.ndarray, starts: np.ndarray, n: np.ndarray) -> np.ndarray:
        """A hash of every word: its code points times random factors by position, summed."""
        longest = int(n.max())
        if longest > len(self.factors):
            self.factors = np.random.default_rng(self.seed).integers(1, 2**64, max(longest, 64), np.uint64)
        at = np.arange(len(codes)) - np.repeat(starts, n)
        return np.add.reduceat((codes.astype(np.uint64) + np.uint64(1)) * self.factors[at], starts)

    def _numbers(self, text: str, codes: np.ndarray, starts: np.ndarray, n: np.ndarray) -> np.ndarray | None:
        """The numbers of the words, new ones learnt; None if different words have one hash."""
        h = self._hashes(codes, starts, n)
        slot = (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        out = self.slots[slot].astype(np.int64)
        miss = np.flatnonzero((out < 0) | (self.hash_of[out] != h))
        if len(self.hashes):
            i = np.minimum(np.searchsorted(self.hashes, h[miss]), len(self.hashes) - 1)
            out[miss] = self.number[i]
            miss = miss[self.hashes[i] != h[miss]]
        if len(miss):
            new, first, of = np.unique(h[miss], return_index=True, return_inverse=True)
            word, base = miss[first], len(self.at)
            a, size = starts[word], n[word]
            self._learn([text[b:e].encode() for b, e in zip(a.tolist(), (a + size).tolist())])
            self.code_at = np.concatenate([self.code_at, len(self.codes) + np.cumsum(size) - size])
            self.code_len = np.concatenate([self.code_len, size])
            self.codes = np.concatenate([self.codes, codes[spans(a, size)]])
            where = np.searchsorted(self.hashes, new)
            self.hashes = np.insert(self.hashes, where, new)
            self.number = np.insert(self.number, where, base + np.arange(len(new)))
            self.hash_of = np.concatenate([self.hash_of[:base], new])
            free = self.slots[slot[word]] < 0
            self.slots[slot[word][free]] = base + np.flatnonzero(free)
            out[miss] = base + of
        same = (self.code_len[out] == n).all() and (self.codes[spans(self.code_at[out], n)] == codes).all()
        return out if same else None

    def _block(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces, one after the other; their numbers)."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(size)
        text = "".join(pieces)
        if not text:
            return np.zeros(0, np.int32), np.zeros(len(pieces), np.int64)
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        starts = _word_starts(codes, self.classes[codes], (ends - size)[size > 0])
        n = np.diff(starts, append=len(codes))
        while (word := self._numbers(text, codes, starts, n)) is None:
            self._clear(self.seed + 1)
        count = self.len[word]
        total = np.concatenate([[0], np.cumsum(count)])
        return self.flat[spans(self.at[word], count)], np.diff(total[np.searchsorted(starts, ends)], prepend=0)

    def _parts(self, piece: str) -> Iterator[str]:
        """A long piece cut before white space behind other characters, where a word ends in any case."""
        while len(piece) > BLOCK and (seam := self.seam(piece, BLOCK)):
            yield piece[:seam.start()]
            piece = piece[seam.start():]
        yield piece

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, one after the other; the end of each text's ids)."""
        if len(self.hashes) > CACHE_WORDS:
            self._clear(self.seed)
        pieces: list[str] = []
        ends = np.zeros(len(texts), np.int64)
        marks: list[tuple[int, int]] = []  # this piece is a special token
        for i, t in enumerate(texts):
            if t:
                if self.split and any(s in t for s in self.special):
                    for k, piece in enumerate(self.split(t)):
                        if k % 2:
                            marks.append((len(pieces), self.special[piece]))
                            pieces.append("")
                        else:
                            pieces += self._parts(piece)
                else:
                    pieces += self._parts(t)
            ends[i] = len(pieces)
        size = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        cuts = [0, *(np.flatnonzero(np.diff(size // BLOCK)) + 1).tolist(), len(pieces)]
        done = [self._block(pieces[a:z]) for a, z in zip(cuts, cuts[1:]) if a < z]
        ids = np.concatenate([np.zeros(0, np.int32), *(d[0] for d in done)]).astype(np.int64)
        count = np.concatenate([np.zeros(0, np.int64), *(d[1] for d in done)])
        if marks:
            where = np.array([m[0] for m in marks])
            ids = np.insert(ids, (np.cumsum(count) - count)[where], [m[1] for m in marks])
            count[where] = 1
        return ids, np.concatenate([[0], np.cumsum(count)])[ends]

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all texts, one after the other; the end of each text's bytes)."""
        n = self.token_len[ids]
        data = self.token_bytes[spans(self.token_at[ids], n)]
        total = np.concatenate([[0], np.cumsum(n)])
        return data, total[ends]


def _valid(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Strings of decoded bytes; what is not UTF-8 is replaced, as the library does."""
    raw = data.tobytes()
    try:
        raw.decode("utf-8")
        return binary(raw, ends, pa.string())
    except UnicodeDecodeError:
        starts = np.concatenate([[0], ends[:-1]])
        return pa.array([raw[a:z].decode("utf-8", "replace") for a, z in zip(starts, ends)], pa.string())


def _texts(b: pa.RecordBatch, i: int) -> list[str | None]:
    return b.column(i).to_pylist()


def encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the token ids of its texts, ``array<int>``."""
    v = docs.sparkSession.sparkContext.broadcast(load_vocabulary(docs.sparkSession, path))
    at = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = Encoder(v.value)
        for b in slices(batches, at):
            ids, ends = e.encode(_texts(b, at))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*b.columns, lists], names=[*b.schema.names, ids_col])

    if ids_col.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"there is a column {ids_col}")
    return docs.mapInArrow(run, schema)


def decode(rows: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``rows`` with the text of its ``array<int>`` ids (null ids: the empty text)."""
    v = rows.sparkSession.sparkContext.broadcast(load_vocabulary(rows.sparkSession, path))
    at = rows.columns.index(ids_col)
    schema = T.StructType([*rows.schema.fields, T.StructField(text_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = Encoder(v.value)
        for b in batches:
            lists = b.column(at)  # flatten() leaves the null lists out
            n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            data, ends = e.decode(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum(n))
            yield pa.RecordBatch.from_arrays([*b.columns, _valid(data, ends)], names=[*b.schema.names, text_col])

    return rows.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_tokens, ids, decoded)``: ids as little-endian unsigned 32-bit integers, and their text.

    Encoding and decoding share one pass over the rows.
    """
    v = docs.sparkSession.sparkContext.broadcast(load_vocabulary(docs.sparkSession, path))
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = Encoder(v.value)
        for b in slices(batches, 1):
            ids, ends = e.encode(_texts(b, 1))
            data, byte_ends = e.decode(ids, ends)
            yield batch(("id", b.column(0)), ("n_tokens", pa.array(np.diff(ends, prepend=0), pa.int64())),
                        ("ids", binary(ids.astype("<u4").tobytes(), ends * 4)), ("decoded", _valid(data, byte_ends)))

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def tokenized(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with ``n_tokens``, ``ids`` and ``lossless``: whether they decode to the text."""
    v = docs.sparkSession.sparkContext.broadcast(load_vocabulary(docs.sparkSession, path))
    at = docs.columns.index(text_col)
    names = fresh(docs, "n_tokens", "ids", "lossless")
    kinds = (T.LongType(), T.ArrayType(T.IntegerType()), T.BooleanType())
    rest = [i for i in range(len(docs.columns)) if i != at]
    schema = T.StructType([*(docs.schema.fields[i] for i in rest), *map(T.StructField, names, kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = Encoder(v.value)
        for b in slices(batches, at):
            ids, ends = e.encode(_texts(b, at))
            text = _valid(*e.decode(ids, ends))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids.astype(np.int32)))
            same = pc.equal(text, pc.fill_null(b.column(at), ""))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in rest), pa.array(np.diff(ends, prepend=0), pa.int64()), lists, same],
                names=[*(b.schema.names[i] for i in rest), *names])

    return docs.mapInArrow(run, schema)
