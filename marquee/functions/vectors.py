"""Column expressions for genre vectors and cosine scores.

A genre vector over a vocabulary of k names is multi-hot; the same set is also
kept as a bit mask (``bigint``, bit i = vocabulary[i]) so that movies sharing a
genre set share one *signature* and a score is computed once per signature.
All expressions are built-in Catalyst expressions (no Python UDF).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.schema import GENRE_SEPARATOR

WORD_NAMES = 62  # bits of a non-negative bigint


def genre_list(genres: Column) -> Column:
    """Split the separator-joined genre string into an array.

    Empty names at the end are dropped (``Action|`` is one genre, ``|`` none),
    as a split on the JVM does; an empty name elsewhere stays, and is unknown.
    """
    sep = "[" + GENRE_SEPARATOR + "]"
    return F.when(genres.rlike(f"^{sep}+$"), F.array().cast("array<string>")).otherwise(
        F.split(F.regexp_replace(genres, f"{sep}+$", ""), sep))


def multi_hot(genre_arr: Column, vocabulary: Sequence[str]) -> Column:
    """``array<double>``: 1.0 where the vocabulary name is in the array, else 0.0."""
    return F.array(*[F.when(F.array_contains(genre_arr, g), F.lit(1.0)).otherwise(F.lit(0.0))
                     for g in vocabulary])


def _word(genre_arr: Column, names: Sequence[str]) -> Column:
    out = F.lit(0).cast("bigint")
    for i, g in enumerate(names):
        out = out.bitwiseOR(F.when(F.array_contains(genre_arr, g), F.lit(1 << i).cast("bigint"))
                            .otherwise(F.lit(0).cast("bigint")))
    return out


def genre_mask(genre_arr: Column, vocabulary: Sequence[str]) -> Column:
    """The vocabulary names present in the array as bits: a ``bigint``, or an
    ``array<bigint>`` of words for a vocabulary of more than ``WORD_NAMES`` names."""
    if len(vocabulary) <= WORD_NAMES:
        return _word(genre_arr, vocabulary)
    return F.array(*[_word(genre_arr, vocabulary[i:i + WORD_NAMES]) for i in range(0, len(vocabulary), WORD_NAMES)])


def mask_literal(value: int, k: int) -> Column:
    """A mask that no set has, of the type that ``k`` names need."""
    word = F.lit(value).cast("bigint")
    return word if k <= WORD_NAMES else F.array(word)


def mask_size(mask: Column, vocabulary: Sequence[str]) -> Column:
    """The number of names in a mask."""
    if len(vocabulary) <= WORD_NAMES:
        return F.bit_count(mask)
    return F.aggregate(mask, F.lit(0), lambda n, word: n + F.bit_count(word))


def mask_positions(mask: str, k: int) -> Column:
    """``array<int>``: 1-based vocabulary positions of a mask, ascending."""
    word = mask if k <= WORD_NAMES else f"element_at({mask}, cast(floor((i - 1) / {WORD_NAMES}) as int) + 1)"
    return F.expr(f"filter(sequence(1, {int(k)}), i -> (shiftright({word}, cast((i - 1) % {WORD_NAMES} as int)) & 1) = 1)")


def unknown_genres(genre_arr: Column, vocabulary: Sequence[str]) -> Column:
    """Names in the array that are not in the vocabulary."""
    vocab = F.array(*[F.lit(g) for g in vocabulary])
    return F.filter(genre_arr, lambda g: ~F.array_contains(vocab, g))


def norm(vec: Column) -> Column:
    """Euclidean norm of an ``array<double>``."""
    return F.sqrt(F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + x * x))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def scaled_cosine(dot_: Column, norm_a: Column, norm_b: Column, scale: float) -> Column:
    """``scale * dot / (|a||b|)``; a zero denominator yields ``scale * dot``.

    (With non-negative vectors a zero norm means a zero dot product, so the
    result is 0 there.)
    """
    denom = norm_a * norm_b
    return F.lit(scale) * F.when(denom != 0, dot_ / denom).otherwise(dot_)
