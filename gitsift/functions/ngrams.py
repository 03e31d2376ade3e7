"""Tokens of messages and diffs: words, word pairs, character n-grams, id sequences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gitsift import fixed_values as fv
from gitsift.functions.text import let, strip


def words(text: Column) -> Column:
    """Lower-cased runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({fv.WORD})"), F.lit(1))


def word_terms(text: Column) -> Column:
    """Words, then pairs of neighbouring words."""

    def with_pairs(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - 2)
        pairs = F.transform(starts, lambda i: F.concat_ws(" ", w[i], w[i + 1]))
        return F.when(F.size(w) >= 2, F.concat(w, pairs)).otherwise(w)

    return let(words(text), with_pairs)


def char_terms(text: Column) -> Column:
    """Character 3- to 5-grams inside space-padded chunks, by size and then by place.

    With two spaces between chunks, a piece lies inside one padded chunk exactly
    when no space is among its inner characters. A look-ahead finds the pieces
    at every place in one pass per size; one character is consumed each time, so
    characters outside the basic plane count as one.
    """
    spaced = F.regexp_replace(strip(F.lower(text)), f"{fv.SPACE_CLASS}+", "  ")
    low, high = fv.CHAR_NGRAMS

    def pieces(padded: Column) -> Column:
        return F.concat(*[
            F.regexp_extract_all(padded, F.lit(f"(?s)(?=(.[^ ]{{{n - 2}}}.))."), F.lit(1))
            for n in range(low, high + 1)])

    return let(F.concat(F.lit(" "), spaced, F.lit(" ")), pieces)


def joined_pieces(text: Column, analyzer: str) -> Column:
    """What ``term_counts`` takes apart: word terms, or the chunks that hold the n-grams, a line each."""
    if analyzer == "word":
        return F.array_join(word_terms(text), "\n")
    return F.regexp_replace(strip(F.lower(text)), f"{fv.SPACE_CLASS}+", "\n")


def plain_tokens(text: Column) -> Column:
    """Lower-cased, punctuation removed, split at white space."""
    bare = F.regexp_replace(F.lower(text), fv.PUNCTUATION, "")
    return F.filter(F.split(bare, f"{fv.SPACE_CLASS}+"), lambda w: w != "")
