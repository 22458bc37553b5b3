"""Pair similarities that built-in column functions express."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import char_ngrams


def token_jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; two empty ones are equal."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def set_cosine(x: Column, y: Column) -> Column:
    """Unweighted cosine of two arrays without repeats; 0 if either is empty."""
    product = F.size(x) * F.size(y)
    return F.when(product == 0, 0.0).otherwise(F.size(F.array_intersect(x, y)) / F.sqrt(product.cast("double")))


def ngram_cosine(a: Column, b: Column, n: int = 3) -> Column:
    """Of the n-gram sets of two texts."""
    return set_cosine(F.array_distinct(char_ngrams(a, n)), F.array_distinct(char_ngrams(b, n)))


def acronym(words: Column) -> Column:
    return F.array_join(F.transform(words, lambda t: F.substring(t, 1, 1)), "")


def acronym_match(words_a: Column, words_b: Column, nospace_a: Column, nospace_b: Column) -> Column:
    return ((acronym(words_a) == nospace_b) | (acronym(words_b) == nospace_a)).cast("double")


def abbreviation_share(a: Column, b: Column) -> Column:
    """Share of the shorter name's words that start some word of the longer; of equal lengths the first is the shorter."""
    first = F.size(a) <= F.size(b)
    short, long_ = F.when(first, a).otherwise(b), F.when(first, b).otherwise(a)
    # A word starts some word of the longer name where it stands after a blank in their joined text: no nested loop over words.
    joined = F.concat(F.lit(" "), F.array_join(long_, " "))
    hits = F.size(F.filter(short, lambda t: F.contains(joined, F.concat(F.lit(" "), t))))
    return F.when(F.size(short) == 0, 0.0).otherwise(hits / F.size(short))


def legal_form_code(a: Column, b: Column) -> Column:
    """2 equal, 1 different, 0 if one is missing."""
    return F.when(a.isNull() | b.isNull(), 0).when(a == b, 2).otherwise(1)


def shared_numbers(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def number_conflict(a: Column, b: Column) -> Column:
    return ((F.size(a) > 0) & (F.size(b) > 0) & (shared_numbers(a, b) == 0)).cast("double")


def postcode_equal(a: Column, b: Column) -> Column:
    return F.coalesce((a != "") & (a == b), F.lit(False)).cast("double")


def address_missing(a: Column, b: Column) -> Column:
    return ((F.coalesce(a, F.lit("")) == "") | (F.coalesce(b, F.lit("")) == "")).cast("double")

