"""Similarity measures. Text similarity is the only Python function."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import BRAND_WEIGHT, NAME_WEIGHT, PRICE_WEIGHT


@F.pandas_udf(T.DoubleType())
def matching_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio of two normalised texts; not symmetric."""
    matcher = SequenceMatcher(None)
    current = None
    ratios = []
    for a, b in zip(left, right):
        if b != current:
            matcher.set_seq2(b)
            current = b
        matcher.set_seq1(a)
        ratios.append(matcher.ratio())
    return pd.Series(ratios, dtype="float64")


def price_similarity(left: Column, right: Column) -> Column:
    """One for equal prices, towards zero as they part; a missing price gives zero."""
    one = F.lit(1.0)
    return F.coalesce(
        F.greatest(F.lit(0.0), one - F.abs(left - right) / F.greatest(left, right, one))
        , F.lit(0.0)
    )


def base_score(name_similarity: Column, brand_similarity: Column) -> Column:
    return F.lit(NAME_WEIGHT) * name_similarity + F.lit(BRAND_WEIGHT) * brand_similarity


def full_score(base: Column, price: Column) -> Column:
    return base + F.lit(PRICE_WEIGHT) * price


# The characters a normalised text can hold.
SYMBOLS = "abcdefghijklmnopqrstuvwxyz0123456789 "


def symbol_counts(normalized: Column) -> Column:
    """How often each symbol occurs in a normalised text."""
    size = F.length(normalized)
    return F.array(*[
        size - F.length(F.replace(normalized, F.lit(s), F.lit(""))) for s in SYMBOLS])


def shared_symbols_bound(left: Column, right: Column, total: Column) -> Column:
    """Upper bound of the matching ratio: matched characters are shared characters.

    ``left`` and ``right`` are symbol counts, ``total`` the joint length.
    """
    shared = F.lit(0)
    for i in range(len(SYMBOLS)):
        shared = shared + F.least(left[i], right[i])
    return F.when(total == 0, F.lit(1.0)).otherwise(2.0 * shared / total)


def substrings(normalized: Column, size: Column) -> Column:
    """Every substring of ``size`` characters, in place order; null when too short."""
    return F.when(
        F.length(normalized) >= size,
        F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(normalized) - size + 1, F.lit(1))),
            lambda i: F.substring(normalized, i, size)),
    )


def rounded_score(score: Column) -> Column:
    """A score from 0 to 1 to four decimals, by its exact binary value, ties to even.

    ``bround`` on a double rounds its printed digits, which may lie on the other side of
    a tie. In units of 2 ** -60 the value is an integer and, for small ones, a fraction of few bits.
    """
    scaled = score * F.lit(float(1 << 60))
    integer = F.floor(scaled).cast("bigint")
    fraction = (scaled - integer.cast("double")) * F.lit(10_000.0)
    more = fraction > F.floor(fraction).cast("double")
    units = integer.cast("decimal(20,0)") * F.lit(10_000).cast("decimal(5,0)") + F.floor(fraction).cast("decimal(5,0)")
    one = F.lit(1 << 60).cast("decimal(19,0)")
    whole = F.floor(units / one).cast("bigint")
    rest = units - whole.cast("decimal(19,0)") * one
    half = F.lit(1 << 59).cast("decimal(19,0)")
    up = (rest > half) | ((rest == half) & (more | (whole % 2 == 1)))
    return (whole + F.when(up, 1).otherwise(0)) / F.lit(10_000.0)
