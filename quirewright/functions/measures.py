"""Edit distances, overlaps and rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quirewright.functions.text import once

#: First code point that stands for a token when token sequences are compared as strings; those of surrogates are passed over.
_FIRST, _BELOW = 0x4E00, 0xD800 - 0x4E00
#: Code points there are for tokens; a pair with more couldn't be compared in any time, as the distance is quadratic.
MOST_TOKENS = 0x110000 - _FIRST - 0x800


def character_distance(a: Column, b: Column) -> Column:
    return F.levenshtein(a, b)


def token_distance(a: Column, b: Column) -> Column:
    """Edit distance of two arrays of tokens: each distinct token of the pair becomes one character, so it stays in the JVM.

    For pairs of at most ``MOST_TOKENS`` distinct tokens; more raise an error.
    """

    def compared(known: Column) -> Column:
        place = lambda n: F.when(n <= _BELOW, n + (_FIRST - 1)).otherwise(n + (_FIRST - 1 + 0x800))
        sign = lambda t: F.decode(F.unhex(F.lpad(F.hex(place(F.array_position(known, t))), 8, "0")), "UTF-32")
        coded = lambda xs: F.array_join(F.transform(xs, sign), "")
        return F.when(F.size(known) <= MOST_TOKENS, F.levenshtein(coded(a), coded(b))).otherwise(F.raise_error(F.lit("too many distinct tokens in a pair")).cast("int"))

    return once(F.array_distinct(F.concat(a, b)), compared)


def error_rate(distance: Column, reference: Column, hypothesis: Column) -> Column:
    """Distance over reference length; with an empty reference 0 if the hypothesis is empty too, else 1."""
    return F.when(reference == 0, F.when(hypothesis == 0, 0.0).otherwise(1.0)).otherwise(distance / reference)


def rate(part: Column, whole: Column) -> Column:
    """Rounded ratio, null over zero."""
    return F.bround(F.try_divide(part, whole), 6)


def numbered(tokens: Column) -> Column:
    """Tokens told apart by their occurrence, so that sets of them are multisets of tokens."""
    mark = lambda s: F.transform(s, lambda t, i: F.concat(t, F.lit("\u0001"), (i - F.array_position(s, t)).cast("string")))
    return once(F.array_sort(tokens), mark)


def numbered_jaccard(a: Column, b: Column) -> Column:
    """Multiset Jaccard of two arrays of ``numbered`` tokens; 0 if either is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(both / (F.size(a) + F.size(b) - both))


def token_jaccard(a: Column, b: Column) -> Column:
    return numbered_jaccard(numbered(a), numbered(b))


def winner(left: Column, right: Column, left_name: str, right_name: str, lower_wins: bool) -> Column:
    """Name of the better side, tie, or unavailable if a side is null or not finite."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    better = left < right if lower_wins else left > right
    return F.when(bad(left) | bad(right), "unavailable").when(left == right, "tie").when(better, left_name).otherwise(right_name)
