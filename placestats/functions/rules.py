"""Conditional classification driven by data: every rule takes its table as an argument."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from placestats.functions.text import any_like, any_word


def first_match(rules: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """Value of the first true condition; null conditions count as false."""
    (cond, value), *rest = rules
    out = F.when(cond, F.lit(value))
    for cond, value in rest:
        out = out.when(cond, F.lit(value))
    return out if default is None else out.otherwise(default if isinstance(default, Column) else F.lit(default))


def bucketize(col: Column, ranges: Sequence[tuple], default: object) -> Column:
    """Label of the closed range that holds the value."""
    return first_match([(col.between(lo, hi), label) for lo, hi, label in ranges], default)


def member_label(col: Column, groups: Mapping[str, Sequence], default: object) -> Column:
    """Label of the list that holds the value."""
    return first_match([(col.isin(list(members)), label) for label, members in groups.items()], default)


def map_values(col: Column, table: Mapping, default: object = None) -> Column:
    """Look the value up in a small literal map."""
    literal = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
    found = F.try_element_at(literal, col)
    return found if default is None else F.coalesce(found, F.lit(default))


def keyword_tier(col: Column, tiers: Sequence[tuple[Sequence[str], object]], default: object) -> Column:
    """Value of the first word list with a word in the text."""
    return first_match([(any_word(col, list(words)), value) for words, value in tiers], default)


def keyword_flag(col: Column, words: Sequence[str]) -> Column:
    return F.coalesce(any_word(col, list(words)), F.lit(False))


def pattern_map(col: Column, rules: Sequence[tuple[Sequence[str], str]], default: object) -> Column:
    """Label of the first list with a case-insensitive LIKE match."""
    return first_match([(any_like(col, list(pats), ci=True), label) for pats, label in rules], default)


def pattern_flag(col: Column, patterns: Sequence[str]) -> Column:
    return F.coalesce(any_like(col, list(patterns), ci=True), F.lit(False))


def flag_in(col: Column, values: Sequence) -> Column:
    return F.coalesce(col.isin(list(values)), F.lit(False))


def validate_code(col: Column, allowed: Sequence[str], default: str) -> Column:
    code = F.upper(F.trim(col))
    return F.when(code.isin(list(allowed)), code).otherwise(F.lit(default))


def grade(score: Column, bands: Sequence[tuple[float, object]], default: object, op: str = ">=") -> Column:
    """Label of the first band the score meets, from above (`>=`) or below (`<=`)."""
    meets = (lambda t: score >= t) if op == ">=" else (lambda t: score <= t)
    return first_match([(meets(t), label) for t, label in bands], default)


def color_of(col: Column, table: Mapping[str, Sequence[int]], default: Sequence[int]) -> Column:
    """Colour array looked up by label."""
    arrays = {k: F.array(*[F.lit(v) for v in rgba]) for k, rgba in table.items()}
    other = F.array(*[F.lit(v) for v in default])
    out = None
    for label, rgba in arrays.items():
        out = F.when(col == label, rgba) if out is None else out.when(col == label, rgba)
    return out.otherwise(other)


def trend_class(recent: Column, base: Column, tol: float = 0.05) -> Column:
    """increasing / decreasing / stable against a base, within a relative tolerance."""
    zero_base = F.when(recent > 0, F.lit("increasing")).otherwise(F.lit("stable"))
    moved = (
        F.when(recent > base * F.lit(1 + tol), F.lit("increasing"))
        .when(recent < base * F.lit(1 - tol), F.lit("decreasing"))
        .otherwise(F.lit("stable"))
    )
    return F.when(base == 0, zero_base).otherwise(moved)


def direction(forecast: Column, recent: Column, tol: float = 0.05) -> Column:
    return (
        F.when(forecast > recent * F.lit(1 + tol), F.lit("rising"))
        .when(forecast < recent * F.lit(1 - tol), F.lit("falling"))
        .otherwise(F.lit("flat"))
    )


def reversal(trend: Column, heading: Column) -> Column:
    """Does the forecast turn against the recent trend?"""
    return ((trend == "decreasing") & (heading == "rising")) | ((trend == "increasing") & (heading == "falling"))


def reliability(*doubts: Column) -> Column:
    """LOW when any doubt holds; a null doubt does not count."""
    doubtful = F.lit(False)
    for d in doubts:
        doubtful = doubtful | F.coalesce(d, F.lit(False))
    return F.when(doubtful, F.lit("LOW")).otherwise(F.lit("HIGH"))
