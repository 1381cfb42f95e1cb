"""Column helpers for text, null handling and value domains."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from .. import fixed_values as fv
from .picks import literal


def strip(text: Column) -> Column:
    """Text without leading and trailing whitespace of any kind; null gives ''."""
    return F.coalesce(F.btrim(text, F.lit(fv.WHITESPACE)), F.lit(""))


def is_blank(text: Column) -> Column:
    return strip(text) == ""


def unless(text: Column, *unwanted: str) -> Column:
    """The text, or null where it is blank or one of ``unwanted``."""
    return F.when(~F.coalesce(text, F.lit("")).isin("", *unwanted), text)


def one_of(value: Column, domain: Iterable[str], otherwise: str) -> Column:
    """The value where it is in the domain, else the fallback (also for null)."""
    return F.when(value.isin(*domain), value).otherwise(F.lit(otherwise))


def clamp(value: Column, low: float, high: float) -> Column:
    """The value moved into [low, high]; null stays null.

    ``greatest``/``least`` skip nulls, hence the guard.
    """
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def count_phrases(lowered: str, phrases: Iterable[str]) -> Column:
    """How many of the phrases occur in an already lower-cased text column."""
    return F.expr(
        " + ".join(f"cast(contains({lowered}, {literal(phrase)}) AS INT)" for phrase in phrases)
    )


def contains_any(lowered: str, phrases: Iterable[str]) -> Column:
    """Whether one of the phrases occurs in an already lower-cased text column."""
    return F.expr(" OR ".join(f"contains({lowered}, {literal(phrase)})" for phrase in phrases))


def rows_of(items: Column) -> Column:
    """One row per array entry, one with null for an empty array.

    The outer form on purpose: for ``explode`` the optimizer adds a filter on
    the array's size and pushes it down, which repeats the whole expression
    behind a computed array. Filter the null entries afterwards.
    """
    return F.explode_outer(items)
