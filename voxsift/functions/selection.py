"""The row at a place in a total order, without sorting the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, functions as F

TAKEN = 10_000  # rows that are put in order at once, at most
DRAWN = 4_096  # keys that pivots are taken from


def key_literal(row: Row, columns: Sequence[str]) -> Column:
    """A key as a struct that compares with ``struct(columns)``; nulls come first."""
    return F.struct(*(F.lit(row[name]).cast("string").alias(name) for name in columns))


def nth_key(rows: DataFrame, columns: Sequence[str], n: int) -> Row | None:
    """The n-th smallest key (text columns, counted from 1, repeated keys included); None if there are fewer rows.

    Two pivots that lie on both sides of the place in a bounded random sample
    divide the keys into three ranges; their rows are counted, and only the range
    that holds the place is looked at again. Each round keeps about a tenth of the
    rows and never moves them: no shuffle but of counts and samples. A key that
    very many rows share is found as soon as it is a pivot. Once the place is
    among the first ``TAKEN`` rows of its range, these are taken in order. Which
    keys are drawn changes the rounds, not the result.
    """
    if n < 1:
        raise ValueError("places are counted from 1")
    key = F.struct(*columns)
    part = rows.select(*columns)
    while n > TAKEN:
        drawn = part.orderBy(F.rand()).limit(DRAWN).select(key.alias("k")).orderBy("k").collect()
        total = part.count()
        if total < n:
            return None
        place, spread = n / total * len(drawn), 3 * len(drawn) ** 0.5
        low = drawn[max(0, int(place - spread))]["k"]
        high = drawn[min(len(drawn) - 1, int(place + spread) + 1)]["k"]
        below, above = key_literal(low, columns), key_literal(high, columns)
        counts = part.agg(
            F.count_if(key < below).alias("a"), F.count_if(key <= below).alias("b"),
            F.count_if(key < above).alias("c"), F.count_if(key <= above).alias("d"),
        ).first()
        if n <= counts["a"]:
            part = part.filter(key < below)
        elif n <= counts["b"]:
            return low
        elif n <= counts["c"]:
            part, n = part.filter((key > below) & (key < above)), n - counts["b"]
        elif n <= counts["d"]:
            return high
        else:
            part, n = part.filter(key > above), n - counts["d"]
    first = part.orderBy(*columns).limit(n).agg(F.max(key).alias("k"), F.count("*").alias("n")).first()
    return first["k"] if first["n"] == n else None


def first_rows(rows: DataFrame, columns: Sequence[str], n: int) -> tuple[Column | None, Row | None, int]:
    """What the first n rows by a key are: (all before this key, the key at the place, how many rows of that key).

    ``(None, None, 0)`` means that all rows are among them. The number is 0 if all rows of the last key are.
    """
    last = nth_key(rows, columns, n)
    if last is None:
        return None, None, 0
    key, found = F.struct(*columns), key_literal(last, columns)
    counts = rows.agg(F.count_if(key < found).alias("less"), F.count_if(key == found).alias("equal")).first()
    needed = n - counts["less"]
    return key < found, last, 0 if needed == counts["equal"] else needed
