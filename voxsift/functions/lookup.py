"""Joining rows to a per-key table when some keys are very frequent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, functions as F

# A key is "hot" when it holds at least 1/HOT_KEYS of all rows, so there can
# never be more than HOT_KEYS of them, whatever the data looks like.
HOT_KEYS = 500
TRACKED_KEYS = 10_000  # of the sketch that finds them


def hot_keys(counts: DataFrame, key: str, rows: str) -> list[str | None]:
    """The hot keys of a table with the number of rows per key, at most HOT_KEYS.

    One job: the total is observed while the most frequent keys are taken, and
    all hot keys must be among the HOT_KEYS most frequent ones.
    """
    seen = Observation()
    top = (
        counts.observe(seen, F.coalesce(F.sum(rows), F.lit(0)).alias("total"))
        .orderBy(F.desc(rows)).limit(HOT_KEYS).select(key, rows).collect()
    )
    total = seen.get["total"]
    return [row[key] for row in top if row[rows] * HOT_KEYS >= total]


def frequent_keys(rows: DataFrame, key: str) -> list[str | None]:
    """The hot keys of a table, from one pass: at most HOT_KEYS.

    A mergeable sketch of frequent items is kept per task, so no key is moved.
    What it can miss holds less than 3.5/TRACKED_KEYS of all rows, far below 1/HOT_KEYS.
    """
    top = F.expr(f"approx_top_k(`{key}`, {HOT_KEYS}, {TRACKED_KEYS})")
    found = rows.agg(top.alias("top"), F.count("*").alias("total")).first()
    return [entry["item"] for entry in found["top"] or [] if entry["count"] * HOT_KEYS >= found["total"]]


def lookup(
    left: DataFrame, right: DataFrame, key: str, counts: DataFrame | None = None, rows: str = "n"
) -> DataFrame:
    """Left join to a table with at most one row per key, whatever the skew.

    ``counts`` holds the rows of ``left`` per key, if they are known already; else
    a sketch finds its frequent keys. ``right`` is read twice if there are any.
    """
    hot = frequent_keys(left, key) if counts is None else hot_keys(counts, key, rows)
    return lookups(left, [right], key, hot)


def lookups(left: DataFrame, rights: Sequence[DataFrame], key: str, hot: Sequence[str | None]) -> DataFrame:
    """Left joins to several tables with at most one row per key; the rows of ``left`` move once.

    Without hot keys these are plain joins. Else rows of hot keys find their
    entries in broadcast tables of at most HOT_KEYS rows and take part in the
    shuffle joins under a made-up key that spreads them and matches nothing; so
    do rows without a key. Every other key holds less than 1/HOT_KEYS of all
    rows, and AQE splits it further where that is still too much for a task.

    The made-up key depends on the partition a row comes from, so exact copies
    are spread too, and not on the order of rows, so a repeated task sends each
    row where the first attempt did.
    """
    known = [k for k in hot if k is not None]
    joined, values = left, []
    if hot:
        is_hot = F.col(key).isNull() | F.col(key).isin(known)
        spread = F.concat(F.lit("\0"), F.xxhash64(F.spark_partition_id(), F.col(key)).cast("string"))
        joined = joined.withColumn("__join_key", F.when(is_hot, spread).otherwise(F.col(key)))
    for number, right in enumerate(rights):
        names = [c for c in right.columns if c != key]
        at, entry, hot_at, hot_entry = (f"__{name}_{number}" for name in ("key", "entry", "hot_key", "hot_entry"))
        entries = right.select(F.col(key).alias(at), F.struct(*names).alias(entry))
        if not hot:
            joined = joined.join(entries, F.col(key) == F.col(at), "left")
            values.append(f"{entry}.*")
            continue
        joined = joined.join(entries, F.col("__join_key") == F.col(at), "left")
        if known:
            of_hot = right.filter(F.col(key).isin(known)).select(F.col(key).alias(hot_at), F.struct(*names).alias(hot_entry))
            joined = joined.join(F.broadcast(of_hot), F.col(key) == F.col(hot_at), "left")
            joined = joined.withColumn(entry, F.coalesce(hot_entry, entry))
        values.append(f"{entry}.*")
    return joined.select(*left.columns, *values)
