"""Mixing sources to target weights by Pareto order sampling.

A source's target is its weighted share of all words, at most ``most_repeats``
times its own; what is cut off goes to the other sources by weight. A document
is due target / size copies, in proportion to its weight if it has one. Whole
copies are certain; what is left of each document is its inclusion odds. The
documents are ranked by random odds over inclusion odds, and the first ones, up
to the number of words that the source still lacks, get one copy more.

A rank is never taken over a whole source: the ranking value is cut into narrow
buckets, the words of each bucket are added up, and only the order within a
bucket of some thousand rows is sorted. So a source with a third of all
rows is as many tasks as its buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.staging import stage

WORD = r"[^\x20\x09-\x0D]+"
BUCKET_ROWS = 4_000
SALTS = 32
BORDERS = 256  # quantiles of the ranking value that bound the buckets of a source with weighted documents
ROUNDS = 60  # of sharing out again what the limit cuts off, at most


def uniform(key: Column, seed: int) -> Column:
    """A repeatable draw in (0, 1), from 52 bits of a hash of the key."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{seed}")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def targets(per_source: DataFrame, weights: tuple[float, ...], most_repeats: float) -> DataFrame:
    """Add ``target`` to the rows (source, source_size), one per source.

    Sources in order of code points, null last, take the weights in turn. The
    weighted level is the one at which all targets add up to all words: the
    sources that it would take over their limit are a prefix of the order by
    limit over weight.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source
    listed = F.array(*(F.lit(float(w)) for w in weights))
    df = per_source.withColumn("m_w", F.element_at(listed, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    df = df.withColumn("m_limit", F.lit(float(most_repeats)) * F.col("source_size"))
    by_limit = Window.orderBy(F.col("m_limit") / F.col("m_w"), F.col("source").asc_nulls_last())
    before, all_rows = by_limit.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left_words = F.sum("source_size").over(all_rows) - F.coalesce(F.sum("m_limit").over(before), F.lit(0.0))
    left_weight = F.sum("m_w").over(all_rows) - F.coalesce(F.sum("m_w").over(before), F.lit(0.0))
    df = df.withColumn("m_level", left_words / left_weight)
    level = F.min(F.when(F.col("m_limit") > F.col("m_level") * F.col("m_w"), F.struct(F.col("m_limit") / F.col("m_w"), F.col("m_level"))))
    df = df.withColumn("m_found", level.over(all_rows)["m_level"])
    share = F.col("m_found") * F.col("m_w")
    return df.select("source", "source_size", F.when(share < F.col("m_limit"), share).otherwise(F.col("m_limit")).alias("target"))


def mix(
    docs: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), most_repeats: int = 3, seed: int = 11,
    weight_col: str | None = None,
) -> DataFrame:
    """Per row: doc_id, source, size, source_size, target and ``copies``, the times the mix takes it (0 to most_repeats).

    ``size`` is the number of words of the text, 0 for null. Documents without
    words, and sources without any, take no part: 0 copies. A null source is a
    source. ``docs`` needs doc_id, text and source; repeated rows count each.
    Draws depend on doc_id alone, so reruns agree.

    With ``weight_col`` documents are due copies in proportion to it, at most
    ``most_repeats``; what that cuts off is shared out among the others of the
    source. Null, NaN, infinite, zero and negative weights: 0 copies. A source whose
    weighted documents cannot fill its target is taken ``most_repeats`` times.
    """
    weight = F.lit(1.0)
    if weight_col:
        given = F.col(weight_col).cast("double")
        weight = F.when((given > 0) & ~F.isnan(given) & (given < float("inf")), given).otherwise(0.0)
    narrow = docs.select(
        "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        weight.alias("m_weight"),
    )
    return _mix(_ranked(stage(narrow, "sizes"), weights, most_repeats, seed, weighted=weight_col is not None))


def _ranked(narrow: DataFrame, weights: tuple[float, ...], most_repeats: int, seed: int, weighted: bool) -> DataFrame:
    """Add the whole copies, the rank and the bucket of each row."""
    per_source = narrow.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("m_weight")).alias("m_weighted")
    )
    goals = targets(per_source, weights, most_repeats).alias("t").join(
        per_source.alias("p"), F.col("t.source").eqNullSafe(F.col("p.source"))
    ).select("t.*", (F.col("target") / F.when(F.col("m_weighted") > 0, F.col("m_weighted"))).alias("m_level"))
    goals = stage(goals, "targets")
    rows = narrow.withColumn("m_u", uniform(F.col("doc_id"), seed))
    rows = rows.withColumn("m_salt", F.floor(F.col("m_u") * SALTS).cast("int"))
    if weighted:
        goals = _levels(rows, goals, most_repeats)
    buckets = -(-narrow.count() // BUCKET_ROWS)

    takes_part = (F.col("size") > 0) & (F.col("m_weight") > 0) & F.col("m_level").isNotNull()
    due = F.when(takes_part, F.least(F.lit(float(most_repeats)), F.col("m_level") * F.col("m_weight")))
    rows = _with_source(rows, goals).select(
        "doc_id", "source", "size", "m_u", "m_salt", "source_size", "target", F.coalesce(due, F.lit(0.0)).alias("m_due"), "m_weight"
    )
    # exact where a source has no document weights: whole copies of all, one part of each
    odds = lambda p: p / (1.0 - p)
    whole = F.floor("m_due")
    part = F.col("m_due") - whole
    rank = F.when((part > 0) & (F.col("m_due") < most_repeats), odds(F.col("m_u")) / odds(part))
    rows = rows.select("*", whole.alias("m_whole"), rank.alias("m_rank"))
    # documents that could take one more copy but have no part left come after all others
    could = F.col("m_rank").isNull() & (F.col("m_whole") < most_repeats) & (F.col("size") > 0) & (F.col("m_weight") > 0)
    rows = rows.withColumn("m_rank", F.when(could, odds(F.col("m_u")) * 1e18).otherwise(F.col("m_rank")))
    if weighted:
        return _bucketed_by_quantiles(rows).drop("m_salt", "m_weight")
    # with equal weights the rank of a source rises with the draw, which is even
    rows, place = rows.drop("m_salt", "m_weight"), F.when(F.col("m_rank").isNotNull(), F.col("m_u"))
    spot = F.floor(place * float(buckets)).cast("long")
    return rows.withColumn("m_bucket", F.coalesce(F.least(spot, F.lit(buckets - 1)), F.pmod(F.xxhash64("doc_id"), F.lit(max(1, buckets))) - buckets))


def _with_source(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """Rows (with ``m_salt``) with the entry of their source; a hot source is met by each of its salts."""
    entries = goals.withColumnRenamed("source", "g_source").withColumn("g_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(entries, F.col("source").eqNullSafe(F.col("g_source")) & (F.col("m_salt") == F.col("g_salt")), "left").drop("g_source", "g_salt")


def _levels(rows: DataFrame, goals: DataFrame, most_repeats: int) -> DataFrame:
    """The level of each source at which its documents, level * weight copies each and at most the limit, fill the target.

    Documents at the limit are taken out and the rest of the target is shared out among the others, until none
    is over the limit. Each round is one aggregation over the narrow rows; the level only rises and never goes too far.
    """
    for _ in range(ROUNDS):
        full = F.col("m_level") * F.col("m_weight") >= most_repeats
        sums = _with_source(rows.where("size > 0 AND m_weight > 0"), goals).groupBy(F.col("source").alias("s_source")).agg(
            F.sum(F.when(full, F.col("size")).otherwise(0)).alias("m_full"),
            F.sum(F.when(~full, F.col("size") * F.col("m_weight")).otherwise(0.0)).alias("m_rest"),
        )
        level = F.when(F.col("m_rest") > 0, (F.col("target") - most_repeats * F.col("m_full")) / F.col("m_rest"))
        risen = goals.join(sums, F.col("source").eqNullSafe(F.col("s_source")), "left").select(
            "source", "source_size", "target", F.greatest("m_level", level).alias("m_level"),
            F.coalesce(level > F.col("m_level") * (1 + 1e-9), F.lit(False)).alias("m_risen"),
        )
        risen = stage(risen, "levels")
        goals = risen.drop("m_risen")
        if not risen.where("m_risen").limit(1).count():
            break
    return goals


def _bucketed_by_quantiles(rows: DataFrame) -> DataFrame:
    """Add the bucket of each row: between two quantiles of the rank in its source, and an even step between them if that holds many rows."""
    steps = F.array(*(F.lit(i / BORDERS) for i in range(1, BORDERS)))
    found = rows.where("m_rank IS NOT NULL").groupBy("source").agg(
        F.percentile_approx("m_rank", steps, F.lit(10_000)).alias("m_borders"), F.ceil(F.count("*") / (BORDERS * BUCKET_ROWS)).alias("m_steps")
    )
    joined = _with_source(rows, stage(found, "borders"))
    above = F.size(F.filter("m_borders", lambda border: border <= F.col("m_rank")))
    low, high = F.coalesce(F.get("m_borders", F.col("m_above") - 1), F.lit(0.0)), F.get(F.col("m_borders"), F.col("m_above"))
    part = F.when(high > low, F.floor((F.col("m_rank") - low) / (high - low) * F.col("m_steps"))).otherwise(0)
    spot = F.col("m_above") * F.col("m_steps") + F.greatest(F.lit(0), F.least(part, F.col("m_steps") - 1))
    placed = joined.withColumn("m_above", above).withColumn("m_bucket", F.when(F.col("m_rank").isNotNull(), spot.cast("long")))
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1024)) - 1024  # rows that need no rank
    return placed.withColumn("m_bucket", F.coalesce("m_bucket", spread)).drop("m_borders", "m_steps", "m_above")


def _mix(rows: DataFrame) -> DataFrame:
    sums = rows.groupBy("source", "m_bucket").agg(
        F.sum(F.when(F.col("m_bucket") >= 0, F.col("size")).otherwise(0)).alias("m_words"),
        F.sum(F.col("size") * F.col("m_whole")).alias("m_certain"), F.max("target").alias("m_target"),
    )
    in_source = Window.partitionBy("source")
    sums = sums.select(
        F.col("source").alias("b_source"), F.col("m_bucket").alias("b_bucket"),
        (F.col("m_target") - F.sum("m_certain").over(in_source)).alias("m_need"),
        F.coalesce(F.sum("m_words").over(in_source.orderBy("m_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("m_before"),
    )
    rows = rows.join(sums, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("m_bucket") == F.col("b_bucket")), "left")
    within = Window.partitionBy("source", "m_bucket").orderBy("m_rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("m_before") + F.sum("size").over(within)
    # the document at the border goes where the total comes nearer to the target
    extra = (F.col("m_bucket") >= 0) & (F.col("size") > 0) & (upto - F.col("size") / 2 <= F.col("m_need"))
    return rows.withColumn("m_extra", extra).select(
        "doc_id", "source", "size", "source_size", "target", (F.col("m_whole") + F.col("m_extra").cast("long")).cast("long").alias("copies")
    )


def mixed_rows(docs: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), most_repeats: int = 3, seed: int = 11) -> DataFrame:
    """The mix itself: each row as often as it is taken, with all its columns."""
    names = docs.columns
    rows = docs.select(
        F.struct(*names).alias("m_row"), F.col("doc_id").alias("d_id"), F.col("source").alias("d_source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).alias("d_size"),
    )
    taken = mix(docs, weights, most_repeats, seed)
    # equal ids draw alike, so one entry per id and size serves all rows of the id
    per_id = taken.groupBy("doc_id", "source", "size").agg(F.max("copies").alias("copies"))
    per_id = per_id.where("copies > 0").select("doc_id", "source", "size", "copies")
    joined = rows.join(per_id, F.col("d_id").eqNullSafe(F.col("doc_id")) & F.col("d_source").eqNullSafe(F.col("source")) & (F.col("d_size") == F.col("size")))
    return joined.withColumn("m_n", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("m_row.*")


STATEMENT = """
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
    ((('0x' || substr(md5(doc_id || ':11'), 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [1.0::DOUBLE, 2.0, 3.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w
  FROM d GROUP BY source),
l AS (
  SELECT *, (sum(source_size) OVER ())::DOUBLE AS total, sum(w) OVER () AS all_w,
    coalesce(sum(3.0::DOUBLE * source_size) OVER before, 0.0) AS full_words, coalesce(sum(w) OVER before, 0.0) AS full_w
  FROM s WINDOW before AS (ORDER BY 3.0::DOUBLE * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (
  SELECT *, (total - full_words) / (all_w - full_w) AS level FROM l),
f AS (
  SELECT level AS found FROM v WHERE 3.0::DOUBLE * source_size > level * w ORDER BY 3.0::DOUBLE * source_size / w, source NULLS LAST LIMIT 1),
t AS (
  SELECT source, source_size, least(found * w, 3.0::DOUBLE * source_size) AS target FROM v CROSS JOIN f),
r AS (
  SELECT d.doc_id, d.source, d.size, d.u, source_size, target, floor(target / source_size)::BIGINT AS whole
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (
  SELECT *, sum(CASE WHEN size > 0 THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY size = 0, u, doc_id ROWS UNBOUNDED PRECEDING) AS upto
  FROM r)
SELECT doc_id, size, source_size, target,
  (size * (whole + CASE WHEN whole < 3 AND size > 0 AND upto - size / 2 <= target - whole * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c
"""
