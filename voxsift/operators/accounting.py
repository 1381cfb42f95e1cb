"""Counts per run. All are single aggregations with map-side combining."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window, functions as F

from .. import fixed_values as fv


def run_counts(outcome: DataFrame) -> DataFrame:
    return outcome.groupBy("run_id", "disposition").agg(F.count("*").alias("items"))


def run_category_counts(outcome: DataFrame) -> DataFrame:
    """Items per category and run, without items whose responses failed."""
    return (
        outcome.filter(~F.col("failed_response"))
        .groupBy("run_id", "category")
        .agg(F.count("*").alias("items"))
    )


def run_metrics(outcome: DataFrame) -> DataFrame:
    """One row per run."""

    def items_of(category: str, name: str):
        return F.count_if(~F.col("failed_response") & (F.col("category") == category)).alias(name)

    return outcome.groupBy("run_id").agg(
        F.max("run_at").alias("run_at"),
        F.count("*").alias("total_processed"),
        F.count_if(F.col("disposition") == "created").alias("tickets_created"),
        F.count_if(F.col("disposition") == "skipped").alias("skipped"),
        F.count_if(F.col("disposition") == "failed").alias("failed"),
        items_of("Bug", "bug_count"),
        items_of("Feature Request", "feature_request_count"),
        items_of("Praise", "praise_count"),
        items_of("Complaint", "complaint_count"),
        items_of("Spam", "spam_count"),
    )


def with_empty_run(metrics: DataFrame, run_id: str, run_at: datetime) -> DataFrame:
    """The metrics of one run, or a row of zeros if it had no items."""
    counts = [c for c in metrics.columns if c not in ("run_id", "run_at")]
    named = metrics.sparkSession.range(1).select(F.lit(run_id).alias("__run"), F.lit(run_at).cast("timestamp").alias("__at"))
    joined = named.join(metrics, F.col("__run") == F.col("run_id"), "left")  # one row each
    return joined.select(
        F.col("__run").alias("run_id"), F.coalesce("run_at", "__at").alias("run_at"),
        *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts),
    )


def run_summary(outcome: DataFrame) -> DataFrame:
    """What a run prints at its end, as rows in order: run_id, position, name, items.

    First the totals, then each category that occurs, by name. One aggregation over
    the outcome; the order is made from its few counts.
    """
    counted = outcome.groupBy("run_id", "disposition", "failed_response", "category").agg(F.count("*").alias("n"))
    totals = [("Total items", F.lit(True)), *((name, F.col("disposition") == kind) for name, kind in (
        ("Tickets created", "created"), ("Skipped", "skipped"), ("Failed / Errored", "failed"),
    ))]
    heads = counted.groupBy("run_id").agg(F.array(*(
        F.struct(F.lit(i).alias("position"), F.lit(name).alias("name"), F.sum(F.when(test, F.col("n")).otherwise(0)).alias("items"))
        for i, (name, test) in enumerate(totals, 1)
    )).alias("lines")).select("run_id", F.inline("lines"))
    found = counted.filter(~F.col("failed_response")).groupBy("run_id", "category").agg(F.sum("n").alias("items"))
    place = F.row_number().over(Window.partitionBy("run_id").orderBy("category"))  # one row per category
    categories = found.select("run_id", (place + len(totals)).alias("position"), F.col("category").alias("name"), "items")
    return heads.unionByName(categories)


def run_succeeded(metrics: DataFrame) -> bool:
    """True if nothing failed."""
    return metrics.agg(F.coalesce(F.sum("failed"), F.lit(0)).alias("n")).first()["n"] == 0


def threshold_sweep(outcome: DataFrame, steps: int = 20) -> DataFrame:
    """What each threshold 0, 1/steps, .. 1 would create, skip and fail.

    ``outcome`` must come from a run at threshold 0, so that every bug and
    feature request has been drafted. Items are first counted by the highest
    step they still pass; only those few counts meet the thresholds.
    """
    thresholds = F.array(*[F.lit(i / steps) for i in range(steps + 1)])
    actionable = ~F.col("failed_response") & ~F.col("category").isin(fv.SKIPPED_CATEGORIES)
    passes_upto = F.size(F.filter(thresholds, lambda t: F.col("confidence") >= t)) - 1
    kind = (
        F.when(F.col("failed_response"), "error")
        .when(~actionable, "category")
        .when(F.col("quality_passed"), "good")
        .otherwise("poor")
    )
    counted = (
        outcome.select(kind.alias("kind"), F.coalesce(passes_upto, F.lit(-1)).alias("upto"))
        .groupBy("kind", "upto")
        .agg(F.count("*").alias("n"))
    )
    spread = counted.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(steps))))
    reached = F.col("upto") >= F.col("step")

    def total(test):
        return F.sum(F.when(test, F.col("n")).otherwise(0))

    good, poor = F.col("kind") == "good", F.col("kind") == "poor"
    return spread.groupBy("step").agg(
        total(good & reached).alias("created"),
        total((F.col("kind") == "category") | ((good | poor) & ~reached)).alias("skipped"),
        total((F.col("kind") == "error") | (poor & reached)).alias("failed"),
    ).select((F.col("step") / steps).alias("threshold"), "created", "skipped", "failed")
