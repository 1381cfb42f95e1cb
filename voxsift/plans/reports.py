"""Reports over stored tickets, processing log and run metrics.

Every report first reduces the table on its own keys; windows and sorts only
ever see those few result rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import fixed_values as fv

_MINUTES = "yyyy-MM-dd HH:mm"


def kpi_summary(tickets: DataFrame, metrics: DataFrame) -> DataFrame:
    runs = metrics.agg(F.count("*")).scalar()
    return tickets.agg(
        F.count("*").alias("total_tickets"),
        F.count_if(F.col("category") == "Bug").alias("bugs"),
        F.count_if(F.col("category") == "Feature Request").alias("feature_requests"),
        F.count_if(F.col("priority") == "Critical").alias("critical"),
    ).withColumn("runs", runs)


def _value_counts(df: DataFrame, column: str, count: str) -> DataFrame:
    """Rows per value; null is no value."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias(count))


def category_breakdown(tickets: DataFrame) -> DataFrame:
    """Tickets and share per category, most frequent first."""
    counted = _value_counts(tickets, "category", "tickets")
    share = F.col("tickets") * 100 / F.sum("tickets").over(Window.partitionBy())
    return counted.withColumn("share_percent", F.round(share, 2)).orderBy(
        F.desc("tickets"), "category"
    )


def _priority_rank(priority: Column) -> Column:
    rank = F.array_position(F.array(*[F.lit(p) for p in fv.PRIORITIES]), priority)
    return F.when(rank > 0, rank).otherwise(len(fv.PRIORITIES) + 1).cast("int")


def priority_distribution(tickets: DataFrame) -> DataFrame:
    """Tickets per priority, Critical first, unknown values last."""
    return (
        _value_counts(tickets, "priority", "tickets")
        .withColumn("priority_rank", _priority_rank(F.col("priority")))
        .orderBy("priority_rank", "priority")
    )


def latest_run(metrics: DataFrame) -> DataFrame:
    columns = ["run_id", "run_at", "total_processed", "tickets_created", "skipped", "failed"]
    newest = F.max_by(F.struct(*columns), F.struct("run_at", "run_id")).alias("run")
    return metrics.agg(newest).filter(F.col("run").isNotNull()).select("run.*")


def recent_tickets(tickets: DataFrame, limit: int = 10) -> DataFrame:
    return (
        tickets.orderBy(F.desc_nulls_last("created_at"), "ticket_id")
        .limit(limit)
        .select(
            "ticket_id", "category", "priority", "source_type", "title",
            F.date_format("created_at", _MINUTES).alias("created_at"),
        )
    )


def _wanted(
    categories: Sequence[str], priorities: Sequence[str], source_types: Sequence[str]
) -> Column:
    return (
        F.col("category").isin(list(categories))
        & F.col("priority").isin(list(priorities))
        & F.col("source_type").isin(list(source_types))
    )


def ticket_filter(
    tickets: DataFrame,
    categories: Sequence[str] = fv.CATEGORIES,
    priorities: Sequence[str] = fv.PRIORITIES,
    source_types: Sequence[str] = fv.SOURCE_TYPES,
) -> DataFrame:
    return tickets.filter(_wanted(categories, priorities, source_types))


def ticket_filter_counts(
    tickets: DataFrame,
    categories: Sequence[str] = fv.CATEGORIES,
    priorities: Sequence[str] = fv.PRIORITIES,
    source_types: Sequence[str] = fv.SOURCE_TYPES,
) -> DataFrame:
    """How many of how many tickets a filter shows, in one scan."""
    return tickets.agg(
        F.count_if(_wanted(categories, priorities, source_types)).alias("shown"),
        F.count("*").alias("total"),
    )


def ticket_lookup(tickets: DataFrame, ticket_id: str) -> DataFrame:
    return tickets.filter(F.col("ticket_id") == ticket_id).limit(1)


def run_history(metrics: DataFrame) -> DataFrame:
    """Runs with their success rate in percent; no rate for an empty run."""
    rate = F.round(F.col("tickets_created") * 100.0 / F.nullif("total_processed", F.lit(0)), 1)
    # sorted by the full time, before it is cut to minutes
    return metrics.orderBy("run_at", "run_id").select(
        "run_id",
        F.date_format("run_at", _MINUTES).alias("run_at"),
        "total_processed", "tickets_created", "skipped", "failed",
        "bug_count", "feature_request_count", "spam_count",
        F.concat(rate.cast("string"), F.lit("%")).alias("success_rate"),
    )


def run_outcomes_stacked(metrics: DataFrame) -> DataFrame:
    """Created, skipped and failed items per run number.

    The window is global, but over one row per run.
    """
    number = F.row_number().over(Window.orderBy("run_at", "run_id"))
    return metrics.select(
        number.alias("run_no"),
        F.col("tickets_created").alias("Created"),
        F.col("skipped").alias("Skipped"),
        F.col("failed").alias("Failed"),
    ).unpivot("run_no", ["Created", "Skipped", "Failed"], "outcome", "items")


def confidence_histogram(log: DataFrame, threshold: float, bins: int = 20) -> DataFrame:
    """Classifier steps per confidence bin over 0..1; empty bins are listed too."""
    # values outside 0..1 count in the outer bins, so there are never more than ``bins`` rows
    bin_no = F.greatest(F.lit(0), F.least(F.floor(F.col("confidence") * bins), F.lit(bins - 1)))
    counted = (
        log.filter((F.col("agent") == "classifier") & F.col("confidence").isNotNull())
        .groupBy(bin_no.cast("bigint").alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    return (
        log.sparkSession.range(bins)
        .join(F.broadcast(counted), F.col("id") == F.col("bin"), "left")
        .select(
            F.col("id").alias("bin"),
            (F.col("id") / bins).alias("lower_bound"),
            ((F.col("id") + 1) / bins).alias("upper_bound"),
            F.coalesce("n", F.lit(0)).alias("steps"),
            ((F.col("id") + 1) / bins <= threshold).alias("below_threshold"),
        )
    )


def agent_step_counts(log: DataFrame) -> DataFrame:
    return _value_counts(log, "agent", "steps").orderBy(F.desc("steps"), "agent")


def priority_crosstab(tickets: DataFrame) -> DataFrame:
    """Tickets per category (rows) and priority (four columns, Critical first)."""
    return (
        tickets.filter(F.col("category").isNotNull())
        .groupBy("category")
        .pivot("priority", fv.PRIORITIES)
        .agg(F.count(F.lit(1)))
        .na.fill(0)
        .orderBy("category")
    )


def priority_crosstab_long(tickets: DataFrame) -> DataFrame:
    return priority_crosstab(tickets).unpivot("category", fv.PRIORITIES, "priority", "tickets")


def overall_stats(metrics: DataFrame) -> DataFrame:
    """Totals over all runs; the success rate of nothing is 0."""

    def total(column: str) -> Column:
        return F.coalesce(F.sum(column), F.lit(0)).alias(column)

    sums = metrics.agg(*[total(c) for c in ("total_processed", "tickets_created", "skipped", "failed")])
    rate = F.when(
        F.col("total_processed") > 0,
        F.round(F.col("tickets_created") * 100.0 / F.col("total_processed"), 1),
    ).otherwise(0.0)
    return sums.withColumn("success_rate", rate)
