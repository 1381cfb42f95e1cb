"""Routing after classification, the bounded retry, and what became of each item."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fv
from ..config import TriageConfig
from ..functions.text import rows_of
from .drafting import template_draft
from .quality import draft_issues

# attempt number -> struct<title, description>, null where the answer is unusable
Drafter = Callable[[int], Column]
# attempt number, issues found by the local rules -> struct<passed, issues>
Reviewer = Callable[[int, Column], Column]


def low_confidence(config: TriageConfig) -> Column:
    return F.col("confidence") < config.threshold


def with_route(classified: DataFrame, config: TriageConfig = TriageConfig()) -> DataFrame:
    """Adds ``route``: error, low_confidence, bug, feature or end."""
    return classified.withColumn(
        "route",
        F.when(F.col("failed_response"), "error")
        .when(low_confidence(config), "low_confidence")
        .when(F.col("category") == "Bug", "bug")
        .when(F.col("category") == "Feature Request", "feature")
        .otherwise("end"),
    )


def template_drafter(attempt: int) -> Column:
    title, description = template_draft()
    return F.struct(title.alias("title"), description.alias("description"))


def recorded_drafter(attempt: int) -> Column:
    return F.col(f"answer_draft_{attempt}")


def local_reviewer(attempt: int, issues: Column) -> Column:
    return F.struct((F.size(issues) == 0).alias("passed"), issues.alias("issues"))


def recorded_reviewer(attempt: int, issues: Column) -> Column:
    """The recorded verdict, else the local rules: a bad verdict fails no item."""
    return F.coalesce(F.col(f"answer_critic_{attempt}"), local_reviewer(attempt, issues))


def draft_with_retry(
    states: DataFrame, drafter: Drafter = template_drafter, reviewer: Reviewer = local_reviewer
) -> DataFrame:
    """Draft and review, and once more where the first review fails.

    Both passes are columns of the same row: no second scan, no union, and each
    item keeps exactly one row. ``retry_count`` counts failed reviews.
    """

    def reviewed(df: DataFrame, attempt: int, needed: Column) -> DataFrame:
        draft, found = F.col(f"__draft_{attempt}"), F.col(f"__issues_{attempt}")
        made = draft.isNotNull()
        return df.withColumn(f"__draft_{attempt}", F.when(needed, drafter(attempt))).withColumn(
            f"__issues_{attempt}", F.when(made, draft_issues(draft["title"], draft["description"]))
        ).withColumn(f"__review_{attempt}", F.when(made, reviewer(attempt, found)))

    once = reviewed(states, 1, ~F.col("failed_response"))
    again = F.coalesce(~F.col("__review_1")["passed"], F.lit(False))
    twice = reviewed(once.withColumn("__again", again), 2, F.col("__again"))
    final_draft = F.when(F.col("__again"), F.col("__draft_2")).otherwise(F.col("__draft_1"))
    final_review = F.when(F.col("__again"), F.col("__review_2")).otherwise(F.col("__review_1"))
    return (
        twice.withColumn("__draft", final_draft)
        .withColumn("__review", final_review)
        .withColumn("failed_response", F.col("__draft").isNull())
        .withColumn("title", F.col("__draft")["title"])
        .withColumn("description", F.col("__draft")["description"])
        .withColumn("quality_passed", F.coalesce(F.col("__review")["passed"], F.lit(False)))
        .withColumn("quality_issues", F.col("__review")["issues"])
        .withColumn(
            "retry_count",
            F.col("__again").cast("int")
            + F.coalesce(~F.col("__review_2")["passed"], F.lit(False)).cast("int"),
        )
        .drop(
            "__draft_1", "__issues_1", "__review_1", "__again", "__draft_2", "__issues_2",
            "__review_2", "__draft", "__review",
        )
    )


def with_disposition(handled: DataFrame, config: TriageConfig = TriageConfig()) -> DataFrame:
    """Adds ``disposition`` (created, skipped, failed) and ``reason``.

    The category is looked at before the confidence: low-confidence praise is
    skipped as praise.
    """
    reason = (
        F.when(F.col("failed_response"), "response error")
        .when(F.col("category").isin(fv.SKIPPED_CATEGORIES), F.lower("category"))
        .when(low_confidence(config), "low confidence")
        .when(F.col("quality_passed"), "passed review")
        .otherwise("failed review")
    )
    disposition = (
        F.when(F.col("reason") == "passed review", "created")
        .when(F.col("reason").isin("response error", "failed review"), "failed")
        .otherwise("skipped")
    )
    return handled.withColumn("reason", reason).withColumn("disposition", disposition)


def processing_log(outcome: DataFrame) -> DataFrame:
    """One or two rows per item, in the order the steps happen."""

    def row(agent: str, decision: Column, confidence: Column = F.lit(None)) -> Column:
        return F.struct(
            F.lit(agent).alias("agent"),
            decision.alias("decision"),
            confidence.cast("double").alias("confidence"),
        )

    failed, reason = F.col("failed_response"), F.col("reason")
    steps = F.array(
        F.when(failed, row("pipeline", F.lit("error")))
        .otherwise(row("classifier", F.col("category"), F.col("confidence"))),
        F.when(reason == "low confidence", row("filter", F.lit("skipped")))
        .when(reason == "passed review", row("ticket_creator", F.lit("created")))
        .when(reason == "failed review", row("quality_critic", F.lit("failed"))),
    )
    return outcome.select(
        "run_id", "source_id", "source_type", rows_of(steps).alias("step"),
        F.col("processed_at").alias("timestamp"),
    ).filter(F.col("step").isNotNull()).select(
        "run_id", "source_id", "source_type", "step.agent", "step.decision", "step.confidence",
        "timestamp",
    )
