"""Quality review of ticket drafts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fv
from ..functions.text import is_blank, rows_of, strip


def local_issues(
    title: Column, description: Column, category: Column, priority: Column,
    technical_details: Column, source_id: Column, source_type: Column,
) -> Column:
    """Every rule a draft breaks, in fixed order; length and validity rules
    do not repeat what the missing-field rule already says."""
    values = {
        "source_id": source_id, "source_type": source_type, "title": title,
        "description": description, "category": category, "priority": priority,
    }
    found = [
        F.when(is_blank(values[name]), F.lit(fv.MSG_MISSING_FIELD % name))
        for name in fv.REQUIRED_FIELDS
    ]
    for text, minimum, message in (
        (title, fv.TITLE_MIN, fv.MSG_TITLE_SHORT),
        (description, fv.DESCRIPTION_MIN, fv.MSG_DESCRIPTION_SHORT),
    ):
        size = F.length(strip(text))
        found.append(F.when((size > 0) & (size < minimum), F.format_string(message, size)))
    for value, domain, message in (
        (category, fv.CATEGORIES, fv.MSG_BAD_CATEGORY),
        (priority, fv.PRIORITIES, fv.MSG_BAD_PRIORITY),
    ):
        found.append(F.when((value != "") & ~value.isin(domain), F.format_string(message, value)))
    found.append(
        F.when((category == "Bug") & is_blank(technical_details), F.lit(fv.MSG_BUG_DETAILS))
    )
    return F.array_compact(F.array(*found))


def draft_issues(title: Column, description: Column) -> Column:
    """``local_issues`` of a draft whose other fields have their usual names."""
    return local_issues(
        title, description, F.col("category"), F.col("priority"),
        F.col("technical_details"), F.col("source_id"), F.col("source_type"),
    )


def review(drafts: DataFrame) -> DataFrame:
    """Adds quality_issues and quality_passed by the local rules."""
    return drafts.withColumn(
        "quality_issues", draft_issues(F.col("title"), F.col("description"))
    ).withColumn("quality_passed", F.size("quality_issues") == 0)


def review_recorded(drafts: DataFrame, verdict: Column) -> DataFrame:
    """A recorded verdict is taken as given; without one the local rules decide."""
    return (
        review(drafts)
        .withColumn("quality_passed", F.coalesce(verdict["passed"], F.col("quality_passed")))
        .withColumn("quality_issues", F.coalesce(verdict["issues"], F.col("quality_issues")))
    )


def issue_counts(reviewed: DataFrame) -> DataFrame:
    return (
        reviewed.select(rows_of(F.col("quality_issues")).alias("issue"))
        .filter(F.col("issue").isNotNull())
        .groupBy("issue")
        .agg(F.count("*").alias("drafts"))
    )
