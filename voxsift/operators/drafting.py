"""Ticket drafts: priority, technical details, context, prompts, title and text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fv
from ..config import TriageConfig
from ..functions.text import rows_of, unless

# columns a bug or feature state may carry
STATE_COLUMNS = {
    "platform": "string", "os_version": "string", "steps_to_reproduce": "string",
    "severity": "string", "feature_description": "string", "user_impact": "string",
    "demand_score": "int",
}


def with_state(items: DataFrame) -> DataFrame:
    """Adds missing detail columns as nulls."""
    missing = {c: F.lit(None).cast(t) for c, t in STATE_COLUMNS.items() if c not in items.columns}
    return items.withColumns(missing)


def priority(config: TriageConfig = TriageConfig()) -> Column:
    """Bug by severity, feature request by demand, everything else by default."""
    defaults = config.default_priority
    category, severity = F.col("category"), F.col("severity")
    score = F.coalesce(F.col("demand_score"), F.lit(fv.DEMAND_DEFAULT))
    derived = F.when(
        category == "Bug",
        F.when(severity.isin(fv.PRIORITIES), severity).otherwise(
            F.lit(defaults.get("Bug", fv.DEFAULT_PRIORITY["Bug"]))
        ),
    ).when(
        category == "Feature Request",
        F.when(score >= fv.DEMAND_HIGH, F.lit("High"))
        .when(score >= fv.DEMAND_MEDIUM, F.lit("Medium"))
        .otherwise(F.lit("Low")),
    )
    # an absent category counts as Complaint
    known = F.coalesce(category, F.lit(fv.FALLBACK_CATEGORY))
    for name, value in defaults.items():
        if name not in ("Bug", "Feature Request"):
            derived = derived.when(known == name, F.lit(value))
    return derived.otherwise(F.lit(fv.FALLBACK_PRIORITY))


def _line(label: str, value: Column, tail: str = "") -> Column:
    """'label: value', or null where the value is null (``concat`` passes nulls on)."""
    return F.concat(F.lit(label + ": "), value, F.lit(tail))


def _demand() -> Column:
    score = F.col("demand_score")
    return F.when(score != 0, score.cast("string"))


def technical_details() -> Column:
    bug = F.concat_ws(
        " | ",
        _line("Platform", unless(F.col("platform"), fv.UNKNOWN)),
        _line("OS", unless(F.col("os_version"), fv.UNKNOWN)),
        _line("Steps", unless(F.col("steps_to_reproduce"), fv.NOT_SPECIFIED)),
        _line("Severity", unless(F.col("severity"))),
    )
    feature = F.concat_ws(
        " | ",
        _line("User Impact", unless(F.col("user_impact"))),
        _line("Demand Score", _demand(), "/10"),
        _line("Feature", unless(F.col("feature_description"))),
    )
    return (
        F.when(F.col("category") == "Bug", bug)
        .when(F.col("category") == "Feature Request", feature)
        .otherwise(F.lit(""))
    )


def context_block() -> Column:
    """What is known about an item, one line each; unknown parts are left out."""
    return F.concat_ws(
        "\n",
        _line("Category", F.coalesce(F.col("category"), F.lit(fv.UNKNOWN))),
        F.concat(
            F.lit("Source: "), F.col("source_type"), F.lit(" (ID: "), F.col("source_id"), F.lit(")")
        ),
        F.concat(F.lit("Original feedback:\n"), F.col("text")),
        _line("Bug severity", unless(F.col("severity"))),
        _line("Platform", unless(F.col("platform"), fv.UNKNOWN)),
        _line("Steps to reproduce", unless(F.col("steps_to_reproduce"), fv.NOT_SPECIFIED)),
        _line("Feature description", unless(F.col("feature_description"))),
        _line("User impact", unless(F.col("user_impact"))),
        _line("Demand score", _demand(), "/10"),
    )


def retry_hint(retry_count: Column, issues: Column) -> Column:
    """The issues of a failed attempt as bullets; '' on a first attempt."""
    bullets = F.array_join(F.transform(issues, lambda i: F.concat(F.lit("  - "), i)), "\n")
    return F.when(
        (retry_count > 0) & (F.size(issues) > 0),
        F.concat(
            F.lit("\n\nPREVIOUS ATTEMPT FAILED quality review. Fix these issues:\n"), bullets
        ),
    ).otherwise(F.lit(""))


def template_draft() -> tuple[Column, Column]:
    """Title and description from the item's details and ``technical_details``."""
    is_bug = F.col("category") == "Bug"
    first_step = F.substring_index("steps_to_reproduce", "\n", 1)
    known_steps = unless(first_step, fv.NOT_SPECIFIED)
    place = unless(F.col("platform"), fv.UNKNOWN)
    title = F.when(
        is_bug,
        F.concat(
            F.lit("Fix "), F.lower("severity"), F.lit(" problem"),
            F.coalesce(F.concat(F.lit(" on "), place), F.lit("")),
            F.coalesce(F.concat(F.lit(": "), known_steps), F.lit("")),
        ),
    ).otherwise(F.concat(F.lit("Add support: "), F.col("feature_description")))
    summary = F.when(
        is_bug, F.concat(F.lit("A user reports a "), F.lower("severity"), F.lit(" defect."))
    ).otherwise(F.concat(F.col("feature_description"), F.lit(".")))
    impact = F.when(
        is_bug, F.concat(F.lit("Severity "), F.col("severity"), F.lit("."))
    ).otherwise(F.concat(F.lit("Impact "), F.col("user_impact"), F.lit(".")))
    description = F.concat(
        F.lit("**Summary:** "), summary,
        F.lit("\n**Details:** "), F.col("technical_details"),
        F.lit("\n**User Impact:** "), impact,
    )
    return F.substring(title, 1, fv.TITLE_MAX), description


_ASK = {
    "classifier": "Decide which single category fits this feedback on a mobile app.\n"
    "Bug: something is broken, fails or crashes\n"
    "Feature Request: asks for something new or better\n"
    "Praise: is satisfied\n"
    "Complaint: dislikes price, support or speed, without a defect\n"
    "Spam: advertising, unrelated or meaningless",
    "bug": "Describe the defect in this feedback: device or system, version of the system, "
    "steps that trigger it, and how severe it is (Critical, High, Medium or Low). "
    "Write Unknown or Not specified for what the text does not say.",
    "feature": "Describe the wish in this feedback in one or two sentences, how many people it "
    "helps (High, Medium or Low) and the demand from 1 to 10.",
    "draft": "Write an engineering ticket for this feedback. The title has at most 80 characters "
    "and begins with Fix, Add, Investigate or Improve. The description has the parts "
    "**Summary:**, **Details:** and **User Impact:**.",
    "critic": "Judge whether an engineer could start on this ticket: nothing required is empty, "
    "title and description are specific, category and priority are valid, and a bug "
    "carries technical details.",
}
_ANSWER = {
    "classifier": "Answer with a JSON object: category, confidence (0.0 to 1.0).",
    "bug": "Answer with a JSON object: platform, os_version, steps_to_reproduce, severity.",
    "feature": "Answer with a JSON object: feature_description, user_impact, demand_score.",
    "draft": "Answer with a JSON object: title, description.",
    "critic": "Answer with a JSON object: passed (true or false), issues (list of texts).",
}


def _prompt(stage: str, subject: Column) -> Column:
    return F.concat(F.lit(_ASK[stage] + "\n\n"), subject, F.lit("\n\n" + _ANSWER[stage]))


def stage_prompts(states: DataFrame) -> DataFrame:
    """Requests for offline batch inference: one row per item, stage it reaches and attempt.

    ``states`` carries items with their ``route``, details, draft (title,
    description, priority, technical_details), retry_count and quality_issues.
    Only the routes ``bug`` and ``feature`` go beyond classification. A failed
    review adds second requests for draft and critic: the draft's names the
    issues found. Rows match recorded responses by (source_id, stage, attempt).
    """
    route = F.col("route")
    source = F.concat(
        F.lit("Source: "), F.col("source_type"), F.lit(" (ID: "), F.col("source_id"),
        F.lit(")\nFeedback:\n"), F.col("text"),
    )
    ticket = F.concat_ws("\n", *[
        F.concat(F.lit(f"  {name}: "), F.col(name))
        for name in [*fv.REQUIRED_FIELDS, "technical_details"]
    ])
    hint = retry_hint(F.col("retry_count"), F.col("quality_issues"))
    actionable = route.isin("bug", "feature")
    again = actionable & (F.col("retry_count") > 0)

    def request(stage: str, attempt: int, subject: Column) -> Column:
        return F.struct(
            F.lit(stage).alias("stage"), F.lit(attempt).alias("attempt"), _prompt(stage, subject).alias("prompt")
        )

    prompts = [
        request("classifier", 1, source),
        F.when(route == "bug", request("bug", 1, F.col("text"))),
        F.when(route == "feature", request("feature", 1, F.col("text"))),
        F.when(actionable, request("draft", 1, context_block())),
        F.when(actionable, request("critic", 1, ticket)),
        F.when(again, request("draft", 2, F.concat(context_block(), hint))),
        F.when(again, request("critic", 2, ticket)),
    ]
    return (
        states.select("source_id", rows_of(F.array(*prompts)).alias("p"))
        .filter(F.col("p").isNotNull())
        .select("source_id", "p.stage", "p.attempt", "p.prompt")
    )
