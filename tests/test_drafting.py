import pytest
from pyspark.sql import functions as F

from voxsift.config import TriageConfig
from voxsift.operators import drafting

BUG = dict(source_id="r1", source_type="review", category="Bug", text="It crashes.", platform="Android 14",
           os_version="14", steps_to_reproduce="Tap sync", severity="Critical")
WISH = dict(source_id="r2", source_type="email", category="Feature Request", text="Dark please.",
            feature_description="Offer a dark mode", user_impact="High", demand_score=9)
SCHEMA = ("source_id string, source_type string, category string, text string, platform string, os_version string, "
          "steps_to_reproduce string, severity string, feature_description string, user_impact string, demand_score int")


def evaluate(spark, column, *states):
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    df = spark.createDataFrame([tuple(s.get(n) for n in names) for s in states], SCHEMA).coalesce(1)
    df = df.withColumn("technical_details", drafting.technical_details())
    return [r[0] for r in df.select(column).collect()]


@pytest.mark.parametrize("state,want", [
    *[(dict(category="Bug", severity=s), s) for s in ("Critical", "High", "Medium", "Low")],
    (dict(category="Bug"), "High"), (dict(category="Bug", severity="odd"), "High"),
    *[(dict(category="Feature Request", demand_score=n), w)
      for n, w in ((10, "High"), (8, "High"), (7, "Medium"), (5, "Medium"), (4, "Low"), (1, "Low"), (None, "Medium"))],
    (dict(category="Complaint"), "Low"), (dict(category="Praise"), "Low"), (dict(category="Else"), "Low"), ({}, "Low"),
])
def test_priority(spark, state, want):
    assert evaluate(spark, drafting.priority(), state) == [want]


def test_default_priorities_are_applied(spark):
    config = TriageConfig(default_priority={"Bug": "Low", "Complaint": "High"})
    assert evaluate(spark, drafting.priority(config), dict(category="Bug"), dict(category="Complaint"), {}) == [
        "Low", "High", "High"]
    with pytest.raises(ValueError):
        TriageConfig(default_priority={"Bug": "Urgent"})


def test_technical_details(spark):
    assert evaluate(
        spark, drafting.technical_details(), BUG, {**BUG, "platform": "Unknown", "os_version": "Unknown"},
        {**BUG, "steps_to_reproduce": "Not specified"}, WISH, dict(category="Bug"), dict(category="Spam", severity="Low"),
    ) == [
        "Platform: Android 14 | OS: 14 | Steps: Tap sync | Severity: Critical",
        "Steps: Tap sync | Severity: Critical",
        "Platform: Android 14 | OS: 14 | Severity: Critical",
        "User Impact: High | Demand Score: 9/10 | Feature: Offer a dark mode",
        "", "",
    ]


def test_context_block(spark):
    assert evaluate(spark, drafting.context_block(), BUG, WISH, {**BUG, "category": None, "severity": None}) == [
        "Category: Bug\nSource: review (ID: r1)\nOriginal feedback:\nIt crashes.\nBug severity: Critical\n"
        "Platform: Android 14\nSteps to reproduce: Tap sync",
        "Category: Feature Request\nSource: email (ID: r2)\nOriginal feedback:\nDark please.\n"
        "Feature description: Offer a dark mode\nUser impact: High\nDemand score: 9/10",
        "Category: Unknown\nSource: review (ID: r1)\nOriginal feedback:\nIt crashes.\nPlatform: Android 14\n"
        "Steps to reproduce: Tap sync",
    ]


def test_retry_hint_only_after_a_failure_with_issues(spark):
    rows = [(0, ["x"]), (1, []), (1, ["Title too generic", "b"])]
    df = spark.createDataFrame(rows, "n int, issues array<string>").coalesce(1)
    hints = [r[0] for r in df.select(drafting.retry_hint(F.col("n"), F.col("issues"))).collect()]
    assert hints[:2] == ["", ""]
    assert hints[2].endswith("  - Title too generic\n  - b") and "PREVIOUS ATTEMPT" in hints[2]


def test_template_draft(spark):
    title, description = drafting.template_draft()
    titles = evaluate(spark, title, BUG, WISH, {**WISH, "feature_description": "x" * 200})
    assert titles[0] == "Fix critical problem on Android 14: Tap sync"
    assert titles[1].startswith("Add") and len(titles[2]) == 80
    for text in evaluate(spark, description, BUG, WISH):
        assert text.startswith("**Summary:** ") and "\n**Details:** " in text and "\n**User Impact:** " in text


def test_prompts_go_by_route_and_attempt(spark):
    rows = [dict(BUG, source_id=i, route=route, title="Fix", description="d", priority="High", technical_details="t",
                 retry_count=n, quality_issues=["Title too short"] if n else [])
            for i, route, n in (("a", "bug", 0), ("b", "bug", 1), ("c", "low_confidence", 0), ("e", "error", 0))]
    schema = ", ".join(f"{name} string" for name in rows[0] if name not in ("retry_count", "quality_issues"))
    df = drafting.with_state(spark.createDataFrame(rows, schema + ", retry_count int, quality_issues array<string>"))
    got = {(r.source_id, r.stage, r.attempt): r.prompt for r in drafting.stage_prompts(df).collect()}
    first = [("classifier", 1), ("bug", 1), ("draft", 1), ("critic", 1)]
    want = {("a", *x) for x in first} | {("b", *x) for x in [*first, ("draft", 2), ("critic", 2)]}
    assert set(got) == want | {("c", "classifier", 1), ("e", "classifier", 1)}
    assert "Title too short" in got["b", "draft", 2] and "Title too short" not in got["b", "draft", 1]
