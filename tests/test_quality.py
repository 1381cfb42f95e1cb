import pytest
from pyspark.sql import functions as F

from voxsift.operators import quality

GOOD = dict(source_id="r1", source_type="review", title="Fix sync crash on Android",
            description="**Summary:** it crashes when syncing.", category="Bug", priority="High",
            technical_details="Platform: Android 14")
SCHEMA = ", ".join(f"{name} string" for name in GOOD)


def issues(spark, **changes):
    df = quality.review(spark.createDataFrame([tuple({**GOOD, **changes}.values())], SCHEMA))
    row = df.first()
    assert row.quality_passed == (not row.quality_issues)
    return row.quality_issues


@pytest.mark.parametrize("changes,want", [
    ({}, []),
    ({"category": "Feature Request", "technical_details": ""}, []),
    ({"title": ""}, ["Missing required field: 'title'"]),
    ({"title": None}, ["Missing required field: 'title'"]),
    ({"title": "  \n "}, ["Missing required field: 'title'"]),
    ({"title": "Fix bug"}, ["Title too short (7 chars, min 10)"]),
    ({"title": "  Fix a bug "}, ["Title too short (9 chars, min 10)"]),
    ({"title": "Fix bug 10"}, []),
    ({"title": "é😀" * 5}, []),
    ({"description": ""}, ["Missing required field: 'description'"]),
    ({"description": "Crashes."}, ["Description too short (8 chars, min 20)"]),
    ({"category": "Unknown"}, ["Invalid category: 'Unknown'"]),
    ({"priority": "Urgent"}, ["Invalid priority: 'Urgent'"]),
    ({"priority": ""}, ["Missing required field: 'priority'"]),
    ({"priority": None}, ["Missing required field: 'priority'"]),
    ({"technical_details": " "}, ["Bug ticket is missing technical_details"]),
    ({"technical_details": None}, ["Bug ticket is missing technical_details"]),
    ({"title": "", "description": "", "priority": "", "technical_details": ""},
     ["Missing required field: 'title'", "Missing required field: 'description'",
      "Missing required field: 'priority'", "Bug ticket is missing technical_details"]),
])
def test_local_rules(spark, changes, want):
    assert issues(spark, **changes) == want


def test_recorded_verdict_counts_as_given_else_local_rules(spark):
    rows = [("a", True, ["odd"]), ("b", False, []), ("c", None, None)]
    drafts = spark.createDataFrame([(i, p, x, *GOOD.values()) for i, p, x in rows],
                                   "i string, p boolean, x array<string>, " + SCHEMA)
    verdict = F.when(F.col("p").isNotNull(), F.struct(F.col("p").alias("passed"), F.col("x").alias("issues")))
    got = {r.i: (r.quality_passed, r.quality_issues) for r in quality.review_recorded(drafts, verdict).collect()}
    assert got == {"a": (True, ["odd"]), "b": (False, []), "c": (True, [])}
