import random

import pytest
from pyspark.sql import functions as F

from voxsift.operators import responses as rs

TYPED = "source_type string, source_id string, stage string, attempt int, raw string, recorded_at long"


def said(category, confidence):
    return f'{{"category": "{category}", "confidence": {confidence}}}'


def attached(spark, rows, items, names=("answer_classifier",), schema=TYPED):
    frame = spark.createDataFrame(items, "source_type string, source_id string")
    return rs.attach_answers(frame, spark.createDataFrame(rows, schema), names)


def test_the_last_usable_recording_counts(spark):
    rows = [
        ("review", "1", "classifier", 1, said("Bug", 0.9), 5), ("review", "1", "classifier", 1, said("Spam", 0.2), 9),
        ("review", "1", "classifier", 1, "cut off", 12), ("review", "2", "classifier", 1, said("Praise", 0.5), 2),
        ("review", "2", "classifier", 1, said("Praise", 0.5), 2), ("review", "3", "classifier", 1, said("Bug", 0.4), 7),
        ("review", "3", "classifier", 1, said("Bug", 0.6), None), ("review", "4", "classifier", 1, "nothing", 1),
    ]
    got = {r.source_id: r.answer_classifier for r in attached(spark, rows, [("review", str(i)) for i in range(1, 6)]).collect()}
    assert {k: v and tuple(v) for k, v in got.items()} == {
        "1": ("Spam", 0.2), "2": ("Praise", 0.5), "3": ("Bug", 0.4), "4": None, "5": None}
    told = rs.conflicts(spark.createDataFrame(rows, TYPED)).collect()
    assert sorted((r.source_type, r.source_id, r.slot, r.recordings, r.different) for r in told) == [
        ("review", "1", "answer_classifier", 2, 2), ("review", "3", "answer_classifier", 2, 2)]


def test_recorded_at_may_be_a_timestamp(spark):
    rows = [("a", "classifier", 1, said("Bug", 0.9), "2024-01-02"), ("a", "classifier", 1, said("Spam", 0.1), "2024-01-01")]
    responses = spark.createDataFrame(rows, "source_id string, stage string, attempt int, raw string, at string").selectExpr(
        "* EXCEPT (at)", "timestamp(at) AS recorded_at")
    items = spark.createDataFrame([("review", "a")], "source_type string, source_id string")
    assert rs.attach_answers(items, responses, ["answer_classifier"]).first().answer_classifier.category == "Bug"


def test_one_id_in_both_sources_has_two_answers(spark):
    rows = [("review", "1", "classifier", 1, said("Bug", 0.9), 1), ("email", "1", "classifier", 1, said("Praise", 0.8), 1),
            (None, "1", "classifier", 1, said("Spam", 0.7), 1)]
    got = {r.source_type: r.answer_classifier.category if r.answer_classifier else None
           for r in attached(spark, rows, [("review", "1"), ("email", "1"), ("chat", "1")]).collect()}
    assert got == {"review": "Bug", "email": "Praise", "chat": None}


@pytest.mark.parametrize("hot", [False, True])
def test_all_slots_against_a_plain_version(spark, hot):
    draw = random.Random(int(hot))
    names = list(rs.ANSWERS)
    bodies = {
        "classifier": lambda: said(draw.choice(["Bug", "Spam"]), round(draw.random(), 2)),
        "bug": lambda: '{"platform": "P%d", "os_version": "1", "steps_to_reproduce": "s", "severity": "High"}' % draw.randrange(9),
        "feature": lambda: '{"feature_description": "d%d", "user_impact": "Low", "demand_score": 3}' % draw.randrange(9),
        "draft": lambda: '{"title": "t%d", "description": "d"}' % draw.randrange(9),
        "critic": lambda: '{"passed": true, "issues": []}',
    }
    rows = []
    for i in range(300):
        item = "7" if hot and i % 3 == 0 else str(draw.randrange(60))
        stage, attempt = rs.ANSWERS[draw.choice(names)]
        rows.append(("review", item, stage, attempt, bodies[stage](), draw.randrange(10**6)))
    items = [("review", "7" if hot and i % 3 == 0 else str(i % 70)) for i in range(400)]
    last = {}
    for _, item, stage, attempt, raw, at in sorted(rows, key=lambda r: r[-1]):
        last[item, stage, attempt] = raw
    got = attached(spark, rows, items, names).collect()
    assert len(got) == 400
    text = {"classifier": "category", "bug": "platform", "feature": "feature_description", "draft": "title", "critic": "passed"}
    for row in got:
        for name, (stage, attempt) in rs.ANSWERS.items():
            raw = last.get((row.source_id, stage, attempt))
            value = row[name] and row[name][text[stage]]
            assert (value is None) == (raw is None)
            assert raw is None or str(value).lower() in raw.lower()


def test_no_sort_aggregate_where_recordings_are_unique(spark):
    rows = [("review", str(i), "classifier", 1, said("Bug", 0.9), 1) for i in range(50)]
    plan = attached(spark, rows, [("review", str(i)) for i in range(50)], list(rs.ANSWERS))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    repeated = rs._repeated(rs.usable_answers(spark.createDataFrame(rows, TYPED), ["answer_classifier"]))
    plan = repeated._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_other_columns_do_not_disturb(spark):
    items = spark.createDataFrame([("review", "a", 1, "kept")], "source_type string, source_id string, recorded_at int, stage string")
    rows = [("review", "a", "classifier", 1, said("Bug", 0.9), 1)]
    got = rs.attach_answers(items, spark.createDataFrame(rows, TYPED).withColumn("note", F.lit("x")), ["answer_classifier"])
    assert got.columns == [*items.columns, "answer_classifier"] and got.first().stage == "kept"
