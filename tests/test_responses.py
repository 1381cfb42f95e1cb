import pytest

from voxsift import schemas
from voxsift.operators import responses as rs


def answers(spark, stage, raws):
    rows = [(str(i), stage, 1, raw) for i, raw in enumerate(raws)]
    df = rs.validated(spark.createDataFrame(rows, schemas.RESPONSES), stage)
    return [r.answer and r.answer.asDict() for r in df.orderBy(df.source_id.cast("int")).collect()]


@pytest.mark.parametrize("cases", [[
    ('{"category": "Bug", "confidence": 0.9}', ("Bug", 0.9)),
    ('Sure!\n```json\n{"category": "Praise", "confidence": 0.95}\n```\nDone', ("Praise", 0.95)),
    ('```\n{"category": "Spam", "confidence": 1}\n```', ("Spam", 1.0)),
    ('{"category": "Other", "confidence": 0.8}', ("Complaint", 0.8)),
    ('{"category": 5, "confidence": 0.8}', ("Complaint", 0.8)),
    ('{"category": "Bug", "confidence": 1.5}', ("Bug", 1.0)),
    ('{"category": "Bug", "confidence": -0.3}', ("Bug", 0.0)),
    ('{"category": "Bug", "confidence": "0.7"}', ("Bug", 0.7)),
    ('{"category": "Bug", "confidence": true}', ("Bug", 1.0)),
    ('{"category": "Bug", "confidence": 7e-1}', ("Bug", 0.7)),
    ('one {"category": "Bug", "confidence": 0.6} two {"category": "Spam", "confidence": 1}', ("Bug", 0.6)),
    ("no json here", None),
    ('{"category": "Bug"}', None),
    ('{"category": null, "confidence": 0.8}', None),
    ('{"category": "Bug", "confidence": "NaN"}', None),
    ('{"category": "Bug", "confidence": "high"}', None),
    ('{"category": {"n": 1}, "confidence": 0.8}', None),
    ('{"category": "Bug", "confidence": 0.8', None),
    ("{'category': 'Bug', 'confidence': 0.8}", None),
    ('["Bug", 0.8]', None),
    ("```json\n```", None),
    ("   ", None),
    (None, None),
]])
def test_classifications(spark, cases):
    got = answers(spark, rs.CLASSIFIER, [raw for raw, _ in cases])
    want = [w and {"category": w[0], "confidence": w[1]} for _, w in cases]
    assert got == want


def test_severity_outside_the_list_is_medium(spark):
    raw = '{"platform": "Unknown", "os_version": "Unknown", "steps_to_reproduce": "Not specified", "severity": "%s"}'
    got = answers(spark, rs.BUG, [raw % s for s in ("Critical", "High", "Medium", "Low", "Unknown", "")])
    assert [a["severity"] for a in got] == ["Critical", "High", "Medium", "Low", "Medium", "Medium"]
    assert got[0]["platform"] == "Unknown" and got[0]["steps_to_reproduce"] == "Not specified"
    assert answers(spark, rs.BUG, ['{"platform": "x", "severity": "Low"}']) == [None]


def test_feature_impact_and_score(spark):
    raw = '{"feature_description": "d", "user_impact": "%s", "demand_score": %s}'
    cases = [("High", "99", ("High", 10)), ("Low", "-5", ("Low", 1)), ("Very High", "6", ("Medium", 6)),
             ("Low", '"7"', ("Low", 7)), ("Low", "9.0", ("Low", 9)), ("Low", "8.5", None), ("Low", '"abc"', None)]
    got = answers(spark, rs.FEATURE, [raw % (i, s) for i, s, _ in cases])
    assert [a and (a["user_impact"], a["demand_score"]) for a in got] == [w for *_, w in cases]


def test_draft_title_is_cut_to_80_characters(spark):
    got = answers(spark, rs.DRAFT, ['{"title": "%s", "description": "d"}' % ("é😀" * 60), '{"title": "t"}'])
    assert got[0]["title"] == "é😀" * 40 and got[1] is None


def test_verdicts(spark):
    got = answers(spark, rs.CRITIC, [
        '{"passed": true, "issues": []}', '{"passed": "no", "issues": ["a", "b"]}',
        '{"passed": true, "issues": ["kept"]}', '{"passed": "maybe", "issues": []}',
        '{"passed": true, "issues": [null]}', '{"passed": true}', "none",
    ])
    assert [a and (a["passed"], a["issues"]) for a in got] == [
        (True, []), (False, ["a", "b"]), (True, ["kept"]), None, None, None, None]


def test_rejects_name_their_reason(spark):
    rows = [("a", "classifier", 1, "nothing"), ("b", "classifier", 1, '{"category": "Bug"}'),
            ("c", "feature", 1, '{"feature_description": "d", "user_impact": "Low", "demand_score": 1.5}'),
            ("d", "draft", 1, '{"title": "t", "description": "d"}')]
    got = {r.source_id: r.reason for r in rs.rejects(spark.createDataFrame(rows, schemas.RESPONSES)).collect()}
    assert got == {"a": "no JSON object", "b": "field confidence", "c": "field demand_score"}


def test_repeated_recordings_give_one_answer(spark):
    rows = [("a", "classifier", 1, '{"category": "Bug", "confidence": 0.%d}' % c) for c in (5, 9, 7)] * 3
    responses = spark.createDataFrame(rows, schemas.RESPONSES)
    items = spark.createDataFrame([("a", "review"), ("b", "review")], "source_id string, source_type string")
    got = {r.source_id: r.answer_classifier for r in rs.attach_answers(items, responses).collect()}
    assert got["a"].confidence == 0.9 and got["b"] is None


def test_a_stray_field_rejects_nothing(spark):
    raw = '{"category": "Bug", "confidence": 0.8, "issues": "none so far", "passed": "maybe", "title": [1]}'
    df = spark.createDataFrame([("a", "classifier", 1, raw)], schemas.RESPONSES)
    assert rs.validated(df, "classifier").first().answer.category == "Bug"
    assert rs.rejects(df).count() == 0
    critic = spark.createDataFrame([("a", "critic", 1, '{"passed": true, "issues": "text"}')], schemas.RESPONSES)
    assert rs.validated(critic, "critic").first().answer is None
