import dataclasses
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from voxsift import TriageConfig, schemas
from voxsift.operators import accounting, routing
from voxsift.operators.intake import unify
from voxsift.operators.ticket_ids import last_number
from voxsift.plans import generate as gen, triage

AT = datetime(2025, 6, 1, 9, 30)
LONG = "**Summary:** it breaks when syncing."


def stamped(spark, n=300, partitions=4):
    reviews, emails, _ = gen.generate(spark, n, n // 2, seed=11)
    return triage.stamp(unify(reviews, emails).repartition(partitions), "run-1", AT)


@pytest.fixture(scope="module")
def native(spark):
    tables = triage.run(stamped(spark))
    return dataclasses.replace(tables, outcome=tables.outcome.cache())


def test_counts_add_up(native):
    m = native.metrics.first()
    assert m.total_processed == 450 == m.tickets_created + m.skipped + m.failed
    by_category = m.bug_count + m.feature_request_count + m.praise_count + m.complaint_count + m.spam_count
    assert by_category == 450 and m.failed == 0 and m.run_at == AT
    assert accounting.run_succeeded(native.metrics)
    assert native.tickets.count() == m.tickets_created > 0


def test_tickets_are_numbered_in_order_and_pass_review(native):
    rows = native.tickets.orderBy("ticket_id").collect()
    assert [r.ticket_id for r in rows] == [f"T{i:04d}" for i in range(1, len(rows) + 1)]
    assert [(r.source_type, r.source_id) for r in rows] == sorted((r.source_type, r.source_id) for r in rows)
    assert {r.category for r in rows} <= {"Bug", "Feature Request"}
    assert all(len(r.title) <= 80 and r.technical_details for r in rows)
    assert last_number(native.tickets) == len(rows)


def test_numbers_go_on_past_four_digits(spark):
    tables = triage.run(stamped(spark, 40), after_ticket=9_990)
    ids = sorted((r.ticket_id for r in tables.tickets.collect()), key=lambda t: int(t[1:]))
    assert ids[0] == "T9991" and ids[-1] == f"T{9_990 + len(ids)}" and len(ids) > 9


def test_log_has_one_or_two_rows_per_item(native):
    steps = native.log.groupBy("source_id").agg(F.collect_set("agent").alias("agents")).collect()
    assert len(steps) == 450
    reasons = {r.source_id: r.reason for r in native.outcome.collect()}
    second = {"passed review": "ticket_creator", "failed review": "quality_critic", "low confidence": "filter"}
    for row in steps:
        want = {"classifier", second.get(reasons[row.source_id])} - {None}
        assert set(row.agents) == want


def test_result_does_not_depend_on_partitions(spark, native):
    again = triage.run(stamped(spark, partitions=9))
    assert sorted(again.tickets.collect()) == sorted(native.tickets.collect())
    assert sorted(again.log.select("source_id", "agent", "decision").collect()) == sorted(
        native.log.select("source_id", "agent", "decision").collect())


def test_threshold_and_limit_are_applied(spark, native):
    none = triage.run(stamped(spark), config=TriageConfig(threshold=1.0)).metrics.first()
    assert none.tickets_created == 0 and none.skipped == 450
    few = triage.run(stamped(spark), config=TriageConfig(limit=7)).outcome
    assert few.count() == 7 and {r.source_type for r in few.collect()} == {"email"}
    with pytest.raises(ValueError):
        TriageConfig(limit=-1)
    with pytest.raises(ValueError):
        TriageConfig(threshold=1.2)


def draft(title="Fix the sync crash", text=LONG):
    return f'{{"title": "{title}", "description": "{text}"}}'


BUG = '{"category": "Bug", "confidence": 0.9}'
DETAILS = ('{"platform": "iOS 17", "os_version": "17", "steps_to_reproduce": "Not specified", "severity": "Odd"}')
WISH = '{"feature_description": "dark mode", "user_impact": "High", "demand_score": 8}'
BAD = '{"passed": false, "issues": ["too generic"]}'
# id -> responses by (stage, attempt), reason, retry_count, priority
CASES = {
    "ok": ({("classifier", 1): BUG, ("bug", 1): DETAILS, ("draft", 1): draft()}, "passed review", 0, "Medium"),
    "wish": ({("classifier", 1): BUG.replace("Bug", "Feature Request"), ("feature", 1): WISH, ("draft", 1): draft()},
             "passed review", 0, "High"),
    "second": ({("classifier", 1): BUG, ("bug", 1): DETAILS, ("draft", 1): draft("Fix"), ("draft", 2): draft()},
               "passed review", 1, "Medium"),
    "never": ({("classifier", 1): BUG, ("bug", 1): DETAILS, ("draft", 1): draft("Fix"), ("draft", 2): draft("Fix it")},
              "failed review", 2, "Medium"),
    "critic": ({("classifier", 1): BUG, ("bug", 1): DETAILS, ("draft", 1): draft(), ("critic", 1): BAD,
                ("draft", 2): draft(), ("critic", 2): BAD}, "failed review", 2, "Medium"),
    "critic_broken": ({("classifier", 1): BUG, ("bug", 1): DETAILS, ("draft", 1): draft(), ("critic", 1): "??"},
                      "passed review", 0, "Medium"),
    "critic_kind": ({("classifier", 1): BUG, ("bug", 1): DETAILS, ("draft", 1): draft("Fix"),
                     ("critic", 1): '{"passed": true, "issues": ["short"]}'}, "passed review", 0, "Medium"),
    "no_draft": ({("classifier", 1): BUG, ("bug", 1): DETAILS, ("draft", 1): "??"}, "response error", 0, "Medium"),
    "no_redraft": ({("classifier", 1): BUG, ("bug", 1): DETAILS, ("draft", 1): draft("Fix"), ("draft", 2): "??"},
                   "response error", 1, "Medium"),
    "no_details": ({("classifier", 1): BUG, ("bug", 1): "{}", ("draft", 1): draft()}, "response error", 0, None),
    "no_class": ({("classifier", 1): "??"}, "response error", None, None),
    "silent": ({}, "response error", None, None),
    "edge": ({("classifier", 1): BUG.replace("0.9", "0.7"), ("bug", 1): DETAILS, ("draft", 1): draft()},
             "passed review", 0, "Medium"),
    "unsure": ({("classifier", 1): BUG.replace("0.9", "0.69")}, "low confidence", None, None),
    "unsure_praise": ({("classifier", 1): '{"category": "Praise", "confidence": 0.1}'}, "praise", None, None),
    "other": ({("classifier", 1): '{"category": "Else", "confidence": 0.9}'}, "complaint", None, None),
}


@pytest.fixture(scope="module")
def recorded(spark):
    rows = [(i, s, n, raw) for i, (answers, *_) in CASES.items() for (s, n), raw in answers.items()]
    items = spark.createDataFrame([(i, "review", "text") for i in CASES], "source_id string, source_type string, text string")
    return triage.run(triage.stamp(items, "r", AT), spark.createDataFrame(rows, schemas.RESPONSES), triage.RECORDED)


def test_recorded_cases(recorded):
    got = {r.source_id: r for r in recorded.outcome.collect()}
    assert set(got) == set(CASES)
    for name, (_, reason, retries, priority) in CASES.items():
        row = got[name]
        assert (name, row.reason, row.retry_count) == (name, reason, retries)
        if priority and reason != "response error":
            assert row.priority == priority


def test_recorded_accounting(recorded):
    m = recorded.metrics.first()
    assert (m.total_processed, m.tickets_created, m.skipped, m.failed) == (16, 6, 3, 7)
    assert (m.bug_count, m.feature_request_count, m.praise_count, m.complaint_count) == (8, 1, 1, 1)
    assert not accounting.run_succeeded(recorded.metrics)
    log = {(r.source_id, r.agent, r.decision) for r in recorded.log.collect()}
    assert ("silent", "pipeline", "error") in log and ("critic", "quality_critic", "failed") in log
    assert ("unsure", "filter", "skipped") in log and ("ok", "ticket_creator", "created") in log
    assert len(log) == 5 + 2 + 9 * 2
    assert all(r.confidence is None for r in recorded.log.filter("agent <> 'classifier'").collect())


def test_recorded_steps_need_responses(spark):
    with pytest.raises(ValueError):
        triage.outcome(stamped(spark, 10), None, triage.RECORDED)


def test_many_items_with_one_id_are_all_kept(spark):
    """A third of the items share an id; each is handled on its own."""
    items = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "same").otherwise(F.concat(F.lit("i"), "id")).alias("source_id"),
        F.lit("review").alias("source_type"), F.lit("text").alias("text"),
    )
    responses = spark.createDataFrame([("same", "classifier", 1, '{"category": "Praise", "confidence": 0.9}')], schemas.RESPONSES)
    done = triage.outcome(triage.stamp(items, "r", AT), responses, triage.RECORDED)
    assert {r.reason: r["count"] for r in done.groupBy("reason").count().collect()} == {
        "praise": 1000, "response error": 2000}


def test_threshold_sweep_matches_single_runs(spark):
    loose = triage.outcome(stamped(spark), config=TriageConfig(threshold=0.0))
    sweep = {round(r.threshold, 2): r for r in accounting.threshold_sweep(loose).collect()}
    assert len(sweep) == 21
    for threshold in (0.0, 0.5, 0.75, 1.0):
        m = triage.run(stamped(spark), config=TriageConfig(threshold=threshold)).metrics.first()
        row = sweep[threshold]
        assert (row.created, row.skipped, row.failed) == (m.tickets_created, m.skipped, m.failed)


def test_route_prefers_low_confidence_over_category(spark):
    rows = [("Bug", 0.7, False), ("Bug", 0.69, False), ("Feature Request", 0.9, False), ("Praise", 0.2, False),
            ("Spam", 0.9, False), (None, None, True)]
    df = spark.createDataFrame(rows, "category string, confidence double, failed_response boolean").coalesce(1)
    assert [r.route for r in routing.with_route(df).collect()] == [
        "bug", "low_confidence", "feature", "low_confidence", "end", "error"]
