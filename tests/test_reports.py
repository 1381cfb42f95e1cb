from datetime import datetime, timedelta

import pytest

from voxsift import schemas
from voxsift.operators import edits
from voxsift.plans import reports
from voxsift.sources import tables

T0 = datetime(2025, 1, 1, 12, 0)


@pytest.fixture
def tickets(spark):
    def row(n, category, priority, at, kind="review"):
        return (f"T{n:04d}", f"s{n}", kind, f"title {n}", "text", category, priority, "details", at)

    return spark.createDataFrame([
        row(1, "Bug", "High", T0), row(2, "Bug", "Critical", T0 + timedelta(days=1), "email"),
        row(3, "Feature Request", "Low", None), row(4, "Bug", "Odd", T0), row(5, None, None, T0),
    ], schemas.TICKETS)


@pytest.fixture
def metrics(spark):
    return spark.createDataFrame([
        ("run-b", T0, 8, 3, 4, 1, 3, 2, 1, 1, 1), ("run-a", T0 + timedelta(hours=1), 3, 1, 1, 1, 1, 1, 0, 1, 0),
        ("run-c", T0 - timedelta(hours=1), 0, 0, 0, 0, 0, 0, 0, 0, 0),
    ], schemas.METRICS)


def test_kpis(spark, tickets, metrics):
    row = reports.kpi_summary(tickets, metrics).first()
    assert tuple(row) == (5, 3, 1, 1, 3)
    empty = reports.kpi_summary(tickets.limit(0), metrics.limit(0)).first()
    assert tuple(empty) == (0, 0, 0, 0, 0)


def test_breakdowns_leave_out_nulls_and_keep_unknown_values(tickets):
    assert [tuple(r) for r in reports.category_breakdown(tickets).collect()] == [
        ("Bug", 3, 75.0), ("Feature Request", 1, 25.0)]
    assert [tuple(r) for r in reports.priority_distribution(tickets).collect()] == [
        ("Critical", 1, 1), ("High", 1, 2), ("Low", 1, 4), ("Odd", 1, 5)]


def test_crosstab_has_all_priorities_and_no_unknown_ones(tickets):
    table = reports.priority_crosstab(tickets)
    assert table.columns == ["category", "Critical", "High", "Medium", "Low"]
    assert [tuple(r) for r in table.collect()] == [("Bug", 1, 1, 0, 0), ("Feature Request", 0, 0, 0, 1)]
    assert reports.priority_crosstab_long(tickets).count() == 8


def test_recent_tickets_put_missing_times_last(tickets):
    rows = reports.recent_tickets(tickets, 10).collect()
    assert [r.ticket_id for r in rows] == ["T0002", "T0001", "T0004", "T0005", "T0003"]
    assert rows[0].created_at == "2025-01-02 12:00" and rows[-1].created_at is None
    assert reports.recent_tickets(tickets, 2).count() == 2


def test_filter_lookup_and_counts(tickets):
    assert [r.ticket_id for r in reports.ticket_filter(tickets).collect()] == ["T0001", "T0002", "T0003"]
    assert tuple(reports.ticket_filter_counts(tickets, source_types=["email"]).first()) == (1, 5)
    assert reports.ticket_lookup(tickets, "T0004").first().source_id == "s4"
    assert reports.ticket_lookup(tickets, "T9").count() == 0


def test_runs(metrics):
    assert reports.latest_run(metrics).first().run_id == "run-a"
    assert reports.latest_run(metrics.limit(0)).count() == 0
    assert [(r.run_id, r.success_rate) for r in reports.run_history(metrics).collect()] == [
        ("run-c", None), ("run-b", "37.5%"), ("run-a", "33.3%")]
    stacked = {(r.run_no, r.outcome): r["items"] for r in reports.run_outcomes_stacked(metrics).collect()}
    assert len(stacked) == 9 and stacked[(2, "Skipped")] == 4
    assert tuple(reports.overall_stats(metrics).first()) == (11, 4, 5, 2, 36.4)
    assert tuple(reports.overall_stats(metrics.limit(0)).first()) == (0, 0, 0, 0, 0.0)


def test_confidence_histogram(spark):
    rows = [("i", "review", "classifier", "Bug", c, T0) for c in (0.0, 0.049, 0.05, 0.7, 0.95, 1.0, None)]
    log = spark.createDataFrame(rows + [("i", "review", "filter", "skipped", 0.5, T0)], schemas.LOG)
    bins = {r.bin: r for r in reports.confidence_histogram(log, 0.7).collect()}
    assert len(bins) == 20 and sum(r.steps for r in bins.values()) == 6
    assert (bins[0].steps, bins[1].steps, bins[14].steps, bins[19].steps) == (2, 1, 1, 2)
    assert bins[13].below_threshold and not bins[14].below_threshold
    assert {r.agent: r.steps for r in reports.agent_step_counts(log).collect()} == {"classifier": 7, "filter": 1}


def test_edits(spark, tickets):
    changes = spark.createDataFrame([
        ("T0001", "Bug", "Low", "old", "x", 1), ("T0001", "Spam", "High", "new", None, 2), ("T0099", "Bug", "Low", "-", "-", 1),
    ], "ticket_id string, category string, priority string, title string, technical_details string, edit_no int")
    got = {r.ticket_id: r for r in edits.apply_edits(tickets, changes, edits.TABLE_COLUMNS).collect()}
    assert len(got) == 5
    assert tuple(got["T0001"][c] for c in edits.TABLE_COLUMNS) == ("Spam", "High", "new", None)
    assert got["T0001"].edited and not got["T0002"].edited and got["T0002"].title == "title 2"


def test_stored_tables(spark, tmp_path, tickets):
    path = str(tmp_path / "tickets")
    assert tables.load_tickets(spark, path).columns == schemas.TICKETS.names
    assert tables.load_tickets(spark, path).count() == 0
    tables.ensure_table(spark, path, schemas.TICKETS)
    tables.ensure_table(spark, path, schemas.TICKETS)
    assert tables.load_tickets(spark, path).count() == 0
    for run in ("r1", "r2"):
        tables.append(tickets.selectExpr("*", f"'{run}' AS run_id"), path)
    assert tables.load_tickets(spark, path).filter("run_id = 'r2'").count() == 5
    assert tables.load_tickets(spark, path).count() == 10


def test_bad_text_becomes_null(spark):
    raw = spark.createDataFrame([("0.5", "2024-01-02"), ("", "2024-01-02T03:04:05+00:00"), ("n/a", "never")],
                                "confidence string, timestamp string").coalesce(1)
    rows = tables.coerce_log(raw).collect()
    assert [r.confidence for r in rows] == [0.5, None, None]
    assert [r.timestamp for r in rows] == [datetime(2024, 1, 2), datetime(2024, 1, 2, 3, 4, 5), None]
