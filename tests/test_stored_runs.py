from datetime import datetime

from voxsift.functions import staging
from voxsift.config import TriageConfig
from voxsift.operators import edits
from voxsift.operators.intake import unify
from voxsift.plans import generate as gen, triage
from voxsift.sources import tables

AT = datetime(2025, 6, 1, 9, 30)


def test_stored_runs_go_on_and_can_be_repeated(spark, tmp_path):
    reviews, emails, _ = gen.generate(spark, 60, 30, seed=4)
    items = unify(reviews, emails)

    def store(run_id):
        return triage.run_and_store(spark, items, str(tmp_path), run_id, AT)

    first = store("run-1").tickets.count()
    assert first > 0
    both = store("run-2")
    wanted = [f"T{i:04d}" for i in range(1, 2 * first + 1)]
    assert sorted(r.ticket_id for r in both.tickets.collect()) == wanted
    staging.clear(spark)  # what is stored does not depend on staged tables
    again = store("run-2")
    assert sorted(r.ticket_id for r in again.tickets.collect()) == wanted
    assert sorted(r.run_id for r in again.metrics.collect()) == ["run-1", "run-2"]
    assert again.log.groupBy("run_id").count().select("count").distinct().count() == 1


def test_a_repeat_without_tickets_leaves_none(spark, tmp_path):
    reviews, emails, _ = gen.generate(spark, 40, 20, seed=5)
    items = unify(reviews, emails)
    assert triage.run_and_store(spark, items, str(tmp_path), "it's 1", AT).tickets.count() > 0
    again = triage.run_and_store(spark, items, str(tmp_path), "it's 1", AT, config=TriageConfig(threshold=1.0))
    assert again.tickets.count() == 0 and again.metrics.first().tickets_created == 0
    empty = triage.run_and_store(spark, items.limit(0), str(tmp_path), "it's 1", AT)
    assert empty.log.count() == 0
    row = empty.metrics.first()
    assert (row.run_id, row.run_at, row.total_processed, row.failed) == ("it's 1", AT, 0, 0)


def test_edits_last(spark, tmp_path):
    reviews, emails, _ = gen.generate(spark, 40, 20, seed=6)
    items = unify(reviews, emails)
    stored = triage.run_and_store(spark, items, str(tmp_path), "run-1", AT).tickets
    total = stored.count()
    changes = spark.createDataFrame(
        [("T0001", "Bug", "Critical", "Edited by hand", "none", 1)],
        "ticket_id string, category string, priority string, title string, technical_details string, edit_no int",
    )
    tables.store_edited(edits.apply_edits(stored, changes, edits.TABLE_COLUMNS), f"{tmp_path}/tickets")
    after = triage.run_and_store(spark, items, str(tmp_path), "run-2", AT).tickets.collect()
    assert len(after) == 2 * total and sum(r.run_id == "run-1" for r in after) == total
    assert [r.title for r in after if r.ticket_id == "T0001"] == ["Edited by hand"]
