from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from voxsift import schemas
from voxsift.functions import atomic
from voxsift.operators import edits
from voxsift.operators.intake import unify
from voxsift.plans import generate as gen, triage
from voxsift.sources import numbers, tables, versions

AT = datetime(2025, 6, 1, 9, 30)
SCHEMA = schemas._struct(("name", schemas._S))


def rows(spark, run_id, *names):
    return spark.createDataFrame([(n, run_id) for n in names], "name string, run_id string")


def stored(spark, folder, table="t"):
    return sorted(((r.run_id, r.name) for r in versions.read(spark, folder, table, SCHEMA).collect()), key=str)


@pytest.fixture
def items(spark):
    reviews, emails, _ = gen.generate(spark, 40, 20, seed=9)
    return unify(reviews, emails)


def test_a_file_is_created_once_and_whole(spark, tmp_path):
    path = f"{tmp_path}/a b/000000000001"
    (tmp_path / "a b").mkdir()
    assert atomic.put_if_absent(spark, path, "first é")
    assert not atomic.put_if_absent(spark, path, "second")
    assert atomic.read_text(spark, path) == "first é"
    assert atomic.names(spark, f"{tmp_path}/a b") == ["000000000001"]
    assert atomic.names(spark, f"{tmp_path}/none") == [] and atomic.latest(spark, f"{tmp_path}/none") is None


def test_numbers_are_claimed_by_one_only(spark, tmp_path):
    folder = str(tmp_path)
    counts = [3, 1, 7, 0, 2, 5, 4, 6]
    with ThreadPoolExecutor(8) as pool:
        after = list(pool.map(lambda k: numbers.reserve(spark, folder, counts[k], f"run {k}"), range(8)))
    taken = [n for start, count in zip(after, counts) for n in range(start + 1, start + count + 1)]
    assert sorted(taken) == list(range(1, sum(counts) + 1))
    assert [c["last"] - c["first"] + 1 for c in numbers.claims(spark, folder)] != []
    assert numbers.reserve(spark, folder, 1, "late", floor=1000) == 1000
    with pytest.raises(ValueError):
        numbers.reserve(spark, folder, -1, "x")


def test_runs_are_replaced_and_others_stay(spark, tmp_path):
    folder = str(tmp_path)
    assert versions.read(spark, folder, "t", SCHEMA) is None and not versions.has_run(spark, folder, "r1")
    versions.publish(spark, folder, {"t": rows(spark, "r1", "a", "b").unionByName(rows(spark, "it's 2/3", "c"))})
    versions.publish(spark, folder, {"t": rows(spark, "r1", "d")})
    assert stored(spark, folder) == [("it's 2/3", "c"), ("r1", "d")]
    versions.publish(spark, folder, {"t": rows(spark, None, "e")})
    assert len(stored(spark, folder)) == 3
    versions.publish(spark, folder, {"t": rows(spark, "r1").limit(0)}, ["r1"])
    assert versions.has_run(spark, folder, "r1") and not versions.has_run(spark, folder, "r9")
    assert [n for _, n in versions.read(spark, folder, "t", SCHEMA).select("run_id", "name").collect() if n != "e"] == ["c"]
    assert versions.clear_old(spark, folder) == 2  # the first one is still that of the other run
    assert versions.read(spark, folder, "t", SCHEMA).count() == 2


def test_only_current_versions_are_read(spark, tmp_path):
    folder = str(tmp_path)
    for name in "abc":
        versions.publish(spark, folder, {"t": rows(spark, "r1", name)})
    rows_now = versions.read(spark, folder, "t", SCHEMA)
    assert [r.name for r in rows_now.collect()] == ["c"]
    assert "dynamicpruning" in rows_now._jdf.queryExecution().executedPlan().toString()


def test_a_job_that_dies_before_the_step_changes_nothing(spark, tmp_path, items, monkeypatch):
    folder = str(tmp_path)
    before = triage.run_and_store(spark, items, folder, "run-1", AT)
    was = [sorted(map(tuple, t.collect()), key=str) for t in (before.tickets, before.log, before.metrics)]

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        patched.setattr(versions.atomic, "put_next", dies)
        with pytest.raises(KeyboardInterrupt):
            versions.publish(spark, folder, {"tickets": before.tickets.limit(1), "log": before.log.limit(0)}, ["run-1"])
    now = [tables.load_tickets(spark, f"{folder}/tickets"), tables.load_log(spark, f"{folder}/log"), tables.load_metrics(spark, f"{folder}/metrics")]
    assert [sorted(map(tuple, t.collect()), key=str) for t in now] == was


def test_a_run_that_dies_leaves_a_gap_and_overlapping_runs_are_dense(spark, tmp_path, items, monkeypatch):
    folder = str(tmp_path)

    def dies(*_, **__):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        patched.setattr(triage.versions, "publish", dies)
        with pytest.raises(KeyboardInterrupt):
            triage.run_and_store(spark, items, folder, "dead", AT)
    gap = numbers.claims(spark, folder)[-1]
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda k: triage.run_and_store(spark, items, folder, f"run-{k}", AT), range(3)))
    tickets = tables.load_tickets(spark, f"{folder}/tickets")
    found = sorted(int(r.ticket_id[1:]) for r in tickets.collect())
    size = gap["last"]
    assert gap["first"] == 1 and found == list(range(size + 1, 4 * size + 1))
    assert tickets.groupBy("run_id").count().select("count").distinct().collect() == [(size,)]
    assert tables.load_metrics(spark, f"{folder}/metrics").count() == 3


def test_edits_do_not_undo_a_repeated_run(spark, tmp_path, items):
    folder = str(tmp_path)
    stored_tickets = triage.run_and_store(spark, items, folder, "run-1", AT).tickets
    base = versions.current(spark, folder)
    changes = spark.createDataFrame(
        [("T0001", "Bug", "Critical", "Edited by hand", "none", 1)],
        "ticket_id string, category string, priority string, title string, technical_details string, edit_no int",
    )
    edited = edits.apply_edits(stored_tickets, changes, edits.TABLE_COLUMNS)
    triage.run_and_store(spark, items, folder, "run-2", AT)  # another run does not matter
    tables.store_edited(edited, f"{folder}/tickets", based_on=base)
    assert tables.load_tickets(spark, f"{folder}/tickets").filter("title = 'Edited by hand'").count() == 1
    triage.run_and_store(spark, items, folder, "run-1", AT)
    with pytest.raises(versions.StoredAgain):
        tables.store_edited(edited, f"{folder}/tickets", based_on=base)
    assert tables.load_tickets(spark, f"{folder}/tickets").filter("title = 'Edited by hand'").count() == 0


def test_plain_rows_are_read_until_their_run_is_published(spark, tmp_path):
    path = f"{tmp_path}/tickets"
    ticket = spark.createDataFrame([("T0001",)], "ticket_id string").selectExpr(
        *[f"cast({'ticket_id' if n == 'ticket_id' else 'NULL'} AS {t.simpleString()}) AS {n}" for n, t in ((f.name, f.dataType) for f in schemas.TICKETS)]
    )
    ticket.selectExpr("*", "'old' AS run_id").unionByName(ticket.selectExpr("*", "'older' AS run_id")).write.partitionBy("run_id").parquet(path)
    tables.append(ticket.selectExpr("*", "'new' AS run_id"), path)
    assert sorted(r.run_id for r in tables.load_tickets(spark, path).collect()) == ["new", "old", "older"]
    tables.append(ticket.selectExpr("*", "'old' AS run_id").unionByName(ticket.selectExpr("*", "'old' AS run_id")), path)
    tables.drop_run(spark, path, "older")
    assert sorted(r.run_id for r in tables.load_tickets(spark, path).collect()) == ["new", "old", "old"]
