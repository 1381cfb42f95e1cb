import pytest
from pyspark.sql import functions as F

from voxsift.functions import staging
from voxsift.operators.intake import unify
from voxsift.plans import generate as gen
from voxsift.sources import numbers, tables, versions
from voxsift.streaming import intake_stream as intake


@pytest.fixture
def items(spark):
    reviews, emails, _ = gen.generate(spark, 60, 30, seed=2)
    return unify(reviews, emails).drop("metadata")


def stored(spark, folder):
    return {
        "tickets": sorted(map(tuple, tables.load_tickets(spark, f"{folder}/tickets").collect()), key=str),
        "log": sorted(map(tuple, tables.load_log(spark, f"{folder}/log").collect()), key=str),
        "metrics": sorted(map(tuple, tables.load_metrics(spark, f"{folder}/metrics").collect()), key=str),
    }


def test_an_id_in_several_files_is_one_item_also_after_a_restart(spark, tmp_path, items):
    inbox, folder, progress = (str(tmp_path / n) for n in ("inbox", "out", "progress"))

    def run():
        arriving = spark.readStream.schema(items.schema).option("maxFilesPerTrigger", 1).parquet(inbox)
        intake.triage_into_tables(arriving, folder, progress).awaitTermination()

    # the same ids in several files, in one file, and for both sources
    items.filter("source_type = 'review'").coalesce(1).write.mode("append").parquet(inbox)
    items.filter("source_id <= 'REV00040'").unionByName(items.limit(5)).coalesce(1).write.mode("append").parquet(inbox)
    items.limit(3).withColumn("source_type", F.lit("email")).coalesce(1).write.mode("append").parquet(inbox)
    run()
    items.coalesce(2).write.mode("append").parquet(inbox)
    run()
    run()
    log = tables.load_log(spark, f"{folder}/log").filter("agent = 'classifier'")
    keys = [(r.source_type, r.source_id) for r in log.collect()]
    assert len(keys) == len(set(keys)) == 90 + 3
    tickets = tables.load_tickets(spark, f"{folder}/tickets").collect()
    assert sorted(int(r.ticket_id[1:]) for r in tickets) == list(range(1, len(tickets) + 1)) and tickets
    metrics = tables.load_metrics(spark, f"{folder}/metrics").collect()
    assert sum(r.total_processed for r in metrics) == 93 and sum(r.tickets_created for r in metrics) == len(tickets)
    assert len(metrics) > 2


def test_a_replayed_batch_changes_nothing(spark, tmp_path, items, monkeypatch):
    folder = str(tmp_path)
    batch = items.withColumn(intake.ARRIVED, F.current_timestamp())
    intake.store_batch(batch, 0, folder)
    first = stored(spark, folder)
    assert first["tickets"] and len(first["metrics"]) == 1
    intake.store_batch(batch, 0, folder)
    assert stored(spark, folder) == first
    # a batch that dies before its run is published leaves nothing but a gap in the numbers
    with monkeypatch.context() as patched:
        patched.setattr(versions, "publish", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            intake.store_batch(batch, 1, folder)
    assert stored(spark, folder) == first
    intake.store_batch(batch, 1, folder)
    both = stored(spark, folder)
    assert len(both["tickets"]) == 2 * len(first["tickets"]) and len(both["metrics"]) == 2
    claimed = numbers.claims(spark, folder)
    assert [c["run_id"] for c in claimed] == [intake.batch_run_id("stream", b) for b in (0, 1, 1)]
    intake.store_batch(batch.limit(0), 2, folder)
    assert stored(spark, folder) == both


def test_what_a_batch_stages_is_freed(spark, tmp_path, items):
    import os

    shared = staging._own_folder(spark)
    before = set(os.listdir(shared)) if os.path.isdir(shared) else set()
    intake.store_batch(items.withColumn(intake.ARRIVED, F.current_timestamp()), 0, str(tmp_path))
    assert {n for n in os.listdir(shared) if not n.startswith(".")} <= before
