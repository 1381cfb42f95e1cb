from datetime import datetime

from voxsift import schemas
from voxsift.operators import accounting
from voxsift.sources import profile, text_files


def test_run_summary_is_in_order(spark):
    rows = [("r", "created", False, "Bug"), ("r", "created", False, "Bug"), ("r", "skipped", False, "Spam"), ("r", "failed", True, None),
            ("r", "failed", True, "Praise"), ("q", "skipped", False, "Praise")]
    outcome = spark.createDataFrame(rows, "run_id string, disposition string, failed_response boolean, category string")
    got = [tuple(r) for r in accounting.run_summary(outcome).orderBy("run_id", "position").collect()]
    assert got == [
        ("q", 1, "Total items", 1), ("q", 2, "Tickets created", 0), ("q", 3, "Skipped", 1), ("q", 4, "Failed / Errored", 0), ("q", 5, "Praise", 1),
        ("r", 1, "Total items", 5), ("r", 2, "Tickets created", 2), ("r", 3, "Skipped", 1), ("r", 4, "Failed / Errored", 2), ("r", 5, "Bug", 2),
        ("r", 6, "Spam", 1),
    ]
    assert accounting.run_summary(outcome.limit(0)).count() == 0


def test_profile_with_sizes_of_files(spark, tmp_path):
    path = tmp_path / "a table"
    spark.range(10).selectExpr("id", "nullif(id % 3, 0) AS x").repartition(3).write.parquet(str(path))
    spark.range(0).write.parquet(str(tmp_path / "empty"))
    files = list(path.glob("part-*"))
    tables = {"numbers": spark.read.parquet(str(path)), "empty": spark.read.schema("id long").parquet(str(tmp_path / "empty"))}
    got = {r.input: r for r in profile.profile_files(tables).collect()}
    assert (got["numbers"].row_count, got["numbers"].column_count, got["numbers"].null_values) == (10, 2, 4)
    assert (got["numbers"].files, got["numbers"].bytes) == (len(files), sum(f.stat().st_size for f in files))
    assert got["empty"].row_count == 0 and got["empty"].files == len(list((tmp_path / "empty").glob("part-*")))


def test_exported_tables_are_typed_when_read(spark, tmp_path):
    (tmp_path / "metrics.csv").write_text("run_id,run_at,total_processed,failed\nr1,2024-01-02T03:04:05,7,0\nr2,yesterday,x,\n")
    got = text_files.read_metrics(spark, str(tmp_path / "metrics.csv"))
    assert got.schema.names == schemas.METRICS.names and [f.dataType for f in got.schema] == [f.dataType for f in schemas.METRICS]
    rows = {r.run_id: r for r in got.collect()}
    assert (rows["r1"].run_at, rows["r1"].total_processed, rows["r1"].spam_count) == (datetime(2024, 1, 2, 3, 4, 5), 7, None)
    assert (rows["r2"].run_at, rows["r2"].total_processed, rows["r2"].failed) == (None, None, None)
    (tmp_path / "log.csv").write_text("source_id,confidence,timestamp\na,0.5,2024-01-02\nb,high,\n")
    assert [r.confidence for r in text_files.read_log(spark, str(tmp_path / "log.csv")).orderBy("source_id").collect()] == [0.5, None]
    (tmp_path / "tickets.csv").write_text("ticket_id,created_at\nT0001,2024-01-02\nT0002,never\n")
    assert [r.created_at for r in text_files.read_tickets(spark, str(tmp_path / "tickets.csv")).orderBy("ticket_id").collect()] == [datetime(2024, 1, 2), None]
