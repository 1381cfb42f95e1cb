"""Stored tickets, processing log and run metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from .. import schemas
from . import versions


def _plain(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The files right below the path, or an empty table where there are none."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _split(path: str) -> tuple[str, str]:
    folder, _, table = path.rstrip("/").rpartition("/")
    return folder, table


def _known(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table: current versions of published runs, and rows that were added plainly.

    Where nothing is stored yet, an empty table of the same shape. Plain rows of a
    run that was published since are not read any more.
    """
    folder, table = _split(path)
    plain = _plain(spark, path, schema)
    as_of = versions.current(spark, folder)
    if as_of is None:
        return plain
    runs = versions.listed(spark, folder, as_of).filter(F.col("table") == table).select(F.col("run_id").alias("__run"))
    if "run_id" in plain.columns:
        plain = plain.join(runs, F.col("run_id").eqNullSafe(F.col("__run")), "left_anti")
    return versions.read(spark, folder, table, schema, as_of).unionByName(plain, allowMissingColumns=True)


def load_tickets(spark: SparkSession, path: str) -> DataFrame:
    return _known(spark, path, schemas.TICKETS)


def load_log(spark: SparkSession, path: str) -> DataFrame:
    return _known(spark, path, schemas.LOG)


def load_metrics(spark: SparkSession, path: str) -> DataFrame:
    return _known(spark, path, schemas.METRICS)


def coerce_tickets(raw: DataFrame) -> DataFrame:
    """Typed tickets from text columns; an unreadable time becomes null."""
    return raw.withColumn("created_at", F.col("created_at").try_cast("timestamp"))


def coerce_metrics(raw: DataFrame) -> DataFrame:
    """Typed metrics from text columns; unreadable times and counts become null."""
    kinds = {field.name: field.dataType for field in schemas.METRICS}
    return raw.withColumns({name: F.col(name).try_cast(kinds[name]) for name in raw.columns if name in kinds})


def coerce_log(raw: DataFrame) -> DataFrame:
    """Typed log from text columns; unreadable times and numbers become null."""
    return raw.withColumns({
        "timestamp": F.col("timestamp").try_cast("timestamp"),
        "confidence": F.col("confidence").try_cast("double"),
    })


def ensure_table(spark: SparkSession, path: str, schema: StructType) -> None:
    """Create the table without rows unless it is there already."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)


def append(rows: DataFrame, path: str, partition_by: Sequence[str] = ("run_id",)) -> None:
    """Store the runs of a batch, each in the place of what it has stored before.

    The runs are published in one step (see ``versions``): a job that dies leaves
    the table as it was. Without ``partition_by`` rows are simply added.
    """
    if not partition_by:
        rows.write.mode("append").parquet(path)
        return
    folder, table = _split(path)
    versions.publish(rows.sparkSession, folder, {table: rows})


def drop_run(spark: SparkSession, path: str, run_id: str) -> None:
    """Remove what a run has stored in a table; readers see all of it until it is gone."""
    folder, table = _split(path)
    versions.publish(spark, folder, {table: None}, [run_id])


def store_edited(tickets: DataFrame, path: str, based_on: str | None = None) -> None:
    """Put edited tickets (flag ``edited``) in the place of the stored ones they come from.

    Only runs with an edit are written again, and all of them become current in
    one step. ``based_on`` is what ``versions.current`` gave when the tickets were
    read; a run that was stored again since is an error then, and keeps what it has.
    """
    runs = tickets.filter("edited").select(F.col("run_id").alias("__run")).distinct()
    changed = tickets.join(runs, F.col("run_id").eqNullSafe(F.col("__run")), "left_semi").drop("edited")
    folder, table = _split(path)
    versions.publish(tickets.sparkSession, folder, {table: changed}, based_on=based_on)
