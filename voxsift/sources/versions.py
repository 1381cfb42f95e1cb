"""Stored runs that are replaced in one step.

A folder holds tables, and each run's rows of a table are a version: a folder
that is written once and never changed. What is current is named by one list of
(table, run, version); the highest numbered pointer file names the list. A run is
written beside what is there, a new list is written, and then the next pointer is
created, which either happens or does not. So

* readers see all tables of a run as they were, or all as they are now;
* a job that dies at any point before the pointer leaves everything as it was;
* of two jobs that publish at once, the second looks again and adds to the first.

Versions that no list names any more can be cleared with ``clear_old``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import atomic
from ..schemas import RUN_KEY

_LIST = StructType([StructField(name, StringType()) for name in ("table", "run_id", "version")])


class StoredAgain(RuntimeError):
    """Rows that an edit was based on have been replaced meanwhile."""


def _pointers(folder: str) -> str:
    return f"{folder}/versions/pointers"


def current(spark: SparkSession, folder: str) -> str | None:
    """The list that is current now; None before the first run."""
    return atomic.latest(spark, _pointers(folder))


def _listed(spark: SparkSession, folder: str, name: str | None) -> DataFrame:
    if name is None:
        return spark.createDataFrame([], _LIST)
    return spark.read.schema(_LIST).parquet(f"{folder}/versions/lists/{name}")


def listed(spark: SparkSession, folder: str, as_of: str | None = None) -> DataFrame:
    """(table, run_id, version) of all current runs; a null version is a run without rows."""
    return _listed(spark, folder, as_of or current(spark, folder))


def has_run(spark: SparkSession, folder: str, run_id: str) -> bool:
    return listed(spark, folder).filter(F.col("run_id") == run_id).limit(1).count() > 0


def read(spark: SparkSession, folder: str, table: str, schema: StructType, as_of: str | None = None) -> DataFrame | None:
    """The current rows of a table with their run_id, or None if no run was published.

    Only the folders of current versions are read: the list, one row per run,
    prunes partitions.
    """
    name = as_of or current(spark, folder)
    if name is None:
        return None
    wanted = _listed(spark, folder, name).filter((F.col("table") == table) & F.col("version").isNotNull())
    keys = StructType([StructField("version", StringType()), *RUN_KEY])
    typed = StructType([*(f for f in schema if f.name not in keys.names), *keys])
    try:
        rows = spark.read.schema(typed).parquet(f"{folder}/versions/data/{table}")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], typed)
    kept = wanted.select(F.col("version").alias("__version"), F.col("run_id").alias("__run"))
    same = (F.col("version") == F.col("__version")) & F.col("run_id").eqNullSafe(F.col("__run"))
    names = [*(f.name for f in schema if f.name != "run_id"), "run_id"]
    return rows.join(kept, same, "left_semi").select(*names)


def publish(
    spark: SparkSession, folder: str, tables: Mapping[str, DataFrame | None], runs: Iterable[str] = (), based_on: str | None = None
) -> None:
    """Write the tables' rows (with a run_id) and make them current, all in one step.

    Every run that has rows in a table, and every run in ``runs`` with or without
    rows, is replaced in that table; other runs stay. None stands for no rows. With ``based_on``, the list
    that the rows were derived from, it is an error if one of the replaced runs was
    published again since.
    """
    version, named = uuid.uuid4().hex, list(runs)
    news = spark.createDataFrame([(table, run, None) for table in tables for run in named], _LIST)
    for table, rows in tables.items():
        if rows is None:
            continue
        # the hint gives each run few files of an even size; AQE splits a run that holds most of the rows
        path = f"{folder}/versions/data/{table}/version={version}"
        rows.hint("rebalance", "run_id").write.partitionBy("run_id").parquet(path)
        try:
            written = spark.read.schema(RUN_KEY).parquet(path).distinct()
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        news = news.unionByName(written.select(F.lit(table).alias("table"), "run_id", F.lit(version).alias("version")))
    # a run with rows wins over its mention in ``runs``
    news = news.groupBy("table", "run_id").agg(F.max("version").alias("version"))
    changes = f"{folder}/versions/lists/changes-{version}"
    news.write.parquet(changes)
    news = spark.read.schema(_LIST).parquet(changes)

    def same(left: DataFrame, right: DataFrame):
        return (left["table"] == right["table"]) & left["run_id"].eqNullSafe(right["run_id"])

    def next_list(before: str | None) -> str:
        old = _listed(spark, folder, before)
        if based_on is not None and before != based_on:
            base = _listed(spark, folder, based_on)
            touched = [rows.join(news, same(rows, news), "left_semi") for rows in (base, old)]
            if touched[1].exceptAll(touched[0]).limit(1).count():
                raise StoredAgain("a run was stored again while its rows were edited")
        name = uuid.uuid4().hex
        old.join(news, same(old, news), "left_anti").unionByName(news).write.parquet(f"{folder}/versions/lists/{name}")
        return name

    atomic.put_next(spark, _pointers(folder), next_list)


def clear_old(spark: SparkSession, folder: str) -> int:
    """Delete versions that are not current; returns how many. Nobody may read or publish meanwhile."""
    keep = {row["version"] for row in listed(spark, folder).select("version").distinct().toLocalIterator()}
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/versions/data")
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = 0
    for table in fs.listStatus(root) if fs.exists(root) else []:
        for entry in fs.listStatus(table.getPath()):
            if entry.getPath().getName().removeprefix("version=") not in keep:
                fs.delete(entry.getPath(), True)
                gone += 1
    return gone
