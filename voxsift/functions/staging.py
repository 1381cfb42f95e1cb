"""Intermediate tables in the cluster's shared folder.

A staged table cuts the lineage: later stages read columns of a parquet table
instead of recomputing, and a lost executor costs no more than its own tasks.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Where it is unset, a folder below the warehouse, which all executors of a
    session share as well.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/voxsift-staging"


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/voxsift-{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def clear(spark: SparkSession) -> None:
    """Delete what this application has staged, once its results are stored.

    Frames that read a staged table cannot be used afterwards.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_OPEN: ContextVar[tuple[list[str], ...]] = ContextVar("open", default=())


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Delete what is staged within the block when it ends; frames that read it end with it."""
    folders: list[str] = []
    before = _OPEN.set((*_OPEN.get(), folders))
    try:
        yield
    finally:
        _OPEN.reset(before)
        for folder in folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str, partition_by: Sequence[str] = (), keep: bool = False) -> DataFrame:
    """Write the frame once and return a frame that reads it back; with ``keep`` it outlives a block of ``freed``."""
    spark = df.sparkSession
    folder = new_folder(spark, name)
    for folders in () if keep else _OPEN.get():
        folders.append(folder)
    df.write.partitionBy(*partition_by).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
