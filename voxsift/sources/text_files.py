"""Reviews, e-mails and labels as delimited text files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import schemas
from . import tables

# Quoted bodies run over several lines and double their quotes. An empty text is
# written as "" and a missing one as nothing, and read back as such.
_OPTIONS = {
    "header": "true", "multiLine": "true", "escape": '"', "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}

_EMPTY = "\x00empty"  # what a quoted empty field is read as before it becomes ''


def _scan(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Columns by the names in the header, in any order; other columns are ignored, missing ones null.

    Fails at once if the path does not exist. A file with multi-line records is
    one task. Convert large inputs with ``to_parquet`` once, one file per task,
    and read the table from then on. Unquoted nothing is null.
    """
    raw = spark.read.options(**_OPTIONS).option("nullValue", "").option("emptyValue", _EMPTY).csv(path)

    def text(name: str) -> Column:
        if name not in raw.columns:
            return F.lit(None).cast("string")
        return F.when(F.col(f"`{name}`") == _EMPTY, "").otherwise(F.col(f"`{name}`"))

    return raw.select(*(text(f.name).cast(f.dataType).alias(f.name) for f in schema))


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    return _scan(spark, path, schemas.REVIEWS_TEXT)


def read_emails(spark: SparkSession, path: str) -> DataFrame:
    return _scan(spark, path, schemas.EMAILS_TEXT)


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    return _scan(spark, path, schemas.LABELS)


def read_tickets(spark: SparkSession, path: str) -> DataFrame:
    """An exported ticket table, typed; unreadable times become null."""
    return tables.coerce_tickets(_scan(spark, path, _as_text(schemas.TICKETS)))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """An exported processing log, typed; unreadable times and numbers become null."""
    return tables.coerce_log(_scan(spark, path, _as_text(schemas.LOG)))


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Exported run metrics, typed; unreadable times and counts become null."""
    return tables.coerce_metrics(_scan(spark, path, _as_text(schemas.METRICS)))


def _as_text(schema: StructType) -> StructType:
    return StructType([StructField(field.name, StringType()) for field in schema])


def to_parquet(df: DataFrame, path: str) -> DataFrame:
    """Store a text source as parquet in evenly sized files and read it back."""
    df.hint("rebalance").write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_text(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Write only the declared columns, quoted so that ``read_*`` gets them back."""
    (
        df.select(*columns).write.options(**_OPTIONS).option("nullValue", "").option("emptyValue", '""')
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss").mode("errorifexists").csv(path)
    )
