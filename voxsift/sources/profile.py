"""What an input table holds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def profile(name: str, df: DataFrame) -> DataFrame:
    """Logical rows, columns and nulls of a table in one scan, one row out."""
    nulls = reduce(
        lambda total, column: total + column,
        [F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns],
    )
    return df.agg(F.count("*").alias("row_count"), nulls.alias("null_values")).select(
        F.lit(name).alias("input"),
        "row_count",
        F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        "null_values",
    )


def profile_all(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [profile(n, df) for n, df in tables.items()])


def file_sizes(df: DataFrame) -> DataFrame:
    """Bytes per input file of a file-based table, from the listing alone: no file is opened."""
    spark = df.sparkSession
    conf = spark._jsc.hadoopConfiguration()
    rows = []
    for name in df.inputFiles():
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name))
        rows.append((name, path.getFileSystem(conf).getFileStatus(path).getLen()))
    return spark.createDataFrame(rows, "file string, bytes bigint")


def profile_files(tables: dict[str, DataFrame]) -> DataFrame:
    """``profile_all`` of file-based tables, with the number of their files and bytes.

    Sizes come from the listing a scan makes anyway, one entry per file. A table without files has 0 of both.
    """
    sizes = reduce(DataFrame.unionByName, [
        file_sizes(df).agg(F.count("*").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).withColumn("input", F.lit(name))
        for name, df in tables.items()
    ])
    return profile_all(tables).join(F.broadcast(sizes), "input")  # one row per table
