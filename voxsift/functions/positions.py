"""Positions 1..n in a total order without bringing all rows together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from .staging import stage

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def with_positions(df: DataFrame, order: Sequence[str], position: str) -> DataFrame:
    """Adds the position of each row by the given columns, dense from 1.

    Rows are range-partitioned and sorted, and every row is written together
    with its partition and its place in it, so its position never depends on
    recomputing the sort. Exact copies are told apart by the partition they
    come from and need not stay together. The offset table has one row per
    partition, so broadcasting it is bounded by the partition count.
    """
    keys = [*order, "__origin"]
    place = F.monotonically_increasing_id()
    placed = stage(
        df.withColumn("__origin", F.spark_partition_id())
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("__part", F.shiftright(place, _ROW_BITS))
        .withColumn("__row", place.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("__origin"),
        "ordered",
    )
    sizes = placed.groupBy("__part").agg(F.count("*").alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before")
    )
    return (
        placed.join(F.broadcast(offsets), "__part")
        .withColumn(position, F.col("__before") + F.col("__row") + 1)
        .drop("__part", "__row", "__before")
    )
