"""Manual edits of stored tickets as keyed updates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

TABLE_COLUMNS = ["category", "priority", "title", "technical_details"]
DETAIL_COLUMNS = ["title", "description", "technical_details"]


def last_edits(edits: DataFrame, columns: Sequence[str], order: str) -> DataFrame:
    """One edit per ticket: the one with the highest ``order``."""
    return edits.groupBy("ticket_id").agg(
        F.max_by(F.struct(*columns), F.col(order)).alias("edit")
    )


def apply_edits(
    tickets: DataFrame, edits: DataFrame, columns: Sequence[str], order: str = "edit_no"
) -> DataFrame:
    """All tickets, with the edited columns where an edit exists.

    A match is told by a flag rather than by non-null values, so an edit can
    also clear a column. ``ticket_id`` is unique on both sides; Spark decides
    by size whether the edits are broadcast.
    """
    latest = last_edits(edits, columns, order).withColumn("__edited", F.lit(True))
    joined = tickets.join(latest, "ticket_id", "left")
    edited = F.coalesce(F.col("__edited"), F.lit(False))
    changes = {
        name: F.when(edited, F.col("edit")[name]).otherwise(F.col(name)) for name in columns
    }
    return joined.withColumns({**changes, "edited": edited}).drop("edit", "__edited")
