"""Dense ticket ids that continue over runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fv
from ..functions.positions import with_positions


def ticket_number() -> Column:
    """The number in a ticket_id."""
    return F.substring("ticket_id", 2, 20).try_cast("bigint")


def last_number(tickets: DataFrame) -> int:
    """The highest number in use; 0 without tickets."""
    return tickets.agg(F.max(ticket_number()).alias("n")).first()["n"] or 0


def with_ticket_ids(tickets: DataFrame, after: int = 0) -> DataFrame:
    """Numbers tickets after+1, after+2, .. by source type and id."""
    order = ["source_type", "source_id", "created_at", "title"]
    number = F.col("__number") + after
    return (
        with_positions(tickets, order, "__number")
        .withColumn("ticket_id", F.format_string(fv.TICKET_ID_FORMAT, number))
        .drop("__number")
    )


def ticket_rows(outcome: DataFrame) -> DataFrame:
    """Created items as tickets without ids; missing text becomes ''."""
    text = ["title", "description", "category", "priority", "technical_details"]
    return outcome.filter(F.col("disposition") == "created").select(
        "run_id", "source_id", "source_type",
        *[F.coalesce(F.col(name), F.lit("")).alias(name) for name in text],
        F.col("processed_at").alias("created_at"),
    )


def tickets(outcome: DataFrame, after: int = 0) -> DataFrame:
    return with_ticket_ids(ticket_rows(outcome), after).select(*fv.TICKET_COLUMNS, "run_id")
