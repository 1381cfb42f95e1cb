"""Ticket numbers that are claimed before they are given out.

A claim is a numbered file with the first and last number and the run they are
for. Creating the next file is atomic, so runs that overlap get ranges that
neither overlap nor leave anything between them. A run that dies after its claim
leaves its range unused: a gap, and the only kind there is. The claim files name
it, so it can be told from a lost ticket.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from ..functions import atomic


def _claims(folder: str) -> str:
    return f"{folder}/versions/numbers"


def reserve(spark: SparkSession, folder: str, count: int, run_id: str, floor: int = 0) -> int:
    """Claim ``count`` numbers; returns the one before the first.

    ``floor``: the highest number in use by tickets that were stored without a claim.
    """
    if count < 0:
        raise ValueError("count must not be negative")

    def claim(before: str | None) -> str:
        last = max(floor, json.loads(before)["last"] if before else 0)
        return json.dumps({"first": last + 1, "last": last + count, "run_id": run_id})

    return json.loads(atomic.put_next(spark, _claims(folder), claim))["first"] - 1


def claims(spark: SparkSession, folder: str) -> list[dict]:
    """All claims in order: first, last and run_id."""
    place = _claims(folder)
    return [json.loads(atomic.read_text(spark, f"{place}/{name}")) for name in atomic.names(spark, place)]
