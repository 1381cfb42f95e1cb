"""Continuous intake: new files of items are triaged as they arrive."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import TriageConfig
from ..functions import staging
from ..plans import triage
from ..sources import versions

ARRIVED = "arrived_at"
ITEM_KEY = ("source_type", "source_id")


def once_per_id(arriving: DataFrame, bound: str = "30 days", key: Sequence[str] = ITEM_KEY) -> DataFrame:
    """Each key once: an item whose id was taken up less than ``bound`` ago is left out.

    The keys seen are streaming state, kept in the query's checkpoint and dropped
    when their time is over, so state grows with the ids of one ``bound`` and not
    with the stream. Time is the time of the batch (``arrived_at``), which the
    checkpoint records, so no row is late and a repeated batch decides alike. Of
    several rows that arrive under one new id in one batch, one is kept. Null ids
    are a key like any other.
    """
    timed = arriving.withColumn(ARRIVED, F.current_timestamp())
    return timed.withWatermark(ARRIVED, bound).dropDuplicatesWithinWatermark(list(key))


def _started(arriving: DataFrame, store: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool) -> StreamingQuery:
    """With ``available_now`` the query ends once everything present is processed."""
    writer = arriving.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def triage_stream(
    arriving: DataFrame,
    process: Callable[[DataFrame], DataFrame],
    sink: str,
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Apply a row-wise step to a stream and keep the result under ``sink``.

    Each micro-batch owns the partition ``batch=<id>`` and overwrites it, so a
    batch that is repeated after a failure leaves no second copy.
    """

    def store(rows: DataFrame, batch: int) -> None:
        process(rows).write.mode("overwrite").parquet(f"{sink}/batch={batch}")

    return _started(arriving, store, checkpoint, available_now)


def batch_run_id(name: str, batch: int) -> str:
    return f"{name}-{batch:010d}"


def store_batch(
    rows: DataFrame, batch: int, folder: str, name: str = "stream", responses: DataFrame | None = None,
    steps: triage.Steps = triage.NATIVE, config: TriageConfig = TriageConfig(),
) -> None:
    """One micro-batch of items (with ``arrived_at``) as a run of its own: tickets, log and metrics at once.

    The run is named after the batch and published in one step, so a batch that is
    repeated finds its run and changes nothing, whether the job died before the
    step or after it. Ticket numbers are claimed per batch. What the batch has
    staged is deleted once it is published. A batch without items leaves nothing.
    """
    spark, run_id = rows.sparkSession, batch_run_id(name, batch)
    if versions.has_run(spark, folder, run_id):
        return
    with staging.freed(spark):
        items = staging.stage(rows, "arrived")
        at = items.agg(F.max(ARRIVED).alias("at")).first()["at"]
        if at is not None:
            triage.run_and_store(spark, items.drop(ARRIVED), folder, run_id, at, responses, steps, config)


def triage_into_tables(
    arriving: DataFrame,
    folder: str,
    checkpoint: str,
    name: str = "stream",
    bound: str = "30 days",
    responses: DataFrame | None = None,
    steps: triage.Steps = triage.NATIVE,
    config: TriageConfig = TriageConfig(),
    available_now: bool = True,
) -> StreamingQuery:
    """Triage arriving items, each id once, into the tickets, log and metrics under ``folder``.

    Every micro-batch is a run, so reports and edits work on the tables as on those of any other
    run. Demand for a feature counts within a batch, and a limit holds for each batch.
    """

    def store(rows: DataFrame, batch: int) -> None:
        store_batch(rows, batch, folder.rstrip("/"), name, responses, steps, config)

    return _started(once_per_id(arriving, bound), store, checkpoint, available_now)
