"""One stored run per session and input, for the queries that read stored tables."""

from __future__ import annotations

import dataclasses
from threading import RLock

from pyspark.sql import DataFrame, SparkSession

from voxsift.config import TriageConfig
from voxsift.functions.staging import new_folder, stage
from voxsift.operators import accounting, responses as rs, routing, ticket_ids as numbering
from voxsift.plans import triage
from voxsift.sources import tables

from . import spine

# Classification and drafts as recorded, details and review by native rules.
MIXED = dataclasses.replace(
    triage.RECORDED,
    bug_details=triage.NATIVE.bug_details,
    feature_details=triage.NATIVE.feature_details,
    review=routing.local_reviewer,
    answers=("answer_classifier", "answer_draft_1", "answer_draft_2"),
)

_LOCK = RLock()


class StoredRun:
    """The outcome of a run, and its tables; each table is written when it is first asked for."""

    _MADE = {"tickets": numbering.tickets, "log": routing.processing_log, "metrics": accounting.run_metrics}
    _READ = {"tickets": tables.load_tickets, "log": tables.load_log, "metrics": tables.load_metrics}

    def __init__(self, spark: SparkSession, outcome: DataFrame) -> None:
        self.outcome, self._folder, self._stored = outcome, new_folder(spark, "run"), {}

    def _table(self, name: str) -> DataFrame:
        with _LOCK:
            if name not in self._stored:
                path = f"{self._folder}/{name}"
                tables.append(self._MADE[name](self.outcome), path, partition_by=())
                self._stored[name] = self._READ[name](self.outcome.sparkSession, path)
            return self._stored[name]

    tickets = property(lambda self: self._table("tickets"))
    log = property(lambda self: self._table("log"))
    metrics = property(lambda self: self._table("metrics"))


_RUNS: dict[tuple, StoredRun] = {}


def mixed_outcome(
    spark: SparkSession, sf_dir: str, config: TriageConfig = TriageConfig()
) -> DataFrame:
    recorded = spine.responses(spark, sf_dir, rs.CLASSIFIER, rs.DRAFT)
    return triage.outcome(spine.items(spark, sf_dir), recorded, MIXED, config)


def stored_run(spark: SparkSession, sf_dir: str) -> StoredRun:
    """Outcome, tickets, log and metrics as written by a run over all orders.

    The run happens when a session first asks for these input files. Many
    small runs share the batch, so the tables are not split into a folder per
    run.
    """
    files = spark.read.parquet(f"{sf_dir}/orders.parquet").inputFiles()
    key = (spark.sparkContext.applicationId, sf_dir, tuple(files))
    with _LOCK:
        if key not in _RUNS:
            _RUNS[key] = StoredRun(spark, stage(mixed_outcome(spark, sf_dir), "outcome"))
        return _RUNS[key]
