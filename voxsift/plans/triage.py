"""A triage run over a whole item table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import TriageConfig
from ..functions.staging import stage
from ..operators import accounting, details, routing
from ..operators.drafting import priority, technical_details, with_state
from ..operators.intake import first_items
from ..operators.responses import ANSWERS, attach_answers
from ..operators.scoring import Scorer, recorded_scorer, rule_scorer
from ..operators.ticket_ids import last_number, ticket_number, ticket_rows, tickets
from ..sources import numbers, tables, versions

DetailStep = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Steps:
    """How each step gets its answer: by native rules or from recorded responses."""

    score: Scorer = rule_scorer
    bug_details: DetailStep = details.bug_details
    feature_details: DetailStep = details.feature_details
    draft: routing.Drafter = routing.template_drafter
    review: routing.Reviewer = routing.local_reviewer
    # recorded answers the steps above read
    answers: tuple[str, ...] = ()


NATIVE = Steps()
RECORDED = Steps(
    score=recorded_scorer,
    bug_details=details.recorded_bug_details,
    feature_details=details.recorded_feature_details,
    draft=routing.recorded_drafter,
    review=routing.recorded_reviewer,
    answers=tuple(ANSWERS),
)

OUTCOME_COLUMNS = [
    "run_id", "run_at", "processed_at", "source_id", "source_type", "category", "confidence",
    "failed_response", "route", "title", "description", "priority", "technical_details",
    "quality_passed", "quality_issues", "retry_count", "reason", "disposition",
]


def stamp(items: DataFrame, run_id: str, run_at: datetime) -> DataFrame:
    """Marks all items as belonging to one run; the caller names run and time."""
    at = F.lit(run_at).cast("timestamp")
    return items.withColumns({"run_id": F.lit(run_id), "run_at": at, "processed_at": at})


def classify(
    items: DataFrame, responses: DataFrame | None, steps: Steps, config: TriageConfig
) -> DataFrame:
    """Items with answers attached, scored and routed."""
    taken = first_items(items, config.limit)
    if steps.answers and responses is None:
        raise ValueError("these steps need recorded responses")
    known = attach_answers(taken, responses, steps.answers) if steps.answers else taken
    return routing.with_route(steps.score(known), config)


def handle(routed: DataFrame, steps: Steps, config: TriageConfig) -> DataFrame:
    """Details, drafts and disposition, one branch per route.

    Only bugs and feature requests go through extraction and drafting, and only
    feature requests through the demand join. On a table partitioned by route
    each branch reads nothing but its own rows.
    """
    route = F.col("route")
    bugs = with_state(steps.bug_details(routed.filter(route == "bug")))
    features = with_state(steps.feature_details(routed.filter(route == "feature")))
    states = bugs.unionByName(features)
    drafted = routing.draft_with_retry(
        states.withColumns(
            {"priority": priority(config), "technical_details": technical_details()}
        ),
        steps.draft, steps.review,
    )
    ended = routed.filter(~route.isin("bug", "feature"))
    keep = [c for c in OUTCOME_COLUMNS if c not in ("reason", "disposition")]
    all_items = drafted.select(*keep).unionByName(
        ended.select(*[c for c in keep if c in ended.columns]), allowMissingColumns=True
    )
    return routing.with_disposition(all_items, config).select(*OUTCOME_COLUMNS)


def outcome(
    items: DataFrame,
    responses: DataFrame | None = None,
    steps: Steps = NATIVE,
    config: TriageConfig = TriageConfig(),
) -> DataFrame:
    """One row per item: what was found out about it and what became of it.

    The classified items are written once: three branches and the demand count
    read them, and the long chain of expressions is cut there.
    """
    routed = stage(classify(items, responses, steps, config), "classified", ["route"])
    return handle(routed, steps, config)


@dataclass(frozen=True)
class TriageTables:
    outcome: DataFrame
    tickets: DataFrame
    log: DataFrame
    metrics: DataFrame


def run(
    items: DataFrame,
    responses: DataFrame | None = None,
    steps: Steps = NATIVE,
    config: TriageConfig = TriageConfig(),
    after_ticket: int = 0,
) -> TriageTables:
    """The three output tables of a run, all derived from one stored outcome."""
    return tables_of(stage(outcome(items, responses, steps, config), "outcome"), after_ticket)


def tables_of(done: DataFrame, after_ticket: int = 0) -> TriageTables:
    """What a stored outcome gives; ticket numbers begin after the given one."""
    return TriageTables(
        outcome=done,
        tickets=tickets(done, after_ticket),
        log=routing.processing_log(done),
        metrics=accounting.run_metrics(done),
    )


def _after_number(spark: SparkSession, folder: str, done: DataFrame, run_id: str) -> int:
    """The number before a run's first ticket: its own from before if they suffice, else newly claimed."""
    count = ticket_rows(done).count()
    if not count:
        return 0
    stored = tables.load_tickets(spark, f"{folder}/tickets")
    if "run_id" not in stored.columns:
        return numbers.reserve(spark, folder, count, run_id, last_number(stored))
    number = ticket_number()
    own = F.col("run_id").eqNullSafe(F.lit(run_id))
    seen = stored.agg(
        F.coalesce(F.max(number), F.lit(0)).alias("last"), F.count_if(own).alias("had"), F.min(F.when(own, number)).alias("first")
    ).first()
    if seen["had"] >= count:
        return seen["first"] - 1
    return numbers.reserve(spark, folder, count, run_id, seen["last"])


def run_and_store(
    spark: SparkSession,
    items: DataFrame,
    folder: str,
    run_id: str,
    run_at: datetime,
    responses: DataFrame | None = None,
    steps: Steps = NATIVE,
    config: TriageConfig = TriageConfig(),
) -> TriageTables:
    """Run over ``items`` and add the run to the tables under ``folder``.

    Numbers are claimed before they are given out, so runs into one folder may
    overlap. Doing the same run again replaces all its tables in one step, also if
    it now has no tickets, so a job that was cut short can simply be repeated. It
    keeps its numbers, unless it has more tickets than before. A run without items
    leaves a metrics row of zeros.
    """
    folder = folder.rstrip("/")
    paths = {name: f"{folder}/{name}" for name in ("tickets", "log", "metrics")}
    done = stage(outcome(stamp(items, run_id, run_at), responses, steps, config), "outcome")
    made = tables_of(done, _after_number(spark, folder, done, run_id))
    made = replace(made, metrics=accounting.with_empty_run(made.metrics, run_id, run_at))
    versions.publish(spark, folder, {name: getattr(made, name) for name in paths}, [run_id])
    return TriageTables(
        outcome=made.outcome,
        tickets=tables.load_tickets(spark, paths["tickets"]),
        log=tables.load_log(spark, paths["log"]),
        metrics=tables.load_metrics(spark, paths["metrics"]),
    )
