"""The registered queries: every operator over whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from voxsift import fixed_values as fv
from voxsift.config import TriageConfig
from voxsift.functions.picks import draw, literal, pick
from voxsift.functions.staging import new_folder, stage
from voxsift.operators import (
    accounting, details, drafting, edits, evaluation, intake, quality, responses as rs,
    routing, scoring, ticket_ids as numbering,
)
from voxsift.plans import generate as gen, reports, triage
from voxsift.sources import profile, tables
from voxsift.streaming.intake_stream import triage_into_tables, triage_stream

from . import spine
from .store import mixed_outcome, stored_run

Query = Callable[[SparkSession, str], DataFrame]
_ALL: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _ALL[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_ALL)


def _minute(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name.split(".")[-1])


# --- intake ---------------------------------------------------------------------
@query
def normalize_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intake.review_items(spine.raw_reviews(spark, sf_dir)).select(
        "source_id", "source_type", "text", "metadata.platform",
        F.col("metadata.rating").cast("string").alias("rating"),
        "metadata.user_name", _minute("metadata.date"), "metadata.app_version",
    )


@query
def normalize_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intake.email_items(spine.raw_emails(spark, sf_dir)).select(
        "source_id", "source_type", "text", "metadata.subject", "metadata.sender_email",
        _minute("metadata.timestamp"), "metadata.priority",
    )


def _unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intake.unify(spine.raw_reviews(spark, sf_dir), spine.raw_emails(spark, sf_dir))


@query
def unified_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unified(spark, sf_dir).select(
        "source_id", "source_type", "text", "metadata.platform", "metadata.sender_email",
        "metadata.priority",
    )


@query
def items_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intake.first_items(_unified(spark, sf_dir), 300).select("source_id", "source_type", "text")


@query
def items_limit_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intake.first_items(spine.items(spark, sf_dir), 12_000).select("source_id", "source_type", "text")


@query
def input_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile_all({
        "reviews": spine.raw_reviews(spark, sf_dir),
        "emails": spine.raw_emails(spark, sf_dir),
        "labels": spine.table(spark, sf_dir, "labels"),
    })


@query
def input_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, columns, nulls and sizes of tables as they are stored."""
    names = ["customer", "labels", "conversations"]
    found = profile.profile_files({name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in names})
    # bytes per row say that all files were seen, whatever the writer's compression
    fits = (F.col("files") > 0) & F.col("bytes").between(F.col("row_count"), 10_000 * F.col("row_count") + 100_000)
    return found.select("input", "row_count", "column_count", "null_values", fits.alias("sizes_fit"))


# --- stored text tables -----------------------------------------------------------
def _time_text() -> Column:
    at, shape = F.col("processed_at"), F.col("shape") % 5
    return (
        F.when(shape == 0, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'+00:00'"))
        .when(shape == 1, F.date_format(at, "yyyy-MM-dd HH:mm:ss"))
        .when(shape == 2, F.date_format(at, "yyyy-MM-dd"))
        .when(shape == 3, "yesterday")
        .otherwise("")
    )


@query
def load_coerce_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = spine.items(spark, sf_dir).withColumn("shape", F.expr(draw("key", "shape"))).select(
        F.col("source_id").alias("ticket_id"), "source_type", _time_text().alias("created_at")
    )
    return tables.coerce_tickets(raw)


@query
def load_coerce_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = (
        spine.items(spark, sf_dir)
        .withColumn("shape", F.expr(draw("key", "shape")))
        .withColumn("n", F.expr(f"{draw('key', 'number')} % 100"))
        .select(
            "source_id",
            F.when(F.col("n") < 10, "n/a").when(F.col("n") < 20, "")
            .when(F.col("n") < 30, "1e-1")
            .otherwise(F.concat(F.lit("0."), F.col("n").cast("string"))).alias("confidence"),
            _time_text().alias("timestamp"),
        )
    )
    return tables.coerce_log(raw)


@query
def load_coerce_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.expr(f"{draw('key', 'number')} % 100")
    raw = spine.items(spark, sf_dir).withColumn("shape", F.expr(draw("key", "shape"))).withColumn("n", number).select(
        F.col("source_id").alias("run_id"), _time_text().alias("run_at"),
        F.when(F.col("n") < 10, "n/a").when(F.col("n") < 20, "").otherwise(F.col("n").cast("string")).alias("total_processed"),
    )
    return tables.coerce_metrics(raw)


# --- responses ----------------------------------------------------------------------
@query
def parse_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rs.parse(spine.responses(spark, sf_dir)).select(
        "source_id", "stage", "attempt", "well_formed", "confidence", "demand_score",
        F.col("passed").cast("string").alias("passed"),
        *[F.col(f"fields.{name}") for name in (
            "category", "platform", "severity", "user_impact", "title", "description"
        )],
        F.array_join("issues", "; ").alias("issues"),
    )


@query
def response_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rs.rejects(spine.responses(spark, sf_dir))


def _answers(spark: SparkSession, sf_dir: str, stage: str) -> DataFrame:
    answered = rs.validated(spine.responses(spark, sf_dir, stage), stage)
    return answered.filter(F.col("answer").isNotNull()).select("source_id", "answer.*")


@query
def validate_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _answers(spark, sf_dir, rs.CLASSIFIER)


@query
def validate_bug(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _answers(spark, sf_dir, rs.BUG)


@query
def validate_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _answers(spark, sf_dir, rs.FEATURE)


# --- classification -------------------------------------------------------------------
def _by_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.rule_scorer(spine.items(spark, sf_dir))


@query
def classify_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_rules(spark, sf_dir).select(
        "source_id", "label", "category", F.round("confidence", 6).alias("confidence")
    )


@query
def classify_recorded(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = rs.attach_answers(
        spine.items(spark, sf_dir).select("source_id", "source_type"),
        spine.responses(spark, sf_dir, rs.CLASSIFIER),
        ["answer_classifier"],
    )
    return scoring.recorded_scorer(known).drop("answer_classifier")


@query
def classify_rerecorded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several recordings of an item: the last one that can be used counts."""
    known = rs.attach_answers(
        spine.items(spark, sf_dir).select("source_id", "source_type"), spine.responses_again(spark, sf_dir), ["answer_classifier"],
    )
    return scoring.recorded_scorer(known).drop("answer_classifier")


@query
def response_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rs.conflicts(spine.responses_again(spark, sf_dir), ["answer_classifier"])


@query
def classify_calibrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a trained and calibrated scorer is worth on items it has not seen: each check with its items, and whether it holds."""
    labelled = spine.items(spark, sf_dir).select("source_id", "text", "label")
    scored = stage(scoring.cross_calibrated(labelled).select("label", "category", "confidence"), "calibrated")
    right = F.count_if(F.col("label") == F.col("category")) / F.count("*")
    per_label = scored.groupBy("label").agg(F.count("*").alias("items"), (right >= 0.95).alias("holds"))
    bins = evaluation.calibration_table(scored)
    error = evaluation.calibration_error(bins).select(
        F.lit("calibration error below 0.02").alias("check"), "items", (F.col("error") < 0.02).alias("holds")
    )
    # a bin of a few items may be off by chance: three standard deviations of a share
    off = F.col("gap") > 0.03 + 1.5 / F.sqrt("items")
    each = bins.agg(F.sum("items").alias("items"), (F.count_if(off) == 0).alias("holds")).select(
        F.lit("every bin is calibrated").alias("check"), "items", "holds"
    )
    recall = per_label.select(F.concat(F.lit("recall of "), "label").alias("check"), "items", "holds")
    return recall.unionByName(error).unionByName(each)


@query
def classify_ml(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = spine.items(spark, sf_dir).select("source_id", "text", "label")
    return scoring.cross_scored(labelled).select(
        "source_id", "label", "category", F.round("confidence", 4).alias("confidence")
    )


# --- details and drafts -----------------------------------------------------------------
def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with their true category standing in for the classifier's."""
    return spine.items(spark, sf_dir).withColumnRenamed("label", "category")


def _labelled_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, written once by category as a run does, since each branch and the demand count read it."""
    return stage(_labelled(spark, sf_dir), "labelled", ["category"])


def _bugs(labelled: DataFrame) -> DataFrame:
    return details.bug_details(labelled.filter(F.col("category") == "Bug"))


def _features(labelled: DataFrame) -> DataFrame:
    return details.feature_details(labelled.filter(F.col("category") == "Feature Request"))


def _actionable(labelled: DataFrame) -> DataFrame:
    """Bugs and feature requests with their details."""
    return drafting.with_state(_bugs(labelled)).unionByName(
        drafting.with_state(_features(labelled))
    )


def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All items, bugs and feature requests with their details."""
    labelled = _labelled_once(spark, sf_dir)
    others = labelled.filter(~F.col("category").isin("Bug", "Feature Request"))
    return _actionable(labelled).unionByName(drafting.with_state(others))


@query
def bug_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bugs(_labelled(spark, sf_dir)).select(
        "source_id", "platform", "os_version", "steps_to_reproduce", "severity"
    )


@query
def feature_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = _labelled(spark, sf_dir).filter(F.col("category") == "Feature Request")
    return details.feature_demand(details.feature_phrases(wanted))


@query
def feature_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(_labelled_once(spark, sf_dir)).select(
        "source_id", "feature_description", "user_impact", "demand_score"
    )


@query
def derive_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _states(spark, sf_dir).select(
        "source_id", "category", drafting.priority().alias("priority")
    )


@query
def technical_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _states(spark, sf_dir).select(
        "source_id", drafting.technical_details().alias("technical_details")
    )


@query
def ticket_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _states(spark, sf_dir).select("source_id", drafting.context_block().alias("context"))


def _drafted(states: DataFrame) -> DataFrame:
    title, description = drafting.template_draft()
    return states.withColumns({
        "priority": drafting.priority(), "technical_details": drafting.technical_details(),
    }).withColumns({"title": title, "description": description})


def _drafts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drafted(_actionable(_labelled_once(spark, sf_dir)))


@query
def ticket_draft(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drafts(spark, sf_dir).select("source_id", "title", "description")


# --- quality --------------------------------------------------------------------------
def _review_cases(labelled: DataFrame) -> DataFrame:
    """Drafts, many of them damaged in one way or another."""
    def damage(purpose: str, column: str, *bad: str) -> Column:
        cases = [f"WHEN {i} THEN {literal(value)}" for i, value in enumerate([*bad])]
        return F.expr(
            f"CASE {draw('key', purpose)} % 20 {' '.join(cases)} WHEN {len(bad)} THEN NULL ELSE {column} END"
        )

    return _drafted(_actionable(labelled)).withColumns({
        "title": damage("case_title", "title", "", " \n ", "Fix bug", " Fix it now "),
        "description": damage("case_text", "description", "", "It crashes."),
        "category": damage("case_category", "category", "", "Other", " "),
        "priority": damage("case_priority", "priority", "", "Urgent"),
        "technical_details": damage("case_details", "technical_details", "", "  "),
    })


@query
def quality_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.review(_review_cases(_labelled_once(spark, sf_dir))).select(
        "source_id", "quality_passed", F.array_join("quality_issues", "; ").alias("issues")
    )


@query
def quality_review_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rs.attach_answers(
        _labelled(spark, sf_dir), spine.responses(spark, sf_dir, rs.CRITIC), ["answer_critic_1"]
    )
    judged = stage(judged, "judged", ["category"])  # read by each branch
    return quality.review_recorded(_review_cases(judged), F.col("answer_critic_1")).select(
        "source_id", "quality_passed", F.array_join("quality_issues", "; ").alias("issues")
    )


@query
def quality_issue_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.issue_counts(quality.review(_review_cases(_labelled_once(spark, sf_dir))))


@query
def retry_hint(spark: SparkSession, sf_dir: str) -> DataFrame:
    reviewed = quality.review(_review_cases(_labelled_once(spark, sf_dir)))
    failed = (~F.col("quality_passed")).cast("int")
    return reviewed.select(
        "source_id", drafting.retry_hint(failed, F.col("quality_issues")).alias("hint")
    )


@query
def stage_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled items, some stopped by a drawn confidence, some with a first title that fails."""
    short = F.expr(f"CASE WHEN {draw('key', 'case_title')} % 20 < 3 THEN 'Fix bug' ELSE title END")
    reviewed = quality.review(_drafted(_states(spark, sf_dir)).withColumn("title", short))
    drawn = reviewed.withColumns({
        "retry_count": (~F.col("quality_passed")).cast("int"),
        "confidence": F.expr(f"(50 + {draw('key', 'conf')} % 50) / 100D"),
        "failed_response": F.lit(False),
    })
    return drafting.stage_prompts(routing.with_route(drawn))


# --- a run: routes, retries, accounting ---------------------------------------------------
@query
def route_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_run(spark, sf_dir).outcome.select("source_id", "route")


@query
def retry_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        stored_run(spark, sf_dir).outcome.filter(F.col("route").isin("bug", "feature"))
        .select("source_id", "failed_response", "quality_passed", "retry_count")
    )


@query
def item_disposition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_run(spark, sf_dir).outcome.select("source_id", "disposition", "reason")


@query
def run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accounting.run_counts(stored_run(spark, sf_dir).outcome)


@query
def run_category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accounting.run_category_counts(stored_run(spark, sf_dir).outcome)


@query
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accounting.run_summary(stored_run(spark, sf_dir).outcome)


@query
def processing_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.processing_log(stored_run(spark, sf_dir).outcome)


@query
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole run from the given table, nothing stored before."""
    return accounting.run_metrics(mixed_outcome(spark, sf_dir))


@query
def run_metrics_recorded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run in which every step, details and reviews too, is a recorded response."""
    recorded = spine.responses(spark, sf_dir)
    return accounting.run_metrics(
        triage.outcome(spine.items(spark, sf_dir), recorded, triage.RECORDED)
    )


@query
def run_metrics_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run in which every step is a native rule."""
    return accounting.run_metrics(triage.outcome(spine.items(spark, sf_dir)))


@query
def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbering.tickets(stored_run(spark, sf_dir).outcome)


@query
def ticket_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers that go on after those in use."""
    done = stored_run(spark, sf_dir)
    more = numbering.ticket_rows(done.outcome)
    return numbering.with_ticket_ids(more, numbering.last_number(done.tickets)).select(
        "ticket_id", "source_type", "source_id"
    )


@query
def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accounting.threshold_sweep(mixed_outcome(spark, sf_dir, TriageConfig(threshold=0.0)))


# --- reports -------------------------------------------------------------------------------
@query
def kpi_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = stored_run(spark, sf_dir)
    return reports.kpi_summary(run.tickets, run.metrics)


@query
def category_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.category_breakdown(stored_run(spark, sf_dir).tickets)


@query
def priority_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.priority_distribution(stored_run(spark, sf_dir).tickets)


@query
def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.latest_run(stored_run(spark, sf_dir).metrics)


@query
def recent_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.recent_tickets(stored_run(spark, sf_dir).tickets)


@query
def ticket_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.ticket_filter(
        stored_run(spark, sf_dir).tickets, ["Bug"], ["Critical", "High"], ["email"]
    ).select("ticket_id", "category", "priority", "source_type", "source_id", "title")


@query
def ticket_filter_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.ticket_filter_counts(
        stored_run(spark, sf_dir).tickets, ["Bug"], ["Critical", "High"], ["email"]
    )


@query
def ticket_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.ticket_lookup(stored_run(spark, sf_dir).tickets, "T0042")


@query
def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.run_history(stored_run(spark, sf_dir).metrics)


@query
def run_outcomes_stacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.run_outcomes_stacked(stored_run(spark, sf_dir).metrics)


@query
def confidence_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.confidence_histogram(stored_run(spark, sf_dir).log, fv.CONFIDENCE_THRESHOLD)


@query
def agent_step_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.agent_step_counts(stored_run(spark, sf_dir).log)


@query
def priority_crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.priority_crosstab(stored_run(spark, sf_dir).tickets)


@query
def priority_crosstab_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.priority_crosstab_long(stored_run(spark, sf_dir).tickets)


@query
def overall_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.overall_stats(stored_run(spark, sf_dir).metrics)


# --- edits ---------------------------------------------------------------------------------
def _edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers edit the tickets of their number, suppliers some of them again."""
    by_customer = spine.table(spark, sf_dir, "customer").selectExpr(
        "format_string('T%04d', c_custkey) AS ticket_id", "1 AS edit_no", "c_custkey AS key"
    )
    by_supplier = spine.table(spark, sf_dir, "supplier").selectExpr(
        "format_string('T%04d', s_suppkey * 2) AS ticket_id", "2 AS edit_no", "s_suppkey AS key"
    )
    return by_customer.unionByName(by_supplier).selectExpr(
        "ticket_id", "edit_no",
        f"{pick(fv.CATEGORIES, draw('key', 'new_category'))} AS category",
        f"{pick(fv.PRIORITIES, draw('key', 'new_priority'))} AS priority",
        "concat('Edited title ', edit_no, ' of ', key) AS title",
        "'Edited description' AS description",
        f"CASE WHEN {draw('key', 'clear')} % 4 > 0 THEN concat('Edited details ', edit_no) END AS technical_details",
    )


@query
def ticket_edit_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edits.apply_edits(
        stored_run(spark, sf_dir).tickets, _edits(spark, sf_dir), edits.TABLE_COLUMNS
    ).select(
        "ticket_id", "source_id", "category", "priority", "title", "technical_details", "edited"
    )


@query
def ticket_edit_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edits.apply_edits(
        stored_run(spark, sf_dir).tickets, _edits(spark, sf_dir), edits.DETAIL_COLUMNS
    ).select("ticket_id", "category", "title", "description", "technical_details", "edited")


# --- generated data ------------------------------------------------------------------------
def _numbers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    orders = spine.table(spark, sf_dir, "orders")
    return orders.select((F.col("o_orderkey") + 1).alias("number")), orders.count()


@query
def gen_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gen.draw_reviews(*_numbers(spark, sf_dir)).select(*gen.REVIEW_COLUMNS)


@query
def gen_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gen.draw_emails(*_numbers(spark, sf_dir)).select(*gen.EMAIL_COLUMNS)


@query
def gen_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers, n = _numbers(spark, sf_dir)
    return gen.all_labels(gen.draw_reviews(numbers, n), gen.draw_emails(numbers, n))


@query
def label_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gen.distribution(gen_labels(spark, sf_dir))


# --- evaluation and stream -------------------------------------------------------------------
def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spine.items(spark, sf_dir).select(
        "source_type", "source_id", F.col("label").alias("category")
    )
    return evaluation.confusion(_by_rules(spark, sf_dir), labels)


@query
def eval_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.confusion_matrix(_pairs(spark, sf_dir))


@query
def eval_per_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.per_class(_pairs(spark, sf_dir))


@query
def eval_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.accuracy(_pairs(spark, sf_dir))


@query
def stream_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order file arrives as a stream; items are scored and routed on the way."""
    schema = spark.read.parquet(f"{sf_dir}/orders.parquet").schema
    arriving = (
        spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet").parquet(sf_dir)
    )
    folder = new_folder(spark, "stream")
    done = triage_stream(
        arriving,
        lambda orders: routing.with_route(
            scoring.rule_scorer(spine.items_of(spine.spread(orders)))
        ).select("source_id", "category", "confidence", "route"),
        f"{folder}/items", f"{folder}/progress",
    )
    done.awaitTermination()
    return spark.read.parquet(f"{folder}/items").select(
        "source_id", "category", F.round("confidence", 6).alias("confidence"), "route"
    )


@query
def stream_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items arrive in two deliveries that share a third of them; a query takes up the first, a restarted one the second.

    Each item counts once, and the tickets of all batches are numbered without gaps.
    """
    folder = new_folder(spark, "stream-tables")
    arriving = spine.items(spark, sf_dir).withColumn("part", F.expr(f"{draw('key', 'delivery')} % 3"))
    for wanted in ("part < 2", "part > 0"):
        delivery = arriving.filter(wanted).select("source_id", "source_type", "text")
        delivery.write.mode("append").parquet(f"{folder}/inbox")
        inbox = spark.readStream.schema(delivery.schema).parquet(f"{folder}/inbox")
        triage_into_tables(inbox, f"{folder}/out", f"{folder}/progress").awaitTermination()
    counts = ["total_processed", "tickets_created", "skipped", "failed"]
    totals = tables.load_metrics(spark, f"{folder}/out/metrics").agg(*(F.sum(c).alias(c) for c in counts))
    logged = tables.load_log(spark, f"{folder}/out/log").agg(F.count_if(F.col("agent") == "classifier").alias("classified"))
    numbers = tables.load_tickets(spark, f"{folder}/out/tickets").agg(
        F.count_distinct("ticket_id").alias("ticket_ids"), F.coalesce(F.max(numbering.ticket_number()), F.lit(0)).alias("last_number")
    )
    return totals.crossJoin(logged).crossJoin(numbers)  # one row each
