"""Labelled test data of any size, drawn row by row from a hash of the row number."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import fixed_values as fv, vocabulary as words
from ..functions.picks import draw, fill, literal, pick, pick_by, pick_weighted

ANCHOR = datetime(2025, 6, 1, 12, 0, 0)

_REVIEW_DRAWS = [
    "app", "tmpl", "action", "device", "os", "version", "station", "feature", "part", "url", "rating",
    "platform", "date", "first", "last", "label_priority", "rest",
]
_EMAIL_DRAWS = [
    "subject", "tmpl", "action", "device", "os", "version", "station", "feature", "part",
    "rides", "first", "last", "sender", "number", "domain", "date", "prio", "label_priority",
    "rest",
]
# what the texts of both kinds draw
TEXT_DRAWS = [
    "tmpl", "subject", "action", "device", "os", "version", "station", "feature", "url", "part",
    "rides", "first", "last",
]


def with_draws(keyed: DataFrame, purposes: Sequence[str], seed: int | None = None) -> DataFrame:
    """One drawn number ``d_<purpose>`` per purpose, from the column ``key``."""
    return keyed.selectExpr("*", *[f"{draw('key', p, seed)} AS d_{p}" for p in purposes])


_SLOTS = {
    "action": pick(words.ACTIONS, "d_action"),
    "device": pick(words.DEVICES, "d_device"),
    "os": pick(words.OS_VERSIONS, "d_os"),
    "version": pick(words.VERSIONS, "d_version"),
    "station": pick(words.STATIONS, "d_station"),
    "part": pick(words.PARTS, "d_part"),
    "feature": pick(words.FEATURES, "d_feature"),
}
PERSON = f"concat({pick(words.FIRST_NAMES, 'd_first')}, ' ', {pick(words.LAST_NAMES, 'd_last')})"
REVIEW_TEXT = fill(
    pick_by("label", words.REVIEW_TEMPLATES, "d_tmpl"),
    {**_SLOTS, "url": pick(words.SPAM_LINKS, "d_url")},
)
EMAIL_SUBJECT = pick_by("label", words.EMAIL_SUBJECTS, "d_subject")
EMAIL_BODY = fill(
    pick_by("label", words.EMAIL_BODIES, "d_tmpl"),
    {
        **_SLOTS,
        "rides": f"cast(d_rides % {words.MAX_RIDES} + 1 AS STRING)",
        "name": PERSON,
    },
)
_FIRST, _LAST = f"lower({pick(words.FIRST_NAMES, 'd_first')})", f"lower({pick(words.LAST_NAMES, 'd_last')})"
# first.last, first plus a number, or initial plus last, at some domain
SENDER = f"""concat(
    CASE d_sender % 3
        WHEN 0 THEN concat({_FIRST}, '.', {_LAST})
        WHEN 1 THEN concat({_FIRST}, cast(d_number % 99 + 1 AS STRING))
        ELSE concat(substring({_FIRST}, 1, 1), {_LAST})
    END, '@', {pick(words.MAIL_DOMAINS, 'd_domain')})"""


def quota_label(n: int, quota: list[tuple[str, float]]) -> str:
    """Categories in blocks of their exact quota; a rounding rest is drawn."""
    cases, upto = [], 0
    for category, share in quota:
        upto += round(share * n)
        cases.append(f"WHEN number <= {upto} THEN {literal(category)}")
    return f"CASE {' '.join(cases)} ELSE {pick([c for c, _ in quota], 'd_rest')} END"


def _numbered(
    numbers: DataFrame, n: int, quota: list[tuple[str, float]], side: str,
    purposes: Sequence[str], seed: int | None,
) -> DataFrame:
    keyed = numbers.selectExpr("number", f"concat('{side}', number) AS key")
    return with_draws(keyed, purposes, seed).withColumn("label", F.expr(quota_label(n, quota)))


def _bug_only(values: Sequence[str], drawn: str) -> str:
    return f"CASE WHEN label = 'Bug' THEN {pick(values, drawn)} END"


def _days_before(anchor: datetime, days_back: int) -> str:
    return f"TIMESTAMP '{anchor:%Y-%m-%d %H:%M:%S}' - make_dt_interval(cast(d_date % {days_back + 1} AS INT))"


def draw_reviews(numbers: DataFrame, n: int, seed: int | None = None, anchor: datetime = ANCHOR) -> DataFrame:
    """Reviews for ``number`` 1..n, with the drawn label and its hidden attributes."""
    drawn = _numbered(numbers, n, fv.REVIEW_QUOTA, "review-", _REVIEW_DRAWS, seed)
    return drawn.selectExpr(
        f"format_string('{fv.REVIEW_ID_FORMAT}', number) AS review_id",
        f"{pick(words.APP_NAMES, 'd_app')} AS app_name",
        f"{REVIEW_TEXT} AS review_text",
        f"{pick_by('label', fv.RATINGS, 'd_rating')} AS rating",
        f"{pick(words.PLATFORMS, 'd_platform')} AS platform",
        f"{pick(words.VERSIONS, 'd_version')} AS app_version",
        f"{_days_before(anchor, fv.REVIEW_DAYS_BACK)} AS date",
        f"{PERSON} AS user_name",
        "label",
        f"{_bug_only(words.DEVICES, 'd_device')} AS hidden_device",
        f"{_bug_only(words.OS_VERSIONS, 'd_os')} AS hidden_os",
        f"{_bug_only(words.ACTIONS, 'd_action')} AS hidden_action",
        "cast(NULL AS STRING) AS hidden_version",
        f"{pick_by('label', words.REVIEW_SUBJECTS, 'd_tmpl')} AS hidden_subject",
        "d_label_priority AS hidden_roll",
    )


def draw_emails(numbers: DataFrame, n: int, seed: int | None = None, anchor: datetime = ANCHOR) -> DataFrame:
    drawn = _numbered(numbers, n, fv.EMAIL_QUOTA, "email-", _EMAIL_DRAWS, seed)
    return drawn.selectExpr(
        f"format_string('{fv.EMAIL_ID_FORMAT}', number) AS email_id",
        f"{EMAIL_SUBJECT} AS subject",
        f"{EMAIL_BODY} AS body",
        f"{SENDER} AS sender_email",
        f"{_days_before(anchor, fv.EMAIL_DAYS_BACK)} AS timestamp",
        f"{pick_by('label', fv.EMAIL_PRIORITIES, 'd_prio')} AS priority",
        "label",
        f"{_bug_only(words.DEVICES, 'd_device')} AS hidden_device",
        f"{_bug_only(words.OS_VERSIONS, 'd_os')} AS hidden_os",
        f"{_bug_only(words.ACTIONS, 'd_action')} AS hidden_action",
        f"{_bug_only(words.VERSIONS, 'd_version')} AS hidden_version",
        "cast(NULL AS STRING) AS hidden_subject",
        "d_label_priority AS hidden_roll",
    )


REVIEW_COLUMNS = ["review_id", "app_name", "review_text", "rating", "platform", "app_version", "date", "user_name"]
EMAIL_COLUMNS = ["email_id", "subject", "body", "sender_email", "timestamp", "priority"]


def label_rows(drawn: DataFrame, id_column: str, source_type: str) -> DataFrame:
    """Ground truth of generated rows."""
    importance = " ".join(
        f"WHEN {literal(category)} THEN {pick_weighted(fv.PRIORITIES, percents, 'hidden_roll')}"
        for category, percents in fv.LABEL_PRIORITY_PERCENT.items()
    )
    titles = {category: literal(text) for category, text in fv.LABEL_TITLES.items()}
    titles["Bug"] = f"concat({titles['Bug']}, hidden_action)"
    titles["Feature Request"] = f"coalesce(hidden_subject, {titles['Feature Request']})"
    title = " ".join(f"WHEN {literal(category)} THEN {text}" for category, text in titles.items())
    return drawn.selectExpr(
        f"{id_column} AS source_id",
        f"'{source_type}' AS source_type",
        "label AS category",
        f"CASE label {importance} END AS priority",
        """concat_ws(' | ', concat('Device: ', hidden_device), concat('OS: ', hidden_os),
           concat('Trigger: ', hidden_action), concat('App version: ', hidden_version))
           AS technical_details""",
        f"CASE label {title} END AS suggested_title",
    )


def all_labels(reviews: DataFrame, emails: DataFrame) -> DataFrame:
    return label_rows(reviews, "review_id", "review").unionByName(
        label_rows(emails, "email_id", "email")
    )


def generate(
    spark: SparkSession, n_reviews: int = 120, n_emails: int = 60, seed: int | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(reviews, emails, labels). The same seed always gives the same rows."""

    def numbers(n: int) -> DataFrame:
        return spark.range(1, n + 1).withColumnRenamed("id", "number")

    reviews = draw_reviews(numbers(n_reviews), n_reviews, seed)
    emails = draw_emails(numbers(n_emails), n_emails, seed)
    return reviews.select(*REVIEW_COLUMNS), emails.select(*EMAIL_COLUMNS), all_labels(reviews, emails)


def distribution(labels: DataFrame) -> DataFrame:
    """Labels per category and per priority, each row counted once per kind."""
    return (
        labels.groupBy("source_type", "category", "priority")
        .agg(F.count("*").alias("n"))
        .select(
            F.explode(F.array(
                F.struct(
                    F.concat(F.col("source_type"), F.lit(" category")).alias("kind"),
                    F.col("category").alias("value"),
                ),
                F.struct(F.lit("priority").alias("kind"), F.col("priority").alias("value")),
            )).alias("e"),
            "n",
        )
        .groupBy("e.kind", "e.value")
        .agg(F.sum("n").alias("items"))
    )
