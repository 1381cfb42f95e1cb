"""Feedback in the given tables' clothes.

The given tables hold no feedback, so items, recorded responses and edits are
derived row by row from ``orders``; long free text comes from ``documents`` and
``conversations``. Everything grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voxsift import fixed_values as fv, vocabulary as words
from voxsift.functions.picks import draw, literal, pick
from voxsift.operators import responses as rs
from voxsift.plans import generate as gen


def spread(df: DataFrame) -> DataFrame:
    """A frame that is read as fewer pieces than there are cores is spread over
    all of them first; a large one keeps its own splits."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


_LABEL = """CASE
    WHEN source_type = 'email' THEN CASE WHEN u < 60 THEN 'Bug' ELSE 'Feature Request' END
    WHEN u < 30 THEN 'Bug' WHEN u < 55 THEN 'Feature Request' WHEN u < 75 THEN 'Praise'
    WHEN u < 90 THEN 'Complaint' ELSE 'Spam' END"""


def keyed(orders: DataFrame, *purposes: str) -> DataFrame:
    """One row per order with its kind of source, its true category and its draws."""
    rows = orders.selectExpr(
        "o_orderkey AS key",
        "cast(o_orderdate AS TIMESTAMP) AS ordered",
        "CASE WHEN o_orderkey % 3 = 0 THEN 'email' ELSE 'review' END AS source_type",
        f"{draw('o_orderkey', 'category')} % 100 AS u",
    )
    named = rows.selectExpr(
        "key", "ordered", "source_type", f"{_LABEL} AS label",
        f"""CASE source_type WHEN 'email' THEN format_string('{fv.EMAIL_ID_FORMAT}', key)
            ELSE format_string('{fv.REVIEW_ID_FORMAT}', key) END AS source_id""",
    )
    return gen.with_draws(named, purposes)


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items_of(table(spark, sf_dir, "orders"))


def items_of(orders: DataFrame) -> DataFrame:
    mail = f"concat({gen.EMAIL_SUBJECT}, '\n\n', {gen.EMAIL_BODY})"
    return keyed(orders, *gen.TEXT_DRAWS, "sec").selectExpr(
        "key", "source_id", "source_type", "label",
        f"CASE source_type WHEN 'email' THEN {mail} ELSE {gen.REVIEW_TEXT} END AS text",
        "concat('run-', date_format(ordered, 'yyyyMM')) AS run_id",
        "date_trunc('month', ordered) AS run_at",
        "timestampadd(SECOND, cast(d_sec % 86400 AS INT), ordered) AS processed_at",
    )


_CLASSIFIER_RAW = f"""CASE
    WHEN d_resp % 100 < 2 THEN 'no json here'
    WHEN d_resp % 100 < 4 THEN concat({literal('{"category": "')}, label, {literal('"}')})
    WHEN d_resp % 100 < 10 THEN concat({literal('```json' + chr(10) + '{"category": "')}, label,
        {literal('", "confidence": 0.9}' + chr(10) + '```')})
    WHEN d_resp % 100 < 12 THEN {literal('{"category": "Other", "confidence": 0.8}')}
    WHEN d_resp % 100 < 14 THEN concat({literal('{"category": "')}, label, {literal('", "confidence": 1.5}')})
    WHEN d_resp % 100 < 16 THEN concat({literal('{"category": "')}, label, {literal('", "confidence": -0.3}')})
    ELSE concat({literal('My answer: {"category": "')}, label, {literal('", "confidence": 0.')},
        cast(50 + d_conf % 50 AS STRING), '}}') END"""

_OS = pick(words.OS_VERSIONS, "d_os")
_ACTION = pick(words.ACTIONS, "d_action")
_FEATURE = pick(words.FEATURES, "d_feature")
_BUG_START = f"""{literal('{"platform": "')}, {_OS}, {literal('", "os_version": "')},
    split_part({_OS}, ' ', 2), {literal('", "steps_to_reproduce": "Try to ')}, {_ACTION}, '"'"""
_NOTHING_KNOWN = (
    '{"platform": "Unknown", "os_version": "Unknown", '
    '"steps_to_reproduce": "Not specified", "severity": "Low"}'
)
_BUG_RAW = f"""CASE WHEN label = 'Bug' THEN CASE
    WHEN d_bugresp % 100 < 4 THEN concat({_BUG_START}, {literal(', "severity": "Unknown"}')})
    WHEN d_bugresp % 100 < 6 THEN concat({_BUG_START}, '}}')
    WHEN d_bugresp % 100 < 10 THEN {literal(_NOTHING_KNOWN)}
    ELSE concat({_BUG_START}, {literal(', "severity": "')}, {pick(fv.SEVERITIES, 'd_sev')}, {literal('"}')}) END END"""

_FEATURE_START = f"""{literal('{"feature_description": "Offer ')}, {_FEATURE}, '"'"""
_FEATURE_RAW = f"""CASE WHEN label = 'Feature Request' THEN CASE
    WHEN d_featresp % 100 < 4 THEN concat({_FEATURE_START}, {literal(', "user_impact": "High", "demand_score": 99}')})
    WHEN d_featresp % 100 < 8 THEN concat({_FEATURE_START}, {literal(', "user_impact": "High", "demand_score": -5}')})
    WHEN d_featresp % 100 < 12 THEN concat({_FEATURE_START}, {literal(', "user_impact": "Very High", "demand_score": 6}')})
    WHEN d_featresp % 100 < 14 THEN concat({_FEATURE_START}, {literal(', "user_impact": "Low", "demand_score": "abc"}')})
    WHEN d_featresp % 100 < 16 THEN concat({_FEATURE_START}, {literal(', "user_impact": "Low", "demand_score": "7"}')})
    ELSE concat({_FEATURE_START}, {literal(', "user_impact": "')}, {pick(fv.IMPACTS, 'd_impact')},
        {literal('", "demand_score": ')}, cast(d_demand % 10 + 1 AS STRING), '}}') END END"""

_LONG = ", as the reporter explains at length in a message that does not fit into one title line"
_TITLE = f"""CASE WHEN label = 'Feature Request' THEN concat('Add ', {_FEATURE})
    ELSE concat('Investigate why users cannot ', {_ACTION}) END,
    CASE WHEN d_long % 100 < 5 THEN {literal(_LONG)} ELSE '' END"""


def _draft_raw(attempt: int) -> str:
    short, broken = (15, 17) if attempt == 1 else (20, 20)
    return f"""CASE
        WHEN d_draft{attempt} % 100 < {short} THEN {literal('{"title": "Fix bug", "description": "Too short"}')}
        WHEN d_draft{attempt} % 100 < {broken} THEN 'sorry, no ticket'
        ELSE concat({literal('{"title": "')}, {_TITLE}, {literal('", "description": "**Summary:** ')}, {_TITLE},
            {literal('.' + chr(92) + 'n**Details:** From source ')}, source_id,
            {literal('.' + chr(92) + 'n**User Impact:** Daily work is affected."}')}) END"""


def _critic_raw(attempt: int) -> str:
    return f"""CASE
        WHEN d_verdict{attempt} % 100 < 10 THEN 'no verdict'
        WHEN d_verdict{attempt} % 100 < 15 THEN {literal('{"passed": false, "issues": ["Title too generic"]}')}
        WHEN d_verdict{attempt} % 100 < 20 THEN {literal('{"passed": true, "issues": ["Wording", "Length"]}')}
        ELSE {literal('{"passed": true, "issues": []}')} END"""


# stage, attempt, response text, the draws it needs
_RECORDED = [
    (rs.CLASSIFIER, 1, _CLASSIFIER_RAW, ["resp", "conf"]),
    (rs.BUG, 1, _BUG_RAW, ["bugresp", "os", "action", "sev"]),
    (rs.FEATURE, 1, _FEATURE_RAW, ["featresp", "feature", "impact", "demand"]),
    (rs.DRAFT, 1, _draft_raw(1), ["draft1", "action", "feature", "long"]),
    (rs.DRAFT, 2, _draft_raw(2), ["draft2", "action", "feature", "long"]),
    (rs.CRITIC, 1, _critic_raw(1), ["verdict1"]),
    (rs.CRITIC, 2, _critic_raw(2), ["verdict2"]),
]


def responses(spark: SparkSession, sf_dir: str, *stages: str) -> DataFrame:
    """Recorded responses of the named stages (all by default)."""
    wanted = [row for row in _RECORDED if not stages or row[0] in stages]
    purposes = sorted({purpose for row in wanted for purpose in row[3]})
    made = ", ".join(
        f"named_struct('stage', '{stage}', 'attempt', {attempt}, 'raw', {raw})"
        for stage, attempt, raw, _ in wanted
    )
    slots = f"array({made})"
    if len(wanted) > 3:  # the lambda keeps so many texts out of one generated method, which the JVM would not compile
        slots = f"filter({slots}, r -> r.raw IS NOT NULL)"
    return (
        keyed(table(spark, sf_dir, "orders"), *purposes)
        .selectExpr("source_type", "source_id", f"{slots} AS made")
        .selectExpr("source_type", "source_id", "inline_outer(made)")
        .filter("raw IS NOT NULL")
    )


_AGAIN_RAW = f"""CASE
    WHEN d_again % 100 < 10 THEN {literal('{"category": "Spam", "confidence": 0.65}')}
    WHEN d_again % 100 < 15 THEN 'cut off {{'
    WHEN d_again % 100 BETWEEN 25 AND 29 THEN {literal('{"category": "Praise", "confidence": 0.9}')} END"""


def responses_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded classifications, some of them with a later or an earlier recording beside."""
    again = keyed(table(spark, sf_dir, "orders"), "again").selectExpr(
        "source_type", "source_id", f"'{rs.CLASSIFIER}' AS stage", "1 AS attempt", f"{_AGAIN_RAW} AS raw",
        "CASE WHEN d_again % 100 < 15 THEN 2L ELSE 0L END AS recorded_at",
    )
    once = responses(spark, sf_dir, rs.CLASSIFIER).selectExpr("*", "1L AS recorded_at")
    return once.unionByName(again.filter("raw IS NOT NULL"))


# --- free text from documents and conversations ---------------------------------
_PADDING = ["", " ", "\t\n", "\u00a0\u2003", "\r\n \u3000"]


def _padded(key: str) -> str:
    return f"concat({pick(_PADDING, draw(key, 'left'))}, text, {pick(_PADDING, draw(key, 'right'))})"


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as reviews: padded text, some without text or with a bad rating."""
    dates = ["2024-03-01", "2024-03-02 10:20:30", "unknown"]
    return (
        table(spark, sf_dir, "documents")
        .selectExpr("*", f"{draw('doc_id', 'rating')} % 7 AS drawn_rating")
        .selectExpr(
            f"format_string('{fv.REVIEW_ID_FORMAT}', doc_id) AS review_id",
            f"{literal(words.APP_NAMES[0])} AS app_name",
            f"CASE WHEN {draw('doc_id', 'blank')} % 50 > 0 THEN {_padded('doc_id')} END AS review_text",
            """CASE WHEN drawn_rating = 0 THEN 'none'
                    WHEN drawn_rating < 6 THEN cast(drawn_rating AS STRING) END AS rating""",
            "source AS platform",
            f"{pick(words.VERSIONS, draw('doc_id', 'version'))} AS app_version",
            f"{pick(dates, draw('doc_id', 'date'))} AS date",
            "lang AS user_name",
        )
    )


def raw_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as e-mails: role and turn as subject, text as body."""
    times = ["2024-05-01 08:00:00", "2024-05-02", ""]
    return (
        table(spark, sf_dir, "conversations")
        .selectExpr("*", "concat(conv_id, '-', turn) AS key")
        .selectExpr(
            "concat('EML', key) AS email_id",
            "concat(' Turn ', turn, ' \n') AS subject",
            f"{_padded('key')} AS body",
            "concat(role, '@mail.example') AS sender_email",
            f"{pick(times, draw('key', 'date'))} AS timestamp",
            f"nullif({pick(['High', 'Low', ''], draw('key', 'prio'))}, '') AS priority",
        )
    )
