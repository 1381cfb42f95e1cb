"""Bug and feature details."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fv, vocabulary as words
from ..functions.lookup import lookup
from ..functions.staging import stage
from ..functions.text import contains_any, strip


def _match(text: Column, pattern: str, group: int) -> Column:
    """The matched group, or null: ``regexp_extract`` gives '' for no match."""
    return _found(F.regexp_extract(text, pattern, group))


def _found(matched: Column) -> Column:
    """Null for ''; inside a condition ``nullif`` repeats what it is given, so give it a column."""
    return F.nullif(matched, F.lit(""))


def severity_of(text: str) -> Column:
    lowered = f"lower({text})"
    chosen = None
    for severity, phrases in words.SEVERITY_PHRASES:
        hit = contains_any(lowered, phrases)
        chosen = F.when(hit, F.lit(severity)) if chosen is None else chosen.when(hit, F.lit(severity))
    return chosen.otherwise(F.lit(words.SEVERITY_OTHERWISE))


def bug_details(items: DataFrame) -> DataFrame:
    """platform, os_version, steps_to_reproduce and severity from the whole text.

    Each pattern is a column of its own, so that it runs at most once per item;
    device and trigger are looked for only where the system or the steps are missing.
    """
    text = F.col("text")
    os, steps = F.col("__os"), F.col("__steps")
    return (
        items.withColumns({
            "__os": F.regexp_extract(text, words.OS_PATTERN, 0),
            "__version": F.regexp_extract(text, words.OS_PATTERN, 2),
            "__block": F.regexp_extract(text, words.STEPS_BLOCK_PATTERN, 1),
        })
        .withColumn("__steps", strip(F.col("__block")))
        .withColumns({
            "__device": F.when(os == "", F.regexp_extract(text, words.DEVICE_PATTERN, 0)),
            "__trigger": F.when(steps == "", F.regexp_extract(text, words.TRIGGER_PATTERN, 2)),
        })
        .withColumns({
            "platform": F.coalesce(_found(os), _found(F.col("__device")), F.lit(fv.UNKNOWN)),
            "os_version": F.coalesce(_found(F.col("__version")), F.lit(fv.UNKNOWN)),
            "steps_to_reproduce": F.coalesce(_found(steps), _found(F.col("__trigger")), F.lit(fv.NOT_SPECIFIED)),
            "severity": severity_of("text"),
        })
        .drop("__os", "__version", "__block", "__steps", "__device", "__trigger")
    )


def feature_phrases(items: DataFrame) -> DataFrame:
    """Adds ``phrase``: what the item asks for, in lower case; null if it names nothing."""
    asked = strip(F.lower(_match(F.col("text"), words.FEATURE_PATTERN, 3)))
    return items.withColumn("phrase", F.nullif(asked, F.lit("")))


def feature_demand(requests: DataFrame) -> DataFrame:
    """Requests per named phrase; a frequent phrase is combined before the shuffle."""
    return requests.filter(F.col("phrase").isNotNull()).groupBy("phrase").agg(F.count("*").alias("requests"))


def feature_details(items: DataFrame) -> DataFrame:
    """feature_description, user_impact and demand_score.

    The demand score is the phrase's number of requests in proportion to the
    most requested phrase, from 1 to 10. Requests that name nothing are no
    common wish: they have no score and count for nobody. The demand table, one
    row per phrase, is written once because the lookup reads it several times.
    """
    asked = feature_phrases(items)
    demand = stage(feature_demand(asked), "demand")
    most = demand.agg(F.max("requests")).scalar()
    known = lookup(asked, demand, "phrase", counts=demand, rows="requests")
    return score_demand(known.withColumn("__most", most)).drop("__most", "requests", "phrase")


def score_demand(counted: DataFrame) -> DataFrame:
    score = F.ceil(F.col("requests") * fv.DEMAND_MAX / F.col("__most")).cast("int")
    weighed = F.coalesce("demand_score", F.lit(fv.DEMAND_DEFAULT))
    return (
        counted.withColumn("demand_score", score)
        .withColumn(
            "user_impact",
            F.when(weighed >= fv.DEMAND_HIGH, F.lit("High"))
            .when(weighed >= fv.DEMAND_MEDIUM, F.lit("Medium"))
            .otherwise(F.lit("Low")),
        )
        .withColumn("feature_description", F.concat(F.lit("Users ask for: "), F.coalesce("phrase", F.lit(words.FEATURE_OTHERWISE))))
    )


def recorded_bug_details(items: DataFrame) -> DataFrame:
    answer = F.col("answer_bug")
    return items.select(
        *[c for c in items.columns if c != "failed_response"],
        answer["platform"].alias("platform"),
        answer["os_version"].alias("os_version"),
        answer["steps_to_reproduce"].alias("steps_to_reproduce"),
        answer["severity"].alias("severity"),
        (F.col("failed_response") | answer.isNull()).alias("failed_response"),
    )


def recorded_feature_details(items: DataFrame) -> DataFrame:
    answer = F.col("answer_feature")
    return items.select(
        *[c for c in items.columns if c != "failed_response"],
        answer["feature_description"].alias("feature_description"),
        answer["user_impact"].alias("user_impact"),
        answer["demand_score"].alias("demand_score"),
        (F.col("failed_response") | answer.isNull()).alias("failed_response"),
    )
