"""Recorded model responses: text in, validated fields or a reject reason out.

A response row is ``(source_id, stage, attempt, raw)``, and may name the
``source_type`` of its item and when it was ``recorded_at`` (a number or a
timestamp). Parsing is one expression over the tall table, whatever the stage;
nothing is parsed per item.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fv, schemas
from ..functions.lookup import frequent_keys, lookup, lookups
from ..functions.staging import stage
from ..functions.text import clamp, one_of, rows_of, strip

CLASSIFIER, BUG, FEATURE, DRAFT, CRITIC = "classifier", "bug", "feature", "draft", "critic"
STAGES = [CLASSIFIER, BUG, FEATURE, DRAFT, CRITIC]

_REQUIRED = {
    CLASSIFIER: ["category", "confidence"],
    BUG: ["platform", "os_version", "steps_to_reproduce", "severity"],
    FEATURE: ["feature_description", "user_impact", "demand_score"],
    DRAFT: ["title", "description"],
    CRITIC: ["passed", "issues"],
}
# spellings read as a boolean
_TRUE = ["true", "1", "t", "y", "yes", "on"]
_FALSE = ["false", "0", "f", "n", "no", "off"]


def with_object_text(responses: DataFrame) -> DataFrame:
    """Adds ``json``, the JSON object inside a response.

    A fenced block counts first, then the shortest ``{...}``, else the text.
    ``regexp_extract`` gives '' both for no match and for an empty match, so
    the fence is recognised by its whole match. Each step is a column of its
    own: nested into one expression, the regexes would run several times.
    """
    fence, text, body = F.col("__fence"), F.col("__text"), F.col("__body")
    return (
        responses.withColumn("__text", strip(F.col("raw")))
        .withColumn("__fence", F.when(F.contains(text, F.lit("```")), F.regexp_extract(text, fv.FENCE_PATTERN, 0)).otherwise(""))
        .withColumn(
            "__body",
            F.when(fence != "", strip(F.regexp_extract(fence, fv.FENCE_PATTERN, 1))).otherwise(text),
        )
        .withColumn("__braces", F.regexp_extract(body, fv.OBJECT_PATTERN, 0))
        .withColumn("json", F.when(F.col("__braces") != "", F.col("__braces")).otherwise(body))
        .drop("__text", "__fence", "__body", "__braces")
    )


def _number(text: Column) -> Column:
    """A number from response text; the JSON literals true and false count as 1 and 0."""
    return F.coalesce(
        text.try_cast("double"), F.when(text == "true", 1.0).when(text == "false", 0.0)
    )


def _boolean(text: Column) -> Column:
    lowered = F.lower(text)
    return F.when(lowered.isin(_TRUE), F.lit(True)).when(lowered.isin(_FALSE), F.lit(False))


def parse(responses: DataFrame) -> DataFrame:
    """Adds ``well_formed``, ``fields`` (all read as text) and the converted
    fields ``confidence``, ``demand_score``, ``passed`` and ``issues``; NaN is no
    number. What another stage's field holds never makes a response ill-formed."""
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": "malformed",
        "allowSingleQuotes": "false",
    }
    score = F.col("__score")
    return (
        with_object_text(responses)
        .withColumn("fields", F.from_json("json", schemas.RESPONSE_FIELDS, options))
        .withColumn(
            "well_formed",
            F.startswith(F.col("json"), F.lit("{"))
            & F.col("fields").isNotNull()
            & F.col("fields.malformed").isNull(),
        )
        .withColumn("__confidence", _number(F.col("fields.confidence")))
        .withColumn("confidence", F.when(~F.isnan("__confidence"), F.col("__confidence")))
        .withColumn("__score", _number(F.col("fields.demand_score")))
        .withColumn("demand_score", F.when(~F.isnan(score) & (score == F.floor(score)), score))
        .withColumn("passed", _boolean(F.col("fields.passed")))
        .withColumn("issues", F.from_json("fields.issues", "array<string>"))
        .drop("json", "__confidence", "__score")
    )


def _all_known(*columns: Column) -> Column:
    known = columns[0].isNotNull()
    for column in columns[1:]:
        known = known & column.isNotNull()
    return known


def classification() -> Column:
    """category (unknown ones become Complaint) and confidence in 0..1."""
    category, confidence = F.col("fields.category"), F.col("confidence")
    return F.when(
        _all_known(category, confidence),
        F.struct(
            one_of(category, fv.CATEGORIES, fv.FALLBACK_CATEGORY).alias("category"),
            clamp(confidence, 0.0, 1.0).alias("confidence"),
        ),
    )


def bug_fields() -> Column:
    texts = [F.col(f"fields.{name}") for name in _REQUIRED[BUG]]
    severity = one_of(F.col("fields.severity"), fv.SEVERITIES, fv.FALLBACK_SEVERITY)
    return F.when(_all_known(*texts), F.struct(*texts[:-1], severity.alias("severity")))


def feature_fields() -> Column:
    description, impact = F.col("fields.feature_description"), F.col("fields.user_impact")
    score = F.col("demand_score")
    return F.when(
        _all_known(description, impact, score),
        F.struct(
            description,
            one_of(impact, fv.IMPACTS, fv.FALLBACK_IMPACT).alias("user_impact"),
            clamp(score, float(fv.DEMAND_MIN), float(fv.DEMAND_MAX)).cast("int").alias("demand_score"),
        ),
    )


def draft_fields() -> Column:
    title, description = F.col("fields.title"), F.col("fields.description")
    return F.when(
        _all_known(title, description),
        F.struct(F.substring(title, 1, fv.TITLE_MAX).alias("title"), description),
    )


def verdict_fields() -> Column:
    passed, issues = F.col("passed"), F.col("issues")
    complete = ~F.exists(issues, lambda issue: issue.isNull())
    return F.when(_all_known(passed, issues) & complete, F.struct(passed, issues))


_VALIDATORS = {
    CLASSIFIER: classification, BUG: bug_fields, FEATURE: feature_fields,
    DRAFT: draft_fields, CRITIC: verdict_fields,
}


def validated(responses: DataFrame, stage: str) -> DataFrame:
    """Responses of one stage with the validated struct ``answer`` (null = reject)."""
    parsed = parse(responses.filter(F.col("stage") == stage))
    answer = F.when(F.col("well_formed"), _VALIDATORS[stage]())
    return parsed.withColumn("answer", answer).select("source_id", "stage", "attempt", "raw", "answer")


def _bad_field(stage: str) -> Column:
    """Name of the first field that is missing or cannot be converted."""
    converted = ("confidence", "demand_score", "passed", "issues")
    return F.coalesce(*[
        F.when(F.col(name if name in converted else f"fields.{name}").isNull(), F.lit(name))
        for name in _REQUIRED[stage]
    ])


def rejects(responses: DataFrame) -> DataFrame:
    """Responses that cannot be used, each with its reason.

    The reason is unfolded before it is filtered: a filter on what is parsed
    moves below the parsing and repeats it.
    """
    bad = None
    for stage in STAGES:
        test, name = F.col("stage") == stage, _bad_field(stage)
        bad = F.when(test, name) if bad is None else bad.when(test, name)
    reason = F.when(~F.col("well_formed"), F.lit("no JSON object")).otherwise(F.concat(F.lit("field "), bad))
    return (
        parse(responses)
        .select("source_id", "stage", "attempt", rows_of(F.array(reason)).alias("reason"), "raw")
        .filter(F.col("reason").isNotNull())
    )


# answer column on the item -> (stage, attempt)
ANSWERS = {
    "answer_classifier": (CLASSIFIER, 1),
    "answer_bug": (BUG, 1),
    "answer_feature": (FEATURE, 1),
    "answer_draft_1": (DRAFT, 1),
    "answer_draft_2": (DRAFT, 2),
    "answer_critic_1": (CRITIC, 1),
    "answer_critic_2": (CRITIC, 2),
}


KEY = "__key"


def _with_key(rows: DataFrame, typed: bool) -> DataFrame:
    """Adds the key of an item: its id, and its source where responses name it."""
    name = F.concat("source_type", F.lit("\0"), "source_id") if typed else F.col("source_id")
    return rows.withColumn(KEY, name)


def _order(responses: DataFrame) -> Column:
    """The place of a recording among others of its item; without ``recorded_at`` all have the same."""
    if "recorded_at" not in responses.columns:
        return F.lit(0).cast("long")
    kind = responses.schema["recorded_at"].dataType.simpleString()
    at = F.unix_micros("recorded_at") if kind == "timestamp" else F.col("recorded_at").cast("long")
    return F.coalesce(at, F.lit(-(1 << 63) + 1))


def usable_answers(responses: DataFrame, names: Sequence[str], told_apart: bool = True) -> DataFrame:
    """(key, slot, recorded, answer per stage): the responses of the named slots that can be used.

    With ``told_apart`` adds the key's own columns too: source_id, and source_type if the responses have it.
    All parsed responses are written first: a filter on what is parsed would parse everything twice.
    """
    stages = sorted({ANSWERS[name][0] for name in names})
    typed = "source_type" in responses.columns
    slot = None
    for name in names:
        stage_name, attempt = ANSWERS[name]
        here = (F.col("stage") == stage_name) & (F.col("attempt") == attempt)
        slot = F.when(here, F.lit(name)) if slot is None else slot.when(here, F.lit(name))
    slotted = responses.withColumn("__slot", slot).withColumn("__recorded", _order(responses)).filter(F.col("__slot").isNotNull())
    parsed = parse(slotted)
    answers = [
        F.when(F.col("well_formed") & (F.col("stage") == name), _VALIDATORS[name]()).alias(f"__{name}") for name in stages
    ]
    keys = [c for c in ("source_type", "source_id") if told_apart and c in responses.columns]
    taken = _with_key(parsed, typed).select(KEY, *keys, "__slot", "__recorded", *answers)
    return stage(taken, "answers").filter(F.coalesce(*(F.when(F.col(f"__{name}").isNotNull(), True) for name in stages), F.lit(False)))


def _repeated(usable: DataFrame) -> DataFrame:
    """Keys and slots with more than one usable recording, and the time of the last one: a narrow hash aggregation."""
    counted = usable.groupBy(KEY, "__slot").agg(F.count("*").alias("__n"), F.max("__recorded").alias("__last"))
    return counted.filter(F.col("__n") > 1).drop("__n")


def _answers_of(usable: DataFrame) -> list[str]:
    return [c for c in usable.columns if c.removeprefix("__") in STAGES]


def one_answer_each(usable: DataFrame) -> DataFrame:
    """At most one answer per key and slot: the last recorded one that can be used.

    Of several that were recorded last at the same time, the largest value
    stands. ``usable`` is a stored table. Only what was recorded more than once is
    aggregated with its texts; everything else passes as it is.
    """
    repeated = stage(_repeated(usable), "repeated")
    if not repeated.limit(1).count():
        return usable.drop("__recorded")
    names = _answers_of(usable)
    pair = F.concat(KEY, F.lit("\0"), "__slot")
    marked = lookup(usable.withColumn("__pair", pair), repeated.select(pair.alias("__pair"), "__last"), "__pair")
    once = marked.filter(F.col("__last").isNull()).select(KEY, "__slot", *names)
    last = marked.filter(F.col("__recorded") == F.col("__last")).groupBy(KEY, "__slot").agg(*(F.max(c).alias(c) for c in names))
    return once.unionByName(last)


def conflicts(responses: DataFrame, names: Sequence[str] = tuple(ANSWERS)) -> DataFrame:
    """Items with usable recordings of one slot that differ: source_type, source_id, slot, recordings and different answers.

    The source is null if the responses do not name it. Counts are of digests, so a hot id costs one number per different answer.
    """
    usable = usable_answers(responses, names)
    source = F.col("source_type") if "source_type" in usable.columns else F.lit(None).cast("string")
    digest = F.xxhash64(*(F.to_json(c) for c in _answers_of(usable)))
    each = usable.groupBy(source.alias("source_type"), "source_id", F.col("__slot").alias("slot"), digest.alias("d")).agg(F.count("*").alias("n"))
    told = each.groupBy("source_type", "source_id", "slot").agg(F.sum("n").alias("recordings"), F.count("*").alias("different"))
    return told.filter(F.col("different") > 1)


def attach_answers(
    items: DataFrame, responses: DataFrame, names: Sequence[str] = tuple(ANSWERS)
) -> DataFrame:
    """Items with their answers; an item without any keeps null answers.

    Responses that name a ``source_type`` belong to the item of that source only,
    so ids may be shared by sources; with ``recorded_at`` the last usable recording
    counts. Usable answers are written once; each slot is then joined on its own,
    with only its columns. Items should be unique, but many may share an id, a
    blank one say; the lookups spread such items over all tasks.
    """
    typed = "source_type" in responses.columns
    answers = one_answer_each(usable_answers(responses, names, told_apart=False))
    keyed = _with_key(items, typed)
    rights = [
        answers.filter(F.col("__slot") == name).select(KEY, F.col(f"__{ANSWERS[name][0]}").alias(name)) for name in names
    ]
    return lookups(keyed, rights, KEY, frequent_keys(keyed, KEY)).drop(KEY)
