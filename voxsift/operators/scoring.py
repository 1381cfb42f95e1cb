"""Classification: one of five categories and a confidence per item.

A scorer is a function ``DataFrame -> DataFrame`` that adds ``category``,
``confidence`` and ``failed_response``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.feature import HashingTF, IndexToString, RegexTokenizer, StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fv, vocabulary as words
from ..functions.text import count_phrases

Scorer = Callable[[DataFrame], DataFrame]


def rule_scorer(items: DataFrame) -> DataFrame:
    """Phrase votes per category; the first category with the most votes wins.

    confidence = share of the winning votes, damped while there are few of
    them: best/all * (1 - 0.5^(best+1)); without any vote Complaint at 0.5.
    """
    lowered = F.regexp_replace(F.lower(F.col("text")), words.NEGATED_PHRASES, " ")
    votes = items.withColumn("__lowered", lowered).withColumn(
        "__votes",
        F.array(*[count_phrases("__lowered", words.LEXICON[c]) for c in fv.CATEGORIES]),
    )
    most = F.array_max("__votes")
    every = F.aggregate("__votes", F.lit(0), lambda so_far, v: so_far + v)
    winner = F.element_at(
        F.array(*[F.lit(c) for c in fv.CATEGORIES]),
        F.array_position("__votes", F.col("__most")).cast("int"),
    )
    return (
        votes.withColumn("__most", most)
        .withColumn("__all", every)
        .withColumn(
            "category", F.when(F.col("__all") == 0, F.lit(fv.FALLBACK_CATEGORY)).otherwise(winner)
        )
        .withColumn(
            "confidence",
            F.when(F.col("__all") == 0, F.lit(0.5)).otherwise(
                F.col("__most") / F.col("__all") * (1 - F.pow(F.lit(0.5), F.col("__most") + 1))
            ),
        )
        .withColumn("failed_response", F.lit(False))
        .drop("__lowered", "__votes", "__most", "__all")
    )


def recorded_scorer(items: DataFrame) -> DataFrame:
    """Takes the recorded answer; an item without a usable one has failed."""
    answer = F.col("answer_classifier")
    return (
        items.withColumn("category", answer["category"])
        .withColumn("confidence", answer["confidence"])
        .withColumn("failed_response", answer.isNull())
    )


_TOKEN_BUCKETS = 1 << 12


def train_text_model(labelled: DataFrame, text: str = "text", label: str = "label") -> PipelineModel:
    """A multinomial naive Bayes model over hashed words.

    Training is a single aggregation over the data: what reaches the driver is
    one vector of 4096 sums per category, however many rows there are.
    """
    return Pipeline(stages=[
        StringIndexerModel.from_labels(fv.CATEGORIES, inputCol=label, outputCol="__target"),
        RegexTokenizer(inputCol=text, outputCol="__words", pattern=r"[^\p{L}0-9]+"),
        HashingTF(inputCol="__words", outputCol="__features", numFeatures=_TOKEN_BUCKETS),
        NaiveBayes(
            featuresCol="__features", labelCol="__target",
            predictionCol="__prediction", probabilityCol="__probability",
            rawPredictionCol="__raw",
        ),
        IndexToString(inputCol="__prediction", outputCol="category", labels=fv.CATEGORIES),
    ]).fit(labelled)


def model_scorer(model: PipelineModel) -> Scorer:
    """A scorer around a trained model; confidence is the largest probability."""
    # the label indexer is for training only: new items carry no label
    stages = PipelineModel(model.stages[1:])

    def score(items: DataFrame) -> DataFrame:
        scored = stages.transform(items)
        return (
            scored.withColumn("confidence", F.array_max(vector_to_array("__probability")))
            .withColumn("failed_response", F.lit(False))
            .drop("__words", "__features", "__raw", "__probability", "__prediction")
        )

    return score


def cross_scored(labelled: DataFrame, key: str = "source_id") -> DataFrame:
    """Every item scored by the model that was trained on the other half.

    Both halves train and both are scored, so no row is left out and none is
    scored by a model that has seen it.
    """
    halved = labelled.withColumn("__half", F.pmod(F.xxhash64(key), F.lit(2)))
    parts = []
    for half in (0, 1):
        model = train_text_model(halved.filter(F.col("__half") != half))
        parts.append(model_scorer(model)(halved.filter(F.col("__half") == half)))
    return parts[0].unionByName(parts[1]).drop("__half")


# --- calibrated confidence -------------------------------------------------------
SCORE_BINS = 100


def train_logistic_model(labelled: DataFrame, text: str = "text", label: str = "label") -> PipelineModel:
    """Multinomial logistic regression over hashed words.

    Each round is one aggregation over the data; the driver holds one vector of
    4096 weights per category, however many rows there are.
    """
    return Pipeline(stages=[
        StringIndexerModel.from_labels(fv.CATEGORIES, inputCol=label, outputCol="__target"),
        RegexTokenizer(inputCol=text, outputCol="__words", pattern=r"[^\p{L}0-9]+"),
        HashingTF(inputCol="__words", outputCol="__features", numFeatures=_TOKEN_BUCKETS, binary=True),
        LogisticRegression(
            featuresCol="__features", labelCol="__target", family="multinomial", maxIter=15, regParam=0.002,
            predictionCol="__prediction", probabilityCol="__probability", rawPredictionCol="__raw",
        ),
        IndexToString(inputCol="__prediction", outputCol="category", labels=fv.CATEGORIES),
    ]).fit(labelled)


def pool_adjacent_violators(hits: Sequence[int], rows: Sequence[int]) -> list[float]:
    """A rising share of hits per bin: neighbours that fall are pooled; a bin without rows takes what is below it."""
    pools: list[list[int]] = []  # hits, rows, bins
    for hit, count in zip(hits, rows):
        pools.append([hit, count, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    shares = [(hit / count if count else 0.0, bins) for hit, count, bins in pools]
    return [share for share, bins in shares for _ in range(bins)]


def _bin(score: Column, bins: int) -> Column:
    return F.least(F.floor(score * bins), F.lit(bins - 1)).cast("int")


@dataclass(frozen=True)
class Calibration:
    """The share of right answers per bin of scores; rises with the score."""

    shares: tuple[float, ...]

    def confidence(self, score: Column) -> Column:
        return F.element_at(F.array(*(F.lit(share) for share in self.shares)), _bin(score, len(self.shares)) + 1)


def fit_calibration(scored: DataFrame, label: str = "label", bins: int = SCORE_BINS) -> Calibration:
    """From scored items with a known label: one aggregation, and one row per bin to the driver."""
    right = F.coalesce(F.col("category") == F.col(label), F.lit(False))
    counted = scored.groupBy(_bin(F.col("confidence"), bins).alias("bin")).agg(F.count("*").alias("rows"), F.count_if(right).alias("hits"))
    found = {row["bin"]: row for row in counted.collect()}
    of = lambda name: [found[i][name] if i in found else 0 for i in range(bins)]
    return Calibration(tuple(pool_adjacent_violators(of("hits"), of("rows"))))


def calibrated_scorer(model: PipelineModel, calibration: Calibration) -> Scorer:
    """A scorer whose confidence is the share of such answers that were right on items the model had not seen."""
    score = model_scorer(model)

    def calibrated(items: DataFrame) -> DataFrame:
        return score(items).withColumn("confidence", calibration.confidence(F.col("confidence")))

    return calibrated


def train_calibrated_scorer(labelled: DataFrame, key: str = "source_id") -> Scorer:
    """Three quarters of the items, drawn by hash of the key, train the model; the others calibrate it."""
    drawn = labelled.withColumn("__quarter", F.pmod(F.xxhash64(F.lit("calibration"), F.col(key)), F.lit(4)))
    model = train_logistic_model(drawn.filter("__quarter > 0"))
    held_out = model_scorer(model)(drawn.filter("__quarter = 0"))
    return calibrated_scorer(model, fit_calibration(held_out))


def cross_calibrated(labelled: DataFrame, key: str = "source_id") -> DataFrame:
    """Every item scored by the scorer that was trained and calibrated on the other half."""
    halved = labelled.withColumn("__half", F.pmod(F.xxhash64(key), F.lit(2)))
    parts = [
        train_calibrated_scorer(halved.filter(F.col("__half") != half), key)(halved.filter(F.col("__half") == half)) for half in (0, 1)
    ]
    return parts[0].unionByName(parts[1]).drop("__half")
