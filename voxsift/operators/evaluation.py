"""Predicted categories against the ground-truth labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as fv


_NONE = "none"  # prediction of an item whose responses failed


def confusion(predicted: DataFrame, labels: DataFrame) -> DataFrame:
    """Items per true and predicted category; failed ones count as 'none'.

    Labels and predictions meet in one aggregation on the item id instead of a
    join: a single shuffle, combined on the map side, so an id that occurs very
    often is no hot spot. Items without a label are left out.
    """
    guesses = [*fv.CATEGORIES, _NONE]
    guess = F.when(F.col("failed_response"), _NONE).otherwise(F.col("category"))
    both = labels.select(
        "source_type", "source_id", F.col("category").alias("actual"),
        F.lit(None).cast("string").alias("predicted"),
    ).unionByName(
        predicted.select(
            "source_type", "source_id", F.lit(None).cast("string").alias("actual"),
            guess.alias("predicted"),
        )
    )
    per_item = both.groupBy("source_type", "source_id").agg(
        F.max("actual").alias("actual"),
        *[F.count_if(F.col("predicted") == g).alias(g) for g in guesses],
    )
    return (
        per_item.filter(F.col("actual").isNotNull())
        .groupBy("actual")
        .agg(*[F.sum(F.col(f"`{g}`")).alias(g) for g in guesses])
        .unpivot("actual", guesses, "predicted", "items")
        .filter(F.col("items") > 0)
    )


def confusion_matrix(pairs: DataFrame) -> DataFrame:
    """One row per true category, one column per prediction."""
    wide = pairs.groupBy("actual").pivot("predicted", [*fv.CATEGORIES, _NONE]).sum("items")
    renamed = {c: c.lower().replace(" ", "_") for c in [*fv.CATEGORIES, _NONE]}
    return wide.na.fill(0).select(
        "actual", *[F.col(f"`{c}`").alias(f"predicted_{name}") for c, name in renamed.items()]
    )


def per_class(pairs: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per category, from the few pair counts."""
    listed = pairs.select(
        F.explode(F.array(
            F.struct(F.col("actual").alias("category"), F.lit(True).alias("is_actual")),
            F.struct(F.col("predicted").alias("category"), F.lit(False).alias("is_actual")),
        )).alias("side"),
        (F.col("actual") == F.col("predicted")).alias("right"),
        "items",
    ).filter(F.col("side.category") != _NONE)
    actual = F.col("side.is_actual")

    def total(test):
        return F.sum(F.when(test, F.col("items")).otherwise(0))

    sums = listed.groupBy(F.col("side.category").alias("category")).agg(
        total(actual).alias("support"),
        total(~actual).alias("predicted"),
        total(actual & F.col("right")).alias("hits"),
    )
    precision = F.when(F.col("predicted") > 0, F.col("hits") / F.col("predicted")).otherwise(0.0)
    recall = F.when(F.col("support") > 0, F.col("hits") / F.col("support")).otherwise(0.0)
    f1 = F.when(
        F.col("hits") > 0, 2 * F.col("hits") / (F.col("support") + F.col("predicted"))
    ).otherwise(0.0)
    return sums.select(
        "category", "support", "predicted", "hits",
        F.round(precision, 6).alias("precision"),
        F.round(recall, 6).alias("recall"),
        F.round(f1, 6).alias("f1"),
    )


def accuracy(pairs: DataFrame) -> DataFrame:
    hits = F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("items")).otherwise(0))
    return pairs.agg(
        F.sum("items").alias("items"),
        hits.alias("hits"),
        F.round(hits / F.sum("items"), 6).alias("accuracy"),
    )


def calibration_table(scored: DataFrame, label: str = "label", bins: int = 10) -> DataFrame:
    """Per bin of confidence its items, hits, mean confidence, accuracy, and the gap between the last two."""
    right = F.coalesce(F.col("category") == F.col(label), F.lit(False))
    number = F.least(F.floor(F.col("confidence") * bins), F.lit(bins - 1)).cast("int")
    return scored.groupBy(number.alias("bin")).agg(
        F.count("*").alias("items"), F.count_if(right).alias("hits"), F.avg("confidence").alias("mean_confidence"),
    ).withColumn("accuracy", F.col("hits") / F.col("items")).withColumn("gap", F.abs(F.col("mean_confidence") - F.col("accuracy")))


def calibration_error(table: DataFrame) -> DataFrame:
    """One row: items, and the gap of all bins weighted by their items."""
    return table.agg(
        F.coalesce(F.sum("items"), F.lit(0)).alias("items"), (F.sum(F.col("gap") * F.col("items")) / F.sum("items")).alias("error")
    )
