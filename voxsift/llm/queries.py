"""Registered queries of the operators for training data, and their statements.

Each ``opN_*`` applies one operator, with its production parameters, to its
whole table. What a query reports is derived from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    hard_negatives, html_extract, license_scan, mixing, multi_index, packing, periodic_runs, quality_rules, simhash,
    suffix_dedup, token_prefix, toxicity, warc,
)


def tokenizer_file(name: str) -> str:
    """Where the public vocabulary files are installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(_table(spark, sf_dir, "pages"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_prefix.token_counts(_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), 2048)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(_table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(_table(spark, sf_dir, "documents"))


def op10_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = multi_index.usable(_table(spark, sf_dir, "embeddings"))
    return multi_index.nearest(vectors, vectors.where("id % 50 = 0"), k=5)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    turned = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _table(spark, sf_dir, "embeddings").withColumn("label", turned)
    return hard_negatives.hard_negatives(hard_negatives.usable(rows), anchors="id % 50 = 0")


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), threshold=0.3)
    return found.select("doc_id", "held_out", "score", "predicted")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.summary(periodic_runs.with_planted_repeats(_table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_html_text": op2_html_text,
    "op3_warc": op3_warc,
    "op4_license_scan": op4_license_scan,
    "op5_token_counts": op5_token_counts,
    "op6_mixing": op6_mixing,
    "op7_quality_rules": op7_quality_rules,
    "op8_simhash": op8_simhash,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_multi_index": op10_multi_index,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_toxicity": op12_toxicity,
    "op13_periodic_runs": op13_periodic_runs,
}

STATEMENTS: dict[str, str] = {"op3_warc": warc.STATEMENT, "op6_mixing": mixing.STATEMENT, "op7_quality_rules": quality_rules.STATEMENT}
