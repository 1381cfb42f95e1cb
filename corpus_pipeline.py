"""From raw documents to packed training sequences.

Each stage works on all that the one before has kept, and its decisions take
effect: rejected documents and near copies go, later copies of passages are cut
out of the texts, the mix repeats or leaves out whole documents, and what is left
is packed. Every stage is written and read again, so a stage starts from a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voxsift.functions.staging import freed, stage
from voxsift.llm import mixing, packing, quality_rules, simhash, suffix_dedup
from voxsift.llm.queries import tokenizer_file


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep_good(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings that an earlier document, or an earlier place, holds."""
    return suffix_dedup.cut_repeats(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixed_rows(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces in training sequences."""
    return packing.pack_documents(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", good),
    ("simhash", one_of_each),
    ("suffix dedup", without_repeats),
    ("mixing", mixed),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        with freed(spark):  # what a stage wrote on its way is not needed once its rows are stored
            docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"), keep=True)
    return docs


#: Fingerprints, tokens and sequences cannot be said in SQL; tests/llm/test_pipeline.py has a plain version.
ORACLE_SQL = None
