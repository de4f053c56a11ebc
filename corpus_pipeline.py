"""A corpus pipeline: from raw documents to packed training sequences.

Every stage works on all that its predecessor kept, written as Parquet and read again, and all but
the last return the columns of ``documents``. Held without SQL: the classifier is trained and the
packing is a heuristic; tests hold the stages against brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tablelift.llm import crf_quality, jaccard_join, packing, quality_rules, suffix_dedup
from tablelift.llm.common import Scratch


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier, trained on the labelled ones, scores 0.5 or more."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return crf_quality.keep_good(docs, crf_quality.fit(docs, labels))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie near a language's reference."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return jaccard_join.keep_one_of_each(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 50 words or more that an earlier document has."""
    return suffix_dedup.cut_repeats(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document goes in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), 0, 2048)


STAGES = [("quality classifier", classify), ("quality rules", rules), ("near duplicates", near_duplicates),
          ("repeated passages", repeats), ("packing", packed)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"), Scratch(spark)
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.table(stage(spark, docs, sf_dir), f"stage{k}")
    return docs
