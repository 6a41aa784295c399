"""From raw documents to packed sequences: STAGES in order, each over all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from postflow.llm import exact_dedup, packing, quality_model, quality_rules, simhash
from postflow.llm.common import saved, table


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the quality rules."""
    return quality_rules.keep_good(docs)


def classified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier calls good. It learns from the corpus as it was before
    the rules took the plain cases of bad quality away."""
    model = quality_model.trained(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality_model.keep_good(docs, model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.without_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.one_of_each(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece with its place in a sequence."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality_rules", rules), ("quality_classifier", classified), ("exact_dedup", exact),
          ("simhash_near_dedup", near), ("best_fit_packing", packed)]
# Scores from zstandard, token ids and a search for components cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder of tables."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = saved(docs, name)
    return docs
