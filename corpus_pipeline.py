"""From raw documents to packed training sequences, stage by stage.

Every stage is written to the shared folder as Parquet and read back before the next one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from patronlens.llm import (common, language_id, minhash_dedup, packing, quality,
                            substring_dedup)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach."""
    return language_id.in_known_language(docs)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that read like those labelled as good."""
    return quality.good_documents(docs, common.table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group of near-duplicates."""
    return minhash_dedup.one_of_each(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier document already has."""
    return substring_dedup.without_repeats(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces in sequences of equal length."""
    return packing.pack(docs)


STAGES = [("language_id", known_language), ("quality_classifier", good_quality),
          ("minhash_dedup", one_of_each), ("substring_dedup", without_repeats),
          ("best_fit_packing", packed)]
ORACLE_SQL = None  # trained models and tokenizers have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
