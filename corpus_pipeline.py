"""From documents to a training mix: five stages, each over all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tristrata.llm import decontaminate, exactdup, langid, mixing, neardup
from tristrata.llm.common import table
from tristrata.scratch import staged


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language."""
    held_out = langid.held_out(F.col("doc_id"), 5, 0)
    return langid.keep_identified(docs, langid.train(docs.where(~held_out)))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: that with the largest id."""
    return exactdup.deduplicate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id."""
    return neardup.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark items do not contaminate."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
]

#: The first stage is a trained model, which SQL does not express; tests compare the stages with
#: brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
