"""A corpus pipeline of five stages over ``documents``.

quality rules, toxicity, exact deduplication, near deduplication, packing. Each
stage takes the documents its predecessor kept; all but the last return the
columns of ``documents``. Stages are written as Parquet and read again.

A stage's answers to odd rows (nulls, empty or long texts, repeats, empty
tables, columns of any name) are those of its operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from usageloom.llm import exact_dedup, near_dedup, packing, quality, toxicity
from usageloom.llm.common import read_table, written
from usageloom.llm.queries import vocabulary


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.kept_documents(docs, read_table(spark, sf_dir, "labels"))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean_documents(docs, read_table(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.without_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.without_near_copies(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # workers have run the stages before, so they keep fewer known units
    return packing.pack_documents(docs, vocabulary("word_bpe_49k.json"), units=300_000)


STAGES = [
    ("quality_rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("packing", packing_stage),
]

#: trained models and tokenizers are beyond SQL; a test runs the pipeline and compares every stage with plain code
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
