"""The corpus pipeline: stages over documents, each written as Parquet and read again by the next.

Every stage but the last returns the columns of documents. A stage begins by removing the tables that the stages before it
have kept in the shared folder, but for those that its documents lie in; so a stage's result is written before the next
one is called. Nulls in any column, empty and very long texts, repeated rows and ids, other columns and empty tables
are treated as the operator of the stage says; null and empty texts end at the mixing at the latest, which takes words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import curriculum, decontaminate, simhash, training_order, weak_labels
from millrace.llm.staging import release, small_batches, stored, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps; see ``weak_labels.verdicts``."""
    release(spark, docs)
    small_batches(spark)
    return weak_labels.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group; see ``simhash.keep_one``."""
    release(spark, docs)
    small_batches(spark)
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item; see ``decontaminate.without_benchmark``."""
    release(spark, docs)
    small_batches(spark)
    return decontaminate.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order; see ``curriculum.training_order``."""
    release(spark, docs)
    small_batches(spark)
    return curriculum.training_order(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shards of token sequences; one row a sequence; see ``training_order.materialised``."""
    release(spark, docs)
    small_batches(spark)
    return training_order.materialised(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_output", token_output),
]

#: SQL has no XXH64, no trained scorer and no tokenizer, so the stages are tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
