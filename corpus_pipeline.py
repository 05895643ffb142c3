"""Corpus pipeline: quality rules, language ID, near-duplicate join, substring
dedup and packing, each stage written as Parquet and read by the next."""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from encore.llm import jaccard_join, language_id, packing, quality_rules, substring_dedup
from encore.llm.common import clear_stored, stored, table


#: Text that goes to a Python worker at once (Spark's default of 64 MB is held
#: on both sides, by every task).
BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", "2m")


def in_small_batches(stage):
    """The stage with ``BATCH`` set, also for those who call it by itself. The
    value stays: the stage's plan runs after it has returned."""
    @wraps(stage)
    def go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set(*BATCH)
        return stage(spark, docs, sf_dir)
    return go


@in_small_batches
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


@in_small_batches
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents mostly in one known language (the model learns from the lang
    column of the documents that reach this stage)."""
    return language_id.keep_known(spark, docs)


@in_small_batches
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of near copies."""
    return jaccard_join.one_of_each_group(docs)


@in_small_batches
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that a smaller doc_id has."""
    return substring_dedup.remove_repeats(docs)


@in_small_batches
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.pack_query(docs, public_tokenizers.path("byte_bpe_50k.json"),
                              public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality),
    ("language ID", language),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("best-fit packing", packed),
]

#: SQL cannot express the suffix arrays, the fitted language model or the
#: packing; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    before = spark.conf.get(BATCH[0])
    try:
        docs = table(spark, sf_dir, "documents")
        for name, stage in STAGES:
            docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
            clear_stored(spark, but_last=1)    # what the stage needed on its way
        return docs
    finally:
        spark.conf.set(BATCH[0], before)
