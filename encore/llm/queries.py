"""Registered queries of this subpackage: opN_<name> over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from encore.llm import (byte_bpe, fill_in_middle, jaccard_join, language_id, metric_join, packing,
                        quality_rules, range_coder, ring_shards, spelling_variants, substring_dedup,
                        suffix_tree, toxicity)
from encore.llm.common import table
from encore.llm.oracle import oracle_sql  # noqa: F401  (read by the entry)


def op1_range_coded_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return range_coder.files_query(table(spark, sf_dir, "documents"),
                                   public_tokenizers.path("word_bpe_49k.json"))


def op2_suffix_tree_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score_query(spark, table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digest_query(table(spark, sf_dir, "documents"),
                                 public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict_query(spark, table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rows(table(spark, sf_dir, "documents")).drop("covered", "longest_repeat")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_query(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_query(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_query(table(spark, sf_dir, "documents"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_query(table(spark, sf_dir, "documents"),
                              public_tokenizers.path("byte_bpe_50k.json"),
                              public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_metric_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_join.join_query(table(spark, sf_dir, "embeddings"))


def op11_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ring_shards.shard_query(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants_query(table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digest_query(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in sorted(globals().items()) if name[:2] == "op" and name[2].isdigit()}
