"""The registered queries of this package: thin contracts over the operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from larder.llm import (
    conversation_trie, decontamination, hard_negatives, html_extract, language_id, license_scan, media, oracles, packing, sharding, simhash, suffix_dedup,
    token_files, topk,
)
from larder.llm.common import load

TOKENIZER = "byte_bpe_50k.json"


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_query(load(spark, sf_dir, "documents"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.html_query(load(spark, sf_dir, "pages"))


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup_query(load(spark, sf_dir, "documents"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_query(load(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharding_query(load(spark, sf_dir, "documents"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontamination_query(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files_query(load(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(load(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), end_id=1)


def op9_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_query(load(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id_query(load(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives_query(load(spark, sf_dir, "embeddings"))


def op12_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.topk_query(load(spark, sf_dir, "embeddings"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie_query(load(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_license_scan,
        op2_html_extraction,
        op3_suffix_array_dedup,
        op4_simhash_near_dedup,
        op5_sharding,
        op6_benchmark_decontamination,
        op7_token_files,
        op8_packing,
        op9_media_columns,
        op10_language_id,
        op11_hard_negatives,
        op12_topk_search,
        op13_conversation_trie,
    )}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_license_scan": oracles.license_scan_sql(),
        "op3_suffix_array_dedup": oracles.suffix_dedup_sql(),
        "op5_sharding": oracles.sharding_sql(),
        "op11_hard_negatives": oracles.hard_negatives_sql(),
        "op12_topk_search": oracles.topk_sql(),
        "op13_conversation_trie": oracles.trie_sql(),
    }
