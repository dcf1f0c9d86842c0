"""Registered queries of the corpus operators: each takes its whole table and returns its full result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from walrill.llm import ann, decontam, html_extract, mixing, neardup, pii, sharding, substring, token_store, toxicity
from walrill.llm.common import table


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op2_token_store(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("word_bpe_49k.json")
    return token_store.read_digests(spark, token_store.write_tokens(table(spark, sf_dir, "documents"), tokenizer_path))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.substring_dedup(table(spark, sf_dir, "documents"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op1_main_text": op1_main_text, "op2_token_store": op2_token_store, "op3_near_duplicates": op3_near_duplicates, "op4_mixing": op4_mixing, "op5_nearest": op5_nearest, "op6_toxicity": op6_toxicity, "op7_substring_dedup": op7_substring_dedup, "op8_personal_data": op8_personal_data, "op9_decontamination": op9_decontamination, "op10_sharding": op10_sharding}

ORACLE_SQL: dict[str, str] = {"op3_near_duplicates": neardup.NEAR_DUPLICATES_SQL, "op4_mixing": mixing.MIXTURE_SQL, "op7_substring_dedup": substring.SUBSTRING_SQL, "op9_decontamination": decontam.DECONTAMINATION_SQL}
