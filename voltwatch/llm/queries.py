"""The queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from voltwatch.llm import (
    bpe,
    conversation_repair,
    decontam,
    edit_fingerprint,
    langid,
    lexical,
    minhash,
    pii,
    quality,
    quality_rules,
    secret_scan,
    sql,
    substring,
    token_counts,
)
from voltwatch.llm.common import documents


def op1_edit_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_fingerprint.with_next(documents(spark, sf_dir))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op3_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.substring_digest(documents(spark, sf_dir))


def tokenizer(name: str) -> str:
    """Path of a public tokenizer's file on the driver; workers get its tables from the driver."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digest(documents(spark, sf_dir), tokenizer("word_bpe_49k.json"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the 32,000-piece tokenizer, whose first free id ends a document."""
    return token_counts.document_counts(documents(spark, sf_dir), tokenizer("piece_bpe_32k.model"), end=32_000)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_digest(documents(spark, sf_dir))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(documents(spark, sf_dir))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(documents(spark, sf_dir))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_digest(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.rules(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_edit_fingerprint": op1_edit_fingerprint,
    "op2_decontamination": op2_decontamination,
    "op3_substring": op3_substring,
    "op4_bpe": op4_bpe,
    "op5_token_counts": op5_token_counts,
    "op6_language": op6_language,
    "op7_minhash": op7_minhash,
    "op8_pii": op8_pii,
    "op9_quality": op9_quality,
    "op10_secrets": op10_secrets,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_quality_rules": op12_quality_rules,
    "op13_lexical_search": op13_lexical_search,
}

SQL: dict[str, str] = {
    "op2_decontamination": sql.LEAK_SQL,
    "op3_substring": sql.SUBSTRING_SQL,
    "op7_minhash": sql.NEAR_SQL,
    "op8_pii": sql.PII_SQL,
    "op11_conversation_repair": sql.REPAIR_SQL,
    "op12_quality_rules": sql.RULES_SQL,
    "op13_lexical_search": sql.SEARCH_SQL,
}
