"""Corpus pipeline: language ID, near-duplicates, benchmark decontamination, personal data, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; ``run`` writes each stage's rows as
Parquet in the shared checkpoint folder and reads them again as the next one's documents. All stages but the last return
the columns of documents; a table that lacks optional columns (lang, source, n_chars) or has more keeps its own.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from voltwatch.llm import bpe, decontam, langid, minhash, pii
from voltwatch.llm.common import documents, with_checkpoint_dir
from voltwatch.llm.queries import tokenizer


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised (operator 6)."""
    return langid.recognised(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, by five-word shingles from 80 percent on (operator 7)."""
    return minhash.one_of_each(docs, size=5, threshold=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item (operator 2)."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with its confirmed personal data replaced by the kind's name (operator 8)."""
    return pii.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digests of every document's ids and decoded text (operator 4)."""
    return bpe.bpe_digest(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

#: Fitted language centroids are no SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the whole documents table."""
    docs = documents(spark, sf_dir)
    where = f"{with_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{where}/{k}-{name}")
        docs = spark.read.parquet(f"{where}/{k}-{name}")
    return docs
