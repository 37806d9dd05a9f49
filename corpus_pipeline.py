"""A corpus pipeline over ``documents``: each stage applies one operator of ``slotledger.llm``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotledger.llm import bpe, decontamination, language, near_duplicates, pii
from slotledger.llm.common import stored, table

LEAST_SCORE = 0.3  # running text in a known language has 0.5 or more; text in none of them far less
TOKENIZER = "byte_bpe_50k.json"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or in no language that the labels teach, go; the others stay unchanged."""
    return language.keep_identified(docs, LEAST_SCORE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are equal or share at least 0.8 of their five-word shingles, directly or in a chain, one stays."""
    return near_duplicates.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out of the texts; every document stays."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets are replaced by their kind; every document stays."""
    return pii.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every text, with a digest of the text that they decode to."""
    coded = bpe.encode_and_decode(docs, public_tokenizers.path(TOKENIZER))
    return coded.select("doc_id", "n_tokens", "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("pii", redact_personal_data),
    ("bpe", encode),
]

ORACLE_SQL = None  # SQL cannot express these stages; tests compare them with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
