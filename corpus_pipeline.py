"""From raw documents to token ids: each stage reads what the stage before it has written."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpus_health.llm import bpe, jaccard, language, mixing, secrets
from corpus_health.llm.common import land

RANKS = "byte_bpe_50k.tiktoken"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach."""
    model = language.learn(docs)
    return language.keep_known(docs, model, own=language.limits(docs, model))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of texts that are linked by similarity."""
    return jaccard.keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with marks in place of secrets."""
    return secrets.redact_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as they are drawn, all sources with the same share, in random order."""
    return mixing.mix(docs, copy=None, place=None)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and digests of the ids and of what they decode to."""
    ranks = public_tokenizers.path(RANKS)
    return bpe.encode_and_decode(docs, ranks).select(
        "doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("data", 256).alias("decoded_sha256")
    )


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("mix_sources", mix_sources),
    ("tokenize", tokenize),
]

#: Profiles, signatures and encodings are not expressed in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each one's result written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
