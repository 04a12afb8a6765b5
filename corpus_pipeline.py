"""A corpus pipeline of five stages: toxic texts go, one of each near-duplicate group stays, documents that leak the
benchmark go, secrets are blanked out, and what is left is encoded.

Each stage takes all that the one before kept; stages but the last return documents with all their columns, whatever
their names. No documents give none.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from catalogue_evidence.llm import bpe, decontaminate, secrets, simhash, toxicity
from catalogue_evidence.llm.common import staged, table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without those that the nearest labelled examples vote toxic. Null and empty texts stay where toxic labels are
    the lesser part; equal rows fare alike."""
    return toxicity.reject(docs, table(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with the smallest doc_id of each group of linked fingerprints, once. Null and empty texts are one group; rows
    without a doc_id all stay."""
    return simhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without those that contain a test item. Null and empty texts contain none; equal rows fare alike."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with their secrets replaced by the kind of each. Every row stays, and texts without a secret as they are."""
    return secrets.redact(docs, RANKS, PATTERN)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of docs, a row for each; null and empty texts have no tokens."""
    return bpe.round_trip(docs, RANKS, PATTERN)


STAGES = [
    ("toxicity", without_toxic),
    ("simhash", without_near_copies),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("encoding", encoded),
]
#: The stages hold nearest neighbours, closures of links and tokenization, which are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
