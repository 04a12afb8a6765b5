"""One query for each training-data operator, over its whole table and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue_evidence.llm import alignment, bpe, decontaminate, language, licences, nearest, packing, secrets, sharding, simhash, tokenfiles, toxicity, whitening
from catalogue_evidence.llm.common import table

BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PATTERN = public_tokenizers.PATTERN


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(table(spark, sf_dir, "documents"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), BYTE_RANKS, PATTERN)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"), BYTE_RANKS, PATTERN)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.through_files(table(spark, sf_dir, "documents"), WORD_TOKENIZER)


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), BYTE_TOKENIZER, PATTERN, with_ids=False).drop("ids")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), BYTE_TOKENIZER, PATTERN, PIECE_MODEL)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash": op1_simhash,
        "op2_byte_bpe": op2_byte_bpe,
        "op3_secrets": op3_secrets,
        "op4_decontaminate": op4_decontaminate,
        "op5_token_files": op5_token_files,
        "op6_nearest": op6_nearest,
        "op7_language": op7_language,
        "op8_licences": op8_licences,
        "op9_sharding": op9_sharding,
        "op10_toxicity": op10_toxicity,
        "op11_packing": op11_packing,
        "op12_whitening": op12_whitening,
        "op13_alignment": op13_alignment,
    }
