"""Registered queries of the operators, each over its whole table, and the pipeline of five stages."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import bpe_round_trip, token_digests
from .chat import format_chats
from .decontaminate import overlaps
from .licenses import licenses
from .negatives import hard_negatives
from .oracles import ORACLE_SQL
from .pieces import piece_round_trip
from .pii import listed, personal_data
from .piecewise import compared_with_next
from .quality import quality_scores
from .sharding import interleave
from .simhash import simhash_groups
from .tables import table
from .toxicity import severities
from .whitening import whiten


def op1_simhash_byte_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op2_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


def op3_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "equal_words", "first_word", "last_word")


def op4_piecewise_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared_with_next(table(spark, sf_dir, "documents"))


def op5_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interleave(table(spark, sf_dir, "documents"))


def op6_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return severities(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_email",
        "n_ip",
        "n_card",
        "n_phone",
        F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def op8_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoded = bpe_round_trip(table(spark, sf_dir, "documents"), path)
    return token_digests(encoded).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op9_quality_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_license_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses(table(spark, sf_dir, "documents"))


def op11_bidiagonal_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op12_secondary_sort_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    mislabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", mislabelled.alias("label"), "embedding")
    return hard_negatives(vectors, anchors=F.col("vec_id") % 50 == 0)


def op13_piece_backtracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    encoded = piece_round_trip(table(spark, sf_dir, "documents"), path)
    return token_digests(encoded).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


__all__ = ["ORACLE_SQL", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_byte_index": op1_simhash_byte_index,
    "op2_role_repair": op2_role_repair,
    "op3_spaced_seeds": op3_spaced_seeds,
    "op4_piecewise_hash": op4_piecewise_hash,
    "op5_interleaved_shards": op5_interleaved_shards,
    "op6_ordinal_toxicity": op6_ordinal_toxicity,
    "op7_weak_supervision": op7_weak_supervision,
    "op8_bpe_transducer": op8_bpe_transducer,
    "op9_quality_discriminant": op9_quality_discriminant,
    "op10_license_paragraphs": op10_license_paragraphs,
    "op11_bidiagonal_whitening": op11_bidiagonal_whitening,
    "op12_secondary_sort_negatives": op12_secondary_sort_negatives,
    "op13_piece_backtracking": op13_piece_backtracking,
}
