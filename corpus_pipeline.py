"""The pipeline from raw documents to token ids: five stages, each written and read by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sensorflow.llm.bpe import bpe_round_trip, token_digests
from sensorflow.llm.decontaminate import without_overlaps
from sensorflow.llm.pii import without_personal_data
from sensorflow.llm.quality import keep_good
from sensorflow.llm.simhash import keep_one
from sensorflow.llm.tables import scratch, stored, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: three-word shingles, three bits."""
    return keep_one(docs, shingle=3, distance=3)


def not_in_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with an item of the benchmark."""
    return without_overlaps(docs, table(spark, sf_dir, "benchmark"))


def no_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose texts have the names of the kinds in place of personal data, with their new length."""
    return without_personal_data(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and digests of them and of the text decoded from them."""
    encoded = bpe_round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return token_digests(encoded).select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", one_of_each),
    ("benchmark decontamination", not_in_benchmark),
    ("PII", no_personal_data),
    ("BPE encoding and decoding", token_ids),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result but the last is a stored table, and gone once the next one is stored."""
    docs = table(spark, sf_dir, "documents")
    release_last = None
    for step, (name, stage) in enumerate(STAGES):
        if step == len(STAGES) - 1:
            return stage(spark, docs, sf_dir)
        with scratch(spark) as release:
            result = stage(spark, docs, sf_dir)
        with scratch(spark) as release_result:
            docs = stored(result, name.replace(" ", "-"))
        release()
        if release_last:
            release_last()
        release_last = release_result
