"""Messages of a topic, from Kafka or from files that have the columns of a Kafka source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import KAFKA_ROW
from .tables import read_table, stream_table


def stream_kafka(
    spark: SparkSession, servers: str, topic: str, starting: str = "earliest", **options: str
) -> DataFrame:
    """A Kafka topic, from `starting` on the first run and from the checkpoint afterwards.

    Needs the Kafka connector on the class path.
    """
    reader = spark.readStream.format("kafka")
    reader = reader.option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return reader.option("startingOffsets", starting).options(**options).load()


def stream_messages(
    spark: SparkSession,
    path: str,
    files_per_batch: int | None = None,
    bytes_per_batch: int | None = None,
) -> DataFrame:
    """The same rows from a topic kept as Parquet files."""
    return stream_table(spark, path, KAFKA_ROW, "parquet", files_per_batch, bytes_per_batch)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, KAFKA_ROW)
