"""What a stream's state holds, read back from its checkpoint as a table, epoch by epoch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import STATE_SETTINGS, settings


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a checkpoint: number, name, partitions, and the epochs whose state is kept."""
    found = spark.read.format("state-metadata").load(checkpoint)
    return found.select("operatorId", "operatorName", "stateStoreName", "numPartitions", "minBatchId", "maxBatchId")


def state_rows(spark: SparkSession, checkpoint: str, epoch: int | None = None, operator: int = 0) -> DataFrame:
    """Rows of an operator's state after an epoch, the last committed one if not said: `key`, `value`, `partition_id`.

    State of an epoch is kept while `spark.sql.streaming.minBatchesToRetain` epochs follow it.
    """
    reader = spark.read.format("statestore").option("operatorId", operator)
    if epoch is not None:
        reader = reader.option("batchId", epoch)
    with settings(spark, STATE_SETTINGS):
        return reader.load(checkpoint)


def open_windows(spark: SparkSession, checkpoint: str, epoch: int | None = None) -> DataFrame:
    """Windows that a windowed aggregate still holds, with how many groups each has."""
    held = state_rows(spark, checkpoint, epoch).select(F.col("key.window").alias("window"))
    return held.groupBy(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")).agg(F.count("*").alias("n_groups"))
