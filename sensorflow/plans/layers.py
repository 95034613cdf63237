"""Raw, silver and gold layers. Each transform runs unchanged on a table and on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import SECONDS_PATTERN
from ..operators.aggregates import (
    hourly_kpi_from_partials,
    last_known,
    mean_temperature_from_partials,
    slice_partials,
)
from ..operators.decoding import silver_decode, silver_valid
from ..operators.dedup import dedup_batch, dedup_stream
from ..schemas import RAW, SILVER
from ..sources.tables import read_table, write_table


def raw_rows(messages: DataFrame) -> DataFrame:
    """Messages as they came, with where and when, so that history can be replayed after a bug."""
    return messages.withColumnRenamed("timestamp", "kafka_ingest_time").withColumn(
        "ingest_date", F.to_date("kafka_ingest_time")
    ).select(*RAW.fieldNames())


def raw_messages(raw: DataFrame) -> DataFrame:
    """Raw rows as messages again."""
    return raw.withColumnRenamed("kafka_ingest_time", "timestamp")


def by_day(df: DataFrame, time: str = "event_time") -> DataFrame:
    """Rows with the day their files are laid out by, so that reads of some days skip the others."""
    return df.withColumn("event_date", F.to_date(time))


def silver_from_raw(
    raw: DataFrame, time_pattern: str = SECONDS_PATTERN, delay: str = "10 minutes", reduce_first: bool = False
) -> DataFrame:
    """Decode, validate and deduplicate raw messages.

    Of repeated readings the first arrival stays. On a stream, `delay` bounds the state; a backfill
    of more history than that goes through `replay_from_raw`, which sorts and spills instead.
    """
    position = () if raw.isStreaming else ("partition", "offset")
    valid = silver_valid(silver_decode(raw_messages(raw), time_pattern, position), keep=position)
    if raw.isStreaming:
        return dedup_stream(valid, delay=delay, reduce_first=reduce_first)
    return dedup_batch(valid, order=("kafka_ingest_time", *position)).select(*SILVER.fieldNames())


def replay_from_raw(
    spark: SparkSession,
    raw_path: str,
    silver_path: str,
    time_pattern: str = SECONDS_PATTERN,
) -> None:
    """Rebuild silver from the whole raw layer, by event day, in a folder that no stream writes to.

    `generations.rebuild` does it for a table that a stream feeds.
    """
    silver = silver_from_raw(read_table(spark, raw_path, RAW), time_pattern)
    write_table(by_day(silver), silver_path, partition_by=["event_date"])


def write_gold(spark: SparkSession, silver_path: str, gold_path: str) -> dict[str, str]:
    """Write the gold tables of a deduplicated silver table, KPIs by day, and return where they are.

    Silver is read twice: once for the five-minute partials that the mean KPIs are folded from,
    once (three columns) for the last known values.
    """
    paths = {name: f"{gold_path}/{name}" for name in ("slices", "temperature_5min", "hourly", "last_known")}
    silver = read_table(spark, silver_path, SILVER)
    day = ["event_date"]
    write_table(by_day(slice_partials(silver), "window_start"), paths["slices"], partition_by=day)
    slices = read_table(spark, paths["slices"])
    write_table(by_day(mean_temperature_from_partials(slices), "window_start"), paths["temperature_5min"], partition_by=day)
    write_table(by_day(hourly_kpi_from_partials(slices), "window_start"), paths["hourly"], partition_by=day)
    write_table(last_known(silver, unique_times=True), paths["last_known"])
    return paths
