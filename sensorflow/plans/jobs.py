"""The jobs a user starts: two ingest streams, a replay into a topic, and two table reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.times import SECONDS_PATTERN
from ..operators.aggregates import counts_by, hourly_kpi, last_known, mean_temperature, total
from ..operators.cleaning import bronze_clean, observe_quality
from ..operators.decoding import as_kafka_rows, lines_to_messages, silver_decode, to_messages
from ..operators.profile import preview, schema_listing
from ..schemas import BRONZE, LAST_KNOWN, RAW, SILVER
from ..session import pin_utc
from ..sources.files import stream_json, stream_text
from ..sources.tables import read_table_or_empty, stream_table, write_table
from ..streaming.runner import AVAILABLE_NOW, Sink, start
from ..streaming.sinks import batch_sink, table_sink
from ..streaming.versions import read_current
from .layers import by_day, raw_rows, silver_from_raw

# Epochs after which a table that is kept current is folded.
FOLD_EVERY = 100

# Of two rows of a sensor the later reading counts, of equal times the larger value.
LAST_KNOWN_ORDER = ("last_time", "last_value")


def ingest_bronze(
    spark: SparkSession,
    input_path: str,
    table: str,
    checkpoint: str,
    trigger: str = "10 seconds",
    files_per_batch: int | None = 1,
    fmt: str = "parquet",
    name: str | None = None,
) -> StreamingQuery:
    """Watch a folder of JSONL readings and append cleaned, classified rows to the bronze table, by event day."""
    readings = observe_quality(stream_json(pin_utc(spark), input_path, files_per_batch=files_per_batch))
    bronze = by_day(bronze_clean(readings), "timestamp_parsed")
    return start(bronze, table_sink(table, fmt, ["event_date"]), checkpoint, trigger=trigger, name=name)


def ingest_silver(
    messages: DataFrame,
    table: str,
    checkpoint: str | None = None,
    trigger: str = "5 seconds",
    time_pattern: str = SECONDS_PATTERN,
    fmt: str = "parquet",
    name: str | None = None,
) -> StreamingQuery:
    """Decode a message stream into the silver table, by event day; the checkpoint sits in its folder by default."""
    pin_utc(messages.sparkSession)
    silver = by_day(silver_decode(messages, time_pattern))
    sink = table_sink(table, fmt, ["event_date"])
    return start(silver, sink, checkpoint or f"{table}/_checkpoint", trigger=trigger, name=name)


def ingest_raw(messages: DataFrame, table: str, checkpoint: str, trigger: str = "5 seconds") -> StreamingQuery:
    """Land a message stream untouched, by ingest day."""
    pin_utc(messages.sparkSession)
    return start(raw_rows(messages), table_sink(table, partition_by=["ingest_date"]), checkpoint, trigger=trigger)


def refine_silver(
    spark: SparkSession,
    raw_path: str,
    table: str,
    checkpoint: str,
    trigger: str = "5 seconds",
    time_pattern: str = SECONDS_PATTERN,
    delay: str = "10 minutes",
    bytes_per_batch: int | None = None,
    reduce_first: bool = False,
) -> StreamingQuery:
    """Follow the raw table and append valid, deduplicated rows to silver, by event day.

    For a table that is to be rebuilt from raw now and then, see `generations`.
    """
    raw = stream_table(pin_utc(spark), raw_path, RAW, bytes_per_batch=bytes_per_batch)
    silver = by_day(silver_from_raw(raw, time_pattern, delay, reduce_first))
    return start(silver, table_sink(table, partition_by=["event_date"]), checkpoint, trigger=trigger)


def follow_hourly_kpi(
    silver: DataFrame, path: str, checkpoint: str, delay: str = "10 minutes", trigger: str = "10 seconds"
) -> StreamingQuery:
    """Keep the hourly KPI table current: each epoch writes the hours it changed."""
    changed = hourly_kpi(silver.withWatermark("event_time", delay))
    sink = batch_sink(path, ("window_start", "building", "sensor_type"), FOLD_EVERY)
    return start(changed, sink, checkpoint, mode="update", trigger=trigger)


def follow_temperature(
    silver: DataFrame, path: str, checkpoint: str, delay: str = "10 minutes", trigger: str = "10 seconds"
) -> StreamingQuery:
    """Keep the five-minute mean temperatures current: each epoch writes the slices it changed."""
    changed = mean_temperature(silver.withWatermark("event_time", delay))
    return start(changed, batch_sink(path, ("window_start",), FOLD_EVERY), checkpoint, mode="update", trigger=trigger)


def follow_last_known(
    silver: DataFrame, path: str, checkpoint: str, trigger: str = "10 seconds", forget: str | None = None
) -> StreamingQuery:
    """Keep the last known value of every sensor: each epoch writes the sensors it changed.

    Without `forget` the state keeps every sensor for ever. With it, the state has a sensor's newest
    reading per slice of that length, and a slice leaves the state once readings are `forget` ahead of
    its end: sensors that fell silent cost no memory, and the table still answers for them. Readings
    of a slice that has left are dropped as late. Read the table with `read_last_known`.
    """
    if forget is not None:
        timed = silver.withWatermark("event_time", forget)
        current = last_known(timed.withColumn("slice", F.window("event_time", forget)), by=["slice"]).drop("slice")
    else:
        current = last_known(silver)
    sink = batch_sink(path, ("sensor_id",), FOLD_EVERY, LAST_KNOWN_ORDER)
    return start(current, sink, checkpoint, mode="update", trigger=trigger)


def read_last_known(spark: SparkSession, path: str) -> DataFrame:
    """The newest reading of every sensor there has been."""
    return read_current(spark, path, LAST_KNOWN, ["sensor_id"], LAST_KNOWN_ORDER)


def send_alerts(
    bronze: DataFrame,
    sink: Sink,
    checkpoint: str,
    topic: str = "alerts",
    level: str = "HIGH",
    trigger: str = "10 seconds",
) -> StreamingQuery:
    """Send rows of an alert level onward as messages keyed by device."""
    alerts = bronze.filter(F.col("alert_level") == level)
    return start(to_messages(alerts, topic, BRONZE.fieldNames(), key="device_id"), sink, checkpoint, trigger=trigger)


def replay_to_topic(
    spark: SparkSession,
    input_path: str,
    sink: Sink,
    checkpoint: str,
    topic: str,
    trigger: str = AVAILABLE_NOW,
) -> StreamingQuery:
    """Send every line of the JSONL files to a topic as one message."""
    return start(lines_to_messages(stream_text(spark, input_path), topic), sink, checkpoint, trigger=trigger)


def replay_to_files(spark: SparkSession, input_path: str, topic_path: str, topic: str) -> None:
    """The same into a topic kept as Parquet files."""
    write_table(as_kafka_rows(lines_to_messages(spark.read.text(input_path), topic)), topic_path)


def bronze_report(spark: SparkSession, table: str, rows: int = 20, fmt: str = "parquet") -> dict[str, DataFrame]:
    """Preview, size, spread over buildings and sensor types, and high alerts of the bronze table."""
    bronze = read_table_or_empty(pin_utc(spark), table, BRONZE, fmt)
    return {
        "preview": preview(bronze, n=rows),
        "total": total(bronze),
        "by_building": counts_by(bronze, "building"),
        "by_type": counts_by(bronze, "type"),
        "high_alerts": bronze.filter(F.col("alert_level") == "HIGH"),
    }


def silver_report(spark: SparkSession, table: str, rows: int = 10, fmt: str = "parquet") -> dict[str, DataFrame]:
    """Schema, preview and size of the silver table; no rows if it is not there yet."""
    silver = read_table_or_empty(pin_utc(spark), table, SILVER, fmt)
    return {
        "schema": schema_listing(silver),
        "preview": preview(silver, n=rows),
        "total": total(silver),
    }
