"""Messages to silver rows, and rows to messages."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json import decode, to_payload
from ..functions.once import evaluate_once
from ..functions.times import SECONDS_PATTERN, parse_time
from ..schemas import KAFKA_ROW, READING, SILVER, conform
from .cleaning import ACCEPTED

# Reading fields that have another name in silver.
SILVER_NAMES = {"device_id": "sensor_id", "type": "sensor_type", "value": "sensor_value"}


def decode_readings(messages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Reading fields and broker time; a payload that is no JSON gives a row of NULL fields."""
    texts = messages.selectExpr("CAST(value AS STRING) AS payload", "timestamp AS kafka_ingest_time", *keep)
    return decode(texts, "payload", READING).select("data.*", "kafka_ingest_time", *keep)


def silver_columns(
    readings: DataFrame,
    time_pattern: str = SECONDS_PATTERN,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rename and type reading fields as silver columns; the value must be set.

    The time is parsed once per row, also when rows without a time are dropped later on. Readings
    that did not come as messages have no broker time.
    """
    timed = evaluate_once(readings, parse_time(F.col("timestamp"), time_pattern), "event_time")
    clocks = {"processing_time": F.current_timestamp()}
    if "kafka_ingest_time" not in readings.columns:
        clocks["kafka_ingest_time"] = F.lit(None).cast("timestamp")
    silver = timed.withColumnsRenamed(SILVER_NAMES).withColumns(clocks).select(*SILVER.fieldNames(), *keep)
    return silver.filter(F.col("sensor_value").isNotNull())


def silver_decode(
    messages: DataFrame,
    time_pattern: str = SECONDS_PATTERN,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Messages to silver rows. `keep` passes message columns such as the offset through."""
    return silver_columns(decode_readings(messages, keep), time_pattern, keep)


def silver_valid(
    silver: DataFrame,
    required: Sequence[str] = ("sensor_id", "event_time", "sensor_value"),
    keep: Sequence[str] = (),
) -> DataFrame:
    """The validated silver contract: declared types, required fields set, no impossible value."""
    typed = conform(silver, SILVER, keep)
    for name in required:
        typed = typed.filter(F.col(name).isNotNull())
    return typed.filter(F.col("sensor_value") >= 0)


def to_messages(df: DataFrame, topic: str, columns: Sequence[str], key: str | None = None) -> DataFrame:
    """One message per row, in the columns a Kafka sink takes."""
    message_key = F.lit(None) if key is None else F.col(key).cast("string")
    return df.select(
        message_key.cast("binary").alias("key"),
        to_payload(*columns).alias("value"),
        F.lit(topic).alias("topic"),
    )


def lines_to_messages(lines: DataFrame, topic: str) -> DataFrame:
    """JSONL text lines to messages, as they stand but for white space around them.

    A line that is no JSON object is skipped; its neighbours are kept. `line_rejects` counts them.
    """
    return lines.filter(is_json_object(F.col("value"))).select(
        F.lit(None).cast("binary").alias("key"),
        F.trim("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
    )


def is_json_object(text: Column) -> Column:
    """Whether text is a JSON object, or would be with its NaN and infinite numbers in quotes."""
    trimmed = F.trim(text)
    lenient = F.regexp_replace(trimmed, r'([:,\[]\s*)-?(NaN|Infinity)(\s*[,}\]])', '$1"$2"$3')
    parsed = F.coalesce(F.get_json_object(trimmed, "$"), F.get_json_object(lenient, "$"))
    return F.coalesce(trimmed.startswith("{") & parsed.isNotNull(), F.lit(False))


def line_rejects(lines: DataFrame) -> DataFrame:
    """Lines by whether `lines_to_messages` takes them: `accepted` or `no_json_object`."""
    reason = F.when(is_json_object(F.col("value")), ACCEPTED).otherwise("no_json_object")
    return lines.groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


def silver_reject_reason(time_pattern: str = SECONDS_PATTERN) -> Column:
    """The first reason for which a decoded reading does not become a valid silver row, or `accepted`."""
    return (
        F.when(F.col("device_id").isNull(), "missing_sensor_id")
        .when(F.col("value").isNull(), "missing_value")
        .when(F.col("timestamp").isNull(), "missing_time")
        .when(parse_time(F.col("timestamp"), time_pattern).isNull(), "unparsed_time")
        .when(F.col("value") < 0, "negative_value")
        .otherwise(ACCEPTED)
    )


def silver_rejects(readings: DataFrame, time_pattern: str = SECONDS_PATTERN) -> DataFrame:
    """Readings per reason for which `silver_valid` drops them, and those it accepts."""
    return readings.groupBy(silver_reject_reason(time_pattern).alias("reason")).agg(F.count("*").alias("n"))


def sorted_readings(messages: DataFrame, time_pattern: str = SECONDS_PATTERN) -> DataFrame:
    """Every message as a silver row with the `reason` for which it is none, or `accepted`; rejected ones keep `raw_value`.

    The reasons are those of `silver_reject_reason`, and `no_json_object` for text that is none.
    Topic, partition and offset come along.
    """
    place = ("topic", "partition", "offset")
    readings = decode_readings(messages.withColumn("raw_value", F.col("value")), ("raw_value", *place))
    timed = evaluate_once(readings, parse_time(F.col("timestamp"), time_pattern), "event_time")
    nothing = reduce(Column.__and__, [F.col(name).isNull() for name in READING.fieldNames()])
    reason = (
        F.when(nothing & ~is_json_object(F.col("raw_value").cast("string")), "no_json_object")
        .when(F.col("device_id").isNull(), "missing_sensor_id")
        .when(F.col("value").isNull(), "missing_value")
        .when(F.col("timestamp").isNull(), "missing_time")
        .when(F.col("event_time").isNull(), "unparsed_time")
        .when(F.col("value") < 0, "negative_value")
        .otherwise(ACCEPTED)
    )
    rows = evaluate_once(timed, reason, "reason").withColumnsRenamed(SILVER_NAMES)
    rejected_value = F.when(F.col("reason") != ACCEPTED, F.col("raw_value"))
    rows = rows.withColumns({"raw_value": rejected_value, "processing_time": F.current_timestamp()})
    return rows.select(*SILVER.fieldNames(), "raw_value", *place, "reason")


def as_kafka_rows(messages: DataFrame, partitions: int = 3, timestamp: Column | None = None) -> DataFrame:
    """Give a batch of messages the columns a Kafka source returns, for topics kept as files.

    Offsets rise within a task and are unique; like a compacted topic they may have gaps.
    """
    placed = messages.withColumns(
        {
            "partition": F.pmod(F.xxhash64("value"), F.lit(partitions)).cast("int"),
            "offset": F.monotonically_increasing_id(),
            "timestamp": F.current_timestamp() if timestamp is None else timestamp,
            "timestampType": F.lit(0),
        }
    )
    return placed.select(*KAFKA_ROW.fieldNames())
