"""The test table `events` seen as sensor readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

from .schemas import READING
from .sources.tables import read_table, stream_table

EVENTS = StructType(
    [
        StructField("event_id", LongType()),
        StructField("ts", TimestampNTZType()),
        StructField("user_id", LongType()),
        StructField("event_type", StringType()),
        StructField("value", DoubleType()),
        StructField("props", StringType()),
    ]
)

# Sensor type and unit each event type stands for; any other type keeps its name.
SENSOR_TYPES = {
    "click": ("temperature", "°C"),
    "view": ("co2", "ppm"),
    "purchase": ("humidity", "%"),
    "signup": ("energy_consumption", "kWh"),
}


def events_path(sf_dir: str) -> str:
    return f"{sf_dir}/events.parquet"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, events_path(sf_dir), EVENTS)


def stream_events(spark: SparkSession, sf_dir: str, bytes_per_batch: int | None = None) -> DataFrame:
    return stream_table(spark, events_path(sf_dir), EVENTS, bytes_per_batch=bytes_per_batch)


def as_readings(events: DataFrame, *keep: str) -> DataFrame:
    """One reading per event, among them missing, negative and out-of-range ones.

    `keep` names event columns to carry along.
    """
    kind = F.col("event_type")
    sensor, unit = kind, F.lit(None).cast("string")
    for name, (sensor_type, sensor_unit) in SENSOR_TYPES.items():
        sensor = F.when(F.col("event_type") == name, sensor_type).otherwise(sensor)
        unit = F.when(F.col("event_type") == name, sensor_unit).otherwise(unit)
    time_text = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    device = F.when(F.col("event_id") % 101 != 0, F.concat(F.lit("sensor-"), F.col("user_id").cast("string")))
    building = F.when(F.col("user_id") % 7 == 6, None).when(F.col("user_id") % 2 == 0, "A").otherwise("B")
    value = (
        F.when(F.col("event_id") % 97 == 0, None)
        .when(F.col("event_id") % 89 == 0, -F.col("value"))
        .when(kind == "view", F.col("value") * 20)
        .otherwise(F.col("value"))
    )
    columns = {
        "timestamp": time_text,
        "device_id": device,
        "building": building,
        "floor": (F.col("user_id") % 3 + 1).cast("int"),
        "type": sensor,
        "value": value,
        "unit": unit,
    }
    kept = [F.col(name) for name in keep]
    return events.select(*[columns[name].alias(name) for name in READING.fieldNames()], *kept)


def read_readings(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    return as_readings(read_events(spark, sf_dir), *keep)


def stream_readings(spark: SparkSession, sf_dir: str, *keep: str, bytes_per_batch: int | None = None) -> DataFrame:
    return as_readings(stream_events(spark, sf_dir, bytes_per_batch), *keep)
