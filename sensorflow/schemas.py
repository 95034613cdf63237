"""Declared schemas of every layer. Nothing in the package infers a schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _schema(*fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields])


# Field names, order and types of the stored layers.
READING = _schema(
    ("timestamp", StringType()),
    ("device_id", StringType()),
    ("building", StringType()),
    ("floor", IntegerType()),
    ("type", StringType()),
    ("value", DoubleType()),
    ("unit", StringType()),
)

BRONZE = _schema(
    ("device_id", StringType()),
    ("timestamp_parsed", TimestampType()),
    ("building", StringType()),
    ("floor", IntegerType()),
    ("building_floor", StringType()),
    ("type", StringType()),
    ("value", DoubleType()),
    ("unit", StringType()),
    ("alert_level", StringType()),
    ("ingestion_time", TimestampType()),
)

SILVER = _schema(
    ("sensor_id", StringType()),
    ("event_time", TimestampType()),
    ("building", StringType()),
    ("floor", IntegerType()),
    ("sensor_type", StringType()),
    ("sensor_value", DoubleType()),
    ("unit", StringType()),
    ("kafka_ingest_time", TimestampType()),
    ("processing_time", TimestampType()),
)

KAFKA_ROW = _schema(
    ("key", BinaryType()),
    ("value", BinaryType()),
    ("topic", StringType()),
    ("partition", IntegerType()),
    ("offset", LongType()),
    ("timestamp", TimestampType()),
    ("timestampType", IntegerType()),
)

# The same with the day its files are laid out by.
SILVER_BY_DAY = StructType([*SILVER.fields, StructField("event_date", DateType(), True)])

# An epoch of silver: accepted readings, and rejected messages with what is known of them.
KIND = "kind"
SILVER_EPOCH = StructType(
    [
        *SILVER.fields,
        StructField("raw_value", BinaryType(), True),
        StructField("topic", StringType(), True),
        StructField("partition", IntegerType(), True),
        StructField("offset", LongType(), True),
        StructField("reason", StringType(), True),
        StructField(KIND, StringType(), True),
        StructField("event_date", DateType(), True),
    ]
)

RAW = _schema(
    ("key", BinaryType()),
    ("value", BinaryType()),
    ("topic", StringType()),
    ("partition", IntegerType()),
    ("offset", LongType()),
    ("kafka_ingest_time", TimestampType()),
    ("ingest_date", DateType()),
)

LAST_KNOWN = _schema(
    ("sensor_id", StringType()),
    ("last_time", TimestampType()),
    ("last_value", DoubleType()),
)

ALERT_RULE = _schema(
    ("type", StringType()),
    ("op", StringType()),
    ("threshold", DoubleType()),
    ("level", StringType()),
)


def conform(df: DataFrame, schema: StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Select the schema's columns in order and cast them; a value that does not fit becomes NULL.

    Columns named in `keep` follow unchanged.
    """
    present = {field.name: field.dataType for field in df.schema.fields}

    def column(field: StructField) -> Column:
        if field.name not in present:
            return F.lit(None).cast(field.dataType).alias(field.name)
        if present[field.name] == field.dataType:
            return F.col(field.name)
        return F.col(field.name).try_cast(field.dataType).alias(field.name)

    return df.select(*[column(field) for field in schema.fields], *keep)


def without(schema: StructType, *names: str) -> StructType:
    return StructType([field for field in schema.fields if field.name not in names])
