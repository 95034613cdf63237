"""Sizes and extremes of a Parquet table from the files' footers, without reading a row."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DateType, DoubleType, FloatType, IntegerType, LongType, ShortType, StructType

from ..session import settings

# Aggregates are answered from footers by the newer of Spark's two Parquet readers.
FOOTER_SETTINGS = {"spark.sql.parquet.aggregatePushdown": "true", "spark.sql.sources.useV1SourceList": ""}

# Footers keep exact extremes of these; of texts they may be cut, and of times Spark does not ask for them.
_EXACT = (ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType, DateType)


def _aggregates(schema: StructType) -> list:
    columns = [F.count("*").alias("n_rows")]
    for place, field in enumerate(schema.fields):
        columns.append(F.count(field.name).alias(f"set_{place}"))
        if isinstance(field.dataType, _EXACT):
            columns += [F.min(field.name).alias(f"min_{place}"), F.max(field.name).alias(f"max_{place}")]
    return columns


def footer_row(spark: SparkSession, path: str) -> DataFrame:
    """One row with the count of all rows and, by column, of set values, and the extremes; plan it under `FOOTER_SETTINGS`."""
    table = spark.read.parquet(path)
    return table.agg(*_aggregates(table.schema))


def profile_footers(spark: SparkSession, path: str) -> DataFrame:
    """`column_name`, `n_rows`, `n_nulls` and, of numbers and dates, `min_value` and `max_value`.

    As many footers are read as there are files, and no column. Spark finds a column in a footer by
    its place, so this is for tables whose files have their columns in one order, as those of one
    writer have; the schema is the files' own, never a declared one. Where a footer has no extremes,
    as for columns with NaN, the columns are read after all.
    """
    schema = spark.read.parquet(path).schema
    try:
        with settings(spark, FOOTER_SETTINGS, override=True):
            row = footer_row(spark, path).first()
    except (PySparkException, Py4JJavaError) as error:
        if "No min/max found" not in str(error):
            raise
        row = footer_row(spark, path).first()
    found, n_rows = [], row["n_rows"] or 0
    for place, field in enumerate(schema.fields):
        extremes = [row[f"{name}_{place}"] if f"{name}_{place}" in row else None for name in ("min", "max")]
        found.append((field.name, n_rows, n_rows - (row[f"set_{place}"] or 0), *[None if x is None else str(x) for x in extremes]))
    return spark.createDataFrame(found, "column_name string, n_rows long, n_nulls long, min_value string, max_value string")
