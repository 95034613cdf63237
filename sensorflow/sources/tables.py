"""Stored tables: snapshot reads, streams over them, readiness, and batch writes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import WRITE_SETTINGS, settings
from .files import rate_limited
from .paths import exists, is_file, literal

# Folders by which a table's path is known to belong to a stream.
STREAM_FOLDERS = ("_spark_metadata", "_checkpoint")


def read_table(spark: SparkSession, path: str, schema: StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """The table's current snapshot. Of a stream's table, only files of committed epochs are read."""
    reader = spark.read.format(fmt)
    return (reader if schema is None else reader.schema(schema)).load(path)


def read_table_or_empty(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """The table, or no rows in the declared schema if it has not been written yet."""
    try:
        return read_table(spark, path, schema, fmt)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def table_status(spark: SparkSession, tables: Mapping[str, tuple[str, StructType]], fmt: str = "parquet") -> DataFrame:
    """Whether each named table holds rows yet, and how many."""

    def status(name: str, path: str, schema: StructType) -> DataFrame:
        counted = read_table_or_empty(spark, path, schema, fmt).agg(F.count("*").alias("n"))
        return counted.select(F.lit(name).alias("table_name"), (F.col("n") > 0).alias("ready"), "n")

    return reduce(DataFrame.unionByName, [status(name, *place) for name, place in tables.items()])


def stream_table(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
    bytes_per_batch: int | None = None,
) -> DataFrame:
    """Rows appended to a table. A table kept as one single file is watched through a pattern for its name."""
    if is_file(spark, path):
        path = f"{literal(path[:-1])}[{path[-1]}]"
    reader = rate_limited(spark.readStream.format(fmt).schema(schema), files_per_batch, bytes_per_batch)
    return reader.load(path)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    only_days: bool = False,
) -> None:
    """Write a batch table.

    With `only_days`, overwriting replaces the partitions that `df` has rows for and leaves the others.

    A folder that a stream writes to is never overwritten: the stream's list of files, and a
    checkpoint kept in the folder, would go with the rows.

    With partition columns the rows are rebalanced first: adaptive execution then joins small
    partitions and splits large ones, so a day with a third of all rows is written by many tasks
    and a short day does not become one file per task.
    """
    if mode == "overwrite" and any(exists(df.sparkSession, f"{path}/{kept}") for kept in STREAM_FOLDERS):
        raise ValueError(f"{path} belongs to a stream; write to another folder and let readers change over")
    if not partition_by:
        df.write.format(fmt).mode(mode).save(path)
        return
    balanced = df.hint("rebalance", *[F.col(name) for name in partition_by])
    with settings(df.sparkSession, WRITE_SETTINGS):
        writer = balanced.write.format(fmt).mode(mode).partitionBy(*partition_by)
        (writer.option("partitionOverwriteMode", "dynamic") if only_days else writer).save(path)
