"""JSONL and CSV files under a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import StructType

from ..schemas import READING


# File streams skip a new file if it is this much older than the newest one seen, without a word.
# Archives and object stores hand out files dated 1970, so the default reaches beyond that: no file
# is skipped by its date. The price is that the stream remembers the names of all files of its
# folder; a folder that keeps files for ever can be given a shorter time.
FILE_AGE = "36500d"


def rate_limited(
    reader: DataStreamReader, files_per_batch: int | None, bytes_per_batch: int | None, file_age: str = FILE_AGE
) -> DataStreamReader:
    """Bound what one micro-batch takes, by files or by size, and say how old a new file may be."""
    reader = reader.option("maxFileAge", file_age)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch is not None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return reader


def read_json(spark: SparkSession, path: str, schema: StructType = READING) -> DataFrame:
    """JSONL files. Unknown fields are ignored; a bad field or line becomes NULL."""
    return spark.read.schema(schema).json(path)


def stream_json(
    spark: SparkSession,
    path: str,
    schema: StructType = READING,
    files_per_batch: int | None = None,
    bytes_per_batch: int | None = None,
    file_age: str = FILE_AGE,
) -> DataFrame:
    """New JSONL files of a folder. The first run takes all files present, later runs only new ones.

    A file counts as new by its name. One changed more than `file_age` before the newest one seen is skipped.
    """
    return rate_limited(spark.readStream.schema(schema), files_per_batch, bytes_per_batch, file_age).json(path)


def stream_csv(
    spark: SparkSession,
    path: str,
    schema: StructType = READING,
    files_per_batch: int | None = None,
    bytes_per_batch: int | None = None,
    file_age: str = FILE_AGE,
) -> DataFrame:
    """New CSV files with a header line."""
    reader = rate_limited(spark.readStream.schema(schema), files_per_batch, bytes_per_batch, file_age)
    return reader.option("header", True).csv(path)


def stream_text(
    spark: SparkSession,
    path: str,
    files_per_batch: int | None = None,
    bytes_per_batch: int | None = None,
    file_age: str = FILE_AGE,
) -> DataFrame:
    """New text files, one row per line in column `value`."""
    return rate_limited(spark.readStream, files_per_batch, bytes_per_batch, file_age).text(path)
