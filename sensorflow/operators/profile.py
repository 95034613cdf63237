"""Quality profile of a table: size, gaps and ranges per column, schema listing, preview."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .aggregates import plain_zero


def _stats(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    types = dict(df.dtypes)
    stats = [F.count(F.lit(1)).alias("n_rows")]
    for name in columns:
        ranged = plain_zero(name) if types[name] == "double" else F.col(name)
        stats += [
            F.count(F.col(name)).alias(f"{name}__set"),
            F.min(ranged).alias(f"{name}__min"),
            F.max(ranged).alias(f"{name}__max"),
        ]
    return stats


def _per_column(stats: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col("n_rows"),
            (F.col("n_rows") - F.col(f"{name}__set")).alias("n_nulls"),
            F.col(f"{name}__min").cast("string").alias("min_value"),
            F.col(f"{name}__max").cast("string").alias("max_value"),
        )
        for name in columns
    ]
    return stats.select(*keep, F.inline(F.array(*rows)))


def profile_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, NULLs, smallest and largest value of each column, from one pass over the table."""
    columns = list(columns or df.columns)
    return _per_column(df.agg(*_stats(df, columns)), columns)


def profile_per_file(table: DataFrame, columns: Sequence[str] | None = None, below: str = "") -> DataFrame:
    """The same profile per stored file; `table` must be a direct read of files.

    Files are named by their path, from after the folder `below` if it is given: files of different
    partition folders may share a name.
    """
    columns = list(columns or table.columns)
    path = F.col("_metadata.file_path")
    name = F.substring_index(path, f"{below.rstrip('/')}/", -1) if below else path
    # Ranges of text cannot be kept in a hash aggregate's rows; with one aggregate among them that
    # keeps objects, Spark hashes all of them instead of sorting every task's rows by file.
    hashed = F.collect_set(F.lit(1)).alias("__hashed")
    stats = table.groupBy(name.alias("file_name")).agg(*_stats(table, columns), hashed)
    return _per_column(stats, columns, keep=["file_name"])


def schema_listing(df: DataFrame) -> DataFrame:
    """Position, name, type and nullability of each column, without reading a row."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string, nullable boolean")


def schema_report(df: DataFrame) -> DataFrame:
    """The same listing and how many rows have each column set, which reads the table."""
    counts = df.agg(*[F.count(F.col(field.name)).alias(field.name) for field in df.schema.fields])
    rows = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("data_type"),
            F.lit(field.nullable).alias("nullable"),
            F.col(field.name).alias("n_set"),
        )
        for position, field in enumerate(df.schema.fields)
    ]
    return counts.select(F.inline(F.array(*rows)))


def preview(df: DataFrame, order_by: Sequence[str] = (), n: int = 20) -> DataFrame:
    """The first n rows met, or in a stated order, which reads the table; each task keeps only its own n."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
