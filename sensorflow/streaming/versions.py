"""Numbered folders of a table written epoch by epoch.

A folder counts once it carries this module's own mark, written after the rows, so a reader never
sees half an epoch whatever the cluster's committer does, and writing the same number again replaces
it. Numbers mean something within one query only, so a table belongs to the query that wrote to it
first, and another one is refused.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from ..session import WRITE_SETTINGS, settings
from ..sources.paths import delete, literal, mark, matching, read_text, size_of, write_text

BATCH = "batch_id"
COMPACT = "compact"
COMPACT_BYTES = 1 << 30  # a compacted folder that has grown to this size is left as it is
FOLD = "fold"
SNAPSHOT = "snapshot"
COMMITTED = "_committed"
WRITER = "_writer="


def folder(path: str, prefix: str, version: int) -> str:
    return f"{path}/{prefix}={version}"


def committed(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers of the complete folders, in order."""
    marks = matching(spark, f"{literal(path)}/{prefix}=*/{COMMITTED}")
    return sorted(int(found.split("/")[-2].split("=", 1)[1]) for found in marks)


def claim(spark: SparkSession, path: str) -> None:
    """Make the table this streaming query's own; an error if it is another's. Outside of a query, nothing."""
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if query is None:
        return
    owners = {found.rsplit(WRITER, 1)[1] for found in matching(spark, f"{literal(path)}/{WRITER}*")}
    if owners - {query}:
        raise ValueError(f"{path} holds epochs of query {min(owners)}; a new checkpoint needs a new table")
    if not owners:
        mark(spark, f"{path}/{WRITER}{query}")


def write_version(
    df: DataFrame, path: str, prefix: str, version: int, partition_by: Sequence[str] = (), note: dict | None = None, counts: Sequence = ()
) -> dict:
    """Write one numbered folder, in place of what a failed attempt has left there.

    The mark that commits it holds `note` and the `counts` (aggregate columns over `df`, taken while
    it is written), so that what is said about an epoch and its rows become valid together.
    """
    spark, place = df.sparkSession, folder(path, prefix, version)
    claim(spark, path)
    observation = Observation()
    counted = df.observe(observation, *counts) if counts else df
    if partition_by:
        counted = counted.hint("rebalance", *[F.col(name) for name in partition_by])
    with settings(spark, WRITE_SETTINGS):
        counted.write.mode("overwrite").partitionBy(*partition_by).parquet(place)
    said = (note or {}) | (_observed(observation, df, counts) if counts else {})
    write_text(spark, f"{place}/{COMMITTED}", json.dumps(said))
    return said


def _observed(observation: Observation, df: DataFrame, counts: Sequence) -> dict:
    """The counts of what was written. Where Spark finds at run time that there are no rows, it leaves the count out with them."""
    try:
        return observation.get
    except Py4JJavaError:
        return df.sparkSession.createDataFrame([], df.schema).agg(*counts).first().asDict()


def note(spark: SparkSession, path: str, prefix: str, version: int) -> dict:
    """What the mark of a complete folder says."""
    return json.loads(read_text(spark, f"{folder(path, prefix, version)}/{COMMITTED}") or "{}")


def prune(spark: SparkSession, path: str, prefix: str, keep: int) -> None:
    for version in committed(spark, path, prefix)[:-keep]:
        delete(spark, folder(path, prefix, version))


def _read(spark: SparkSession, path: str, prefix: str, versions: Sequence[int], schema: StructType) -> DataFrame:
    numbered = StructType([*schema.fields]).add(prefix, LongType())
    if not versions:
        return spark.createDataFrame([], numbered)
    folders = [folder(path, prefix, version) for version in versions]
    return spark.read.schema(numbered).option("basePath", path).parquet(*folders)


def _compacted(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """Ranges of epochs (first, last) that are kept as one folder, without those that a larger one contains."""
    marks = matching(spark, f"{literal(path)}/{COMPACT}=*/{COMMITTED}")
    ranges = sorted((tuple(map(int, found.split("/")[-2].split("=", 1)[1].split("-"))) for found in marks), key=lambda r: (r[0], -r[1]))
    kept: list[tuple[int, int]] = []
    for first, last in ranges:
        if not kept or last > kept[-1][1]:
            kept.append((first, last))
    return kept


def _range(path: str, kept: tuple[int, int]) -> str:
    return f"{path}/{COMPACT}={kept[0]}-{kept[1]}"


def read_batches(spark: SparkSession, path: str, schema: StructType, after: int = -1, upto: int | None = None) -> DataFrame:
    """Rows of all complete epochs, with their number in `batch_id`, from compacted folders where there are any."""
    ranges = _compacted(spark, path)
    compacted_to = ranges[-1][1] if ranges else -1
    versions = [v for v in committed(spark, path, BATCH) if v > max(after, compacted_to) and (upto is None or v <= upto)]
    rows = _read(spark, path, BATCH, versions, schema)
    numbered = StructType([*schema.fields]).add(BATCH, LongType())
    for kept in ranges:
        if kept[1] <= after or (upto is not None and kept[0] > upto):
            continue
        some = spark.read.schema(numbered).option("basePath", _range(path, kept)).parquet(_range(path, kept))
        if kept[0] <= after:
            some = some.where(F.col(BATCH) > after)
        if upto is not None and kept[1] > upto:
            some = some.where(F.col(BATCH) <= upto)
        rows = rows.unionByName(some)
    return rows


def compact(spark: SparkSession, path: str, schema: StructType, partition_by: Sequence[str] = (), most_bytes: int = COMPACT_BYTES) -> tuple[int, int] | None:
    """Write the rows of all small epochs as one folder, which readers take in their place from its mark on.

    The newest compacted folder is taken into the new one while it is smaller than `most_bytes`, so
    their number grows with the bytes stored, and a row is rewritten a bounded number of times.
    Folders are removed at the call after the one that replaced them: a reader that listed them
    keeps all it listed, if it is done before the next but one. A stream that writes epochs goes on
    meanwhile; a crash leaves either the old folders or both, and only one of them is read. Not for
    a table that another stream reads: that one would take the new folder for new rows.
    """
    ranges, epochs = _compacted(spark, path), committed(spark, path, BATCH)
    _remove_replaced(spark, path, ranges)
    fresh = [v for v in epochs if not ranges or v > ranges[-1][1]]
    if not fresh:
        return None
    first = fresh[0]
    if ranges and size_of(spark, _range(path, ranges[-1])) < most_bytes:
        first = ranges[-1][0]
    target = (first, fresh[-1])
    rows = read_batches(spark, path, schema, after=first - 1, upto=fresh[-1])
    if partition_by:
        rows = rows.hint("rebalance", *[F.col(name) for name in partition_by])
    else:
        rows = rows.hint("rebalance")
    with settings(spark, WRITE_SETTINGS):
        rows.write.mode("overwrite").partitionBy(*partition_by).parquet(_range(path, target))
    mark(spark, f"{_range(path, target)}/{COMMITTED}")
    return target


def _remove_replaced(spark: SparkSession, path: str, ranges: Sequence[tuple[int, int]]) -> None:
    """Folders that compacted ones have replaced, but for the newest epoch's note."""
    if not ranges:
        return
    for found in matching(spark, f"{literal(path)}/{COMPACT}=*"):
        kept = tuple(map(int, found.rsplit("=", 1)[1].split("-")))
        if kept not in ranges and kept[1] <= ranges[-1][1]:
            delete(spark, found)
    for version in committed(spark, path, BATCH)[:-1]:
        if version <= ranges[-1][1]:
            delete(spark, folder(path, BATCH, version))


def read_snapshot(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The newest complete snapshot."""
    return _read(spark, path, SNAPSHOT, committed(spark, path, SNAPSHOT)[-1:], schema).drop(SNAPSHOT)


def read_current(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], order: Sequence[str] = (BATCH,)) -> DataFrame:
    """One row per key, from the newest fold and the epochs after it: the last written one, or the largest by `order`."""
    folds = committed(spark, path, FOLD)[-1:]
    rows = read_batches(spark, path, schema, after=folds[0] if folds else -1)
    if folds:
        rows = rows.unionByName(_read(spark, path, FOLD, folds, schema).withColumnRenamed(FOLD, BATCH))
    rest = [name for name in schema.fieldNames() if name not in (*keys, *order)]
    latest = rows.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("latest"))
    return latest.select(
        *[name if name in keys else F.col(f"latest.{name}").alias(name) for name in schema.fieldNames()]
    )


def fold_batches(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], order: Sequence[str] = (BATCH,)) -> None:
    """Write the current rows as one folder, so that reads need not go through all past epochs.

    Epochs that the fold before this one already held are removed, and with them older folds: a
    reader that started before this call keeps all it listed.
    """
    versions, folds = committed(spark, path, BATCH), committed(spark, path, FOLD)
    if not versions or versions[-1:] == folds[-1:]:
        return
    write_version(read_current(spark, path, schema, keys, order), path, FOLD, versions[-1])
    prune(spark, path, FOLD, keep=2)
    if folds:
        for version in versions:
            if version <= folds[-1]:
                delete(spark, folder(path, BATCH, version))


def folders_read(spark: SparkSession, path: str) -> int:
    """How many folders a reader of the epochs goes through."""
    ranges = _compacted(spark, path)
    return len(ranges) + sum(v > (ranges[-1][1] if ranges else -1) for v in committed(spark, path, BATCH))


def epoch_metrics(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows, files and bytes written per epoch, read back from the table itself.

    Unlike the progress of a running query this covers every epoch still stored, also across restarts.
    """
    rows = read_batches(spark, path, schema)
    per_file = rows.groupBy(BATCH, F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("n_rows"), F.max("_metadata.file_size").alias("bytes")
    )
    return per_file.groupBy(BATCH).agg(
        F.sum("n_rows").alias("n_rows"), F.count("*").alias("n_files"), F.sum("bytes").alias("n_bytes")
    )
