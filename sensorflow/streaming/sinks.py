"""Where a stream's rows go. Each function returns a sink for `runner.start`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from .runner import Sink
from .versions import BATCH, COMPACT_BYTES, SNAPSHOT, compact, fold_batches, prune, write_version


def table_sink(path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> Sink:
    """Append to a table. The file manifest (or the table format's log) makes each epoch count once."""

    def attach(writer: DataStreamWriter) -> DataStreamWriter:
        writer = writer.format(fmt).option("path", path)
        return writer.partitionBy(*partition_by) if partition_by else writer

    return attach


def batch_sink(path: str, keys: Sequence[str] = (), fold_every: int | None = None, order: Sequence[str] = (BATCH,)) -> Sink:
    """Write epoch N to its own folder, replacing it when the epoch is replayed after a failure.

    Takes append and update mode; read it with `versions.read_batches` or, where rows replace
    earlier rows of their key, with `versions.read_current`. With `fold_every`, that many epochs are
    folded into one folder of the newest row per key (by `order`), so that a reader never goes
    through all of them.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        write_version(batch, path, BATCH, epoch)
        if fold_every is not None and epoch % fold_every == fold_every - 1:
            fold_batches(batch.sparkSession, path, batch.schema, keys, order)

    return lambda writer: writer.foreachBatch(write)


def epoch_sink(path: str, partition_by: Sequence[str] = (), compact_every: int | None = 100, compact_bytes: int = COMPACT_BYTES) -> Sink:
    """Append epoch N as a folder of its own and make many small epochs few large files now and then.

    Read it with `versions.read_batches`, which a compaction does not disturb. For tables that are read
    as a whole; one that another stream follows belongs in `table_sink`.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        write_version(batch, path, BATCH, epoch, partition_by)
        if compact_every is not None and epoch % compact_every == compact_every - 1:
            compact(batch.sparkSession, path, batch.schema, partition_by, compact_bytes)

    return lambda writer: writer.foreachBatch(write)


def snapshot_sink(path: str, keep: int = 2) -> Sink:
    """Write the whole result of epoch N as a new snapshot and remove all but the newest few.

    For complete mode, which file sinks refuse. Read it with `versions.read_snapshot`.
    """

    def write(result: DataFrame, epoch: int) -> None:
        write_version(result, path, SNAPSHOT, epoch)
        prune(result.sparkSession, path, SNAPSHOT, keep)

    return lambda writer: writer.foreachBatch(write)


def kafka_sink(servers: str, topic: str | None = None) -> Sink:
    """Send message rows to Kafka; without `topic` each row's own topic column decides."""

    def attach(writer: DataStreamWriter) -> DataStreamWriter:
        writer = writer.format("kafka").option("kafka.bootstrap.servers", servers)
        return writer if topic is None else writer.option("topic", topic)

    return attach


def memory_sink(name: str) -> Sink:
    """Debugging: a table in driver memory. For small results only."""
    return lambda writer: writer.format("memory").queryName(name)


def console_sink(rows: int = 20) -> Sink:
    """Debugging: print the first rows of each epoch."""
    return lambda writer: writer.format("console").option("numRows", rows).option("truncate", False)
