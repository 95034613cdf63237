"""Late rows kept aside: one output of a stream for the rows in time, one for those behind the watermark.

The engine drops late rows inside its stateful operators, where nobody can have them. Here each
epoch is split before anything is aggregated, by the mark that the epochs before it left: the newest
event time they held, less the tolerance. The mark is committed with the epoch, so a replayed epoch
is split as it was, and rows kept and rows late always add up to rows read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..operators.aggregates import tumbling
from .runner import Sink
from .versions import BATCH, committed, note, read_batches, write_version

KIND = "kind"
KEPT, LATE = "kept", "late"
_NEWEST = "newest_micros"


def _micros(delay: str) -> Column:
    zero = F.timestamp_micros(F.lit(0))
    return F.unix_micros(zero + F.expr(f"interval {delay}"))


def _mark(newest: int | None, delay: str) -> Column:
    """The watermark in microseconds that the newest event time leaves; the engine's has whole milliseconds as well."""
    return F.lit(newest // 1000 * 1000).cast("long") - _micros(delay)


def _newest(spark: SparkSession, path: str, before: int) -> int | None:
    """Newest event time of the epochs before `before`; each epoch's note has that of all up to it."""
    earlier = [epoch for epoch in committed(spark, path, BATCH) if epoch < before]
    return note(spark, path, BATCH, earlier[-1]).get(_NEWEST) if earlier else None


def is_late(end: Column, newest: int | None, delay: str) -> Column:
    """Whether the window that ends at `end` had closed. A row without time belongs to no window and is late."""
    if newest is None:
        return end.isNull()
    return F.coalesce(F.unix_micros(end) <= _mark(newest, delay), F.lit(True))


def split_sink(path: str, event_time: str, width: str, delay: str) -> Sink:
    """Write each epoch's rows as kept or late, by whether their window of `width` had closed before the epoch.

    A row is late if the end of its window is not after the mark, as in the engine's windowed
    aggregates with a watermark of `delay`.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        newest = _newest(spark, path, epoch)
        end = F.timestamp_micros(F.unix_micros(event_time) - F.pmod(F.unix_micros(event_time), _micros(width)) + _micros(width))
        marked = batch.withColumn(KIND, F.when(is_late(end, newest, delay), LATE).otherwise(KEPT))
        counts = [
            F.count("*").alias("read"),
            *[F.count_if(F.col(KIND) == kind).alias(kind) for kind in (KEPT, LATE)],
            F.max(F.greatest(F.unix_micros(event_time), F.lit(newest).cast("long"))).alias(_NEWEST),
        ]
        # Of an epoch without rows the earlier mark holds on.
        counts[-1] = F.coalesce(counts[-1], F.lit(newest).cast("long")).alias(_NEWEST)
        write_version(marked, path, BATCH, epoch, [KIND], {}, counts)

    return lambda writer: writer.foreachBatch(write)


def read_split(spark: SparkSession, path: str, schema: StructType, kind: str) -> DataFrame:
    """Rows that were kept, or that were late, with their epoch."""
    rows = read_batches(spark, path, StructType([*schema.fields]).add(KIND, StringType()))
    return rows.where(F.col(KIND) == kind).drop(KIND)


def closed_windows(spark: SparkSession, path: str, schema: StructType, event_time: str, width: str, delay: str, *aggregates: Column) -> DataFrame:
    """Aggregates of the kept rows in every window that has closed: what the engine's append mode writes."""
    last = committed(spark, path, BATCH)
    newest = note(spark, path, BATCH, last[-1]).get(_NEWEST) if last else None
    slices = tumbling(read_split(spark, path, schema, KEPT), event_time, width, *aggregates)
    if newest is None:
        return slices.limit(0)
    end = F.col("window_start") + F.expr(f"interval {width}")
    return slices.where(F.unix_micros(end) <= _mark(newest, delay))


def split_counts(spark: SparkSession, path: str) -> DataFrame:
    """Rows read, kept and late of every epoch, from the marks that committed them."""
    rows = []
    for epoch in committed(spark, path, BATCH):  # one small file for each
        said = note(spark, path, BATCH, epoch)
        rows.append((epoch, said["read"], said[KEPT], said[LATE]))
    return spark.createDataFrame(rows, f"{BATCH} long, n_read long, n_kept long, n_late long")
