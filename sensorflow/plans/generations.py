"""A silver table that can be rebuilt while a stream keeps feeding it, and that holds no reading twice.

Silver is kept in generations: each has the rows rebuilt from raw up to a moment (`rebuilt`) and the
epochs a stream has added since (`epochs`). An epoch holds the readings it accepted, by event day,
and the messages it rejected, with the reason; both become valid with one mark. Copies are refused
against what is stored, not against state: an epoch reads the stored keys of its own event days
and times only, so a copy is found however late it comes and nothing has to be remembered.

A rebuild begins with the checkpoint of the generation's stream: it notes the raw files there are, in
the stream's own order, without reading their rows, and rebuilds from exactly these. The stream then
goes on from that checkpoint and never looks at them again. Files tell the two apart whatever the
rows' times and offsets are: broker times are equal, disordered or missing, and offsets start again
when a topic is made anew.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.times import SECONDS_PATTERN
from ..operators.decoding import sorted_readings
from ..operators.dedup import KEY, dedup_batch
from ..schemas import KIND, RAW, SILVER, SILVER_BY_DAY, SILVER_EPOCH
from ..session import pin_utc, settings
from ..sources.paths import files_of, literal, mark, matching
from ..sources.tables import read_table, read_table_or_empty, stream_table, write_table
from ..streaming.runner import AVAILABLE_NOW, start
from ..streaming.versions import BATCH, committed, compact, folder, note, read_batches, write_version
from .layers import by_day, raw_messages, silver_from_raw

READY = "_ready"  # older generations have a time after it
SEEN = "seen"  # the raw files that a rebuild has read
ACCEPTED, REJECTED = "accepted", "rejected"
LAYOUT = (KIND, "event_date")

# An epoch's keys beyond this number are not worth a broadcast.
MANY_ROWS = 1_000_000

# What one task decodes: files of few row groups would leave most cores without work.
DECODE_SETTINGS = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}


def _ready(spark: SparkSession, root: str) -> set[int]:
    """Generations that are complete."""
    found = matching(spark, f"{literal(root)}/generation=*/{READY}*")
    return {int(path.split("generation=")[1].split("/")[0]) for path in found}


def newest(spark: SparkSession, root: str) -> int:
    return max(_ready(spark, root), default=0)


def _file() -> Column:
    return F.col("_metadata.file_path").alias("raw_file")


def _folder(root: str, generation: int) -> str:
    return f"{root}/generation={generation}"


def _stored(spark: SparkSession, place: str, after: int | None = None, upto: int | None = None) -> DataFrame:
    """Accepted rows of a generation; `after` an epoch, or with what was rebuilt."""
    epochs = read_batches(spark, f"{place}/epochs", SILVER_EPOCH, -1 if after is None else after, upto)
    rows = epochs.where(F.col(KIND) == ACCEPTED).select(*SILVER_BY_DAY.fieldNames())
    if after is not None:
        return rows
    return read_table_or_empty(spark, f"{place}/rebuilt", SILVER_BY_DAY).select(*rows.columns).unionByName(rows)


class Span(NamedTuple):
    """First and last time, in microseconds, of an epoch's readings of one day."""

    day: date
    first: int
    last: int


def refuse_stored(fresh: DataFrame, stored: DataFrame, spans: Sequence[Span], keys: Sequence[str] = KEY, time: str = "event_time", day: str = "event_date", many: bool = False) -> DataFrame:
    """Rows of `fresh` whose key `stored` does not hold; of `stored` only the days and times in `spans` are read.

    Of the stored keys, those that are met are sought first: that side stays where it is when the
    epoch is small enough to be broadcast, and the answer is small. With `many` rows in `fresh` both
    sides are shuffled anyway, so they meet once and `fresh` is computed once.
    """
    within = [
        (F.col(day) == F.lit(span.day)) & F.col(time).between(F.timestamp_micros(F.lit(span.first)), F.timestamp_micros(F.lit(span.last)))
        for span in spans
    ]
    if not within:
        return fresh
    held = stored.where(reduce(Column.__or__, within)).select(*keys)
    if not many:
        held = held.join(fresh.select(*keys), list(keys), "left_semi")
    return fresh.join(held, list(keys), "left_anti")


def write_epoch(raw: DataFrame, epoch: int, place: str, time_pattern: str = SECONDS_PATTERN) -> dict:
    """One epoch of raw rows as accepted readings and rejected messages; returns their counts, which the epoch's mark holds."""
    spark = raw.sparkSession
    with settings(spark, DECODE_SETTINGS):
        rows = by_day(sorted_readings(raw_messages(raw.hint("rebalance", "offset")), time_pattern)).persist()
    try:
        time = F.unix_micros("event_time")
        # One row for every day that the epoch writes to, and one for what it rejects.
        by_days = rows.groupBy(F.when(F.col("reason") == ACCEPTED, F.col("event_date")).alias("day")).agg(
            F.count("*").alias("rows"), F.min(time).alias("first"), F.max(time).alias("last")
        )
        with settings(spark, DECODE_SETTINGS):
            days = by_days.collect()
        spans = [Span(row["day"], row["first"], row["last"]) for row in days if row["day"] is not None]
        valid = dedup_batch(rows.where(F.col("reason") == ACCEPTED), order=("kafka_ingest_time", "partition", "offset"))
        many = sum(row["rows"] for row in days if row["day"] is not None) > MANY_ROWS
        accepted = refuse_stored(valid, _stored(spark, place, upto=epoch - 1), spans, many=many).withColumn(KIND, F.lit(ACCEPTED))
        rejected = rows.where(F.col("reason") != ACCEPTED).withColumns({KIND: F.lit(REJECTED), "event_date": F.lit(None).cast("date")})
        counts = [F.count_if(F.col(KIND) == kind).alias(kind) for kind in (ACCEPTED, REJECTED)]
        written = accepted.select(*SILVER_EPOCH.fieldNames()).unionByName(rejected.select(*SILVER_EPOCH.fieldNames()))
        return write_version(written, f"{place}/epochs", BATCH, epoch, LAYOUT, {"read": sum(row["rows"] for row in days)}, counts)
    finally:
        rows.unpersist()


def follow_raw(
    spark: SparkSession,
    raw_path: str,
    root: str,
    trigger: str = "5 seconds",
    time_pattern: str = SECONDS_PATTERN,
    bytes_per_batch: int | None = None,
    compact_every: int | None = 100,
) -> StreamingQuery:
    """Append valid readings that are not stored yet to the newest generation, and keep the messages it rejects.

    Without state: no watermark, nothing is dropped as late. Every `compact_every` epochs the small
    folders become one.
    """
    pin_utc(spark)
    if not _ready(spark, root):
        mark(spark, f"{_folder(root, 0)}/{READY}")
    place = _folder(root, newest(spark, root))

    def write(batch: DataFrame, epoch: int) -> None:
        write_epoch(batch, epoch, place, time_pattern)
        if compact_every is not None and epoch % compact_every == compact_every - 1:
            compact(batch.sparkSession, f"{place}/epochs", SILVER_EPOCH, LAYOUT)

    raw = stream_table(spark, raw_path, RAW, bytes_per_batch=bytes_per_batch)
    return start(raw, lambda writer: writer.foreachBatch(write), f"{place}/checkpoint", trigger=trigger)


def rebuild(spark: SparkSession, raw_path: str, root: str, time_pattern: str = SECONDS_PATTERN) -> int:
    """Write the next generation from all raw files there are, and make it the one that is read.

    Stop the stream of the present generation first and start `follow_raw` afterwards. Raw files that
    land while this runs are left to the stream.
    """
    pin_utc(spark)
    generation = max(_ready(spark, root), default=-1) + 1
    place = _folder(root, generation)

    def note_files(batch: DataFrame, epoch: int) -> None:
        write_version(batch.distinct(), f"{place}/{SEEN}", BATCH, epoch)

    # The file's name is no column of the file, so of the rows only their number is read.
    names = stream_table(spark, raw_path, RAW).select(_file())
    start(names, lambda writer: writer.foreachBatch(note_files), f"{place}/checkpoint", trigger=AVAILABLE_NOW).awaitTermination()
    seen = read_batches(spark, f"{place}/{SEEN}", names.schema).select("raw_file")
    raw = read_table(spark, raw_path, RAW).select("*", _file()).join(seen, "raw_file", "left_semi").select(*RAW.fieldNames())
    write_table(by_day(silver_from_raw(raw, time_pattern)), f"{place}/rebuilt", partition_by=["event_date"])
    mark(spark, f"{place}/{READY}")
    return generation


def read_silver(spark: SparkSession, root: str, after: int | None = None, generation: int | None = None) -> DataFrame:
    """The newest generation, or `generation`, with its `event_date`: every reading once, and no shuffle to make it so.

    `after` leaves out the rebuilt rows and the epochs up to that number.
    """
    place = _folder(root, newest(spark, root) if generation is None else generation)
    return _stored(spark, place, after)


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """Messages that the newest generation's stream has rejected, as they came, with `reason` and epoch."""
    place = _folder(root, newest(spark, root))
    rows = read_batches(spark, f"{place}/epochs", SILVER_EPOCH).where(F.col(KIND) == REJECTED)
    return rows.select("raw_value", "topic", "partition", "offset", "kafka_ingest_time", "reason", BATCH)


def epoch_report(spark: SparkSession, root: str) -> DataFrame:
    """Of every epoch of the newest generation that stands by itself: rows in and out, copies, files and bytes.

    The counts are those committed with the rows, so every epoch has them, whatever session wrote it.
    """
    place = f"{_folder(root, newest(spark, root))}/epochs"
    rows = []
    for epoch in committed(spark, place, BATCH):  # one small file for each; compaction bounds their number
        said = note(spark, place, BATCH, epoch)
        copies = said["read"] - said[ACCEPTED] - said[REJECTED]
        files, size = files_of(spark, folder(place, BATCH, epoch))
        rows.append((epoch, said["read"], said[ACCEPTED], said[REJECTED], copies, files, size))
    counts = "n_read long, n_accepted long, n_rejected long, n_copies long, n_files long, n_bytes long"
    return spark.createDataFrame(rows, f"{BATCH} long, {counts}")


def last_epoch(spark: SparkSession, root: str) -> tuple[int, int]:
    """Newest generation and the newest epoch in it, -1 if it has none."""
    generation = newest(spark, root)
    return generation, max(committed(spark, f"{_folder(root, generation)}/epochs", BATCH), default=-1)
