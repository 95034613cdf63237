"""Registry of queries: each callable takes (spark, sf_dir) and returns a DataFrame over the whole table.

Queries on streams run the stream to its end and return the table it wrote. They work in a new
folder each time, below the shared folder of the session.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import reduce, wraps
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .adapters import EVENTS, as_readings, events_path, read_events, read_readings, stream_readings
from .functions import alerts, json, labels, times
from .operators import aggregates, cleaning, compare, decoding, dedup, footers, profile
from .plans import generations, gold, jobs, layers
from .schemas import BRONZE, RAW, READING, SILVER, without
from .session import new_workspace, pin_utc
from .sources import files, messages, paths, tables
from .streaming import late, sinks, state, versions
from .streaming.progress import epoch_counts, epochs_without_counts
from .streaming.runner import AVAILABLE_NOW, drain, run_until_stopped, start

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

TOPIC = "plant_readings"
FIELDS = READING.fieldNames()
BRONZE_STORED = without(BRONZE, "ingestion_time")
CLOCK_COLUMNS = ("ingestion_time", "kafka_ingest_time", "processing_time")

# Meant to lose some rows.
LATE_DELAY = "5 days"

# What a rate-limited stream takes per epoch: three files, whose rows grow with the table once it
# fills that many files of the least size, so that the number of epochs stays bounded.
ROWS_PER_FILE, FILES_PER_EPOCH = 250, 3
FULL_FILES = 120

# What one epoch may take where the result does not depend on it: an epoch is what a stream repeats
# after a failure, and what a stateful operator shuffles at once.
EPOCH_BYTES = 1 << 40

SMALL_EPOCHS = 12

# How far readings may be behind before a sensor's state goes, and a window's.
FORGET = "1 day"


class Timeline(NamedTuple):
    """Where two thirds of the table's span begin, in microseconds, and a delay that covers all of it."""

    second: int
    third: int
    delay: str


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(pin_utc(spark), sf_dir)

    QUERIES[function.__name__] = run
    return run


def comparable(df: DataFrame) -> DataFrame:
    """Without columns read from the clock, and with times as the test table has them: UTC, no zone."""
    df = df.drop(*CLOCK_COLUMNS)
    zoned = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned}) if zoned else df


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in names})


def side_by_side(*rows: DataFrame) -> DataFrame:
    """Tables of one row each as one row with all their columns, without a join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return stacked.agg(*[F.max(name).alias(name) for name in stacked.columns])


def bronze_of(readings: DataFrame) -> DataFrame:
    return cleaning.bronze_clean(readings)


def silver_of(readings: DataFrame) -> DataFrame:
    return decoding.silver_valid(decoding.silver_columns(readings, times.MICROS_PATTERN))


def messages_of(readings: DataFrame) -> DataFrame:
    return decoding.to_messages(readings, TOPIC, FIELDS, key="device_id")


def land_json(spark: SparkSession, sf_dir: str, path: str) -> str:
    read_readings(spark, sf_dir).write.json(path)
    return path


def land_topic(spark: SparkSession, sf_dir: str, path: str) -> str:
    tables.write_table(decoding.as_kafka_rows(messages_of(read_readings(spark, sf_dir))), path)
    return path


def readings_in_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_readings(spark, sf_dir, bytes_per_batch=EPOCH_BYTES)


def streamed(df: DataFrame, work: str) -> str:
    """Append the stream to a table until nothing is left."""
    drain(df, sinks.table_sink(f"{work}/out"), f"{work}/checkpoint")
    return f"{work}/out"


def in_parts(spark: SparkSession, sf_dir: str, numbers: Iterable[int], work: str) -> Iterator[str]:
    """The events of one third of their time after the other."""
    events = read_events(spark, sf_dir)
    return arriving(events, part_number(timeline(events)), numbers, work)


def timeline(events: DataFrame) -> Timeline:
    """Thirds of the events' time, and a delay that forgets none of them in whatever order and epochs they are read."""
    ends = events.agg(*[F.unix_micros(end("ts").cast("timestamp")).alias(end.__name__) for end in (F.min, F.max)]).first()
    first, last = ends["min"] or 0, ends["max"] or 0
    third = (last - first) // 3
    return Timeline(first + third, first + 2 * third, f"{(last - first) // 1_000_000 + 1} seconds")


def part_number(line: Timeline) -> Column:
    """Which third a row belongs to by event time."""
    time = F.unix_micros(F.col("ts").cast("timestamp"))
    return F.when(time < line.second, 0).when(time < line.third, 1).otherwise(2)


def arriving(rows: DataFrame, part: Column, numbers: Iterable[int], work: str) -> Iterator[str]:
    """Let the parts arrive in a folder one after the other; one pass over the rows, without a shuffle, splits them."""
    spark = rows.sparkSession
    rows.withColumn("part", part).write.partitionBy("part").parquet(f"{work}/parts")
    for number in numbers:
        if paths.exists(spark, f"{work}/parts/part={number}"):
            paths.move(spark, f"{work}/parts/part={number}", f"{work}/in/part={number}")
        yield f"{work}/in"


# --- sources -------------------------------------------------------------------------------


@query
def src_json_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = new_workspace(spark, "src_json_schema")
    return files.read_json(spark, land_json(spark, sf_dir, f"{work}/in"))


@query
def src_json_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = new_workspace(spark, "src_json_stream")
    source = files.stream_json(spark, land_json(spark, sf_dir, f"{work}/in"), bytes_per_batch=EPOCH_BYTES)
    return tables.read_table(spark, streamed(source, work), READING)


@query
def src_rate_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a limited stream gives, epochs above its limit, and whether it took several epochs."""
    work = new_workspace(spark, "src_rate_limit")
    readings = read_readings(spark, sf_dir)
    rows_per_file = max(ROWS_PER_FILE, -(-readings.count() // FULL_FILES))
    readings.write.option("maxRecordsPerFile", rows_per_file).json(f"{work}/in")
    source = files.stream_json(spark, f"{work}/in", files_per_batch=FILES_PER_EPOCH)
    out = tables.read_table(spark, streamed(source, work), READING)
    epochs = epoch_counts(spark, f"{work}/checkpoint").where(F.col("rows_read") > 0)
    taken = epochs.agg(
        F.count_if(F.col("rows_read") > rows_per_file * FILES_PER_EPOCH).alias("epochs_over_limit"),
        (F.count("*") > 1).alias("several_epochs"),
    )
    return side_by_side(aggregates.total(out).withColumnRenamed("n", "n_rows"), taken)


@query
def src_csv_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = new_workspace(spark, "src_csv_stream")
    read_readings(spark, sf_dir).write.option("header", True).csv(f"{work}/in")
    source = files.stream_csv(spark, f"{work}/in", bytes_per_batch=EPOCH_BYTES)
    return tables.read_table(spark, streamed(source, work), READING)


@query
def src_earliest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in the table after each run: the first takes what was there before it, the second adds nothing."""
    work = new_workspace(spark, "src_earliest")
    land_json(spark, sf_dir, f"{work}/in")
    for run in (1, 2):
        out = streamed(files.stream_json(spark, f"{work}/in", bytes_per_batch=EPOCH_BYTES), work)
        tables.write_table(aggregates.total(tables.read_table(spark, out, READING)).withColumn("run", F.lit(run)), f"{work}/runs", "append")
    return tables.read_table(spark, f"{work}/runs")


@query
def src_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = new_workspace(spark, "src_table_scan")
    tables.write_table(bronze_of(read_readings(spark, sf_dir)), f"{work}/bronze")
    return comparable(tables.read_table(spark, f"{work}/bronze", BRONZE))


@query
def src_kafka_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = new_workspace(spark, "src_kafka_decode")
    topic = land_topic(spark, sf_dir, f"{work}/topic")
    source = messages.stream_messages(spark, topic, bytes_per_batch=EPOCH_BYTES)
    return tables.read_table(spark, streamed(decoding.decode_readings(source), work), READING)


@query
def src_missing_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that is there and one that nothing has written yet."""
    missing = f"{new_workspace(spark, 'src_missing_table')}/silver"
    return tables.table_status(spark, {"events": (events_path(sf_dir), EVENTS), "silver": (missing, SILVER)})


@query
def batch_stream_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that one transform gives on the table but not on the stream or the other way round, and those of each."""
    work = new_workspace(spark, "batch_stream_parity")
    out = streamed(readings_in_epochs(spark, sf_dir).transform(bronze_of), work)
    on_table = read_readings(spark, sf_dir).transform(bronze_of).drop("ingestion_time")
    on_stream = tables.read_table(spark, out, BRONZE_STORED)
    return side_by_side(
        compare.count_differences(on_table, on_stream),
        aggregates.total(on_table).withColumnRenamed("n", "n_table"),
        aggregates.total(on_stream).withColumnRenamed("n", "n_stream"),
    )


@query
def replay_to_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = new_workspace(spark, "replay_to_messages")
    jobs.replay_to_files(spark, land_json(spark, sf_dir, f"{work}/in"), f"{work}/topic", TOPIC)
    return comparable(decoding.decode_readings(messages.read_messages(spark, f"{work}/topic")))


@query
def replay_from_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = new_workspace(spark, "replay_from_raw")
    layers.replay_from_raw(spark, landed_raw(spark, sf_dir, work), f"{work}/silver", times.MICROS_PATTERN)
    return comparable(tables.read_table(spark, f"{work}/silver").select(*SILVER.fieldNames()))


def raw_in_parts(spark: SparkSession, sf_dir: str, work: str) -> Iterator[str]:
    """A raw layer that grows by a third of the readings at a time."""
    events = read_events(spark, sf_dir)
    for number, incoming in enumerate(arriving(events, part_number(timeline(events)), range(3), work)):
        arrived = tables.read_table_or_empty(spark, f"{incoming}/part={number}", EVENTS)
        tables.write_table(decoding.as_kafka_rows(messages_of(as_readings(arrived))), f"{work}/topic", "append")
        topic = messages.stream_messages(spark, f"{work}/topic")
        run_until_stopped(jobs.ingest_raw(topic, f"{work}/raw", f"{work}/raw_checkpoint", AVAILABLE_NOW))
        yield f"{work}/raw"


def follow_raw(spark: SparkSession, raw: str, work: str) -> None:
    run_until_stopped(generations.follow_raw(spark, raw, f"{work}/silver", AVAILABLE_NOW, times.MICROS_PATTERN))


@query
def replay_between_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw arrives in three parts; silver follows the first two, is rebuilt, and follows the third."""
    work = new_workspace(spark, "replay_between_streams")
    for number, raw in enumerate(raw_in_parts(spark, sf_dir, work)):
        follow_raw(spark, raw, work)
        if number == 1:
            generations.rebuild(spark, raw, f"{work}/silver", times.MICROS_PATTERN)
    return comparable(generations.read_silver(spark, f"{work}/silver").select(*SILVER.fieldNames()))


# --- cleaning ------------------------------------------------------------------------------


@query
def clean_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.drop_missing(read_readings(spark, sf_dir))


@query
def clean_non_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.drop_negative(read_readings(spark, sf_dir))


@query
def bronze_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(bronze_of(read_readings(spark, sf_dir)))


@query
def silver_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decoding.silver_rejects(read_readings(spark, sf_dir), times.MICROS_PATTERN)


@query
def quality_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.quality_rejects(read_readings(spark, sf_dir))


# --- scalar functions ----------------------------------------------------------------------


@query
def fn_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_events(spark, sf_dir).select("event_id", F.from_json("props", "k INT")["k"].alias("k"))


@query
def fn_parse_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = read_readings(spark, sf_dir, "event_id")
    return comparable(readings.select("event_id", times.parse_iso(F.col("timestamp")).alias("event_time")))


@query
def fn_parse_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = read_readings(spark, sf_dir, "event_id")
    parsed = times.parse_pattern(F.col("timestamp"), times.MICROS_PATTERN)
    return comparable(readings.select("event_id", parsed.alias("event_time")))


@query
def fn_cast_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_readings(spark, sf_dir, "event_id").select(
        "event_id",
        labels.as_text(F.col("device_id").cast("binary")).alias("device_text"),
        labels.as_text(F.col("floor")).alias("floor_text"),
    )


@query
def fn_building_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_readings(spark, sf_dir, "event_id").select("event_id", labels.building_floor().alias("building_floor"))


@query
def fn_to_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = read_readings(spark, sf_dir).select(json.to_payload(*FIELDS).alias("payload"))
    return json.decode(encoded, "payload", READING).select("data.*")


@query
def alert_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = read_readings(spark, sf_dir, "event_id")
    return readings.select("event_id", "type", "value", alerts.alert_level().alias("alert_level"))


# --- silver --------------------------------------------------------------------------------


@query
def silver_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = messages_of(read_readings(spark, sf_dir)).withColumn("timestamp", F.current_timestamp())
    return comparable(decoding.silver_decode(topic, times.MICROS_PATTERN))


@query
def silver_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(silver_of(read_readings(spark, sf_dir)))


@query
def silver_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row arrives in two epochs, and twice in each; one of the four is left."""
    work = new_workspace(spark, "silver_dedup")
    events = read_events(spark, sf_dir)
    delay = timeline(events).delay
    for _ in range(2):
        tables.write_table(events, f"{work}/in", "append")
        source = [silver_of(as_readings(tables.stream_table(spark, f"{work}/in", EVENTS))) for _ in range(2)]
        out = streamed(dedup.dedup_stream(source[0].unionByName(source[1]), delay=delay), work)
    return comparable(tables.read_table(spark, out, SILVER))


def landed_raw(spark: SparkSession, sf_dir: str, work: str) -> str:
    """Send the readings to a topic and land the topic in a raw table."""
    topic = land_topic(spark, sf_dir, f"{work}/topic")
    source = messages.stream_messages(spark, topic, bytes_per_batch=EPOCH_BYTES)
    run_until_stopped(jobs.ingest_raw(source, f"{work}/raw", f"{work}/raw_checkpoint", AVAILABLE_NOW))
    return f"{work}/raw"


@query
def layer_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = tables.read_table(spark, landed_raw(spark, sf_dir, new_workspace(spark, "layer_raw")), RAW)
    return comparable(decoding.decode_readings(layers.raw_messages(raw), keep=["topic"]))


@query
def layer_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = new_workspace(spark, "layer_silver")
    raw = landed_raw(spark, sf_dir, work)
    refine = jobs.refine_silver(
        spark, raw, f"{work}/silver", f"{work}/checkpoint", AVAILABLE_NOW, times.MICROS_PATTERN,
        timeline(read_events(spark, sf_dir)).delay,
    )
    run_until_stopped(refine)
    return comparable(tables.read_table(spark, f"{work}/silver").select(*SILVER.fieldNames()))


@query
def silver_dedup_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All readings arrive, then the same 60 days on, then the first ones again, 60 days late; the stored ones refuse them."""
    work = new_workspace(spark, "silver_dedup_stored")
    events = read_events(spark, sf_dir)
    later = events.withColumn("ts", F.col("ts") + F.expr("interval 60 days"))
    for number, rows in enumerate((events, later, events)):
        sent = decoding.as_kafka_rows(messages_of(as_readings(rows)))
        tables.write_table(layers.raw_rows(sent), f"{work}/raw", "append", ["ingest_date"])
        follow_raw(spark, f"{work}/raw", work)
    return comparable(generations.read_silver(spark, f"{work}/silver").select(*SILVER.fieldNames()))


@query
def silver_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that silver rejects, as they came, with the reason and the epoch."""
    work = new_workspace(spark, "silver_quarantine")
    for raw in raw_in_parts(spark, sf_dir, work):
        follow_raw(spark, raw, work)
    rejects = generations.read_rejects(spark, f"{work}/silver").withColumn("payload", F.col("raw_value").cast("string"))
    return json.decode(rejects, "payload", READING).select("data.*", "topic", "reason", versions.BATCH)


@query
def silver_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every epoch: messages read, readings accepted, messages rejected, and copies refused, as committed with its rows."""
    work = new_workspace(spark, "silver_epochs")
    for raw in raw_in_parts(spark, sf_dir, work):
        follow_raw(spark, raw, work)
    return generations.epoch_report(spark, f"{work}/silver").select(versions.BATCH, "n_read", "n_accepted", "n_rejected", "n_copies")


# --- reads ---------------------------------------------------------------------------------


@query
def agg_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.total(bronze_of(read_readings(spark, sf_dir)))


@query
def agg_by_building(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.counts_by(bronze_of(read_readings(spark, sf_dir)), "building")


@query
def agg_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.counts_by(bronze_of(read_readings(spark, sf_dir)), "type")


@query
def alerts_high(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(bronze_of(read_readings(spark, sf_dir)).filter(F.col("alert_level") == "HIGH"))


@query
def read_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.preview(read_readings(spark, sf_dir, "event_id"), ["event_id"], 20)


@query
def read_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.schema_report(read_events(spark, sf_dir))


@query
def profile_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile_columns(read_readings(spark, sf_dir))


@query
def profile_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all columns, and extremes of the whole numbers, from the file's footer."""
    found = footers.profile_footers(spark, events_path(sf_dir))
    whole = F.col("column_name").isin("event_id", "user_id")  # other engines write fractions another way
    return found.withColumns({name: F.when(whole, F.col(name)) for name in ("min_value", "max_value")})


@query
def profile_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile_per_file(read_events(spark, sf_dir), below=sf_dir)


# --- gold ----------------------------------------------------------------------------------


@query
def gold_temp_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = silver_of(read_readings(spark, sf_dir))
    return comparable(rounded(aggregates.mean_temperature(silver), "avg_temperature"))


@query
def gold_hourly_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(rounded(aggregates.hourly_kpi(silver_of(read_readings(spark, sf_dir))), "avg_value"))


@query
def gold_last_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of unique readings: equal times are settled by the deduplication, so the last value needs no sort."""
    return comparable(aggregates.last_known(dedup.dedup(silver_of(read_readings(spark, sf_dir))), unique_times=True))


def followed(spark: SparkSession, sf_dir: str, work: str, follow, like) -> DataFrame:
    """The table that a following job keeps while silver arrives in three parts."""
    events = read_events(spark, sf_dir)
    line = timeline(events)
    for incoming in arriving(events, part_number(line), range(3), work):
        silver = silver_of(as_readings(tables.stream_table(spark, incoming, EVENTS)))
        run_until_stopped(follow(silver, f"{work}/out", f"{work}/checkpoint", line.delay, AVAILABLE_NOW))
    schema = like(silver_of(read_readings(spark, sf_dir))).schema
    keys = [name for name in ("window_start", "building", "sensor_type") if name in schema.fieldNames()]
    return versions.read_current(spark, f"{work}/out", schema, keys)


@query
def gold_follow_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = new_workspace(spark, "gold_follow_hourly")
    return comparable(rounded(followed(spark, sf_dir, work, jobs.follow_hourly_kpi, aggregates.hourly_kpi), "avg_value"))


@query
def gold_follow_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = new_workspace(spark, "gold_follow_5min")
    kept = followed(spark, sf_dir, work, jobs.follow_temperature, aggregates.mean_temperature)
    return comparable(rounded(kept, "avg_temperature"))


@query
def layer_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw to silver to gold in two rounds, the second of which writes the days it touched; the gold tables, one below the other."""
    work = new_workspace(spark, "layer_gold")
    for number, raw in enumerate(raw_in_parts(spark, sf_dir, work)):
        if number == 0:
            continue
        follow_raw(spark, raw, work)
        gold.refresh_gold(spark, f"{work}/silver", f"{work}/gold")
    written = {name: tables.read_table(spark, f"{work}/gold/{name}") for name in ("temperature_5min", "hourly")}
    written["last_known"] = gold.read_last_known(spark, f"{work}/gold")
    columns = {
        "temperature_5min": ("NULL", "'temperature'", "NULL", "window_start", "avg_temperature", "n"),
        "hourly": ("building", "sensor_type", "NULL", "window_start", "avg_value", "n"),
        "last_known": ("NULL", "NULL", "sensor_id", "last_time", "last_value", "1"),
    }
    parts = [
        written[name].selectExpr(
            f"'{name}' AS kpi",
            f"CAST({building} AS STRING) AS building",
            f"CAST({kind} AS STRING) AS sensor_type",
            f"CAST({sensor} AS STRING) AS sensor_id",
            f"{time} AS time",
            f"round({value}, 6) AS value",
            f"CAST({n} AS BIGINT) AS n",
        )
        for name, (building, kind, sensor, time, value, n) in columns.items()
    ]
    return comparable(reduce(DataFrame.unionByName, parts))


# --- windows -------------------------------------------------------------------------------


def slices(readings: DataFrame) -> DataFrame:
    """Count and mean per five minutes of event time `ts`."""
    mean = [F.count("*").alias("n"), F.avg("value").alias("avg_value")]
    return aggregates.tumbling(readings, "ts", aggregates.FIVE_MINUTES, *mean)


def timed(readings: DataFrame) -> DataFrame:
    return readings.withColumn("ts", F.col("ts").cast("timestamp"))


@query
def win_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(rounded(slices(timed(read_readings(spark, sf_dir, "ts"))), "avg_value"))


@query
def win_watermark_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows are written once the watermark has passed them; the last ones stay open."""
    work = new_workspace(spark, "win_watermark_append")
    closing = slices(timed(stream_readings(spark, sf_dir, "ts")).withWatermark("ts", "10 minutes"))
    return comparable(rounded(tables.read_table(spark, streamed(closing, work)), "avg_value"))


def late_building(spark: SparkSession, sf_dir: str, work: str) -> tuple[DataFrame, Iterator[str]]:
    """The readings, and a folder that receives them in four parts: those of building B come one part later than the others."""
    events = read_events(spark, sf_dir)
    readings = as_readings(events, "ts")
    part = part_number(timeline(events)) + F.col("building").eqNullSafe("B").cast("int")
    return readings, arriving(readings, part, range(4), work)


@query
def win_late_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late rows count while their window is within the tolerance and are dropped beyond it."""
    work = new_workspace(spark, "win_late_data")
    readings, parts = late_building(spark, sf_dir, work)
    for incoming in parts:
        source = timed(tables.stream_table(spark, incoming, readings.schema))
        out = streamed(slices(source.withWatermark("ts", LATE_DELAY)), work)
    return comparable(rounded(tables.read_table(spark, out), "avg_value"))


def split_late(spark: SparkSession, sf_dir: str, work: str) -> StructType:
    """The same readings with the late rows kept aside, in `out`."""
    readings, parts = late_building(spark, sf_dir, work)
    for incoming in parts:
        source = timed(tables.stream_table(spark, incoming, readings.schema)).select(*readings.columns)
        drain(source, late.split_sink(f"{work}/out", "ts", aggregates.FIVE_MINUTES, LATE_DELAY), f"{work}/checkpoint")
    return source.schema


@query
def win_late_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read, kept and late in every epoch."""
    work = new_workspace(spark, "win_late_counts")
    split_late(spark, sf_dir, work)
    return late.split_counts(spark, f"{work}/out")


@query
def win_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that were late, with the epoch they came in."""
    work = new_workspace(spark, "win_late_rows")
    schema = split_late(spark, sf_dir, work)
    return comparable(late.read_split(spark, f"{work}/out", schema, late.LATE))


@query
def win_late_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed windows of the rows that were kept: what the engine's watermark leaves."""
    work = new_workspace(spark, "win_late_kept")
    schema = split_late(spark, sf_dir, work)
    mean = [F.count("*").alias("n"), F.avg("value").alias("avg_value")]
    closed = late.closed_windows(spark, f"{work}/out", schema, "ts", aggregates.FIVE_MINUTES, LATE_DELAY, *mean)
    return comparable(rounded(closed, "avg_value"))


@query
def state_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After each of three runs: windows seen so far, written as closed, and held by the state, read back from it."""
    work = new_workspace(spark, "state_bounded")
    found = []
    for run, incoming in enumerate(in_parts(spark, sf_dir, range(3), work)):
        readings = timed(as_readings(tables.stream_table(spark, incoming, EVENTS), "ts"))
        out = streamed(slices(readings.withWatermark("ts", FORGET)), work)
        # By the parts' own paths: Spark takes two reads of one path for the same, whatever files it has by then.
        arrived = timed(as_readings(spark.read.schema(EVENTS).parquet(*[f"{incoming}/part={part}" for part in range(run + 1)]), "ts"))
        found.append(
            side_by_side(
                aggregates.total(slices(arrived)).withColumnRenamed("n", "n_seen"),
                aggregates.total(tables.read_table(spark, out)).withColumnRenamed("n", "n_closed"),
                state.open_windows(spark, f"{work}/checkpoint").agg(F.sum("n_groups").alias("n_held"), F.min("window_start").alias("oldest_held")),
            ).select(F.lit(run).alias("run"), "*")
        )
    return comparable(reduce(DataFrame.unionByName, found))


# --- output modes --------------------------------------------------------------------------


@query
def mode_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = new_workspace(spark, "mode_append")
    return tables.read_table(spark, streamed(readings_in_epochs(spark, sf_dir), work), READING)


@query
def mode_update_last_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest part arrives first, so that later epochs bring older readings, which must not win."""
    work = new_workspace(spark, "mode_update_last_known")
    for incoming in in_parts(spark, sf_dir, (2, 1, 0), work):
        silver = silver_of(as_readings(tables.stream_table(spark, incoming, EVENTS)))
        run_until_stopped(jobs.follow_last_known(silver, f"{work}/out", f"{work}/checkpoint", AVAILABLE_NOW))
    return comparable(jobs.read_last_known(spark, f"{work}/out"))


@query
def state_last_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensors that have been silent leave the state; the table still has their last value."""
    work = new_workspace(spark, "state_last_known")
    for incoming in in_parts(spark, sf_dir, range(3), work):
        silver = silver_of(as_readings(tables.stream_table(spark, incoming, EVENTS)))
        run_until_stopped(jobs.follow_last_known(silver, f"{work}/out", f"{work}/checkpoint", AVAILABLE_NOW, FORGET))
    held = state.state_rows(spark, f"{work}/checkpoint").select(F.col("key.sensor_id").alias("sensor_id")).distinct()
    known = jobs.read_last_known(spark, f"{work}/out").join(held.withColumn("held", F.lit(True)), "sensor_id", "left")
    return comparable(known.withColumn("held", F.coalesce("held", F.lit(False))))


@query
def mode_complete_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = new_workspace(spark, "mode_complete_counter")
    for incoming in in_parts(spark, sf_dir, range(3), work):
        readings = as_readings(tables.stream_table(spark, incoming, EVENTS))
        errors = aggregates.total(readings.filter(F.col("type") == "error"))
        drain(errors, sinks.snapshot_sink(f"{work}/out"), f"{work}/checkpoint", mode="complete")
    return versions.read_snapshot(spark, f"{work}/out", errors.schema)


# --- sinks and triggers --------------------------------------------------------------------


@query
def sink_append_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = new_workspace(spark, "sink_append_table")
    out = streamed(bronze_of(readings_in_epochs(spark, sf_dir)), work)
    return comparable(tables.read_table(spark, out, BRONZE))


@query
def sink_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream ends after each part and is started again when the next has arrived."""
    work = new_workspace(spark, "sink_resume")
    for incoming in in_parts(spark, sf_dir, range(3), work):
        out = streamed(bronze_of(as_readings(tables.stream_table(spark, incoming, EVENTS))), work)
    return comparable(tables.read_table(spark, out, BRONZE))


def bronze_by_epoch(spark: SparkSession, sf_dir: str, work: str, runs: int = 1) -> str:
    for incoming in in_parts(spark, sf_dir, range(3), work):
        for _ in range(runs):
            bronze = bronze_of(as_readings(tables.stream_table(spark, incoming, EVENTS)))
            drain(bronze, sinks.batch_sink(f"{work}/out"), f"{work}/checkpoint")
    return f"{work}/out"


@query
def sink_exactly_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run is repeated with the same checkpoint; no row doubles."""
    out = bronze_by_epoch(spark, sf_dir, new_workspace(spark, "sink_exactly_once"), runs=2)
    return comparable(versions.read_batches(spark, out, BRONZE).drop(versions.BATCH))


@query
def sink_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve small epochs, of which every four become one folder; the rows, and what is left to list."""
    work = new_workspace(spark, "sink_compacted")
    read_events(spark, sf_dir).repartition(SMALL_EPOCHS).write.parquet(f"{work}/in")
    bronze = bronze_of(as_readings(tables.stream_table(spark, f"{work}/in", EVENTS, files_per_batch=1)))
    drain(bronze, sinks.epoch_sink(f"{work}/out", compact_every=4), f"{work}/checkpoint")
    stored = comparable(versions.read_batches(spark, f"{work}/out", bronze.schema).drop(versions.BATCH))
    return stored.withColumn("n_folders", F.lit(versions.folders_read(spark, f"{work}/out")))


@query
def ingest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every epoch: rows read, by the listener, rows and files written, and whether every committed epoch is there."""
    work = new_workspace(spark, "ingest_metrics")
    for incoming in in_parts(spark, sf_dir, range(3), work):
        bronze = bronze_of(as_readings(tables.stream_table(spark, incoming, EVENTS)))
        drain(bronze.coalesce(1), sinks.batch_sink(f"{work}/out"), f"{work}/checkpoint")
    read = epoch_counts(spark, f"{work}/checkpoint").where(F.col("rows_read") > 0).select(F.col("epoch").alias(versions.BATCH), "rows_read")
    stored = versions.epoch_metrics(spark, f"{work}/out", BRONZE).join(read, versions.BATCH, "left")
    missing = len(epochs_without_counts(spark, f"{work}/checkpoint"))
    return stored.select(versions.BATCH, "rows_read", "n_rows", "n_files", F.lit(missing).alias("n_missing"))


@query
def sink_alert_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = new_workspace(spark, "sink_alert_messages")
    sending = jobs.send_alerts(
        bronze_of(readings_in_epochs(spark, sf_dir)),
        sinks.table_sink(f"{work}/alerts"),
        f"{work}/checkpoint",
        trigger=AVAILABLE_NOW,
    )
    run_until_stopped(sending)
    sent = tables.read_table(spark, f"{work}/alerts")
    return comparable(json.decode(sent, "value", BRONZE).select("data.*"))


@query
def sink_memory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver memory takes only a small result: the counts, not the rows."""
    work = new_workspace(spark, "sink_memory")
    name = "counts_" + work.rsplit("-", 1)[1]
    counts = aggregates.counts_by(bronze_of(readings_in_epochs(spark, sf_dir)), "type", "alert_level")
    drain(counts, sinks.memory_sink(name), f"{work}/checkpoint", mode="complete")
    return spark.table(name)


@query
def trig_available_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = new_workspace(spark, "trig_available_now")
    running = start(
        readings_in_epochs(spark, sf_dir), sinks.table_sink(f"{work}/out"), f"{work}/checkpoint", trigger=AVAILABLE_NOW
    )
    run_until_stopped(running)
    out = aggregates.total(tables.read_table(spark, f"{work}/out", READING))
    return out.withColumn("ended_by_itself", F.lit(not running.isActive))


@query
def trig_processing_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = new_workspace(spark, "trig_processing_time")
    running = start(
        readings_in_epochs(spark, sf_dir), sinks.table_sink(f"{work}/out"), f"{work}/checkpoint", trigger="1 second"
    )
    running.processAllAvailable()
    went_on = running.isActive
    running.stop()
    return aggregates.total(tables.read_table(spark, f"{work}/out", READING)).withColumn("went_on", F.lit(went_on))
