"""Sinks, output modes, triggers and restarts."""

from __future__ import annotations

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from sensorflow.operators.aggregates import counts_by, hourly_kpi, last_known, total
from sensorflow.operators.cleaning import bronze_clean
from sensorflow.operators.decoding import silver_columns
from sensorflow.plans import jobs
from sensorflow.schemas import BRONZE
from sensorflow.session import SHUFFLE_WIDTH, STATE_SETTINGS, state_width
from sensorflow.sources.files import read_json, stream_json
from sensorflow.streaming import versions
from sensorflow.streaming.runner import AVAILABLE_NOW, ONCE, drain, rows_read, run_until_stopped, start
from sensorflow.streaming.sinks import batch_sink, console_sink, memory_sink, snapshot_sink, table_sink

from .conftest import reading, sample


def same(left, right) -> bool:
    return left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def expected_bronze(spark, inbox):
    return bronze_clean(read_json(spark, inbox.path)).drop("ingestion_time")


def test_rate_limit_gives_more_epochs_and_the_same_rows(spark, inbox, tmp_path):
    for start_row in range(0, 60, 10):
        inbox.add(sample(60)[start_row:start_row + 10])
    epochs = {}
    for limit in (1, 4, None):
        stream = stream_json(spark, inbox.path, files_per_batch=limit)
        query = drain(stream, table_sink(f"{tmp_path}/{limit}"), f"{tmp_path}/checkpoint_{limit}")
        epochs[limit] = len(rows_read(query))
        assert same(spark.read.parquet(f"{tmp_path}/{limit}"), read_json(spark, inbox.path))
    assert epochs == {1: 6, 4: 2, None: 1}


def test_restart_goes_on_where_the_stream_stopped(spark, inbox, tmp_path):
    def run():
        stream = bronze_clean(stream_json(spark, inbox.path, files_per_batch=1))
        return rows_read(drain(stream, table_sink(f"{tmp_path}/out"), f"{tmp_path}/out/_checkpoint"))

    rows = sample(50)
    inbox.add(rows[:10])
    inbox.add(rows[10:20])
    assert run() == {0: 10, 1: 10}
    assert not any(run().values())
    for first in (20, 30, 40):
        inbox.add(rows[first:first + 10])
    assert run() == {2: 10, 3: 10, 4: 10}
    assert same(spark.read.parquet(f"{tmp_path}/out").drop("ingestion_time"), expected_bronze(spark, inbox))


def test_epoch_that_fails_after_its_write_is_replayed_without_doubling(spark, inbox, tmp_path):
    for first in range(0, 30, 10):
        inbox.add(sample(30)[first:first + 10])
    out, checkpoint = f"{tmp_path}/out", f"{tmp_path}/checkpoint"

    def failing(writer):
        def write(batch, epoch):
            versions.write_version(batch, out, versions.BATCH, epoch)
            if epoch == 1:
                raise RuntimeError("lost after the write")

        return writer.foreachBatch(write)

    def stream():
        return bronze_clean(stream_json(spark, inbox.path, files_per_batch=1))

    with pytest.raises(StreamingQueryException):
        drain(stream(), failing, checkpoint)
    first_try = versions.read_batches(spark, out, BRONZE).filter("batch_id = 1").first().ingestion_time
    drain(stream(), batch_sink(out), checkpoint)
    result = versions.read_batches(spark, out, BRONZE)
    assert same(result.drop("ingestion_time", "batch_id"), expected_bronze(spark, inbox))
    # The replayed epoch keeps the clock value it was planned with.
    assert result.filter("batch_id = 1").first().ingestion_time == first_try


def test_unfinished_epoch_is_invisible(spark, inbox, tmp_path):
    inbox.add(sample(10))
    out = f"{tmp_path}/out"
    drain(bronze_clean(stream_json(spark, inbox.path)), batch_sink(out), f"{tmp_path}/checkpoint")
    versions.write_version(expected_bronze(spark, inbox), out, versions.BATCH, 1)
    (tmp_path / "out" / "batch_id=1" / versions.COMMITTED).unlink()
    assert versions.committed(spark, out, versions.BATCH) == [0]
    assert versions.read_batches(spark, out, BRONZE).count() == 10


def test_empty_epochs_are_harmless(spark, inbox, tmp_path):
    inbox.add(["not json"])
    inbox.add([])
    inbox.add([reading()])
    for sink, name in ((table_sink(f"{tmp_path}/t"), "a"), (batch_sink(f"{tmp_path}/b"), "b")):
        drain(bronze_clean(stream_json(spark, inbox.path, files_per_batch=1)), sink, f"{tmp_path}/{name}_checkpoint")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 1
    metrics = {row.batch_id: row.n_rows for row in versions.epoch_metrics(spark, f"{tmp_path}/b", BRONZE).collect()}
    assert sum(metrics.values()) == 1


def test_epoch_metrics(spark, inbox, tmp_path):
    inbox.add(sample(10))
    inbox.add(sample(7))
    drain(bronze_clean(stream_json(spark, inbox.path, files_per_batch=1)), batch_sink(f"{tmp_path}/b"), f"{tmp_path}/c")
    rows = versions.epoch_metrics(spark, f"{tmp_path}/b", BRONZE).orderBy("batch_id").collect()
    assert [(row.batch_id, row.n_rows) for row in rows] == [(0, 10), (1, 7)]
    assert all(row.n_files >= 1 and row.n_bytes > 0 for row in rows)


def test_update_mode_keeps_the_latest_by_event_time_not_by_arrival(spark, inbox, tmp_path):
    def at(minute, value, device="d"):
        return reading(device_id=device, timestamp=f"2031-03-09T08:{minute:02d}:00Z", value=value)

    inbox.add([at(30, 3.0), at(10, 1.0)])
    inbox.add([at(20, 2.0), at(5, 7.0, "e")])
    inbox.add([at(30, 4.0), at(1, 9.0, "e")])
    silver = silver_columns(stream_json(spark, inbox.path, files_per_batch=1))
    run_until_stopped(jobs.follow_last_known(silver, f"{tmp_path}/out", f"{tmp_path}/checkpoint", AVAILABLE_NOW))
    schema = last_known(silver).schema

    def current():
        rows = versions.read_current(spark, f"{tmp_path}/out", schema, ["sensor_id"]).collect()
        return {row.sensor_id: row.last_value for row in rows}

    assert current() == {"d": 4.0, "e": 7.0}
    versions.fold_batches(spark, f"{tmp_path}/out", schema, ["sensor_id"])
    assert current() == {"d": 4.0, "e": 7.0}
    inbox.add([at(40, 5.0)])
    silver = silver_columns(stream_json(spark, inbox.path, files_per_batch=1))
    run_until_stopped(jobs.follow_last_known(silver, f"{tmp_path}/out", f"{tmp_path}/checkpoint", AVAILABLE_NOW))
    assert current() == {"d": 5.0, "e": 7.0}
    versions.fold_batches(spark, f"{tmp_path}/out", schema, ["sensor_id"])
    assert versions.committed(spark, f"{tmp_path}/out", versions.BATCH) == [3]
    assert versions.committed(spark, f"{tmp_path}/out", versions.FOLD) == [2, 3]
    assert current() == {"d": 5.0, "e": 7.0}


def test_hourly_kpi_follows_the_stream(spark, inbox, tmp_path):
    rows = sample(90)
    for first in range(0, 90, 30):
        inbox.add(rows[first:first + 30])
    silver = silver_columns(stream_json(spark, inbox.path, files_per_batch=1))
    running = jobs.follow_hourly_kpi(silver, f"{tmp_path}/out", f"{tmp_path}/checkpoint", "2 hours", AVAILABLE_NOW)
    run_until_stopped(running)
    batch = hourly_kpi(silver_columns(read_json(spark, inbox.path)))
    keys = ["window_start", "building", "sensor_type"]
    current = versions.read_current(spark, f"{tmp_path}/out", batch.schema, keys)
    rounded = F.round("avg_value", 9).alias("avg_value")
    columns = [*keys, rounded, "min_value", "max_value", "n"]
    assert same(current.select(*columns), batch.select(*columns))


def test_complete_mode_rewrites_the_result_and_keeps_few_snapshots(spark, inbox, tmp_path):
    for n in (4, 5, 6):
        inbox.add(sample(n))
    counter = total(stream_json(spark, inbox.path, files_per_batch=1))
    drain(counter, snapshot_sink(f"{tmp_path}/out", keep=2), f"{tmp_path}/checkpoint", mode="complete")
    assert versions.read_snapshot(spark, f"{tmp_path}/out", counter.schema).first().n == 15
    assert versions.committed(spark, f"{tmp_path}/out", versions.SNAPSHOT) == [1, 2]


def test_alert_messages(spark, inbox, tmp_path):
    inbox.add([reading(value=30), reading(value=20)])
    inbox.add([reading(type="co2", value=2000), reading(type="humidity", value=1)])
    bronze = bronze_clean(stream_json(spark, inbox.path))
    running = jobs.send_alerts(bronze, table_sink(f"{tmp_path}/out"), f"{tmp_path}/c", trigger=AVAILABLE_NOW)
    run_until_stopped(running)
    sent = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(sent.selectExpr("get_json_object(CAST(value AS STRING), '$.value')").toPandas().iloc[:, 0]) == [
        "2000.0", "30.0"]
    assert {(bytes(row.key), row.topic) for row in sent.collect()} == {(b"probe-t-7", "alerts")}


def test_debug_sinks(spark, inbox, tmp_path):
    inbox.add(sample(9))
    counts = counts_by(bronze_clean(stream_json(spark, inbox.path)), "type")
    drain(counts, memory_sink("debug_counts"), f"{tmp_path}/memory", mode="complete")
    assert {row.type: row.n for row in spark.table("debug_counts").collect()} == dict(
        temperature=3, co2=3, humidity=3)
    query = drain(counts, console_sink(), f"{tmp_path}/console", mode="complete")
    assert rows_read(query) == {0: 9} and query.recentProgress[0].sink.numOutputRows == 3


def test_triggers(spark, inbox, tmp_path):
    inbox.add(sample(5))
    for trigger in (AVAILABLE_NOW, ONCE, "1 second"):
        place = f"{tmp_path}/{trigger.replace(' ', '_')}"
        query = start(stream_json(spark, inbox.path), table_sink(f"{place}/out"), f"{place}/c", trigger=trigger)
        if trigger == "1 second":
            query.processAllAvailable()
            assert query.isActive
            run_until_stopped(query, timeout=0.1)
        else:
            query.awaitTermination()
        assert not query.isActive
        assert spark.read.parquet(f"{place}/out").count() == 5


def test_continuous_trigger_passes_through(spark, tmp_path):
    rate = spark.readStream.format("rate").option("rowsPerSecond", 5).load().select("value")
    query = start(rate, console_sink(1), f"{tmp_path}/c", trigger="continuous 1 second")
    run_until_stopped(query, timeout=3)
    assert not query.isActive and query.exception() is None


def test_starting_a_stream_leaves_the_session_settings_alone(spark, inbox, tmp_path):
    inbox.add(sample(5))
    before = {key: spark.conf.get(key, None) for key in (*STATE_SETTINGS, "spark.sql.shuffle.partitions")}
    counts = counts_by(stream_json(spark, inbox.path), "type")
    query = drain(counts, memory_sink("settings"), f"{tmp_path}/c", mode="complete", state_partitions=3)
    assert query.recentProgress[0].stateOperators[0].numStateStoreInstances == 3
    assert "rocksdb" in str(query.recentProgress[0].stateOperators[0].customMetrics).lower()
    assert before == {key: spark.conf.get(key, None) for key in before}


def test_number_of_state_partitions(spark):
    assert state_width(spark) == {}
    assert state_width(spark, 3) == {SHUFFLE_WIDTH: "3"}
    chosen = spark.conf.get(SHUFFLE_WIDTH)
    spark.conf.unset(SHUFFLE_WIDTH)
    try:
        assert state_width(spark) == {SHUFFLE_WIDTH: "16"}
    finally:
        spark.conf.set(SHUFFLE_WIDTH, chosen)
