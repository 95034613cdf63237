"""Repeated readings on tables and streams."""

from __future__ import annotations

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sensorflow.operators.decoding import silver_columns
from sensorflow.operators.dedup import dedup, dedup_batch, dedup_stream, first_per_batch
from sensorflow.sources.files import read_json, stream_json
from sensorflow.sources.tables import stream_table, write_table
from sensorflow.streaming.runner import drain
from sensorflow.streaming.sinks import table_sink

from .conftest import Inbox, reading, sample


def test_batch_keeps_the_first_by_order_and_loses_no_key(spark):
    rows = [("s", 1, 9.0, 3), ("s", 1, 8.0, 1), ("s", 2, 7.0, 2), ("t", 1, 6.0, 4)]
    rows += [(None, 1, 5.0, 5), (None, 1, 4.0, 6)]
    df = spark.createDataFrame(rows, "sensor_id string, event_time int, v double, offset int")
    kept = dedup_batch(df, order=["offset"])
    assert kept.columns == df.columns
    assert sorted(row.v for row in kept.collect()) == [5.0, 6.0, 7.0, 8.0]


def test_batch_with_a_third_of_all_rows_in_one_key(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("string").alias("sensor_id"),
        F.lit(0).alias("event_time"),
        F.col("id").alias("offset"),
    )
    kept = dedup_batch(df.repartition(16, "offset"), order=["offset"])
    assert kept.count() == 20_001
    assert kept.filter("sensor_id = '0'").first().offset == 0
    # Each of the 16 tasks sends at most one copy of the hot key.
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("reduce_first", [False, True])
def test_stream_removes_copies_within_and_across_micro_batches(spark, inbox, tmp_path, reduce_first):
    rows = sample(40)
    inbox.add(rows[:25] + rows[:25])
    inbox.add(rows[20:] + rows[30:])
    inbox.add(rows)
    silver = silver_columns(stream_json(spark, inbox.path, files_per_batch=1))
    single = dedup_stream(silver, delay="2 hours", reduce_first=reduce_first)
    query = drain(single, table_sink(f"{tmp_path}/out"), f"{tmp_path}/checkpoint")
    assert len([p for p in query.recentProgress if p.numInputRows]) == 3
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.count() == out.select("sensor_id", "event_time").distinct().count() == 40


@given(order=st.permutations(range(5)))
@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_file_order_does_not_matter_if_the_watermark_covers_it(spark, tmp_path_factory, order):
    folder = tmp_path_factory.mktemp("order")
    box = Inbox(folder / "in")
    rows = sample(50)
    for part in order:
        box.add(rows[part * 10:part * 10 + 10] + rows[:5])
    single = dedup(silver_columns(stream_json(spark, box.path, files_per_batch=1)), delay="1 hour")
    drain(single, table_sink(f"{folder}/out"), f"{folder}/checkpoint")
    streamed = spark.read.parquet(f"{folder}/out").drop("processing_time")
    batch = dedup(silver_columns(read_json(spark, box.path))).drop("processing_time")
    assert streamed.count() == 50
    assert streamed.exceptAll(batch).count() == 0


def test_copies_differing_in_payload_give_one_row(spark, inbox):
    inbox.add([reading(value=2), reading(value=1), reading(value=3)])
    kept = dedup(silver_columns(read_json(spark, inbox.path)))
    assert kept.count() == 1


def test_hot_key_is_reduced_before_the_shuffle(spark, tmp_path):
    """A third of the rows are copies of one reading; the task that owns it sees a few of them."""
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("sensor_id"),
        F.lit("2031-03-09 08:00:00").cast("timestamp").alias("event_time"),
        F.when(F.col("id") % 5 != 0, F.lit("x")).alias("unit"),
    )
    write_table(rows, f"{tmp_path}/in")
    single = dedup_stream(stream_table(spark, f"{tmp_path}/in", rows.schema), reduce_first=True)
    query = drain(single, table_sink(f"{tmp_path}/out"), f"{tmp_path}/checkpoint")
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.count() == out.select("sensor_id").distinct().count() == 40_001
    dropped = query.recentProgress[0].stateOperators[0].customMetrics["numDroppedDuplicateRows"]
    assert 0 < dropped < 100


def test_reduction_keeps_first_rows_and_treats_null_as_a_key():
    batch = pa.RecordBatch.from_pydict({"k": ["a", None, "a", "b", None], "t": [1, 1, 1, 1, 1], "v": [1, 2, 3, 4, 5]})
    (kept,) = first_per_batch(["k", "t"])(iter([batch]))
    assert kept.to_pydict()["v"] == [1, 2, 4]
    (same,) = first_per_batch(["v"])(iter([batch]))
    assert same is batch
    (empty,) = first_per_batch(["k"])(iter([batch.slice(0, 0)]))
    assert empty.num_rows == 0
