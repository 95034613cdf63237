"""Rows that must not get lost without a word."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from sensorflow.operators.cleaning import bronze_clean
from sensorflow.operators.decoding import line_rejects, lines_to_messages, silver_columns, silver_rejects, silver_valid
from sensorflow.operators.dedup import dedup_stream, first_per_batch
from sensorflow.operators.profile import profile_per_file, schema_listing
from sensorflow.schemas import BRONZE, READING
from sensorflow.sources.files import read_json, stream_json
from sensorflow.sources.tables import read_table, stream_table, write_table
from sensorflow.streaming import versions
from sensorflow.streaming.progress import epoch_counts
from sensorflow.streaming.runner import drain, rows_read
from sensorflow.streaming.sinks import batch_sink, table_sink

from .conftest import reading, sample


def test_an_old_file_that_comes_late_is_read(spark, inbox, tmp_path):
    inbox.add(sample(5))
    drain(stream_json(spark, inbox.path), table_sink(f"{tmp_path}/out"), f"{tmp_path}/c")
    inbox.add(sample(3), name="old.json")
    old = time.time() - 3_000 * 86_400
    os.utime(inbox.folder / "old.json", (old, old))
    drain(stream_json(spark, inbox.path), table_sink(f"{tmp_path}/out"), f"{tmp_path}/c")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 8


def test_every_epoch_is_counted(spark, inbox, tmp_path):
    for row in sample(115):
        inbox.add([row])
    query = drain(stream_json(spark, inbox.path, files_per_batch=1), table_sink(f"{tmp_path}/out"), f"{tmp_path}/c")
    assert rows_read(query) == {epoch: 1 for epoch in range(115)}
    inbox.add(sample(4))
    drain(stream_json(spark, inbox.path), table_sink(f"{tmp_path}/out"), f"{tmp_path}/c")
    assert epoch_counts(spark, f"{tmp_path}/c").groupBy().sum("rows_read").first()[0] == 119


def test_epochs_count_where_success_marks_are_off(spark, inbox, tmp_path):
    setting = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set(setting, "false")
    try:
        inbox.add(sample(5))
        drain(bronze_clean(stream_json(spark, inbox.path)), batch_sink(f"{tmp_path}/out"), f"{tmp_path}/c")
    finally:
        conf.unset(setting)
    assert not list((tmp_path / "out").rglob("_SUCCESS"))
    assert versions.read_batches(spark, f"{tmp_path}/out", BRONZE).count() == 5


def test_a_second_checkpoint_cannot_replace_epochs(spark, inbox, tmp_path):
    inbox.add(sample(5))
    drain(bronze_clean(stream_json(spark, inbox.path)), batch_sink(f"{tmp_path}/out"), f"{tmp_path}/c1")
    with pytest.raises(StreamingQueryException, match="new checkpoint needs a new table"):
        drain(bronze_clean(stream_json(spark, inbox.path)), batch_sink(f"{tmp_path}/out"), f"{tmp_path}/c2")
    assert versions.read_batches(spark, f"{tmp_path}/out", BRONZE).count() == 5


@pytest.mark.parametrize("reduce_first", [False, True])
def test_reduction_does_not_hide_rows_from_the_watermark(spark, tmp_path, reduce_first):
    """A late copy comes before an on-time one of the same key, whose time is no part of the key."""
    schema = "id long, t timestamp"
    at = lambda minute: F.lit(f"2031-03-09 10:{minute:02d}:00").cast("timestamp")
    parts = [[(1, 50)], [(9, 5), (9, 52), (2, 51)]]
    for number, rows in enumerate(parts):
        frame = spark.range(len(rows)).coalesce(1).select(
            F.element_at(F.array(*[F.lit(i) for i, _ in rows]), F.col("id").cast("int") + 1).cast("long").alias("id"),
            F.element_at(F.array(*[at(m) for _, m in rows]), F.col("id").cast("int") + 1).alias("t"),
        )
        write_table(frame, f"{tmp_path}/in", "append")
        source = stream_table(spark, f"{tmp_path}/in", spark.createDataFrame([], schema).schema)
        single = dedup_stream(source, ["id"], "t", "10 minutes", reduce_first)
        drain(single, table_sink(f"{tmp_path}/out"), f"{tmp_path}/c")
    assert sorted(row.id for row in spark.read.parquet(f"{tmp_path}/out").collect()) == [1, 2, 9]


def test_reduction_takes_any_column_names():
    import pyarrow as pa

    batch = pa.record_batch({"row": ["a", "a", "b"], "v": [1, 2, 3]})
    (kept,) = first_per_batch(["row"])(iter([batch]))
    assert kept.to_pydict() == {"row": ["a", "b"], "v": [1, 3]}


def test_a_streamed_table_is_not_overwritten(spark, inbox, tmp_path):
    inbox.add(sample(5))
    drain(bronze_clean(stream_json(spark, inbox.path)), table_sink(f"{tmp_path}/out"), f"{tmp_path}/out/_checkpoint")
    with pytest.raises(ValueError, match="belongs to a stream"):
        write_table(spark.range(3), f"{tmp_path}/out")
    inbox.add(sample(4))
    drain(bronze_clean(stream_json(spark, inbox.path)), table_sink(f"{tmp_path}/out"), f"{tmp_path}/out/_checkpoint")
    assert read_table(spark, f"{tmp_path}/out", BRONZE).count() == 9


def test_files_of_partition_folders_are_told_apart(spark, tmp_path):
    df = spark.range(30).select((F.col("id") % 3).alias("p"), F.col("id").alias("v")).coalesce(1)
    df.write.partitionBy("p").parquet(f"{tmp_path}/t")
    profile = profile_per_file(spark.read.parquet(f"{tmp_path}/t"), ["v"], below=str(tmp_path))
    plan = profile._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Sort [" not in plan
    rows = profile.collect()
    assert sorted((row.file_name.split("/")[:2], row.n_rows) for row in rows) == [(["t", f"p={p}"], 10) for p in range(3)]
    listing = schema_listing(df)
    assert [tuple(row) for row in listing.collect()] == [(0, "p", "bigint", True), (1, "v", "bigint", False)] or listing.count() == 2


def test_silver_reads_the_times_that_bronze_reads(spark, inbox):
    texts = ["2031-03-09T08:18:00Z", "2031-03-09T08:18:00.5Z", "2031-03-09T09:18:00+01:00", "2031-03-09T08:18:00", "soon", None]
    inbox.add([reading(timestamp=text, device_id=f"d{i}") for i, text in enumerate(texts)])
    readings = read_json(spark, inbox.path)
    in_bronze = {row.device_id: row.timestamp_parsed for row in bronze_clean(readings).collect() if row.timestamp_parsed}
    in_silver = {row.sensor_id: row.event_time for row in silver_valid(silver_columns(readings)).collect()}
    assert in_silver == in_bronze and len(in_silver) == 4
    assert {row.reason: row.n for row in silver_rejects(readings).collect()} == {"accepted": 4, "unparsed_time": 1, "missing_time": 1}


def test_lines_are_sent_as_they_stand(spark):
    lines = ['{"value":1.50}', ' {"value":NaN,"x":"a, NaN"} ', '{"value":-Infinity}', "not json", "[1]", "", None, '{"value":']
    frame = spark.createDataFrame([(line,) for line in lines], "value string")
    sent = [bytes(row.value).decode() for row in lines_to_messages(frame, "t").collect()]
    assert sent == ['{"value":1.50}', '{"value":NaN,"x":"a, NaN"}', '{"value":-Infinity}']
    assert {row.reason: row.n for row in line_rejects(frame).collect()} == {"accepted": 3, "no_json_object": 5}


def test_a_path_with_pattern_signs_is_read(spark, tmp_path):
    folder = tmp_path / "a[1]{b}"
    folder.mkdir()
    spark.range(4).coalesce(1).write.parquet(f"{tmp_path}/t")
    (file,) = (tmp_path / "t").glob("part-*")
    (folder / "x.parquet").write_bytes(file.read_bytes())
    source = stream_table(spark, f"{folder}/x.parquet", spark.range(1).schema)
    drain(source, table_sink(f"{tmp_path}/out"), f"{tmp_path}/c")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 4
    assert READING
