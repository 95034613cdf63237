"""Readings as messages and back."""

from __future__ import annotations

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sensorflow.operators.decoding import (
    as_kafka_rows,
    decode_readings,
    lines_to_messages,
    silver_decode,
    to_messages,
)
from sensorflow.plans import jobs
from sensorflow.schemas import KAFKA_ROW, READING
from sensorflow.sources.files import read_json
from sensorflow.sources.messages import read_messages, stream_kafka, stream_messages
from sensorflow.streaming.runner import drain, run_until_stopped, start
from sensorflow.streaming.sinks import kafka_sink, table_sink

from .conftest import reading, sample


def test_messages_have_the_columns_of_a_kafka_source(spark, inbox):
    inbox.add(sample(12))
    messages = to_messages(read_json(spark, inbox.path), "t", READING.fieldNames(), key="device_id")
    rows = as_kafka_rows(messages, partitions=3)
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in KAFKA_ROW]
    places = rows.select("partition", "offset").collect()
    assert len(set(places)) == 12 and {p.partition for p in places} <= {0, 1, 2}


def test_null_fields_stay_in_the_payload(spark, inbox):
    inbox.add([reading(unit=None)])
    (message,) = to_messages(read_json(spark, inbox.path), "t", READING.fieldNames()).collect()
    assert json.loads(message.value) == reading(unit=None)
    assert message.key is None and message.topic == "t"


def test_lines_become_messages_and_bad_lines_do_not_take_their_neighbours_along(spark, inbox):
    inbox.add([reading(value=1), "not json", "", "[1, 2]", reading(value=2)])
    inbox.add([reading(value=3), '{"cut": '])
    messages = lines_to_messages(spark.read.text(inbox.path), "t")
    assert sorted(json.loads(row.value)["value"] for row in messages.collect()) == [1, 2, 3]
    assert {json.loads(row.value)["unit"] for row in messages.collect()} == {"°C"}


def test_bad_payload_is_dropped_by_silver_and_kept_as_nulls_by_the_decoder(spark):
    rows = [(b"not json",), (b"",), (None,), (json.dumps(reading()).encode(),)]
    messages = spark.createDataFrame(rows, "value binary").withColumn("timestamp", F.current_timestamp())
    assert decode_readings(messages).count() == 4
    assert [row.sensor_id for row in silver_decode(messages).collect()] == ["probe-t-7"]


def test_replay_on_batch_and_stream_gives_the_source_rows(spark, inbox, tmp_path):
    for start in range(0, 30, 10):
        inbox.add(sample(30)[start:start + 10])
    source = read_json(spark, inbox.path)
    jobs.replay_to_files(spark, inbox.path, f"{tmp_path}/topic", "t")
    batch = decode_readings(read_messages(spark, f"{tmp_path}/topic")).drop("kafka_ingest_time")
    assert batch.exceptAll(source).count() == source.exceptAll(batch).count() == 0

    sending = jobs.replay_to_topic(spark, inbox.path, table_sink(f"{tmp_path}/sent"), f"{tmp_path}/checkpoint", "t")
    run_until_stopped(sending)
    sent = spark.read.parquet(f"{tmp_path}/sent").withColumn("timestamp", F.current_timestamp())
    stream = decode_readings(sent).drop("kafka_ingest_time")
    assert stream.exceptAll(source).count() == source.exceptAll(stream).count() == 0


def test_topic_files_as_a_stream(spark, inbox, tmp_path):
    inbox.add(sample(20))
    jobs.replay_to_files(spark, inbox.path, f"{tmp_path}/topic", "t")
    silver = silver_decode(stream_messages(spark, f"{tmp_path}/topic"))
    drain(silver, table_sink(f"{tmp_path}/out"), f"{tmp_path}/checkpoint")
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.count() == 20
    assert out.filter("kafka_ingest_time IS NULL OR processing_time IS NULL OR event_time IS NULL").count() == 0


def test_kafka_without_its_connector_says_so(spark, inbox, tmp_path):
    with pytest.raises(AnalysisException, match="kafka"):
        stream_kafka(spark, "broker:9092", "t", maxOffsetsPerTrigger="1000")
    lines = lines_to_messages(spark.readStream.text(inbox.path), "t")
    with pytest.raises(AnalysisException, match="kafka"):
        start(lines, kafka_sink("broker:9092"), f"{tmp_path}/checkpoint")
