"""Hand-made readings through the bronze and silver rules."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sensorflow.operators.cleaning import bronze_clean, observe_quality, quality_rejects
from sensorflow.operators.decoding import silver_columns, silver_valid
from sensorflow.schemas import BRONZE, READING, SILVER
from sensorflow.sources.files import read_json, stream_json
from sensorflow.streaming.runner import drain, observed
from sensorflow.streaming.sinks import table_sink

from .conftest import reading


@pytest.fixture
def bronze_of(spark, inbox):
    def run(*rows, **options):
        inbox.add(list(rows))
        return bronze_clean(read_json(spark, inbox.path), **options).collect()

    return run


@pytest.mark.parametrize(
    ("kind", "value", "level"),
    [
        ("temperature", 28, "LOW"),
        ("temperature", 28.01, "HIGH"),
        ("co2", 1000, "LOW"),
        ("co2", 1001, "HIGH"),
        ("humidity", 29.9, "MEDIUM"),
        ("humidity", 30, "LOW"),
        ("humidity", 70, "LOW"),
        ("humidity", 70.1, "MEDIUM"),
        ("energy_consumption", 9999, "LOW"),
        ("vibration", 9999, "LOW"),
        (None, 9999, "LOW"),
    ],
)
def test_alert_boundaries(bronze_of, kind, value, level):
    assert bronze_of(reading(type=kind, value=value))[0].alert_level == level


def test_zero_is_kept_and_impossible_values_are_not(bronze_of):
    rows = bronze_of(reading(value=0), reading(value=-0.1), reading(value=None), reading(value="3.0"))
    assert [row.value for row in rows] == [0.0]


def test_nan_is_kept_as_high_unless_rejected(spark, inbox):
    inbox.add(['{"timestamp":"2031-03-09T08:18:00Z","device_id":"d","type":"temperature","value":NaN}'])
    readings = read_json(spark, inbox.path)
    assert [row.alert_level for row in bronze_clean(readings).collect()] == ["HIGH"]
    assert bronze_clean(readings, reject_nan=True).count() == 0


def test_bronze_needs_device_and_time_and_silver_only_the_value(spark, inbox):
    inbox.add([reading(device_id=None), reading(timestamp=None), reading(value=-4.0), reading(value=None)])
    readings = read_json(spark, inbox.path)
    assert bronze_clean(readings).count() == 0
    assert silver_columns(readings).count() == 3
    assert silver_valid(silver_columns(readings)).count() == 0


def test_unreadable_time_stays_in_bronze_without_a_time(bronze_of):
    rows = bronze_of(reading(timestamp="bad"))
    assert [row.timestamp_parsed for row in rows] == [None]


@pytest.mark.parametrize("floor", [2.5, "2"])
def test_wrongly_typed_field_is_null_and_the_row_survives(bronze_of, floor):
    (row,) = bronze_of(reading(floor=floor))
    assert (row.floor, row.building_floor, row.value) == (None, None, 21.5)


def test_malformed_line_and_unknown_field(bronze_of):
    rows = bronze_of("not json", reading(extra=1))
    assert len(rows) == 1
    assert "extra" not in rows[0].asDict()


def test_building_floor_is_text_and_null_if_a_part_is_unknown(bronze_of):
    rows = bronze_of(reading(), reading(building=None), reading(floor=None))
    assert [row.building_floor for row in rows] == ["A-2", None, None]


def test_bronze_layout(spark, inbox):
    inbox.add([reading()])
    bronze = bronze_clean(read_json(spark, inbox.path))
    assert [(f.name, f.dataType) for f in bronze.schema] == [(f.name, f.dataType) for f in BRONZE]
    silver = silver_valid(silver_columns(read_json(spark, inbox.path)))
    assert [(f.name, f.dataType) for f in silver.schema] == [(f.name, f.dataType) for f in SILVER]


def test_same_instant_in_both_layers_whatever_the_session_zone(spark, inbox):
    inbox.add([reading()])
    readings = read_json(spark, inbox.path)
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    bronze = bronze_clean(readings).select(F.unix_timestamp("timestamp_parsed").alias("t")).first().t
    silver = silver_columns(readings).select(F.unix_timestamp("event_time").alias("t")).first().t
    assert bronze == silver == 1930810680


REJECTED = [
    "not json",
    "[1,",
    reading(device_id=None, value=None),
    reading(value=None),
    reading(timestamp=None),
    reading(value=-1),
    reading(),
    reading(timestamp="bad"),
]
REASONS = {
    "malformed": 2,
    "missing_device_id": 1,
    "missing_value": 1,
    "missing_timestamp": 1,
    "negative_value": 1,
    "accepted": 2,
}


def test_each_rejected_row_is_counted_under_its_first_reason(spark, inbox):
    inbox.add(REJECTED)
    counts = {row.reason: row.n for row in quality_rejects(read_json(spark, inbox.path)).collect()}
    assert counts == REASONS


def test_reject_counts_per_micro_batch(spark, inbox, tmp_path):
    inbox.add(REJECTED)
    inbox.add([reading(value=-1), reading()])
    stream = bronze_clean(observe_quality(stream_json(spark, inbox.path, files_per_batch=1)))
    query = drain(stream, table_sink(f"{tmp_path}/out"), f"{tmp_path}/checkpoint")
    counts = observed(query, "quality")
    assert counts[0] == {"input_rows": 8} | REASONS
    assert counts[1]["negative_value"] == 1 and counts[1]["accepted"] == 1
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3


def test_ingestion_time_is_one_value_per_micro_batch(spark, inbox, tmp_path):
    for _ in range(2):
        inbox.add([reading(), reading(value=3)])
    stream = bronze_clean(stream_json(spark, inbox.path, files_per_batch=1))
    drain(stream, table_sink(f"{tmp_path}/out"), f"{tmp_path}/checkpoint")
    times = [row.ingestion_time for row in spark.read.parquet(f"{tmp_path}/out").collect()]
    assert None not in times and len(times) == 4 and len(set(times)) == 2


def test_declared_schema_is_used_as_is(spark, inbox):
    inbox.add([reading(value=862)])
    assert read_json(spark, inbox.path).schema == READING
