"""Stored tables, layers, reports and the shared folder."""

from __future__ import annotations

import shutil

import pytest
from pyspark.sql import functions as F

from sensorflow import session
from sensorflow.__main__ import main
from sensorflow.operators.aggregates import hourly_kpi, last_known, mean_temperature
from sensorflow.operators.cleaning import bronze_clean
from sensorflow.operators.compare import bag_difference, count_differences
from sensorflow.operators.decoding import silver_columns, silver_valid
from sensorflow.operators.profile import profile_columns, profile_per_file
from sensorflow.plans import jobs, layers
from sensorflow.schemas import BRONZE, RAW, SILVER, conform
from sensorflow.sources.files import read_json, stream_csv, stream_json
from sensorflow.sources.messages import stream_messages
from sensorflow.sources.tables import read_table, read_table_or_empty, stream_table, table_status, write_table
from sensorflow.streaming.runner import AVAILABLE_NOW, drain, run_until_stopped
from sensorflow.streaming.sinks import table_sink

from .conftest import reading, sample


def test_missing_table_reads_as_empty_and_other_errors_are_not_hidden(spark, tmp_path):
    empty = read_table_or_empty(spark, f"{tmp_path}/nowhere", SILVER)
    assert empty.schema == SILVER and empty.count() == 0
    with pytest.raises(Exception, match="no_such_format"):
        read_table_or_empty(spark, f"{tmp_path}/nowhere", SILVER, fmt="no_such_format")


def test_table_status(spark, inbox, tmp_path):
    inbox.add(sample(4))
    write_table(bronze_clean(read_json(spark, inbox.path)), f"{tmp_path}/bronze")
    (tmp_path / "hollow").mkdir()
    places = {name: (f"{tmp_path}/{name}", BRONZE) for name in ("bronze", "hollow", "nowhere")}
    assert {tuple(row) for row in table_status(spark, places).collect()} == {
        ("bronze", True, 4), ("hollow", False, 0), ("nowhere", False, 0)}


def test_files_outside_the_manifest_are_not_part_of_a_streamed_table(spark, inbox, tmp_path):
    inbox.add(sample(4))
    out = tmp_path / "out"
    drain(bronze_clean(stream_json(spark, inbox.path)), table_sink(str(out)), f"{tmp_path}/checkpoint")
    part = next(out.glob("*.parquet"))
    shutil.copy(part, out / "stray.parquet")
    assert read_table(spark, str(out), BRONZE).count() == 4


def test_single_file_and_folder_can_be_streamed(spark, inbox, tmp_path):
    inbox.add(sample(6))
    readings = read_json(spark, inbox.path).coalesce(1)
    write_table(readings, f"{tmp_path}/folder.parquet")
    shutil.copy(next((tmp_path / "folder.parquet").glob("part*.parquet")), tmp_path / "file.parquet")
    for name in ("folder", "file"):
        stream = stream_table(spark, f"{tmp_path}/{name}.parquet", readings.schema)
        drain(stream, table_sink(f"{tmp_path}/{name}_out"), f"{tmp_path}/{name}_checkpoint")
        assert spark.read.parquet(f"{tmp_path}/{name}_out").count() == 6


def test_csv_stream(spark, tmp_path, inbox):
    inbox.add(sample(6) + [reading(unit=None, building=None)])
    readings = read_json(spark, inbox.path)
    readings.write.option("header", True).csv(f"{tmp_path}/csv")
    drain(stream_csv(spark, f"{tmp_path}/csv"), table_sink(f"{tmp_path}/out"), f"{tmp_path}/checkpoint")
    assert count_differences(spark.read.parquet(f"{tmp_path}/out"), readings).first().n_diff == 0


def test_partitioned_write_does_not_make_a_file_per_task_and_day(spark, tmp_path):
    days = spark.range(10_000).repartition(16).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 10).alias("day"), "id")
    write_table(days, f"{tmp_path}/out", partition_by=["day"])
    assert len(list((tmp_path / "out").glob("day=*"))) == 10
    assert len(list((tmp_path / "out").glob("day=*/*.parquet"))) <= 20
    assert spark.read.parquet(f"{tmp_path}/out").count() == 10_000


def test_bag_difference_counts_occurrences(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "x string")
    right = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "x string")
    assert {tuple(row) for row in bag_difference(left, right).collect()} == {("a", 1), ("c", -1)}
    assert count_differences(left, right).first().n_diff == 2
    assert count_differences(left, left).first().n_diff == 0


def test_conform_casts_or_nulls(spark):
    df = spark.createDataFrame([("7", "x")], "floor string, sensor_value string")
    row = conform(df, SILVER).first()
    assert (row.floor, row.sensor_value, row.sensor_id) == (7, None, None)


def test_profiles(spark, tmp_path):
    df = spark.createDataFrame([("a", -0.0), ("b", 0.0), (None, 2.5)], "k string, v double").coalesce(1)
    assert {tuple(row) for row in profile_columns(df).collect()} == {
        ("k", 3, 1, "a", "b"), ("v", 3, 0, "0.0", "2.5")}
    df.write.parquet(f"{tmp_path}/t")
    df.filter("k = 'b'").write.mode("append").parquet(f"{tmp_path}/t")
    rows = profile_per_file(spark.read.parquet(f"{tmp_path}/t"), ["v"]).collect()
    assert sorted((row.n_rows, row.max_value) for row in rows) == [(1, "0.0"), (3, "2.5")]
    assert len({row.file_name for row in rows}) == 2


def test_layers_from_topic_to_gold(spark, inbox, tmp_path):
    rows = sample(60)
    inbox.add(rows[:30] + ["not json", reading(device_id=None), reading(value=-1)])
    inbox.add(rows[20:])
    jobs.replay_to_files(spark, inbox.path, f"{tmp_path}/topic", "t")
    topic = stream_messages(spark, f"{tmp_path}/topic")
    run_until_stopped(jobs.ingest_raw(topic, f"{tmp_path}/raw", f"{tmp_path}/raw_cp", AVAILABLE_NOW))
    raw = read_table(spark, f"{tmp_path}/raw", RAW)
    assert raw.count() == 72 and raw.select("ingest_date").distinct().count() == 1

    refine = jobs.refine_silver(spark, f"{tmp_path}/raw", f"{tmp_path}/silver", f"{tmp_path}/cp", AVAILABLE_NOW,
                                delay="1 day")
    run_until_stopped(refine)
    silver = read_table(spark, f"{tmp_path}/silver", SILVER).select(*SILVER.fieldNames())
    layers.replay_from_raw(spark, f"{tmp_path}/raw", f"{tmp_path}/replayed")
    replayed = read_table(spark, f"{tmp_path}/replayed", SILVER).select(*SILVER.fieldNames())
    clean = silver_valid(silver_columns(read_json(spark, inbox.path))).drop("kafka_ingest_time", "processing_time")
    for table in (silver, replayed):
        unclocked = table.drop("kafka_ingest_time", "processing_time")
        assert count_differences(unclocked, clean.distinct()).first().n_diff == 0
    assert (tmp_path / "replayed" / "event_date=2031-03-09").is_dir()

    paths = layers.write_gold(spark, f"{tmp_path}/replayed", f"{tmp_path}/gold")
    for name, direct in (
        ("temperature_5min", mean_temperature(replayed)),
        ("hourly", hourly_kpi(replayed)),
        ("last_known", last_known(replayed)),
    ):
        doubles = {c: F.round(c, 9) for c, kind in direct.dtypes if kind == "double"}
        stored = spark.read.parquet(paths[name]).drop("event_date").withColumns(doubles)
        assert count_differences(stored, direct.withColumns(doubles)).first().n_diff == 0, name


def test_command_line(spark, inbox, tmp_path, capsys):
    inbox.add(sample(30))
    table, checkpoint = f"{tmp_path}/bronze", f"{tmp_path}/checkpoint"
    main(["bronze", "--input", inbox.path, "--table", table, "--checkpoint", checkpoint, "--trigger", "available now"])
    main(["bronze-report", "--table", table])
    main(["replay", "--input", inbox.path, "--topic", f"{tmp_path}/topic"])
    silver = f"{tmp_path}/silver"
    main(["silver", "--topic", f"{tmp_path}/topic", "--table", silver, "--trigger", "available now"])
    main(["silver-report", "--table", silver])
    main(["silver-report", "--table", f"{tmp_path}/nowhere"])
    assert spark.read.parquet(silver).count() == spark.read.parquet(table).count() == 30
    printed = capsys.readouterr().out
    assert "high_alerts" in printed and "sensor_value" in printed


def test_reports(spark, inbox, tmp_path):
    inbox.add(sample(60))
    write_table(bronze_clean(read_json(spark, inbox.path)), f"{tmp_path}/bronze")
    report = jobs.bronze_report(spark, f"{tmp_path}/bronze")
    assert report["preview"].count() == 20 and report["total"].first().n == 60
    assert {row.building: row.n for row in report["by_building"].collect()} == {"A": 30, "B": 30}
    assert {row.type: row.n for row in report["by_type"].collect()} == {"temperature": 20, "co2": 20, "humidity": 20}
    assert {row.alert_level for row in report["high_alerts"].collect()} == {"HIGH"}


def test_shared_folder_comes_from_the_session(spark):
    folder = spark.conf.get(session.SHARED_DIR)
    assert session.shared_folder(spark) == folder.rstrip("/")
    first, second = (session.new_workspace(spark, "x") for _ in range(2))
    assert first != second and first.startswith(folder) and spark.sparkContext.applicationId in first


def test_without_the_setting_work_goes_below_the_warehouse():
    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Context:
        def getConf(self):
            return Conf({})

    class Session:
        conf = Conf({"spark.sql.warehouse.dir": "hdfs://x/warehouse/"})
        sparkContext = Context()

    assert session.shared_folder(Session()) == "hdfs://x/warehouse/_work"


def test_table_format_is_a_parameter(spark, inbox, tmp_path):
    inbox.add(sample(8))
    running = jobs.ingest_bronze(spark, inbox.path, f"{tmp_path}/t", f"{tmp_path}/c", AVAILABLE_NOW, fmt="orc")
    run_until_stopped(running)
    assert list((tmp_path / "t").rglob("*.orc"))
    assert jobs.bronze_report(spark, f"{tmp_path}/t", fmt="orc")["total"].first().n == 8


def test_work_folders_can_be_removed(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path))
    work = session.new_workspace(spark, "x")
    spark.range(3).write.parquet(f"{work}/t")
    (tmp_path / "other").mkdir()
    session.remove_workspaces(spark)
    assert [path.name for path in tmp_path.iterdir()] in (["sensorflow", "other"], ["other", "sensorflow"])
    assert not any((tmp_path / "sensorflow").iterdir())
