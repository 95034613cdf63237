"""A silver table that is streamed, rebuilt from raw, and streamed on."""

from __future__ import annotations

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from sensorflow.operators import aggregates
from sensorflow.operators.compare import count_differences
from sensorflow.operators.decoding import as_kafka_rows, lines_to_messages, silver_columns, silver_valid
from sensorflow.operators.dedup import dedup_batch
from sensorflow.plans import generations, gold, jobs, layers
from sensorflow.schemas import SILVER, SILVER_BY_DAY
from sensorflow.sources.files import read_json
from sensorflow.sources.messages import stream_messages
from sensorflow.sources.tables import read_table, write_table
from sensorflow.streaming import versions
from sensorflow.streaming.runner import AVAILABLE_NOW, rows_read, run_until_stopped

from .conftest import reading, sample


def test_stream_rebuild_and_stream_again(spark, inbox, tmp_path):
    rows = sample(60)
    raw, root = f"{tmp_path}/raw", f"{tmp_path}/silver"

    def arrive(part):
        inbox.add(part)
        lines = spark.read.text(f"{inbox.path}/part_{inbox.arrived - 1:03d}.json")
        write_table(as_kafka_rows(lines_to_messages(lines, "t")), f"{tmp_path}/topic", "append")
        run_until_stopped(jobs.ingest_raw(stream_messages(spark, f"{tmp_path}/topic"), raw, f"{tmp_path}/c", AVAILABLE_NOW))
        run_until_stopped(generations.follow_raw(spark, raw, root, AVAILABLE_NOW))

    def agrees():
        clocks = ("kafka_ingest_time", "processing_time", "event_date")
        clean = silver_valid(silver_columns(read_json(spark, inbox.path))).drop(*clocks)
        return count_differences(generations.read_silver(spark, root).drop(*clocks), clean.distinct()).first().n_diff == 0

    assert generations.read_silver(spark, root).count() == 0
    arrive(rows[:20])
    arrive(rows[10:30])
    assert agrees()
    assert generations.rebuild(spark, raw, root) == 1
    assert agrees()
    arrive(rows[25:50])  # some copies of what the rebuild has read
    assert agrees()
    arrive(rows[50:])
    assert agrees()
    assert generations.rebuild(spark, raw, root) == 2
    assert agrees()
    for part in ("generation=1/rebuilt", "generation=2/rebuilt"):
        assert [(f.name, f.dataType) for f in spark.read.parquet(f"{root}/{part}").schema] == [(f.name, f.dataType) for f in SILVER_BY_DAY]
    day = generations.read_silver(spark, root).where(F.col("event_date") == "2031-03-09")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "Exchange" not in plan
    assert read_table(spark, f"{root}/generation=2/rebuilt").select(*SILVER.fieldNames()).count() == 60


def test_rows_without_a_later_time_are_followed(spark, inbox, tmp_path):
    rows = sample(12)
    raw, root = f"{tmp_path}/raw", f"{tmp_path}/silver"
    noon = F.lit("2031-03-10 12:00:00").cast("timestamp")
    times = {"first": noon, "older": noon - F.expr("interval 1 hour"), "equal": noon, "null": F.lit(None).cast("timestamp"), "none": F.timestamp_millis(F.lit(-1))}

    def land(part, time):
        inbox.add(part)
        lines = spark.read.text(f"{inbox.path}/part_{inbox.arrived - 1:03d}.json")
        messages = as_kafka_rows(lines_to_messages(lines, "t"), timestamp=times[time])
        write_table(layers.raw_rows(messages), raw, "append", partition_by=["ingest_date"])

    def follow():
        run_until_stopped(generations.follow_raw(spark, raw, root, AVAILABLE_NOW))
        return generations.read_silver(spark, root).count()

    land(rows[:2], "first")
    land(rows[2:3], "null")
    land(rows[3:4], "none")
    assert follow() == 4
    assert generations.rebuild(spark, raw, root) == 1
    assert follow() == 4  # what the rebuild has read is not taken again
    for number, time in enumerate(("older", "equal", "null", "none")):
        land(rows[4 + 2 * number : 6 + 2 * number], time)
        assert follow() == 6 + 2 * number
    assert generations.rebuild(spark, raw, root) == 2
    assert follow() == 12


def land(spark, raw, rows, time="2031-03-10 12:00:00"):
    lines = spark.createDataFrame([(row if isinstance(row, str) else json.dumps(row),) for row in rows], "value string")
    sent = as_kafka_rows(lines.select(F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary"), F.lit("t").alias("topic")), timestamp=F.lit(time).cast("timestamp"))
    write_table(layers.raw_rows(sent), raw, "append", partition_by=["ingest_date"])


def follow(spark, raw, root, **options):
    running = generations.follow_raw(spark, raw, root, AVAILABLE_NOW, **options)
    run_until_stopped(running)
    return sum(rows_read(running).values())


def test_after_a_rebuild_old_raw_files_are_not_read_again(spark, tmp_path):
    raw, root = f"{tmp_path}/raw", f"{tmp_path}/silver"
    rows = sample(60)
    for part in range(4):
        land(spark, raw, rows[10 * part : 10 * part + 10])
    assert follow(spark, raw, root) == 40
    generations.rebuild(spark, raw, root)
    assert follow(spark, raw, root) == 0
    land(spark, raw, rows[35:60])  # five of them are stored already
    assert follow(spark, raw, root) == 25  # the new file and nothing else
    assert generations.read_silver(spark, root).count() == 60
    assert [tuple(r) for r in generations.epoch_report(spark, root).select("n_read", "n_accepted", "n_rejected", "n_copies").collect()] == [(25, 20, 0, 5)]


def test_copies_are_refused_however_late(spark, tmp_path):
    raw, root = f"{tmp_path}/raw", f"{tmp_path}/silver"
    old = [reading(timestamp=f"2031-01-{day:02d}T08:00:00Z", device_id="d") for day in range(1, 21)]
    new = [reading(timestamp=f"2031-06-{day:02d}T08:00:00Z", device_id="d") for day in range(1, 21)]
    for rows in (old, new, old, new + old, [reading(timestamp="2031-01-05T08:00:00Z", device_id="other")], old * 3):
        land(spark, raw, rows)
        follow(spark, raw, root)
    assert generations.read_silver(spark, root).count() == 41
    report = generations.epoch_report(spark, root).orderBy("batch_id").collect()
    assert [(r.n_read, r.n_accepted, r.n_copies) for r in report] == [(20, 20, 0), (20, 20, 0), (20, 0, 20), (40, 0, 40), (1, 1, 0), (60, 0, 60)]


def test_only_days_of_the_epoch_are_read_for_copies(spark, tmp_path):
    raw, root = f"{tmp_path}/raw", f"{tmp_path}/silver"
    land(spark, raw, [reading(timestamp=f"2031-01-{day:02d}T08:00:00Z") for day in range(1, 21)])
    follow(spark, raw, root)
    place = f"{root}/generation=0"
    stored = generations._stored(spark, place)
    fresh = stored.where(F.col("event_date") == "2031-01-07")
    noon = 1_925_000_000_000_000
    spans = [generations.Span(date(2031, 1, 7), noon, noon + 10**12)]
    plan = generations.refuse_stored(fresh, stored, spans)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "sensor_id" in line]
    assert any("event_date" in scan.split("PartitionFilters: ")[1].split("PushedFilters")[0] and "GreaterThanOrEqual(event_time" in scan for scan in scans)


def test_rejected_messages_are_kept_with_their_reason(spark, tmp_path):
    raw, root = f"{tmp_path}/raw", f"{tmp_path}/silver"
    bad = ["no json", '{"device_id": "x"', "[1]", reading(device_id=None), reading(value=None), reading(timestamp="yesterday"), reading(timestamp=None), reading(value=-1.0)]
    land(spark, raw, [reading(), *bad, reading()])
    follow(spark, raw, root)
    kept = {(r.raw_value.decode(), r.reason) for r in generations.read_rejects(spark, root).collect()}
    reasons = ["no_json_object", "no_json_object", "no_json_object", "missing_sensor_id", "missing_value", "unparsed_time", "missing_time", "negative_value"]
    assert kept == {(row if isinstance(row, str) else json.dumps(row), reason) for row, reason in zip(bad, reasons)}
    report = generations.epoch_report(spark, root).first()
    assert (report.n_read, report.n_accepted, report.n_rejected, report.n_copies) == (10, 1, 8, 1)
    assert report.n_files >= 2 and report.n_bytes > 0


def test_a_replayed_epoch_writes_both_outputs_once(spark, tmp_path, monkeypatch):
    """The driver dies after the rows are written and before, or after, the mark; the epoch is run again."""
    raw, root = f"{tmp_path}/raw", f"{tmp_path}/silver"
    rows = sample(20)
    land(spark, raw, [*rows[:10], "junk"])
    follow(spark, raw, root)
    for fails_at in ("write_text", "after"):
        land(spark, raw, [*rows[10:], "more junk"] if fails_at == "write_text" else [*rows, "junk again"])
        real = versions.write_text if fails_at == "write_text" else generations.write_version

        def fail(*arguments, **named):
            if fails_at == "after":
                real(*arguments, **named)
            raise RuntimeError("gone")

        with monkeypatch.context() as patch:
            patch.setattr(*((versions, "write_text") if fails_at == "write_text" else (generations, "write_version")), fail)
            with pytest.raises(Exception, match="gone"):
                follow(spark, raw, root)
        follow(spark, raw, root)
    assert generations.read_silver(spark, root).count() == 20
    assert sorted(r.raw_value.decode() for r in generations.read_rejects(spark, root).collect()) == ["junk", "junk again", "more junk"]
    assert [r.n_copies for r in generations.epoch_report(spark, root).orderBy("batch_id").collect()] == [0, 0, 20]


def test_silver_goes_on_while_its_epochs_are_compacted(spark, tmp_path):
    raw, root = f"{tmp_path}/raw", f"{tmp_path}/silver"
    rows = sample(60)
    for part in range(6):
        land(spark, raw, [*rows[10 * part : 10 * part + 10], "junk"])
        follow(spark, raw, root, compact_every=2)
    land(spark, raw, rows)
    follow(spark, raw, root, compact_every=2)
    assert generations.read_silver(spark, root).count() == 60
    assert generations.read_rejects(spark, root).count() == 6
    assert versions.folders_read(spark, f"{root}/generation=0/epochs") == 2


def days_written(gold, name):
    return {path.parent.name.split("=")[1]: sorted(f.name for f in path.parent.glob("*.parquet")) for path in gold.glob(f"{name}/event_date=*/*.parquet")}


def test_gold_writes_changed_days_only(spark, tmp_path):
    raw, root, path = f"{tmp_path}/raw", f"{tmp_path}/silver", tmp_path / "gold"
    days = ["2031-03-01", "2031-03-02", "2031-03-03"]
    land(spark, raw, [reading(timestamp=f"{day}T{hour:02d}:00:00Z", device_id=f"d{hour}", value=float(hour)) for day in days for hour in range(5)])
    assert gold.refresh_gold(spark, root, str(path)) == []
    follow(spark, raw, root)
    assert gold.refresh_gold(spark, root, str(path)) == days
    before = {name: days_written(path, name) for name in ("hourly", "temperature_5min")}
    assert gold.refresh_gold(spark, root, str(path)) == []
    land(spark, raw, [reading(timestamp="2031-03-02T03:30:00Z", device_id="d3", value=9.0), reading(timestamp="2031-03-02T03:00:00Z", device_id="d3", value=3.0)])
    follow(spark, raw, root)
    assert gold.refresh_gold(spark, root, str(path)) == ["2031-03-02"]
    for name, files in before.items():
        now = days_written(path, name)
        assert now["2031-03-01"] == files["2031-03-01"] and now["2031-03-03"] == files["2031-03-03"] and now["2031-03-02"] != files["2031-03-02"]

    def agrees():
        silver = generations.read_silver(spark, root)
        hourly = read_table(spark, f"{path}/hourly").drop("event_date")
        assert count_differences(hourly, aggregates.hourly_kpi(silver).select(*hourly.columns)).first().n_diff == 0
        assert count_differences(gold.read_last_known(spark, str(path)), aggregates.last_known(silver)).first().n_diff == 0

    agrees()
    generations.rebuild(spark, raw, root)
    assert gold.refresh_gold(spark, root, str(path)) == days
    agrees()
    land(spark, raw, [reading(timestamp="2031-03-04T00:00:00Z", device_id="d0"), reading(timestamp="2031-02-01T00:00:00Z", device_id="d1")])
    follow(spark, raw, root)
    assert gold.refresh_gold(spark, root, str(path)) == ["2031-02-01", "2031-03-04"]
    agrees()


def test_large_epochs_refuse_the_same_copies(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(generations, "MANY_ROWS", 0, raising=False)
    raw, root = f"{tmp_path}/raw", f"{tmp_path}/silver"
    old = [reading(timestamp=f"2031-01-{day:02d}T08:00:00Z", device_id="d") for day in range(1, 11)]
    new = [reading(timestamp=f"2031-06-{day:02d}T08:00:00Z", device_id="d") for day in range(1, 11)]
    for rows in (old * 2, new + old, old, [reading(timestamp="2031-01-05T08:00:00Z", device_id="other"), reading(value=-1.0)]):
        land(spark, raw, rows)
        follow(spark, raw, root)
    report = generations.epoch_report(spark, root).orderBy("batch_id").collect()
    assert [(r.n_read, r.n_accepted, r.n_rejected, r.n_copies) for r in report] == [(20, 10, 0, 10), (20, 10, 0, 10), (10, 0, 0, 10), (2, 1, 1, 0)]
    stored = generations._stored(spark, f"{root}/generation=0")
    spans = [generations.Span(date(2031, 1, 5), 0, 2 * 10**15)]
    fresh = spark.createDataFrame(stored.limit(2).collect(), stored.schema)
    plan = generations.refuse_stored(fresh, stored, spans, many=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1


def test_one_raw_file_is_decoded_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(generations, "DECODE_SETTINGS", {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m"}, raising=False)
    payload = F.to_json(F.struct(
        F.date_format(F.timestamp_seconds(F.lit(1_925_000_000) + F.col("id")), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        F.concat(F.lit("d-"), F.col("id")).alias("device_id"), F.col("id").cast("double").alias("value"),
    ))
    sent = spark.range(0, 120_000, 1, 1).select(F.lit(None).cast("binary").alias("key"), payload.cast("binary").alias("value"), F.lit("t").alias("topic"))
    layers.raw_rows(as_kafka_rows(sent)).write.parquet(f"{tmp_path}/raw")
    tasks = []

    def seen(rows, **options):
        per_task = rows.groupBy(F.spark_partition_id()).count().collect()
        tasks.extend(row["count"] for row in per_task)
        return dedup_batch(rows, **options)

    monkeypatch.setattr(generations, "dedup_batch", seen)
    said = generations.write_epoch(spark.read.parquet(f"{tmp_path}/raw"), 0, f"{tmp_path}/place")
    assert said == {"read": 120_000, "accepted": 120_000, "rejected": 0}
    assert sum(tasks) == 120_000 and max(tasks) < 60_000
