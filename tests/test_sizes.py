"""Queries whose work must not outgrow their table, and waits that must not be shorter than the engine takes."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorflow import queries
from sensorflow.adapters import EVENTS
from sensorflow.streaming import runner
from sensorflow.streaming.progress import epoch_counts


def write_events(spark, folder, rows: int) -> str:
    columns = {
        "event_id": F.col("id"),
        "ts": F.timestamp_micros(F.lit(1_704_067_200_000_000) + F.col("id") * 1_000_003).cast("timestamp_ntz"),
        "user_id": F.col("id") % 1500,
        "event_type": F.lit("view"),
        "value": (F.col("id") % 200).cast("double"),
        "props": F.lit('{"k": 1}'),
    }
    events = spark.range(0, rows, 1, 1).select(*[columns[field.name].alias(field.name) for field in EVENTS])
    events.write.parquet(f"{folder}/events.parquet")
    return str(folder)


def test_epochs_of_the_rate_limited_stream_stay_bounded(spark, tmp_path, monkeypatch):
    works = {}

    def new_workspace(_, label):
        return works.setdefault(label, f"{tmp_path}/work")

    monkeypatch.setattr(queries, "new_workspace", new_workspace)
    rows = 60_000
    found = queries.src_rate_limit(spark, write_events(spark, tmp_path / "sf", rows))
    assert [tuple(row) for row in found.collect()] == [(rows, 0, True)]
    epochs = [row.rows_read for row in epoch_counts(spark, f"{works['src_rate_limit']}/checkpoint").collect()]
    assert sum(epochs) == rows
    assert 2 <= len(epochs) <= 45  # 80 with files of 250 rows


def test_rate_limit_of_small_tables_is_250_rows_a_file(spark, tmp_path):
    for rows, several in ((750, False), (751, True)):
        found = queries.src_rate_limit(spark, write_events(spark, tmp_path / f"sf{rows}", rows))
        assert [tuple(row) for row in found.collect()] == [(rows, 0, several)]


def test_a_last_wait_of_less_than_a_millisecond(monkeypatch):
    waits, clock = [], iter([0.0, 0.9999, 1.5])

    class Query:
        isActive = True

        def awaitTermination(self, timeout=None):
            waits.append(timeout)

    monkeypatch.setattr(runner.time, "monotonic", lambda: next(clock, 2.0))
    monkeypatch.setattr(runner, "stop_between_epochs", lambda *_: True)
    runner.run_until_stopped(Query(), timeout=1)
    assert len(waits) == 2 and int(waits[0] * 1000) > 0 and waits[1] is None
