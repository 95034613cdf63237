"""The physical plans have the shape they need at scale."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sensorflow import queries
from sensorflow.adapters import read_readings, stream_readings
from sensorflow.operators import aggregates, cleaning, decoding
from sensorflow.plans import jobs
from sensorflow.schemas import BRONZE
from sensorflow.sources.tables import read_table, write_table
from sensorflow.streaming.runner import drain
from sensorflow.streaming.sinks import batch_sink

from .conftest import sample

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def readings(spark):
    return read_readings(spark, SF)


def test_cleaning_and_decoding_do_not_shuffle(readings):
    for df in (cleaning.bronze_clean(readings), queries.silver_of(readings)):
        assert "Exchange" not in plan(df)


def test_each_document_is_parsed_once(spark, readings):
    topic = queries.messages_of(readings).withColumn("timestamp", F.current_timestamp())
    valid = decoding.silver_valid(decoding.silver_decode(topic))
    assert plan(valid).count("from_json(") == 1


def test_filters_and_columns_reach_the_scan(spark, readings, tmp_path):
    write_table(cleaning.bronze_clean(readings), f"{tmp_path}/bronze")
    report = jobs.bronze_report(spark, f"{tmp_path}/bronze")
    assert "EqualTo(alert_level,HIGH)" in plan(report["high_alerts"])
    assert "ReadSchema: struct<building:string>" in plan(report["by_building"])
    assert "CollectLimit" in plan(report["preview"]) and "Sort" not in plan(report["preview"])


@pytest.mark.parametrize(
    "aggregate",
    [
        lambda df: aggregates.counts_by(df, "building"),
        aggregates.mean_temperature,
        aggregates.hourly_kpi,
        aggregates.slice_partials,
        lambda df: aggregates.last_known(df, unique_times=True),
    ],
)
def test_kpis_combine_before_one_shuffle_by_hash(readings, aggregate):
    text = plan(aggregate(queries.silver_of(readings)))
    assert text.count("Exchange") == 1 and "partial_" in text
    assert "SortAggregate" not in text and "Expand" not in text


def test_no_query_leaves_the_jvm_or_joins_everything(spark):
    for name in ("gold_last_known", "quality_rejects", "profile_columns", "batch_stream_parity", "replay_from_raw"):
        text = plan(queries.QUERIES[name](spark, SF))
        assert not any(word in text for word in ("Python", "Pandas", "CartesianProduct", "NestedLoop"))


def test_stored_bronze_has_the_declared_schema(spark, readings, tmp_path):
    write_table(cleaning.bronze_clean(readings), f"{tmp_path}/bronze")
    stored = spark.read.parquet(f"{tmp_path}/bronze").schema
    assert [(f.name, f.dataType) for f in stored] == [(f.name, f.dataType) for f in BRONZE]
    assert read_table(spark, f"{tmp_path}/bronze", BRONZE).count() > 0


def test_streaming_aggregates_combine_before_their_shuffle(spark, tmp_path):
    """The rows of a window or sensor are reduced where they are read, and state is kept per key only."""
    silver = queries.silver_of(stream_readings(spark, SF))
    for name, aggregate in (("hourly", aggregates.hourly_kpi), ("last", aggregates.last_known)):
        place = f"{tmp_path}/{name}"
        query = drain(aggregate(silver), batch_sink(f"{place}/out"), f"{place}/checkpoint", mode="update")
        above, below = query._jsq.explainInternal(False).split("Exchange", 1)
        assert "StateStoreSave" in above and "partial_" in below and "Exchange" not in below


def test_a_machines_own_warehouse_is_refused_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from sensorflow import session

    conf = SimpleNamespace(get=lambda key, default=None: "file:/tmp/warehouse" if key == session.WAREHOUSE_DIR else default)
    named = {}
    context = SimpleNamespace(master="spark://host:7077", getConf=lambda: named)
    cluster = SimpleNamespace(conf=conf, sparkContext=context, _jvm=spark._jvm, _jsc=spark._jsc)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(cluster)
    context.master = "local[4]"
    assert session.shared_folder(cluster) == "file:/tmp/warehouse/_work"
    context.master, named["spark.checkpoint.dir"] = "spark://host:7077", "file:/mnt/share/"
    assert session.shared_folder(cluster) == "file:/mnt/share"


def test_the_chain_runs_from_the_command_line(spark, inbox, tmp_path, capsys):
    import json

    from sensorflow.__main__ import main

    rows = sample(30)
    inbox.add([*rows, rows[0], "junk"])
    lines = spark.createDataFrame([(json.dumps(row),) for row in rows] + [("junk",)], "value string")
    sent = lines.selectExpr("CAST(NULL AS BINARY) AS key", "CAST(value AS BINARY) AS value", "'t' AS topic")
    topic, raw, silver, gold = (f"{tmp_path}/{name}" for name in ("topic", "raw", "silver", "gold"))
    write_table(decoding.as_kafka_rows(sent), topic)
    now = ["--trigger", "available now"]
    main(["raw", "--topic", topic, "--table", raw, "--checkpoint", f"{tmp_path}/c", *now])
    main(["refine", "--raw", raw, "--table", silver, *now])
    main(["gold", "--table", silver, "--gold", gold])
    main(["epochs-report", "--table", silver])
    main(["rebuild", "--raw", raw, "--table", silver])
    main(["gold", "--table", silver, "--gold", gold])
    main(["last-known-report", "--gold", gold])
    main(["alerts", "--input", inbox.path, "--topic", f"{tmp_path}/alerts", "--checkpoint", f"{tmp_path}/ac", *now])
    said = capsys.readouterr().out
    assert said.count("days written: 2031-03-09") == 2 and "generation 1" in said and "no_json_object" in said and "|sensor-2 " in said
    high = cleaning.bronze_clean(spark.read.schema("timestamp string, device_id string, building string, floor int, type string, value double, unit string").json(inbox.path))
    assert read_table(spark, f"{tmp_path}/alerts").count() == high.where("alert_level = 'HIGH'").count() > 0


def test_the_package_can_be_sent_to_the_workers(tmp_path):
    import subprocess
    import sys

    from .conftest import ROOT

    code = f"""
import sys; sys.path.insert(0, {str(ROOT)!r})
from compare_with_sql import local_session
from sensorflow.session import ship_package
spark = local_session(2)
ship_package(spark)
def names(batches):
    import sensorflow.schemas
    for batch in batches:
        yield batch
print("rows", spark.range(5).mapInArrow(names, "id long").count())
"""
    clean = {k: v for k, v in __import__("os").environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=120)
    assert "rows 5" in done.stdout, done.stderr[-800:]
