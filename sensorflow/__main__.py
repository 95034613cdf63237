"""Command line: `python -m sensorflow <job> ...`, or the same arguments through spark-submit."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.times import SECONDS_PATTERN
from .operators.cleaning import bronze_clean
from .plans import generations, gold, jobs
from .session import pin_utc
from .sources.files import stream_json
from .sources.messages import stream_kafka, stream_messages
from .streaming.runner import run_until_stopped
from .streaming.sinks import kafka_sink, table_sink
from .streaming.versions import BATCH


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="sensorflow")
    commands = root.add_subparsers(dest="job", required=True)

    bronze = commands.add_parser("bronze", help="stream JSONL files into the bronze table")
    bronze.add_argument("--input", required=True)
    bronze.add_argument("--checkpoint", required=True)
    bronze.add_argument("--trigger", default="10 seconds")
    bronze.add_argument("--files-per-batch", type=int, default=1)

    silver = commands.add_parser("silver", help="stream messages into the silver table")
    silver.add_argument("--servers", help="Kafka bootstrap servers")
    silver.add_argument("--topic", required=True, help="Kafka topic, or folder of message files without --servers")
    silver.add_argument("--checkpoint")
    silver.add_argument("--trigger", default="5 seconds")

    replay = commands.add_parser("replay", help="send the lines of JSONL files as messages, once")
    replay.add_argument("--input", required=True)
    replay.add_argument("--servers", help="Kafka bootstrap servers; needs --checkpoint")
    replay.add_argument("--topic", required=True, help="Kafka topic, or folder for message files without --servers")
    replay.add_argument("--checkpoint")

    raw = commands.add_parser("raw", help="land messages untouched, by ingest day")
    raw.add_argument("--servers", help="Kafka bootstrap servers")
    raw.add_argument("--topic", required=True, help="Kafka topic, or folder of message files without --servers")
    raw.add_argument("--checkpoint", required=True)
    raw.add_argument("--trigger", default="5 seconds")

    refine = commands.add_parser("refine", help="follow the raw table into silver: valid readings once, rejects with their reason")
    refine.add_argument("--raw", required=True)
    refine.add_argument("--trigger", default="5 seconds")
    refine.add_argument("--time-pattern", default=SECONDS_PATTERN)

    rebuild = commands.add_parser("rebuild", help="write silver anew from the whole raw table; stop `refine` first")
    rebuild.add_argument("--raw", required=True)
    rebuild.add_argument("--time-pattern", default=SECONDS_PATTERN)

    to_gold = commands.add_parser("gold", help="bring the gold tables up to silver: the days that changed")
    to_gold.add_argument("--gold", required=True)

    alerts = commands.add_parser("alerts", help="send readings of an alert level onward as messages")
    alerts.add_argument("--input", required=True)
    alerts.add_argument("--servers", help="Kafka bootstrap servers")
    alerts.add_argument("--topic", default="alerts", help="Kafka topic, or folder for message files without --servers")
    alerts.add_argument("--checkpoint", required=True)
    alerts.add_argument("--level", default="HIGH")
    alerts.add_argument("--trigger", default="10 seconds")

    last_known = commands.add_parser("last-known-report", help="the last value of every sensor")
    last_known.add_argument("--gold", required=True)
    commands.add_parser("epochs-report", help="rows in and out, copies, files and bytes of silver's epochs, and its latest rejects")
    commands.add_parser("bronze-report", help="preview and counts of the bronze table")
    commands.add_parser("silver-report", help="schema, preview and size of the silver table")
    for name, command in commands.choices.items():
        if name not in ("replay", "alerts", "last-known-report"):
            command.add_argument("--table", required=True)
        if name in ("bronze", "silver", "bronze-report", "silver-report"):
            command.add_argument("--format", default="parquet")
    return root


def incoming(spark: SparkSession, servers: str | None, topic: str) -> DataFrame:
    return stream_kafka(spark, servers, topic) if servers else stream_messages(spark, topic)


def reports(spark: SparkSession, args: argparse.Namespace) -> dict[str, DataFrame]:
    if args.job == "last-known-report":
        return {"last known": gold.read_last_known(spark, args.gold)}
    if args.job == "epochs-report":
        rejects = generations.read_rejects(spark, args.table).withColumn("raw_value", F.col("raw_value").cast("string"))
        return {"epochs": generations.epoch_report(spark, args.table).orderBy(BATCH), "rejects": rejects.orderBy(F.desc(BATCH))}
    report = jobs.bronze_report if args.job == "bronze-report" else jobs.silver_report
    return report(spark, args.table, fmt=args.format)


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = SparkSession.builder.appName(f"sensorflow {args.job}").getOrCreate()
    if args.job == "bronze":
        query = jobs.ingest_bronze(
            spark, args.input, args.table, args.checkpoint, args.trigger, args.files_per_batch, args.format
        )
        run_until_stopped(query)
    elif args.job == "silver":
        messages = incoming(spark, args.servers, args.topic)
        run_until_stopped(jobs.ingest_silver(messages, args.table, args.checkpoint, args.trigger, fmt=args.format))
    elif args.job == "raw":
        run_until_stopped(jobs.ingest_raw(incoming(spark, args.servers, args.topic), args.table, args.checkpoint, args.trigger))
    elif args.job == "refine":
        run_until_stopped(generations.follow_raw(spark, args.raw, args.table, args.trigger, args.time_pattern))
    elif args.job == "rebuild":
        print("generation", generations.rebuild(spark, args.raw, args.table, args.time_pattern))
    elif args.job == "gold":
        print("days written:", *gold.refresh_gold(spark, args.table, args.gold))
    elif args.job == "alerts":
        sink = kafka_sink(args.servers) if args.servers else table_sink(args.topic)
        name = args.topic.rstrip("/").rsplit("/", 1)[-1]
        bronze = bronze_clean(stream_json(pin_utc(spark), args.input))
        run_until_stopped(jobs.send_alerts(bronze, sink, args.checkpoint, name, args.level, args.trigger))
    elif args.job == "replay":
        if args.servers:
            sink = kafka_sink(args.servers)
            run_until_stopped(jobs.replay_to_topic(spark, args.input, sink, args.checkpoint, args.topic))
        else:
            jobs.replay_to_files(spark, args.input, args.topic, args.topic.rstrip("/").rsplit("/", 1)[-1])
    else:
        for title, frame in reports(spark, args).items():
            print(title)
            frame.show(truncate=False)


if __name__ == "__main__":
    main()
