"""Counts and KPIs. Every aggregate here is combined per task before its shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIVE_MINUTES = "5 minutes"
HOUR = "1 hour"


def plain_zero(column: str) -> Column:
    """Minus zero as zero: the two compare equal, so which one is the minimum would depend on row order."""
    return F.col(column) + F.lit(0.0)


def total(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def counts_by(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per combination of the columns; NULL is a group of its own."""
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def tumbling(df: DataFrame, event_time: str, width: str, *aggregates: Column, by: Sequence[str] = ()) -> DataFrame:
    """Aggregates per event-time slice, and per `by` columns if given."""
    grouped = df.groupBy(F.window(event_time, width), *by).agg(*aggregates)
    names = [name for name in grouped.columns if name != "window"]
    return grouped.select(F.col("window.start").alias("window_start"), *names)


def mean_temperature(silver: DataFrame, width: str = FIVE_MINUTES) -> DataFrame:
    """Mean temperature per slice of event time."""
    return tumbling(
        silver.filter(F.col("sensor_type") == "temperature"),
        "event_time",
        width,
        F.avg("sensor_value").alias("avg_temperature"),
        F.count("sensor_value").alias("n"),
    )


def hourly_kpi(silver: DataFrame, width: str = HOUR) -> DataFrame:
    """Mean, extremes and count per hour, building and sensor type."""
    return tumbling(
        silver,
        "event_time",
        width,
        F.avg("sensor_value").alias("avg_value"),
        F.min(plain_zero("sensor_value")).alias("min_value"),
        F.max(plain_zero("sensor_value")).alias("max_value"),
        F.count("sensor_value").alias("n"),
        by=("building", "sensor_type"),
    )


def slice_partials(silver: DataFrame, width: str = FIVE_MINUTES) -> DataFrame:
    """Sum, count and extremes per slice, building and type: enough to derive every mean KPI.

    Coarser KPIs are folded from this small table, so silver is read once however many there are.
    """
    return tumbling(
        silver,
        "event_time",
        width,
        F.sum("sensor_value").alias("sum_value"),
        F.min(plain_zero("sensor_value")).alias("min_value"),
        F.max(plain_zero("sensor_value")).alias("max_value"),
        F.count("sensor_value").alias("n"),
        by=("building", "sensor_type"),
    )


def mean_temperature_from_partials(partials: DataFrame) -> DataFrame:
    per_slice = partials.filter(F.col("sensor_type") == "temperature").groupBy("window_start")
    return per_slice.agg(
        (F.sum("sum_value") / F.sum("n")).alias("avg_temperature"),
        F.sum("n").alias("n"),
    )


def hourly_kpi_from_partials(partials: DataFrame, width: str = HOUR) -> DataFrame:
    return tumbling(
        partials,
        "window_start",
        width,
        (F.sum("sum_value") / F.sum("n")).alias("avg_value"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
        F.sum("n").alias("n"),
        by=("building", "sensor_type"),
    )


def last_known(
    df: DataFrame,
    key: str = "sensor_id",
    event_time: str = "event_time",
    value: str = "sensor_value",
    unique_times: bool = False,
    by: Sequence[str] = (),
) -> DataFrame:
    """The reading with the latest event time per key, and per `by` columns if given; equal times are settled by the larger value.

    Arrival order plays no part, so an old reading that arrives late cannot replace a newer one.
    On deduplicated rows there are no equal times to settle: `unique_times` then lets Spark use a
    hash aggregate, several times faster than the sort that comparing pairs needs.
    """
    if unique_times:
        return df.groupBy(*by, key).agg(
            F.max(event_time).alias("last_time"), F.max_by(value, event_time).alias("last_value")
        )
    latest = df.groupBy(*by, key).agg(F.max(F.struct(event_time, value)).alias("latest"))
    return latest.select(
        *by,
        key,
        F.col(f"latest.{event_time}").alias("last_time"),
        F.col(f"latest.{value}").alias("last_value"),
    )
