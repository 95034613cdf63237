"""Bronze cleaning and the count of what it rejects."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.alerts import DEFAULT_RULES, AlertRule, alert_level
from ..functions.labels import building_floor
from ..functions.times import parse_iso
from ..schemas import BRONZE, READING

REQUIRED = ("device_id", "value", "timestamp")
ACCEPTED = "accepted"


def drop_missing(df: DataFrame, columns: Sequence[str] = REQUIRED) -> DataFrame:
    """Keep rows in which every named column is set."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in columns]))


def drop_negative(df: DataFrame, column: str = "value", reject_nan: bool = False) -> DataFrame:
    """Keep values of zero and above. Spark sorts NaN above all numbers, so it stays unless rejected."""
    kept = F.col(column) >= 0
    if reject_nan:
        kept = kept & ~F.isnan(column)
    return df.filter(kept)


def bronze_clean(
    readings: DataFrame,
    rules: Sequence[AlertRule] = DEFAULT_RULES,
    reject_nan: bool = False,
) -> DataFrame:
    """Readings to the bronze layout: reject bad rows, parse the time, classify, label the place.

    Filters and projections only: one input split gives one output partition, no shuffle.
    """
    cleaned = drop_negative(drop_missing(readings), reject_nan=reject_nan)
    return cleaned.withColumns(
        {
            "ingestion_time": F.current_timestamp(),
            "timestamp_parsed": parse_iso(F.col("timestamp")),
            "alert_level": alert_level(rules),
            "building_floor": building_floor(),
        }
    ).select(*BRONZE.fieldNames())


def reject_checks(reject_nan: bool = False) -> list[tuple[str, Column]]:
    """Named reasons for which bronze drops a row, in the order they are tested."""
    malformed = reduce(lambda a, b: a & b, [F.col(name).isNull() for name in READING.fieldNames()])
    checks = [("malformed", malformed)]
    checks += [(f"missing_{name}", F.col(name).isNull()) for name in REQUIRED]
    checks.append(("negative_value", F.col("value") < 0))
    if reject_nan:
        checks.append(("nan_value", F.isnan("value")))
    return checks


def reject_reason(reject_nan: bool = False) -> Column:
    """The first failing check, or `accepted`."""
    checks = reject_checks(reject_nan)
    reason = F.when(checks[0][1], checks[0][0])
    for name, failed in checks[1:]:
        reason = reason.when(failed, name)
    return reason.otherwise(ACCEPTED)


def quality_rejects(readings: DataFrame, reject_nan: bool = False) -> DataFrame:
    """Rows per reject reason. Counts are combined before the shuffle, so it moves a few rows per task."""
    return readings.groupBy(reject_reason(reject_nan).alias("reason")).agg(F.count("*").alias("n"))


def observe_quality(readings: DataFrame, name: str = "quality", reject_nan: bool = False) -> DataFrame:
    """Pass rows through and report the same counts per micro-batch in the query's progress.

    The counts ride along with the scan: no second pass and no shuffle.
    """
    reason = reject_reason(reject_nan)
    labels = [label for label, _ in reject_checks(reject_nan)] + [ACCEPTED]
    counts = [F.count_if(reason == label).alias(label) for label in labels]
    return readings.observe(name, F.count(F.lit(1)).alias("input_rows"), *counts)
