"""Gold that follows silver: only the event days that new epochs touched are computed and written again."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregates import hourly_kpi_from_partials, last_known, mean_temperature_from_partials, slice_partials
from ..schemas import LAST_KNOWN
from ..session import pin_utc
from ..sources.paths import exists, read_text, write_text
from ..sources.tables import write_table
from ..streaming.versions import SNAPSHOT, committed, prune, read_snapshot, write_version
from .generations import last_epoch, read_silver
from .layers import by_day

CURSOR = "_cursor"  # the epoch of silver up to which gold has everything


def _cursor(spark: SparkSession, gold_path: str) -> tuple[int, int]:
    """Generation and epoch that gold has; (-1, -1) if there is no gold."""
    place = f"{gold_path}/{CURSOR}"
    if not exists(spark, place):
        return -1, -1
    said = json.loads(read_text(spark, place))
    return said["generation"], said["epoch"]


def refresh_gold(spark: SparkSession, silver_root: str, gold_path: str) -> list[str]:
    """Bring the gold tables up to the newest epoch of silver and return the event days written, in order.

    The KPIs of a day are computed from all its silver rows and replace that day's folders; other
    days are neither read nor written. Last known values are the stored ones and the new epochs'.
    After a rebuild of silver everything is computed anew. The cursor moves last, so a call that
    failed is repeated, with the same result. Days without readings any more, which only a rebuild
    with other rules can bring about, are removed with it.
    """
    pin_utc(spark)
    generation, epoch = last_epoch(spark, silver_root)
    done_generation, done_epoch = _cursor(spark, gold_path)
    if (generation, epoch) == (done_generation, done_epoch):
        return []
    whole = generation != done_generation
    fresh = read_silver(spark, silver_root, after=None if whole else done_epoch, generation=generation)
    # As many days as an epoch has folders.
    days = sorted(row.event_date for row in fresh.select("event_date").distinct().collect())
    if days:
        silver = read_silver(spark, silver_root, generation=generation)
        _write_days(silver if whole else silver.where(F.col("event_date").isin(days)), gold_path, whole)
        known = last_known(fresh, unique_times=True)
        versions = committed(spark, f"{gold_path}/last_known", SNAPSHOT)
        if versions and not whole:
            known = _newer(read_last_known(spark, gold_path), known)
        write_version(known, f"{gold_path}/last_known", SNAPSHOT, versions[-1] + 1 if versions else 0)
        prune(spark, f"{gold_path}/last_known", SNAPSHOT, keep=2)
    write_text(spark, f"{gold_path}/{CURSOR}", json.dumps({"generation": generation, "epoch": epoch}))
    return [str(day) for day in days]


def _newer(old: DataFrame, new: DataFrame) -> DataFrame:
    """The later of two last known values per sensor; of equal times the larger value."""
    latest = old.unionByName(new).groupBy("sensor_id").agg(F.max(F.struct("last_time", "last_value")).alias("latest"))
    return latest.select("sensor_id", "latest.last_time", "latest.last_value")


def _write_days(silver: DataFrame, gold_path: str, whole: bool) -> None:
    """The KPI tables by day, both folded from one pass over silver."""
    slices = slice_partials(silver).persist()
    try:
        for name, rows in (("temperature_5min", mean_temperature_from_partials(slices)), ("hourly", hourly_kpi_from_partials(slices))):
            write_table(by_day(rows, "window_start"), f"{gold_path}/{name}", partition_by=["event_date"], only_days=not whole)
    finally:
        slices.unpersist()


def read_last_known(spark: SparkSession, gold_path: str) -> DataFrame:
    return read_snapshot(spark, f"{gold_path}/last_known", LAST_KNOWN)
