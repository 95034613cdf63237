"""Session settings the pipelines rely on, and the shared folder they write to."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

from .sources.paths import delete, delete_on_exit, is_local

SHARED_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"
SHUFFLE_WIDTH = "spark.sql.shuffle.partitions"

# RocksDB keeps streaming state off the JVM heap; changelogs make each commit proportional
# to what the micro-batch changed instead of to the whole state. Counting the rows of a state store
# costs one more lookup per write, so the progress reports no total unless the session asks for it.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}

# Target size of a shuffled partition when a table is written by day: few, large files, but a day of
# many rows is not left to one task.
WRITE_SETTINGS = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m"}


def pin_utc(spark: SparkSession) -> SparkSession:
    """Event times are UTC in every layer, so text with `Z` and stored values agree."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Root for tables and checkpoints: the folder the cluster names in `spark.checkpoint.dir`.

    Without that setting it is a folder of the warehouse, which every executor has to reach as well.
    A warehouse on a machine's own disk, Spark's default, is refused on a cluster: each executor would
    write to another disk. A local path in `spark.checkpoint.dir` is taken at its word, as a mounted share.
    """
    configured = spark.conf.get(SHARED_DIR, None) or spark.sparkContext.getConf().get(SHARED_DIR)
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get(WAREHOUSE_DIR).rstrip("/")
    master = getattr(spark.sparkContext, "master", None)
    if master is not None and not master.startswith("local[") and is_local(spark, warehouse):
        raise ValueError(f"set {SHARED_DIR} to a folder that all machines reach; {warehouse} is each machine's own")
    return f"{warehouse}/_work"


def workspaces(spark: SparkSession) -> str:
    """This application's own corner of the shared folder."""
    return f"{shared_folder(spark)}/sensorflow/{spark.sparkContext.applicationId}"


def new_workspace(spark: SparkSession, label: str) -> str:
    """A fresh folder path below the shared folder; nothing is shared between two calls.

    The folders of an application are removed when it ends, by its file system.
    """
    delete_on_exit(spark, workspaces(spark))
    return f"{workspaces(spark)}/{label}-{uuid.uuid4().hex}"


def remove_workspaces(spark: SparkSession) -> None:
    """Remove this application's work folders, once results read from them are no longer needed."""
    delete(spark, workspaces(spark))


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers, for a driver that was started outside of its folder without `--py-files`.

    Only queries whose tasks run Python need it. Once for a session is enough; Spark hands the file out.
    """
    folder = tempfile.mkdtemp()  # read by the driver only, when it hands the file to Spark
    root = Path(__file__).resolve().parent
    spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/{root.name}", "zip", root.parent, root.name))


def state_width(spark: SparkSession, wanted: int | None = None) -> dict[str, str]:
    """Setting for the number of state partitions of a new stream.

    The number of `wanted`, else what the session has chosen for its shuffles. Without either,
    twice the cores: Spark's default of 200 is too many stores for one machine, and a large
    cluster would leave cores idle.
    """
    if wanted is not None:
        return {SHUFFLE_WIDTH: str(wanted)}
    if spark.conf.get(SHUFFLE_WIDTH, None) is not None:
        return {}
    twice = 2 * spark.sparkContext.defaultParallelism
    local = spark.sparkContext.master.startswith("local")
    return {SHUFFLE_WIDTH: str(twice if local else max(twice, 200))}


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str], override: bool = False) -> Iterator[None]:
    """Apply settings for the duration of the block and put the old ones back.

    A streaming query copies the session's settings when it starts, so starting it inside the
    block is enough. Without `override`, settings the user has chosen are left alone.
    """
    before = {key: spark.conf.get(key, None) for key in values}
    changed = [key for key in values if override or before[key] is None]
    for key in changed:
        spark.conf.set(key, values[key])
    try:
        yield
    finally:
        for key in changed:
            if before[key] is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, before[key])
