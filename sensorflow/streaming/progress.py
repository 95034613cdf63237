"""What each epoch of a query read and counted, kept for every epoch and across restarts.

The progress that a query carries covers about the last hundred epochs of the running process. Here
a listener writes each epoch's numbers to a small file of its own as they come. A session has one
listener, which knows a query's folder from the moment the query exists: it is told of the query
while `start` still waits, before the first epoch can end.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import LongType, MapType, StringType, StructField, StructType

from ..sources.paths import literal, matching, write_text
from ..sources.tables import read_table_or_empty

EPOCHS = "epoch_counts"  # folder below a query's checkpoint
SCHEMA = StructType(
    [
        StructField("run_id", StringType()),
        StructField("epoch", LongType()),
        StructField("rows_read", LongType()),
        StructField("observed", MapType(StringType(), MapType(StringType(), LongType()))),
    ]
)


class EpochRecorder(StreamingQueryListener):
    """Writes the numbers of one session's queries below their checkpoints."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folders: dict[str, str] = {}
        self.starting: str | None = None
        self.lock = threading.Lock()

    @contextmanager
    def of(self, checkpoint: str) -> Iterator[None]:
        """Queries started in the block have this checkpoint. One starts at a time."""
        with self.lock:
            self.starting = f"{checkpoint}/{EPOCHS}"
            try:
                yield
            finally:
                self.starting = None

    def onQueryStarted(self, event) -> None:
        # The engine reports this before `start` returns, and a query's epochs after it.
        if self.starting is not None:
            self.folders[str(event.id)] = self.starting

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        folder = self.folders.get(str(progress.id))
        if folder is None:
            return
        row = {
            "run_id": str(progress.runId),
            "epoch": progress.batchId,
            "rows_read": progress.numInputRows,
            "observed": {name: counts.asDict() for name, counts in progress.observedMetrics.items()},
        }
        write_text(self.spark, f"{folder}/{progress.batchId}.json", json.dumps(row))


_recorders: dict[tuple[str, int], EpochRecorder] = {}


def recorder(spark: SparkSession) -> EpochRecorder:
    """The recorder of this session; a session's listeners hear its own queries only."""
    session = spark.sparkContext.applicationId, spark._jsparkSession.hashCode()
    if session not in _recorders:
        _recorders[session] = EpochRecorder(spark)
        spark.streams.addListener(_recorders[session])
    return _recorders[session]


def epoch_counts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """`epoch`, `rows_read` and the `observed` counts of every epoch, of all runs on the checkpoint."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    return read_table_or_empty(spark, f"{checkpoint}/{EPOCHS}", SCHEMA, "json")


def epochs_without_counts(spark: SparkSession, checkpoint: str) -> list[int]:
    """Committed epochs of a checkpoint that have no numbers, for example those of a driver that died at their end.

    The engine keeps the commits of the last hundred epochs or so; older ones are not looked for.
    """
    commits = {int(name) for path in matching(spark, f"{literal(checkpoint)}/commits/*") if (name := path.rsplit("/", 1)[1]).isdigit()}
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    known = {int(path.rsplit("/", 1)[1].split(".")[0]) for path in matching(spark, f"{literal(checkpoint)}/{EPOCHS}/*.json")}
    return sorted(commits - known)
