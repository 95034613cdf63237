"""Start a stream with a sink, output mode, trigger and checkpoint; wait for it; read its numbers."""

from __future__ import annotations

import signal
import threading
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..session import STATE_SETTINGS, settings, state_width
from .progress import epoch_counts, recorder

Sink = Callable[[DataStreamWriter], DataStreamWriter]

AVAILABLE_NOW = "available now"
ONCE = "once"
CONTINUOUS = "continuous "


def trigger_options(trigger: str) -> dict:
    """`available now`, `once`, `continuous <interval>`, or the interval between micro-batches."""
    if trigger == AVAILABLE_NOW:
        return {"availableNow": True}
    if trigger == ONCE:
        return {"once": True}
    if trigger.startswith(CONTINUOUS):
        return {"continuous": trigger[len(CONTINUOUS):]}
    return {"processingTime": trigger}


def start(
    df: DataFrame,
    sink: Sink,
    checkpoint: str | None = None,
    mode: str = "append",
    trigger: str = AVAILABLE_NOW,
    name: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Start the stream.

    The number of state partitions is fixed by the first run of a checkpoint; see
    `session.state_width` for what it is without `state_partitions`.
    """
    spark = df.sparkSession
    writer = sink(df.writeStream.outputMode(mode).trigger(**trigger_options(trigger)))
    if checkpoint is not None:
        writer = writer.option("checkpointLocation", checkpoint)
    if name is not None:
        writer = writer.queryName(name)
    noted = nullcontext() if checkpoint is None else recorder(spark).of(checkpoint)
    with noted, settings(spark, STATE_SETTINGS), settings(spark, state_width(spark, state_partitions), override=True):
        query = writer.start()
    query.checkpoint = checkpoint
    return query


def drain(
    df: DataFrame,
    sink: Sink,
    checkpoint: str,
    mode: str = "append",
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Process everything that is available, then stop; the finished query carries its progress."""
    query = start(df, sink, checkpoint, mode, AVAILABLE_NOW, state_partitions=state_partitions)
    query.awaitTermination()
    return query


def stop_between_epochs(query: StreamingQuery, patience: float | None = None, poll: float = 0.05) -> bool:
    """Stop the query once the epoch that is running now has ended and is committed; whether it got so far.

    Between two epochs nothing is cut short. Where epochs follow each other without a pause, the next
    one may have begun when the query stops; it has written nothing that counts and is done again at
    the next start. After `patience` seconds the running epoch is cancelled, and done again as well.
    """
    started = time.monotonic()
    last = query.lastProgress
    running = (last.batchId if last else -1) + 1 if query.status["isTriggerActive"] else None
    ended = True
    while running is not None and query.isActive and query.status["isTriggerActive"]:
        last = query.lastProgress
        if last and last.batchId >= running:
            break
        if patience is not None and time.monotonic() - started > patience:
            ended = False
            break
        time.sleep(poll)
    query.stop()
    return ended


def run_until_stopped(query: StreamingQuery, timeout: float | None = None, patience: float | None = None) -> None:
    """Wait for the query; on an interrupt, a request to terminate, or when the time is over, stop it between epochs."""
    until = None if timeout is None else time.monotonic() + timeout
    with _termination() as asked:
        try:
            while query.isActive and not asked.is_set():
                left = None if until is None else until - time.monotonic()
                if left is not None and left <= 0:
                    break
                # The engine counts in whole milliseconds and refuses none.
                query.awaitTermination(1 if left is None else max(0.001, min(1, left)))
        except KeyboardInterrupt:
            pass
        if query.isActive:
            stop_between_epochs(query, patience)
    query.awaitTermination()  # raises what the query failed with


@contextmanager
def _termination() -> Iterator[threading.Event]:
    """An event that a request to terminate the process sets; only the main thread can be told of one."""
    asked = threading.Event()
    if threading.current_thread() is not threading.main_thread():
        yield asked
        return
    before = signal.signal(signal.SIGTERM, lambda *_: asked.set())
    try:
        yield asked
    finally:
        signal.signal(signal.SIGTERM, before)


def _epochs(query: StreamingQuery) -> list:
    return epoch_counts(SparkSession.active(), query.checkpoint).where(F.col("run_id") == str(query.runId)).collect()


def rows_read(query: StreamingQuery) -> dict[int, int]:
    """Source rows per epoch of this run, however many epochs; `progress.epoch_counts` has all runs.

    Rows lost to a watermark are these minus the rows kept: the engine's own dropped-row metric
    counts after partial aggregation.
    """
    return {row.epoch: row.rows_read for row in sorted(_epochs(query))}


def observed(query: StreamingQuery, name: str) -> dict[int, dict]:
    """Counts attached with `DataFrame.observe`, per epoch of this run."""
    return {row.epoch: dict(row.observed[name]) for row in _epochs(query) if name in row.observed}
