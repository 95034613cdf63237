"""What the operators share: reading a table, work tables in the shared folder, order numbers."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import new_workspace
from ..sources.paths import delete

_INDEX_BITS = 33  # monotonically_increasing_id keeps the row's place within its partition in these bits


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_scratch: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[], None]]:
    """Gives a function that removes the tables stored in the block, once nothing reads them any more.

    Without it they stay until the application ends.
    """
    made: list[str] = []
    _scratch.append(made)

    def release() -> None:
        while made:
            delete(spark, made.pop())

    try:
        yield release
    finally:
        _scratch.pop()  # blocks are nested


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` written as Parquet below the shared folder and read back.

    Cuts the lineage without relying on any executor's disk: what is read back survives the loss
    of executors, and several readers share one computation.
    """
    path = new_workspace(df.sparkSession, label)
    for made in _scratch:
        made.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def width(spark: SparkSession) -> int:
    """Partitions of a shuffle, as the session sets them."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def numbered(df: DataFrame, order: Sequence[Column], name: str, label: str) -> DataFrame:
    """`df` as a stored table with the column `name`: each row's place, from 0, in the stated order.

    Rows are dealt by range and sorted within their partition, so no task sees more than its
    share; only the partitions' counts are added up in one place. Rows that are equal in all of
    `order` stay in one partition: end it with a column that tells repeated rows apart.
    """
    place, part = f"__{name}_place", f"__{name}_part"
    dealt = (
        df.repartitionByRange(width(df.sparkSession), *order)
        .sortWithinPartitions(*order)
        .withColumn(place, F.monotonically_increasing_id())
    )
    dealt = stored(dealt, label).withColumn(part, F.shiftright(place, _INDEX_BITS))
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    before = dealt.groupBy(part).agg(F.count("*").alias("__rows")).select(
        part, F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__before")
    )
    # One row for each partition of the shuffle above: that many at most are broadcast.
    return dealt.join(F.broadcast(before), part).withColumn(
        name, F.col("__before") + F.col(place).bitwiseAND((1 << _INDEX_BITS) - 1)
    ).drop(place, part, "__before")
