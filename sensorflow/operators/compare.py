"""Equality of two tables as bags of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bag_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose number of occurrences differs, with `surplus` = count in left minus count in right.

    Both directions in one shuffle, and equal rows are added up per task before it.
    """
    tagged = left.withColumn("surplus", F.lit(1)).unionByName(right.withColumn("surplus", F.lit(-1)))
    return tagged.groupBy(*left.columns).agg(F.sum("surplus").alias("surplus")).filter("surplus <> 0")


def count_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """How many rows lack a partner on the other side."""
    return bag_difference(left, right).agg(F.coalesce(F.sum(F.abs("surplus")), F.lit(0)).alias("n_diff"))
