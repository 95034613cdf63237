"""Costly expressions that filters read as well."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluate_once(df: DataFrame, column: Column, name: str) -> DataFrame:
    """Add a costly column that later filters may read without computing it again.

    A filter on a projected column is moved below the projection with the expression copied into
    it, so a JSON document or a time would be parsed once to filter and once to project. A
    generator is a boundary the filter does not cross: one-element array in, one row out. Filters
    on other columns still pass it and reach the scan.
    """
    return df.select("*", F.explode(F.array(column)).alias(name))
