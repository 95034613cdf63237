"""Text-valued helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_text(column: Column) -> Column:
    """Binary or numeric value as string."""
    return column.cast("string")


def building_floor(building: str = "building", floor: str = "floor") -> Column:
    """Location label such as `A-2`; NULL if either part is unknown."""
    return F.concat(F.col(building), F.lit("-"), as_text(F.col(floor)))
