"""JSON text to columns and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .once import evaluate_once

# NULL fields stay in the text and times keep their microseconds, so that decoding what was
# encoded gives back the same row.
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def to_payload(*columns: str) -> Column:
    """The named columns as one UTF-8 JSON document."""
    return F.to_json(F.struct(*columns), JSON_OPTIONS).cast("binary")


def from_payload(payload: Column, schema: StructType) -> Column:
    """Parse a JSON payload to a struct. Bad text gives NULL fields, not an error."""
    return F.from_json(payload.cast("string"), schema, JSON_OPTIONS)


def decode(df: DataFrame, payload: str, schema: StructType, name: str = "data") -> DataFrame:
    """Add struct `name` parsed from `payload`, parsing each document once."""
    return evaluate_once(df, from_payload(F.col(payload), schema), name)
