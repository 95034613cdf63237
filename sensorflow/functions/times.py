"""Event-time parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats of the event time. `X` reads the zone, so `Z` means UTC whatever
# the session's zone is.
SECONDS_PATTERN = "yyyy-MM-dd'T'HH:mm:ssX"
MICROS_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSX"


def parse_iso(text: Column) -> Column:
    """ISO-8601 text with a zone to a timestamp; text that is no time gives NULL."""
    return F.try_to_timestamp(text)


def parse_pattern(text: Column, pattern: str = SECONDS_PATTERN) -> Column:
    """Text in a declared pattern to a timestamp; text that does not match gives NULL."""
    return F.try_to_timestamp(text, F.lit(pattern))


def parse_time(text: Column, pattern: str = SECONDS_PATTERN) -> Column:
    """Text in a declared pattern, or else ISO-8601 text, to a timestamp: what one layer reads, all do."""
    return F.coalesce(parse_pattern(text, pattern), parse_iso(text))
