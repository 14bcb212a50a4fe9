"""Timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_iso(col: Column) -> Column:
    """ISO-8601 text to TIMESTAMP; unreadable text gives null."""
    return col.try_cast("timestamp")


def iso_now() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


def event_time(col: Column) -> Column:
    """Watermarks need TIMESTAMP; files written without a zone read as TIMESTAMP_NTZ."""
    return col.cast("timestamp")
