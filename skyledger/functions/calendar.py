"""Timestamp parsing and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from skyledger.functions.text import as_column

# fixed value: timestamp format of the raw files
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def parse_timestamp(c: Column | str, fmt: str = TIMESTAMP_FORMAT) -> Column:
    """Timestamp, or NULL for text in any other form."""
    return F.try_to_timestamp(as_column(c), F.lit(fmt))


def cast_timestamp(c: Column | str) -> Column:
    """ISO text as timestamp, or NULL."""
    return as_column(c).try_cast("timestamp")


def calendar_parts(c: Column | str) -> dict[str, Column]:
    ts = as_column(c)
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "hour": F.hour(ts),
    }
