"""Time expressions. All results are zone-less, whatever the session zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def from_millis(col: Column | str) -> Column:
    """Epoch milliseconds to a zone-less UTC timestamp."""
    col = F.col(col) if isinstance(col, str) else col
    return F.timestamp_add("MILLISECOND", col, F.lit("1970-01-01").cast("timestamp_ntz"))


def parse_timestamp(col: Column | str, fmt: str | None = None) -> Column:
    """Text to a zone-less timestamp; bad text is an error in ANSI mode."""
    col = F.col(col) if isinstance(col, str) else col
    return F.to_timestamp_ntz(col, F.lit(fmt)) if fmt else col.cast("timestamp_ntz")


def year_bounds(lo: int, hi: int) -> tuple[datetime, datetime]:
    """First moment of year ``lo`` and first moment after year ``hi``."""
    return datetime(lo, 1, 1), datetime(hi + 1, 1, 1)
