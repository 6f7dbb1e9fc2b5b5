"""Time helpers.  Session time zone is UTC; batch outputs keep TIMESTAMP_NTZ."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_time(c) -> Column:
    """TIMESTAMP (LTZ) form of an NTZ column, needed by watermarks."""
    return _col(c).cast("timestamp")


def epoch_micros(c) -> Column:
    return F.unix_micros(_col(c).cast("timestamp"))


def epoch_seconds(c) -> Column:
    return F.unix_seconds(_col(c).cast("timestamp"))


def seconds_to_ts(c) -> Column:
    """Epoch seconds -> TIMESTAMP_NTZ (UTC wall clock)."""
    return F.timestamp_seconds(_col(c)).cast("timestamp_ntz")


def local_day(c, offset_hours: int = 8) -> Column:
    """Calendar day of ``c`` in a fixed UTC offset (UTC+8 midnight boundary)."""
    return F.to_date(_col(c) + F.expr(f"INTERVAL {int(offset_hours)} HOURS"))


def time_slice(c, seconds: int) -> Column:
    """Monotone slice number of a timestamp: floor(epoch / width)."""
    return F.floor(epoch_micros(c) / F.lit(int(seconds) * 1_000_000)).cast("bigint")
