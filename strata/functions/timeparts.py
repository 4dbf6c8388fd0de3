"""Epoch conversions and calendar parts, all built-in Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ms_to_ts(ms: Column | str) -> Column:
    """Epoch milliseconds -> TIMESTAMP, milliseconds kept."""
    return F.timestamp_millis(_c(ms))


def epoch_ms_to_ts_seconds(ms: Column | str) -> Column:
    """Epoch milliseconds -> TIMESTAMP truncated to whole seconds (integer division)."""
    return F.timestamp_seconds(F.floor(_c(ms) / 1000).cast("long"))


# Weekday numberings used by the three star-schema builds:
#   "spark":     Sunday=1 .. Saturday=7
#   "pandas":    Monday=0 .. Sunday=6
#   "warehouse": Sunday=0 .. Saturday=6
WEEKDAY_CONVENTIONS = ("spark", "pandas", "warehouse")


def weekday(ts: Column | str, convention: str = "spark") -> Column:
    ts = _c(ts)
    if convention == "spark":
        return F.dayofweek(ts)
    if convention == "pandas":
        return F.weekday(ts)
    if convention == "warehouse":
        return F.dayofweek(ts) - 1
    raise ValueError(f"unknown weekday convention {convention!r}")


def time_parts(ts: Column | str, convention: str = "spark") -> list[Column]:
    """hour, day, week (ISO), month, year, weekday of a timestamp column."""
    ts = _c(ts)
    return [
        F.hour(ts).alias("hour"),
        F.dayofmonth(ts).alias("day"),
        F.weekofyear(ts).alias("week"),
        F.month(ts).alias("month"),
        F.year(ts).alias("year"),
        weekday(ts, convention).alias("weekday"),
    ]


def start_time_text(ts: Column | str, twelve_hour: bool = False) -> Column:
    """Timestamp as 'yyyy-MM-dd HH:mm:ss' text.  ``twelve_hour=True`` reproduces a
    'hh' pattern (21:01:46 -> 09:01:46, no am/pm marker -- ambiguous, off by default)."""
    return F.date_format(_c(ts), "yyyy-MM-dd hh:mm:ss" if twelve_hour else "yyyy-MM-dd HH:mm:ss")
