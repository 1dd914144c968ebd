"""Time buckets and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket_start(ts: Column, minutes: int) -> Column:
    """Start of the epoch-aligned tumbling bucket a time falls in."""
    return F.window(ts, f"{minutes} minutes")["start"]


def add_minutes(ts: Column, minutes: int) -> Column:
    return ts + F.make_dt_interval(mins=F.lit(minutes))


def calendar_parts(ts: Column, *, minute: bool = False) -> dict[str, Column]:
    parts = {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "hour": F.hour(ts),
    }
    if minute:
        parts["minute"] = F.minute(ts)
    return parts


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 (session zone UTC for zone-less times)."""
    return F.unix_seconds(ts.cast("timestamp"))
