"""Landing-path keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketlake.functions.calendar import calendar_parts


def landing_time(own: Column, present: Column, now: Column) -> Column:
    """Time a record is filed under: its ``own`` event time, 1970 when it names none, ``now`` when unreadable.

    The event time is what candles use too, so a record is always filed under the day its candle is in.
    """
    epoch = F.timestamp_millis(F.lit(0).cast("bigint"))
    return F.coalesce(
        own.cast("timestamp"),
        F.when(present, now.cast("timestamp")).otherwise(epoch),
    )


def partition_columns(exchange: Column, symbol: Column, at: Column) -> dict[str, Column]:
    """Directory levels. Two-digit text, so directory names sort like the times they hold."""
    parts = calendar_parts(at)
    return {
        "exchange": F.coalesce(exchange, F.lit("unknown")),
        "symbol": F.coalesce(symbol, F.lit("unknown")),
        "year": parts["year"].cast("string"),
        **{level: F.lpad(parts[level].cast("string"), 2, "0") for level in ("month", "day", "hour")},
    }


def partition_key(exchange: Column, symbol: Column, at: Column) -> Column:
    levels = partition_columns(exchange, symbol, at)
    tail = [F.concat(F.lit(f"{name}="), levels[name]) for name in ("year", "month", "day", "hour")]
    return F.concat_ws("/", levels["exchange"], levels["symbol"], *tail)
