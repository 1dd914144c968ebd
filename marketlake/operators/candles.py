"""OHLCV candles.

One interval is one hash aggregation with map-side combine. Several intervals come from one scan: the
finest bucket is aggregated once into mergeable parts, the parts are placed by (symbol, exchange, day),
and every coarser interval is merged from them in place, because all intervals divide a day.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.config import INTERVAL_TABLES
from marketlake.functions.calendar import add_minutes, bucket_start, calendar_parts
from marketlake.functions.parsing import whole_number

SERIES = ("symbol", "exchange")
CANDLE_COLUMNS = (
    "symbol", "exchange", "interval_start", "interval_end", "interval_minutes",
    "open", "high", "low", "close", "volume", "trade_count", "vwap",
    "avg_spread", "avg_spread_percentage", "year", "month", "day", "hour",
)


def trade_order(trades: DataFrame, ts: str = "ts", tie: str = "trade_id") -> Column:
    """Total order of trades inside a bucket: time, then trade id.

    Time and id are packed into one decimal. A fixed-width key keeps the aggregation a hash aggregation; a
    struct key would force every map task to sort its trades first, and is left to composite ids. Text ids
    count as their number, others as a 64-bit hash (any fixed order will do); a missing id comes first.
    """
    kind, trade_id = trades.schema[tie].dataType, F.col(tie)
    if isinstance(kind, T.StringType):
        number = F.coalesce(whole_number(trade_id), F.when(trade_id.isNotNull(), F.xxhash64(trade_id)))
    elif isinstance(kind, T.IntegralType):
        number = trade_id.cast("bigint")
    else:
        return F.struct(F.col(ts), trade_id)
    micros = F.unix_micros(F.col(ts).cast("timestamp")).cast("decimal(18,0)")
    # Wider than the whole range of a 64-bit id, so times never overlap.
    width = F.expr("20000000000000000000BD").cast("decimal(20,0)")
    return micros * width + F.coalesce(number, F.lit(-(2**63))).cast("decimal(19,0)")


def open_close(price: Column, order: Column) -> dict[str, Column]:
    return {"open": F.min_by(price, order), "close": F.max_by(price, order)}


def high_low_volume(price: Column, volume: Column) -> dict[str, Column]:
    return {
        "high": F.max(price),
        "low": F.min(price),
        "volume": F.sum(volume),
        "trade_count": F.count(price),
    }


def weighted_vwap(price: Column, volume: Column) -> Column:
    """Volume-weighted mean price (the ``vwap`` candle column is the plain mean).

    Summed as decimals of the stored scale: the order of the trades can't change the last digits.
    """
    worth, traded = F.sum((price * volume).cast("decimal(30,8)")), F.sum(volume.cast("decimal(20,8)"))
    return F.try_divide(worth.cast("double"), traded.cast("double"))


def candle_parts(trades: DataFrame, minutes: int = 1, **more: Column) -> DataFrame:
    """Mergeable bucket summaries of prepared trades; ``more`` aggregates are added by name."""
    price, spread, percent = F.col("price"), F.col("spread"), F.col("spread_percentage")
    measures = {
        **open_close(price, trade_order(trades)),
        **high_low_volume(price, F.col("volume")),
        "price_sum": F.sum(price),
        "spread_sum": F.sum(spread),
        "spread_count": F.count(spread),
        "percent_sum": F.sum(percent),
        "percent_count": F.count(percent),
        **more,
    }
    # Grouping by the window itself (not its start) keeps a stream's watermark on the key.
    return (
        trades.groupBy(*SERIES, F.window("ts", f"{minutes} minutes").alias("_window"))
        .agg(*[expr.alias(name) for name, expr in measures.items()])
        .select(*SERIES, F.col("_window.start").alias("interval_start"), *measures)
    )


SUMS = ("volume", "trade_count", "price_sum", "spread_sum", "spread_count", "percent_sum", "percent_count")


def merged_measures(first: Column, last: Column) -> list[Column]:
    """Parts of one bucket as one; ``first`` and ``last`` order them by their first and their last trade."""
    return [
        F.min_by("open", first).alias("open"),
        F.max_by("close", last).alias("close"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        *[F.sum(c).alias(c) for c in SUMS],
    ]


def merge_parts(parts: DataFrame, minutes: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """Parts of a coarser bucket. Starts are unique per series, so they order open and close."""
    start = F.col("interval_start")
    return (
        parts.withColumn("_bucket", bucket_start(start, minutes))
        .groupBy(*SERIES, *keep, "_bucket")
        .agg(*merged_measures(start, start))
        .withColumnRenamed("_bucket", "interval_start")
    )


def finish_parts(parts: DataFrame, minutes: int) -> DataFrame:
    start = F.col("interval_start")
    return parts.withColumns(
        {
            "interval_end": add_minutes(start, minutes),
            "interval_minutes": F.lit(minutes),
            "vwap": F.try_divide("price_sum", "trade_count"),
            "avg_spread": F.try_divide("spread_sum", "spread_count"),
            "avg_spread_percentage": F.try_divide("percent_sum", "percent_count"),
            **calendar_parts(start),
        }
    ).select(*CANDLE_COLUMNS)


def candles(trades: DataFrame, minutes: int) -> DataFrame:
    """Candles of one interval from prepared trades."""
    return finish_parts(candle_parts(trades, minutes), minutes)


def candles_all_intervals(trades: DataFrame, intervals: Iterable[int] = tuple(INTERVAL_TABLES)) -> DataFrame:
    """Candles of several day-dividing intervals from a single pass over the trades."""
    wanted = sorted(set(intervals))
    finest = wanted[0]
    if any(minutes % finest or 1440 % minutes for minutes in wanted):
        raise ValueError("intervals must be multiples of the finest one and divide a day")
    placed = (
        candle_parts(trades, finest)
        .withColumn("_day", F.date_trunc("day", F.col("interval_start")))
        .repartition(*SERIES, "_day")
    )
    # The finest level goes through the merge as well: all branches then share one exchange.
    levels = [finish_parts(merge_parts(placed, minutes, keep=("_day",)), minutes) for minutes in wanted]
    return reduce(DataFrame.unionByName, levels)
