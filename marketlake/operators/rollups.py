"""Daily and hourly rollups of candle and quality tables.

Every rollup is a grouped aggregation of fixed-width buffers, combined map-side before its one shuffle,
so a hot symbol or exchange costs no more than one row per task and group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_DATE = F.to_date  # calendar day of a candle


def day_open_close() -> tuple[Column, Column]:
    """First open and last close of a group of candles."""
    return F.min_by("open", "interval_start"), F.max_by("close", "interval_start")


def _by_day(candles: DataFrame, *keys: str):
    return candles.withColumn("date", _DATE("interval_start")).groupBy(*keys, "date")


def daily_summary(candles: DataFrame) -> DataFrame:
    first_open, last_close = day_open_close()
    return _by_day(candles, "symbol", "exchange").agg(
        first_open.alias("open_price"),
        last_close.alias("close_price"),
        F.max("high").alias("high_price"),
        F.min("low").alias("low_price"),
        F.sum("volume").alias("total_volume"),
        F.sum("trade_count").alias("total_trades"),
        F.avg("vwap").alias("avg_vwap"),
        F.avg("price_change_percentage").alias("avg_price_change_percentage"),
        F.avg("rsi").alias("avg_rsi"),
        F.avg("volatility").alias("avg_volatility"),
    )


def exchange_daily(candles: DataFrame) -> DataFrame:
    return _by_day(candles, "exchange").agg(
        F.count_distinct("symbol").alias("symbols_traded"),
        F.sum("volume").alias("total_volume"),
        F.sum("trade_count").alias("total_trades"),
        F.avg("price_change_percentage").alias("avg_price_change"),
        F.avg("rsi").alias("avg_rsi"),
        F.avg("volatility").alias("avg_volatility"),
        F.avg("avg_spread_percentage").alias("avg_spread_percentage"),
    )


def hourly_volume(candles: DataFrame) -> DataFrame:
    return (
        candles.withColumns({"date": _DATE("interval_start"), "hour": F.hour("interval_start")})
        .groupBy("symbol", "exchange", "date", "hour")
        .agg(
            F.sum("volume").alias("hourly_volume"),
            F.count(F.lit(1)).alias("candle_count"),
            F.avg("volume").alias("avg_volume_per_candle"),
            F.max("volume").alias("max_volume"),
            F.min("volume").alias("min_volume"),
        )
    )


def daily_volatility(candles: DataFrame) -> DataFrame:
    reach = F.max("high") - F.min("low")
    return _by_day(candles, "symbol", "exchange").agg(
        F.avg("volatility").alias("avg_volatility"),
        F.max("volatility").alias("max_volatility"),
        F.min("volatility").alias("min_volatility"),
        F.stddev_samp("close").alias("price_stddev"),
        (F.try_divide(reach, F.avg("close")) * 100).alias("daily_range_percentage"),
    )


def daily_means(candles: DataFrame) -> DataFrame:
    return _by_day(candles, "symbol", "exchange").agg(
        F.avg("close").alias("avg_price"),
        F.avg("volume").alias("avg_volume"),
        F.avg("volatility").alias("avg_volatility"),
    )


def correlation_pairs(means: DataFrame, symbols: tuple[str, ...]) -> DataFrame:
    """Days two listed symbols share on an exchange, each pair once.

    The list bounds the pairs per day; the inputs are already one row per symbol and day.
    """
    listed = means.filter(F.col("symbol").isin(*symbols))
    left = listed.select("exchange", "date", *[F.col(c).alias(f"{c}_1") for c in _PAIRED])
    right = listed.select("exchange", "date", *[F.col(c).alias(f"{c}_2") for c in _PAIRED])
    return left.join(right, ["exchange", "date"]).filter(F.col("symbol_1") < F.col("symbol_2"))


_PAIRED = ("symbol", "avg_price", "avg_volume", "avg_volatility")


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation; null when either side is constant, where ``corr`` would fail under ANSI."""
    both_x, both_y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(both_x) * F.stddev_pop(both_y))


def pair_correlation(pairs: DataFrame) -> DataFrame:
    measures = [
        correlation(F.col(f"avg_{name}_1"), F.col(f"avg_{name}_2")).alias(f"{name}_correlation")
        for name in ("price", "volume", "volatility")
    ]
    return pairs.groupBy(
        F.col("symbol_1").alias("symbol1"), F.col("symbol_2").alias("symbol2"), "exchange"
    ).agg(*measures)


def daily_stats(candles: DataFrame) -> DataFrame:
    """One row per symbol, exchange and day of an interval's candles."""
    first_open, last_close = day_open_close()
    return (
        _by_day(candles, "symbol", "exchange")
        .agg(
            first_open.alias("open_price"),
            last_close.alias("close_price"),
            F.max("high").alias("high_price"),
            F.min("low").alias("low_price"),
            F.sum("volume").alias("total_volume"),
            F.sum("trade_count").alias("total_trades"),
            F.avg("avg_spread").alias("avg_spread"),
            F.avg("avg_spread_percentage").alias("avg_spread_percentage"),
            F.stddev_samp("close").alias("volatility"),
            F.avg("rsi").alias("rsi_avg"),
        )
        .withColumns(
            {
                "price_change": F.col("close_price") - F.col("open_price"),
                "price_change_percentage": F.try_divide(
                    F.col("close_price") - F.col("open_price"), F.col("open_price")
                ) * 100,
            }
        )
    )


def exchange_performance(candles: DataFrame, quality: DataFrame, minutes: int = 5) -> DataFrame:
    """Daily exchange totals with the day's quality score and the share of buckets that saw a trade.

    A day without quality rows stays, with a null score.
    """
    traded = _by_day(candles, "exchange").agg(
        F.sum("volume").alias("total_volume"),
        F.sum("trade_count").alias("total_trades"),
        F.avg("avg_spread").alias("avg_spread"),
        F.avg("avg_spread_percentage").alias("avg_spread_percentage"),
        (F.count_distinct("interval_start") * 100.0 / (1440 // minutes)).alias("uptime_percentage"),
    )
    scored = quality.groupBy("exchange", "date").agg(
        F.try_divide(
            F.sum(F.col("quality_score") * F.col("total_records")), F.sum("total_records")
        ).alias("data_quality_score")
    )
    return traded.join(scored, ["exchange", "date"], "left")
