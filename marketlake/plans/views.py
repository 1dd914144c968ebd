"""Serving views over a stored 5-minute candle table (columns of CANDLE plus indicators).

``as_of`` stands for "now"; day-based views count from the start of its day. It is a literal, so the
time filter reaches the Parquet scan and skips files and row groups.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.config import CORRELATION_SYMBOLS
from marketlake.functions import market
from marketlake.operators import rollups


def _now(as_of: datetime | None) -> datetime:
    return as_of or datetime.now(timezone.utc).replace(tzinfo=None)


def _literal(moment: datetime) -> Column:
    """A zone-less literal compares with zone-less and (session UTC) zoned columns alike."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def since_days(days: int, as_of: datetime | None = None, column: str = "interval_start") -> Column:
    """From the start of the day ``days`` before ``as_of``."""
    midnight = _now(as_of).replace(hour=0, minute=0, second=0, microsecond=0)
    return F.col(column) >= _literal(midnight - timedelta(days=days))


def since_hours(hours: int, as_of: datetime | None = None, column: str = "interval_start") -> Column:
    return F.col(column) >= _literal(_now(as_of) - timedelta(hours=hours))


def recent(df: DataFrame, days: int, as_of: datetime | None = None) -> DataFrame:
    """Candles of the last ``days`` days; on a year/month/day layout older directories are not read."""
    kept = df.filter(since_days(days, as_of))
    if {"year", "month", "day"} <= set(df.columns):
        first: date = _now(as_of).date() - timedelta(days=days)
        kept = kept.filter(F.make_date("year", "month", "day") >= F.lit(first))
    return kept


def latest_market_data(candles: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return (
        recent(candles, 1, as_of)
        .select(
            "symbol", "exchange", "interval_start", "interval_end", "open", "high", "low", "close", "volume",
            "trade_count", "vwap", "price_change", "price_change_percentage", "sma_5", "sma_10", "sma_20",
            "rsi", "volatility",
        )
        .orderBy("symbol", F.desc("interval_start"))
    )


def daily_market_summary(candles: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return rollups.daily_summary(recent(candles, 30, as_of))


def exchange_performance(candles: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return rollups.exchange_daily(recent(candles, 7, as_of)).orderBy("exchange", F.desc("date"))


def top_performing_symbols(
    candles: DataFrame, as_of: datetime | None = None, top_k: int | None = None
) -> DataFrame:
    ranked = (
        recent(candles, 1, as_of)
        .filter(F.col("price_change_percentage").isNotNull())
        .select(
            "symbol", "exchange", F.to_date("interval_start").alias("date"), "price_change_percentage",
            "volume", "rsi", "volatility", "interval_start",
        )
        .orderBy(F.desc("price_change_percentage"), "symbol", "exchange", "interval_start")
    )
    return (ranked if top_k is None else ranked.limit(top_k)).drop("interval_start")


def technical_indicators(candles: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return (
        recent(candles, 7, as_of)
        .filter(F.col("sma_20").isNotNull() & F.col("rsi").isNotNull())
        .select(
            "symbol", "exchange", "interval_start", "close", "sma_5", "sma_10", "sma_20", "ema_12", "ema_26",
            "macd", "macd_signal", "macd_histogram", "bb_middle", "bb_upper", "bb_lower", "rsi", "volatility",
            market.trend_signal().alias("trend_signal"), market.rsi_signal().alias("rsi_signal"),
        )
    )


def data_quality_summary(metrics: DataFrame, as_of: datetime | None = None) -> DataFrame:
    first = _now(as_of).date() - timedelta(days=30)
    return (
        metrics.filter(F.col("date") >= F.lit(first))
        .select(
            "exchange", "symbol", "date", "total_records", "valid_records", "invalid_records", "quality_score",
            market.success_rate(F.col("valid_records"), F.col("total_records")).alias("success_rate"),
            "avg_price", "avg_volume", "min_price", "max_price",
        )
        .orderBy(F.desc("date"), F.desc("quality_score"))
    )


def volume_analysis(candles: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return rollups.hourly_volume(recent(candles, 7, as_of)).orderBy("symbol", F.desc("date"), "hour")


def volatility_analysis(candles: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return rollups.daily_volatility(recent(candles, 30, as_of)).orderBy("symbol", F.desc("date"))


def correlation_analysis(
    candles: DataFrame, as_of: datetime | None = None, symbols: tuple[str, ...] = CORRELATION_SYMBOLS
) -> DataFrame:
    # The list filter goes below the aggregation, so only listed symbols are read and grouped.
    listed = recent(candles, 30, as_of).filter(F.col("symbol").isin(*symbols))
    return rollups.pair_correlation(rollups.correlation_pairs(rollups.daily_means(listed), symbols))


def market_sentiment(candles: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return (
        recent(candles, 1, as_of)
        .filter(F.col("rsi").isNotNull() & F.col("macd").isNotNull() & F.col("bb_upper").isNotNull())
        .select(
            "symbol", "exchange", "interval_start", "close", "volume", "rsi", "macd", "macd_signal",
            market.macd_signal_label().alias("macd_signal_label"),
            market.bollinger_signal().alias("bb_signal"),
            market.overall_sentiment().alias("overall_sentiment"),
        )
        .orderBy("symbol", F.desc("interval_start"))
    )


def volatility_threshold(candles: DataFrame, as_of: datetime | None = None, factor: float = 2.0) -> DataFrame:
    """One row: ``factor`` times the mean volatility of the last day."""
    return recent(candles, 1, as_of).agg((F.avg("volatility") * factor).alias("threshold"))


def add_alerts(candles: DataFrame, threshold: Column) -> DataFrame:
    """Alert type and message; the order of the tests is the priority of the alerts."""
    jump = F.abs("price_change_percentage") > 5
    hot, cold = F.col("rsi") > 80, F.col("rsi") < 20
    volatile = F.col("volatility") > threshold
    kind = (
        F.when(jump, "HIGH_VOLATILITY").when(hot | cold, "EXTREME_RSI")
        .when(volatile, "HIGH_VOLATILITY").otherwise("NORMAL")
    )
    text = (
        F.when(jump, "Price change > 5%")
        .when(hot, "RSI > 80 (Overbought)")
        .when(cold, "RSI < 20 (Oversold)")
        .when(volatile, "High volatility detected")
        .otherwise("No alert")
    )
    return candles.withColumns({"alert_type": kind, "alert_message": text})


def real_time_alerts(candles: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Alerting candles of the last hour. The day's threshold is one scalar subquery, computed once."""
    threshold = volatility_threshold(candles, as_of).scalar()
    flagged = add_alerts(recent(candles, 1, as_of).filter(since_hours(1, as_of)), threshold)
    return (
        flagged.filter(F.col("alert_type") != "NORMAL")
        .select(
            "symbol", "exchange", "interval_start", "close", "price_change_percentage", "volume", "rsi",
            "volatility", "alert_type", "alert_message",
        )
        .orderBy(F.desc("interval_start"))
    )


CANDLE_VIEWS: dict[str, Callable[..., DataFrame]] = {
    "v_latest_market_data": latest_market_data,
    "v_daily_market_summary": daily_market_summary,
    "v_exchange_performance": exchange_performance,
    "v_top_performing_symbols": top_performing_symbols,
    "v_technical_indicators": technical_indicators,
    "v_volume_analysis": volume_analysis,
    "v_volatility_analysis": volatility_analysis,
    "v_correlation_analysis": correlation_analysis,
    "v_market_sentiment": market_sentiment,
    "v_real_time_alerts": real_time_alerts,
}


def register_views(
    spark: SparkSession, candles: DataFrame, quality_metrics: DataFrame | None = None, as_of: datetime | None = None
) -> None:
    """Make every view available to SQL under its own name."""
    for name, build in CANDLE_VIEWS.items():
        build(candles, as_of).createOrReplaceTempView(name)
    if quality_metrics is not None:
        data_quality_summary(quality_metrics, as_of).createOrReplaceTempView("v_data_quality_summary")
