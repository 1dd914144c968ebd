"""Price arithmetic and signal labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_of(part: Column, base: Column) -> Column:
    """part / base * 100, null unless base is positive."""
    return F.when(base > 0, F.try_divide(part, base) * 100)


def quoted_spread(bid: Column, ask: Column) -> tuple[Column, Column]:
    """Batch rule: the spread always, its percentage only on a positive bid."""
    return ask - bid, percent_of(ask - bid, bid)


def live_spread(bid: Column, ask: Column) -> tuple[Column, Column]:
    """Stream rule: both values only when both quotes are positive."""
    usable = (bid > 0) & (ask > 0)
    return F.when(usable, ask - bid), F.when(usable, percent_of(ask - bid, bid))


def compare_label(left: Column, right: Column, above: str, below: str, level: str) -> Column:
    return F.when(left > right, above).when(left < right, below).otherwise(level)


def trend_signal() -> Column:
    return compare_label(F.col("close"), F.col("sma_20"), "BULLISH", "BEARISH", "NEUTRAL")


def macd_signal_label() -> Column:
    return compare_label(F.col("macd"), F.col("macd_signal"), "BULLISH", "BEARISH", "NEUTRAL")


def rsi_signal() -> Column:
    rsi = F.col("rsi")
    return F.when(rsi > 70, "OVERBOUGHT").when(rsi < 30, "OVERSOLD").otherwise("NEUTRAL")


def bollinger_signal() -> Column:
    close = F.col("close")
    return (
        F.when(close > F.col("bb_upper"), "OVERBOUGHT")
        .when(close < F.col("bb_lower"), "OVERSOLD")
        .otherwise("NORMAL")
    )


def overall_sentiment() -> Column:
    """First match wins: a momentum-confirmed extreme outranks a bare extreme."""
    hot, cold = F.col("rsi") > 70, F.col("rsi") < 30
    rising = F.col("macd") > F.col("macd_signal")
    falling = F.col("macd") < F.col("macd_signal")
    return (
        F.when(hot & rising, "STRONG_SELL")
        .when(cold & falling, "STRONG_BUY")
        .when(hot, "SELL")
        .when(cold, "BUY")
        .otherwise("HOLD")
    )


def success_rate(valid: Column, total: Column) -> Column:
    """Valid share in percent, two decimals, half away from zero."""
    return F.round(F.try_divide(valid.cast("decimal(20,0)"), total.cast("decimal(20,0)")) * 100, 2)
