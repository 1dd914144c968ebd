"""Declared row types. Names and widths follow the warehouse tables this engine fills."""

from __future__ import annotations

from pyspark.sql import types as T

_D = T.DoubleType()
_S = T.StringType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


TRADE = _struct(
    ("exchange", _S), ("symbol", _S), ("timestamp", _S), ("price", _D), ("volume", _D),
    ("bid", _D), ("ask", _D), ("trade_id", _S), ("quality_score", _D),
)

ENRICHED = T.StructType(
    TRADE.fields
    + _struct(
        ("processed_at", _S), ("spread", _D), ("spread_percentage", _D),
        ("price_change", _D), ("price_change_percentage", _D),
        ("sma_5", _D), ("sma_10", _D), ("volatility", _D),
    ).fields
)

# One landed document: an envelope around at most a flush-buffer's worth of records.
BATCH_DOCUMENT = _struct(
    ("records", T.ArrayType(ENRICHED)),
    ("count", T.IntegerType()),
    ("timestamp", T.LongType()),
    ("partition", _S),
)

# All directory levels a landed record can be filed under, and the ones used by default. A directory per
# series and hour makes tiny files at scale; the full key stays in each document's ``partition`` field.
PARTITION_COLUMNS = ("exchange", "symbol", "year", "month", "day", "hour")
DATE_LEVELS = ("year", "month", "day")

# Storage decimals of the candle tables; everything is computed in double first.
PRICE_DECIMAL = T.DecimalType(20, 8)
PERCENT_DECIMAL = T.DecimalType(10, 4)
# A percentage of two prices has no bound: any two that fit PRICE_DECIMAL have one that fits this.
RATIO_DECIMAL = T.DecimalType(28, 4)
SCORE_DECIMAL = T.DecimalType(5, 4)
UPTIME_DECIMAL = T.DecimalType(5, 2)

_PRICES = ("open", "high", "low", "close", "volume")
_BASE = ("symbol", "exchange", "interval_start", "interval_end", *_PRICES, "trade_count", "vwap")
_SPREADS = ("avg_spread", "avg_spread_percentage")
_TREND = ("price_change", "price_change_percentage", "sma_5", "sma_10", "sma_20")
_MOMENTUM = (
    "ema_12", "ema_26", "macd", "macd_signal", "macd_histogram",
    "bb_middle", "bb_upper", "bb_lower", "bb_std",
)
_OSCILLATORS = ("rsi", "volatility")
_CALENDAR = ("year", "month", "day", "hour")

# Columns each interval's warehouse table holds (fixed values).
CANDLE_TABLE_COLUMNS = {
    1: (*_BASE, *_CALENDAR),
    5: (*_BASE, *_SPREADS, *_TREND, *_MOMENTUM, *_OSCILLATORS, *_CALENDAR),
    15: (*_BASE, *_TREND, *_OSCILLATORS, *_CALENDAR),
    60: (*_BASE, *_TREND, *_MOMENTUM, *_OSCILLATORS, *_CALENDAR),
    240: (*_BASE, *_TREND, *_MOMENTUM, *_OSCILLATORS, *_CALENDAR),
    1440: (*_BASE, *_TREND, *_MOMENTUM, *_OSCILLATORS, "year", "month", "day"),
}

# Columns and natural keys of the stored metric tables (fixed values).
METRIC_TABLE_COLUMNS = {
    "data_quality_metrics": (
        "exchange", "symbol", "date", "total_records", "valid_records", "invalid_records", "quality_score",
        "avg_price", "avg_volume", "min_price", "max_price",
    ),
    "daily_stats": (
        "symbol", "exchange", "date", "open_price", "close_price", "high_price", "low_price", "total_volume",
        "total_trades", "price_change", "price_change_percentage", "avg_spread", "avg_spread_percentage",
        "volatility", "rsi_avg",
    ),
    "exchange_performance": (
        "exchange", "date", "total_volume", "total_trades", "avg_spread", "avg_spread_percentage",
        "data_quality_score", "uptime_percentage",
    ),
}
METRIC_TABLE_KEYS = {
    "data_quality_metrics": ("exchange", "symbol", "date"),
    "daily_stats": ("symbol", "exchange", "date"),
    "exchange_performance": ("exchange", "date"),
}

_RATIO_COLUMNS = {"avg_spread_percentage", "price_change_percentage"}
_PERCENT_COLUMNS = {"avg_spread_percentage", "price_change_percentage", "rsi", "rsi_avg"}
_INTEGER_COLUMNS = {
    "trade_count", "year", "month", "day", "hour", "total_trades",
    "total_records", "valid_records", "invalid_records",
}
_SCORE_COLUMNS = {"quality_score", "data_quality_score"}
_PLAIN_COLUMNS = {"symbol", "exchange", "interval_start", "interval_end", "date"}


def storage_type(column: str) -> T.DataType | None:
    """Warehouse type of a measure; ``None`` leaves the column as it is."""
    if column in _PLAIN_COLUMNS:
        return None
    if column in _INTEGER_COLUMNS:
        return T.IntegerType()
    if column in _PERCENT_COLUMNS:
        return PERCENT_DECIMAL
    if column in _SCORE_COLUMNS:
        return SCORE_DECIMAL
    if column == "uptime_percentage":
        return UPTIME_DECIMAL
    return PRICE_DECIMAL


def candle_storage_type(column: str) -> T.DataType | None:
    """``storage_type`` in a candle table, where two candles in a row may be far apart."""
    return RATIO_DECIMAL if column in _RATIO_COLUMNS else storage_type(column)
