"""Parameters shared by the operators. Everything here can be overridden by argument."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values (must equal the feed and table definitions this engine serves).
EXCHANGES = ("binance", "coinbase", "kraken")
REQUIRED_FIELDS = ("exchange", "symbol", "timestamp", "price", "volume")
INTERVAL_TABLES = {
    1: "ohlcv_1min",
    5: "ohlcv_5min",
    15: "ohlcv_15min",
    60: "ohlcv_1h",
    240: "ohlcv_4h",
    1440: "ohlcv_daily",
}
SEED_SYMBOLS = (
    ("btcusdt", "binance", "BTC", "USDT"),
    ("ethusdt", "binance", "ETH", "USDT"),
    ("bnbusdt", "binance", "BNB", "USDT"),
    ("adausdt", "binance", "ADA", "USDT"),
    ("btc-USD", "coinbase", "BTC", "USD"),
    ("eth-USD", "coinbase", "ETH", "USD"),
    ("ltc-USD", "coinbase", "LTC", "USD"),
    ("bch-USD", "coinbase", "BCH", "USD"),
)
CORRELATION_SYMBOLS = ("btcusdt", "ethusdt", "bnbusdt")


@dataclass(frozen=True)
class QualityBounds:
    """Limits a record is scored against."""

    min_price: float = 0.01
    max_price: float = 1_000_000.0
    min_volume: float = 0.0
    tolerance_seconds: int = 300
    threshold: float = 0.8
    exchanges: tuple[str, ...] = EXCHANGES


@dataclass(frozen=True)
class FeedFormat:
    """How one exchange spells a trade message.

    ``type_field``/``type_value`` select trade messages; ``None`` keeps every message.
    """

    exchange: str
    symbol: str
    time: str
    price: str
    volume: str
    trade_id: str | None = "trade_id"
    type_field: str | None = None
    type_value: str | None = None

    @property
    def required(self) -> tuple[str, ...]:
        return (self.symbol, self.price, self.volume, self.time)


# Message field names per exchange.
FEEDS = {
    "binance": FeedFormat("binance", "s", "T", "p", "q", "t", "e", "trade"),
    "coinbase": FeedFormat("coinbase", "product_id", "time", "price", "size", "trade_id", "type", "match"),
    "kraken": FeedFormat("kraken", "pair", "time", "price", "volume"),
}


@dataclass(frozen=True)
class AlarmRule:
    """Raise when ``statistic`` breaches ``threshold`` in ``periods`` consecutive periods."""

    metric: str
    statistic: str
    threshold: float
    above: bool
    period_seconds: int = 300
    periods: int = 2


# Alarm thresholds.
ALARMS = {
    "errors": AlarmRule("InvalidRecords", "sum", 1.0, above=True),
    "lag": AlarmRule("LagMilliseconds", "max", 60_000.0, above=True),
    "data_quality": AlarmRule("DataQualityScore", "avg", 0.8, above=False),
}
