"""Row-wise trade operators: typing, cleaning, spreads, admission."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.config import QualityBounds
from marketlake.functions.calendar import calendar_parts
from marketlake.functions.market import live_spread, quoted_spread


def add_calendar_parts(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.withColumns(calendar_parts(F.col(ts), minute=True))


def cast_numeric(df: DataFrame, columns: tuple[str, ...] = ("price", "volume")) -> DataFrame:
    """Numbers as double; unreadable text becomes null instead of failing the job."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns})


def clean_trades(df: DataFrame) -> DataFrame:
    """Trades that can enter a candle."""
    complete = [F.col(c).isNotNull() for c in ("price", "volume", "symbol", "exchange")]
    condition = (F.col("price") > 0) & (F.col("volume") >= 0)
    for test in complete:
        condition = condition & test
    return df.filter(condition)


def with_quotes(df: DataFrame) -> DataFrame:
    """Guarantee bid and ask columns; feeds without quotes get nulls."""
    missing = {c: F.lit(None).cast("double") for c in ("bid", "ask") if c not in df.columns}
    return df.withColumns(missing) if missing else df


def add_batch_spread(df: DataFrame) -> DataFrame:
    spread, percent = quoted_spread(F.col("bid"), F.col("ask"))
    return with_quotes(df).withColumns({"spread": spread, "spread_percentage": percent})


def add_live_spread(df: DataFrame) -> DataFrame:
    spread, percent = live_spread(F.col("bid"), F.col("ask"))
    return with_quotes(df).withColumns({"spread": spread, "spread_percentage": percent})


def prepare_trades(df: DataFrame) -> DataFrame:
    """Typed, cleaned and spread-carrying trades: the input of every candle."""
    return add_batch_spread(clean_trades(cast_numeric(df)))


def admit_trades(df: DataFrame, bounds: QualityBounds = QualityBounds()) -> DataFrame:
    """Normalised trades good enough to publish."""
    named = [F.length(F.col(c)) > 0 for c in ("exchange", "symbol", "timestamp")]
    condition = (
        (F.col("price") > 0)
        & F.col("price").between(bounds.min_price, bounds.max_price)
        & (F.col("volume") >= bounds.min_volume)
    )
    for test in named:
        condition = condition & test
    return df.filter(condition)
