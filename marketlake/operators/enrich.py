"""Tick enrichment from a symbol's own recent prices, and symbol lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.market import percent_of
from marketlake.functions.parsing import canonical_symbol
from marketlake.operators.lookback import Frames, RowChunks, over_chunks
from marketlake.operators.trades import add_live_spread

# The longest statistic covers ten prices: the row's own and nine before it.
REACH = 9
TICK_COLUMNS = ("price_change", "price_change_percentage", "sma_5", "sma_10", "volatility")


def tick_statistics(df: DataFrame, window: Frames, price: Column) -> DataFrame:
    """Change against the previous price, and means and deviation once enough prices exist."""
    previous = F.lag("_p").over(window())
    enough = {k: F.count("_p").over(window(k)) >= k for k in (5, 10)}
    with_price = df.withColumn("_p", F.coalesce(price, F.lit(0.0)))
    raw = with_price.withColumns(
        {
            "_previous": previous,
            "sma_5": F.when(enough[5], F.avg("_p").over(window(5))),
            "sma_10": F.when(enough[10], F.avg("_p").over(window(10))),
            "volatility": F.when(enough[10], F.stddev_pop("_p").over(window(10))),
        }
    )
    change = F.col("_p") - F.col("_previous")
    return raw.withColumns(
        {
            "price_change": F.when(F.col("_previous") > 0, change),
            "price_change_percentage": percent_of(change, F.col("_previous")),
        }
    ).drop("_p", "_previous")


def tick_enrich(
    trades: DataFrame, ts: str = "ts", tie: str = "trade_id", chunks: RowChunks | None = RowChunks()
) -> DataFrame:
    """Price change, sma_5, sma_10 and volatility per symbol across all exchanges, in (time, id) order.

    A record without price counts as price 0. ``chunks`` bounds how many of a symbol's trades meet in one task,
    however many fall on one second or have no time (see :mod:`marketlake.operators.lookback`).
    """
    return over_chunks(
        trades, ["symbol"], [ts, tie], chunks, REACH, lambda df, w: tick_statistics(df, w, F.col("price")), ["price"]
    )


def enrich_records(
    records: DataFrame, processed_at: Column | None = None, chunks: RowChunks = RowChunks(store=True)
) -> DataFrame:
    """Everything a landed record carries beyond the trade itself. Parsed records are stored, so parsed once."""
    stamped = records.withColumn("processed_at", F.current_timestamp() if processed_at is None else processed_at)
    return tick_enrich(add_live_spread(stamped), ts="landed", chunks=chunks)


def enrich_symbol_dim(trades: DataFrame, symbols: DataFrame) -> DataFrame:
    """Base and quote currency of each trade's symbol; both sides use the canonical spelling.

    No broadcast hint: the optimizer broadcasts the lookup only while its size is under the session's
    limit, and otherwise joins by shuffle with AQE splitting hot symbols.
    """
    lookup = symbols.select(
        canonical_symbol(F.col("symbol")).alias("_symbol"),
        F.col("exchange").alias("_exchange"),
        "base_currency",
        "quote_currency",
    )
    matches = (canonical_symbol(trades["symbol"]) == lookup["_symbol"]) & (trades["exchange"] == lookup["_exchange"])
    return trades.join(lookup, matches, "left").drop("_symbol", "_exchange")
