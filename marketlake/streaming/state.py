"""Tick statistics from a keyed state store: each symbol's last prices, kept by the stream itself.

Where ``CarriedPrices`` carries a table from batch to batch, here the state is the stream's: one bounded list of prices
for each symbol, checkpointed with the offsets, partitioned by symbol, and forgotten by a timer once a symbol has been
silent for long enough. All rows that a micro-batch has of one symbol meet in one task, so bound the micro-batch
(files, records); for a symbol that dominates unbounded batches take ``stateful_enrich``, which cuts it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from marketlake.operators.enrich import REACH, TICK_COLUMNS

STATE = "prices array<double>"
_ORDER = ["landed", "trade_id"]


def arrival_order(rows: pd.DataFrame) -> np.ndarray:
    """Places of the rows by (landed, trade_id), nulls first; equal ones stay as they come.

    Arrow sorts text without a Python object for each comparison: most of a large group's time went into that.
    """
    table = pa.table({c: pa.array(rows[c], from_pandas=True) for c in _ORDER})
    keys = [(c, "ascending") for c in _ORDER]
    return pc.sort_indices(table, sort_keys=keys, null_placement="at_start").to_numpy()


def tick_columns(prices: np.ndarray, carried: int) -> dict[str, np.ndarray]:
    """The tick statistics of the prices from place ``carried`` on; those before only serve as their past."""

    def over(k: int, statistic) -> np.ndarray:
        out = np.full(len(prices), np.nan)
        if len(prices) >= k:
            out[k - 1 :] = statistic(np.lib.stride_tricks.sliding_window_view(prices, k))
        return out[carried:]

    previous = np.concatenate([[np.nan], prices[:-1]])[carried:]
    previous = np.where(previous > 0, previous, np.nan)
    change = prices[carried:] - previous
    return {
        "price_change": change,
        "price_change_percentage": change / previous * 100,
        "sma_5": over(5, lambda w: w.mean(axis=1)),
        "sma_10": over(10, lambda w: w.mean(axis=1)),
        "volatility": over(10, lambda w: w.std(axis=1)),
    }


def keyed_enrich(records: DataFrame, idle_seconds: float | None = None) -> DataFrame:
    """A stream of typed records (with ``landed``) plus its tick statistics, in append mode.

    Inside a micro-batch a symbol's records go by (landed, trade_id), nulls first; a record without price counts as
    price 0. A symbol's state holds at most ``REACH`` prices. After ``idle_seconds`` of processing time without a
    record the state is removed and the symbol starts anew; without a limit it is kept. Timers need a stream that
    goes on: with one, Spark runs batches without data for ever, so a trigger that takes all available data and stops
    doesn't end.
    """
    out = T.StructType([*records.schema.fields, *[T.StructField(c, T.DoubleType()) for c in TICK_COLUMNS]])
    names = out.fieldNames()

    def step(key: tuple, chunks: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(chunks), ignore_index=True)
        rows = rows.take(arrival_order(rows))
        past = np.asarray(state.get[0] if state.exists else [], float)
        prices = np.concatenate([past, rows["price"].fillna(0.0).to_numpy(float)])
        state.update((prices[-REACH:].tolist(),))
        if idle_seconds is not None:
            state.setTimeoutDuration(max(1, int(idle_seconds * 1000)))
        yield rows.assign(**tick_columns(prices, len(past)))[names]

    timeout = GroupStateTimeout.NoTimeout if idle_seconds is None else GroupStateTimeout.ProcessingTimeTimeout
    return records.groupBy("symbol").applyInPandasWithState(step, out, STATE, "append", timeout)
