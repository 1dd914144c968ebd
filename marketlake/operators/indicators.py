"""Technical indicators over candle series.

All windows share one partitioning and one order, so a series (or chunk of one) is shuffled and sorted
once and every indicator comes from two window passes over the sorted rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions.calendar import epoch_seconds
from marketlake.functions.market import percent_of
from marketlake.operators.lookback import CHUNK, COPY, Frames, over_chunks
from marketlake.storage import stored

SERIES = ("symbol", "exchange")
# Candles per chunk: a chunk covers this many grid steps, so it can never hold more rows.
CHUNK_CANDLES = 4096
# macd_signal reaches furthest: 9 rows of macd, each over 26 rows of close.
MAX_REACH = 35


def chunk_of(minutes: int | Column, candles_per_chunk: int = CHUNK_CANDLES) -> Column:
    """Grid chunk of a candle. Starts are unique per series, which bounds the rows per chunk."""
    step = (minutes if isinstance(minutes, Column) else F.lit(minutes)) * 60 * candles_per_chunk
    return F.floor(epoch_seconds(F.col("interval_start")) / step)


@dataclass(frozen=True)
class Stage:
    """One indicator family, split by what depends on what.

    ``first`` are windows over candle columns, ``between`` plain columns from them, ``second`` windows
    over those, ``last`` plain columns from everything. All stages asked for together share one window
    pass per level. ``outputs`` are the columns kept.
    """

    outputs: tuple[str, ...]
    first: Callable[[Frames], dict[str, Column]]
    between: Callable[[], dict[str, Column]] = dict
    second: Callable[[Frames], dict[str, Column]] = lambda w: {}
    last: Callable[[], dict[str, Column]] = dict


def _smooth(column: str, previous_mean: str, period: int) -> Column:
    """EMA step from the previous row's simple mean; a first row is its own mean."""
    alpha = 2.0 / (period + 1)
    return F.coalesce(F.col(column) * alpha + F.col(previous_mean) * (1 - alpha), F.col(column))


def _mean_before(column: str, period: int, w: Frames) -> Column:
    """The simple mean of ``period`` rows as it stood one row earlier, in a single frame."""
    return F.avg(column).over(w().rowsBetween(-period, -1))


def _change() -> Column:
    return F.col("close") - F.col("_previous")


PRICE_CHANGE = Stage(
    ("price_change", "price_change_percentage"),
    first=lambda w: {"_previous": F.lag("close").over(w())},
    between=lambda: {
        "price_change": _change(),
        "price_change_percentage": percent_of(_change(), F.col("_previous")),
    },
)
SMA = Stage(
    ("sma_5", "sma_10", "sma_20"),
    first=lambda w: {f"sma_{p}": F.avg("close").over(w(p)) for p in (5, 10, 20)},
)
EMA = Stage(
    ("ema_12", "ema_26"),
    first=lambda w: {f"_before_{p}": _mean_before("close", p, w) for p in (12, 26)},
    between=lambda: {f"ema_{p}": _smooth("close", f"_before_{p}", p) for p in (12, 26)},
)
MACD = Stage(
    ("macd", "macd_signal", "macd_histogram"),
    first=EMA.first,
    between=lambda: {"macd": EMA.between()["ema_12"] - EMA.between()["ema_26"]},
    second=lambda w: {"_macd_before": _mean_before("macd", 9, w)},
    last=lambda: {
        "macd_signal": _smooth("macd", "_macd_before", 9),
        "macd_histogram": F.col("macd") - _smooth("macd", "_macd_before", 9),
    },
)
BOLLINGER = Stage(
    ("bb_middle", "bb_std", "bb_upper", "bb_lower"),
    first=lambda w: {
        "bb_middle": F.avg("close").over(w(20)),
        "bb_std": F.stddev_samp("close").over(w(20)),
    },
    between=lambda: {
        "bb_upper": F.col("bb_middle") + F.col("bb_std") * 2.0,
        "bb_lower": F.col("bb_middle") - F.col("bb_std") * 2.0,
    },
)
# Relative strength over simple means; null while no candle in the frame has fallen.
RSI = Stage(
    ("rsi",),
    first=PRICE_CHANGE.first,
    between=lambda: {
        "_gain": F.greatest(F.coalesce(_change(), F.lit(0.0)), F.lit(0.0)),
        "_loss": F.greatest(F.coalesce(-_change(), F.lit(0.0)), F.lit(0.0)),
    },
    second=lambda w: {"_mean_gain": F.avg("_gain").over(w(14)), "_mean_loss": F.avg("_loss").over(w(14))},
    last=lambda: {"rsi": 100 - F.lit(100.0) / (1 + F.try_divide("_mean_gain", "_mean_loss"))},
)
VOLATILITY = Stage(
    ("volatility",),
    first=lambda w: {"volatility": F.stddev_samp("close").over(w(20))},
)
ALL_STAGES = (PRICE_CHANGE, SMA, EMA, MACD, BOLLINGER, RSI, VOLATILITY)


def indicators(
    candles: DataFrame,
    minutes: int | Column,
    stages: Sequence[Stage] = ALL_STAGES,
    keys: Sequence[str] = SERIES,
    candles_per_chunk: int | None = CHUNK_CANDLES,
) -> DataFrame:
    """Add indicator stages to candles of one interval (or of several, with the interval in ``keys``)."""

    def run(df: DataFrame, window: Frames) -> DataFrame:
        def gather(level: str, *args) -> dict[str, Column]:
            return {name: c for stage in stages for name, c in getattr(stage, level)(*args).items()}

        for level, args in (("first", (window,)), ("between", ()), ("second", (window,)), ("last", ())):
            columns = gather(level, *args)
            df = df.withColumns(columns) if columns else df
        kept = [name for stage in stages for name in stage.outputs]
        return df.select(*carried, *kept)

    chunk = None if candles_per_chunk is None else chunk_of(minutes, candles_per_chunk)
    carried = [*candles.columns, *((CHUNK, COPY) if chunk is not None else ())]
    return over_chunks(candles, keys, ["interval_start"], chunk, MAX_REACH, run)


#: Chunks whose maps are composed together: a fold holds so many at once.
FOLDED_CHUNKS = 512


def _values_before(maps: Column, first: Column, decay: Callable[[Column], Column]) -> Column:
    """An array of (_at, value): the value that comes into each of the affine maps, which are in order."""

    def step(state: Column, m: Column) -> Column:
        into = F.array(F.struct(m["_at"].alias("_at"), state["value"].alias("value")))
        return F.struct(
            F.concat(state["into"], into).alias("into"), (state["value"] * decay(m) + m["b"]).alias("value")
        )

    nothing = F.array().cast("array<struct<_at: bigint, value: double>>")
    return F.aggregate(maps, F.struct(nothing.alias("into"), first.cast("double").alias("value")), step)["into"]


def _incoming(ends: DataFrame, q: float) -> DataFrame:
    """(series, _chunk, _in): the value that comes into each chunk, by a two-level scan of the chunks' maps.

    ``ends`` has each chunk's number of rows n, its own sum b and its first value. Maps of up to ``FOLDED_CHUNKS``
    chunks are composed into one; values run through these, one row for so many chunks, and then inside them.
    """
    def decay(m: Column) -> Column:
        return F.pow(F.lit(q), m["n"])

    in_order = F.array_sort(F.collect_list(F.struct(F.col("_chunk").alias("_at"), "n", "b", "first")))
    groups = ends.groupBy(*SERIES, F.floor(F.col("_chunk") / FOLDED_CHUNKS).alias("_group")).agg(in_order.alias("maps"))
    identity = F.struct(F.lit(1.0).alias("a"), F.lit(0.0).alias("b"))
    whole = F.aggregate(
        "maps", identity,
        lambda done, m: F.struct((done["a"] * decay(m)).alias("a"), (done["b"] * decay(m) + m["b"]).alias("b")),
    )
    composed = groups.select(*SERIES, "_group", whole.alias("whole"), F.col("maps")[0]["first"].alias("first"))
    chains = composed.groupBy(*SERIES).agg(
        F.array_sort(F.collect_list(F.struct(F.col("_group").alias("_at"), "whole.a", "whole.b", "first"))).alias("maps")
    )
    into_groups = chains.select(
        *SERIES, F.inline(_values_before(F.col("maps"), F.col("maps")[0]["first"], lambda m: m["a"]))
    ).select(*SERIES, F.col("_at").alias("_group"), F.col("value").alias("_value"))
    return groups.join(into_groups, [*SERIES, "_group"]).select(
        *SERIES, F.inline(_values_before(F.col("maps"), F.col("_value"), decay))
    ).select(*SERIES, F.col("_at").alias("_chunk"), F.col("value").alias("_in"))


def ema_recursive(
    candles: DataFrame, period: int, minutes: int, column: str = "close", steps_per_chunk: int = 256
) -> DataFrame:
    """True recursive EMA: seeded with the first value, then e = a*x + (1-a)*e.

    A run of n steps maps the incoming e to q**n * e + b with q = 1-a, and such maps compose. So each
    chunk is folded on its own by a running sum, the chunks' maps are scanned in two levels, and the incoming value is
    added back with its decay. Folded rows are stored: the candles are read once, and no task sees all chunks of a series.
    """
    alpha, q = 2.0 / (period + 1), 1 - 2.0 / (period + 1)
    if q <= 0:
        return candles.withColumn(f"ema_recursive_{period}", F.col(column).cast("double"))
    # Keep q**-n finite inside a chunk.
    steps = min(steps_per_chunk, max(1, int(600 / -math.log(q))))
    in_chunk = Window.partitionBy(*SERIES, "_chunk").orderBy("interval_start")
    running = in_chunk.rowsBetween(Window.unboundedPreceding, 0)
    local = (
        candles.withColumn("_chunk", chunk_of(minutes, steps))
        .withColumn("_n", F.row_number().over(in_chunk))
        .withColumn("_sum", F.sum(F.col(column) * alpha * F.pow(F.lit(q), -F.col("_n"))).over(running))
        .withColumn("_local", F.col("_sum") * F.pow(F.lit(q), F.col("_n")))
        .drop("_sum")
    )
    local = stored(local, "ema")
    ends = local.groupBy(*SERIES, "_chunk").agg(
        F.max("_n").alias("n"),
        F.max_by("_local", "_n").alias("b"),
        F.min_by(column, "_n").cast("double").alias("first"),
    )
    value = F.col("_local") + F.pow(F.lit(q), F.col("_n")) * F.col("_in")
    return (
        local.join(_incoming(ends, q), [*SERIES, "_chunk"])
        .withColumn(f"ema_recursive_{period}", value)
        .drop("_chunk", "_n", "_local", "_in")
    )
