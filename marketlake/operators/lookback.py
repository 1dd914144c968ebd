"""Row-frame windows over long series without one task per series.

A window that looks back a bounded number of rows does not need its whole series in one task. The
series is cut into chunks and every chunk receives copies of the last ``rows`` rows before it. Frames
of the chunk's own rows are then complete, the copies are dropped afterwards, and a series that holds
a third of all data is spread over as many tasks as it has chunks. The result is the same as without
cutting for every window whose reach, added up over its stages, is at most ``rows``.

Chunks are given by a column, for series on a grid, or are as many rows each (``RowChunks``), whatever the times: a
second that holds most trades, or records without a time, are cut by the rest of the order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from marketlake.storage import stored

CHUNK, COPY = "_chunk", "_copy"
Frames = Callable[..., WindowSpec]


@dataclass(frozen=True)
class RowChunks:
    """Chunks of about ``rows`` rows, by ranges of series and order; more and smaller ones where shuffles are wider.

    Rows that agree in series and order stay together. Ranges are sampled, so the input is counted, sampled and
    shuffled: ``store`` an input that is costly to evaluate. The rows are written with their chunks, since a second
    sample would draw other ranges: to a new folder under the shared root, or to ``folder``, which is overwritten.
    """

    rows: int = 200_000
    store: bool = False
    folder: str | None = None

    def cut(self, df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, int]:
        """``df`` with ``_chunk``, numbered along keys and order without gaps in a series, and the last number."""
        if self.store:
            df = stored(df, "series")
        least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ranges = max(least, -(-df.count() // self.rows))
        cut = df.repartitionByRange(ranges, *keys, *order).withColumn(CHUNK, F.spark_partition_id())
        return stored(cut, "chunks", self.folder), ranges - 1


def _tails(based: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int) -> DataFrame:
    """The last ``rows`` rows of each chunk, with their ``_age``: 1 for the newest."""
    newest_first = Window.partitionBy(*keys, CHUNK).orderBy(*[F.col(c).desc() for c in order])
    # A rank filter this low is applied before the shuffle too, so only tails travel.
    return based.withColumn("_age", F.row_number().over(newest_first)).filter(F.col("_age") <= rows)


def _with_rows_before(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunks: RowChunks, rows: int, narrow: Sequence[str]
) -> DataFrame:
    """As ``with_lookback``. Every tail goes to the next ``rows`` chunks, each of which keeps the newest it got."""
    cut, last = chunks.cut(df, keys, order)
    based = cut.repartition(*keys, CHUNK)
    later = F.sequence(F.col(CHUNK) + 1, F.least(F.col(CHUNK) + rows, F.lit(last)))
    sent = _tails(based, keys, order, rows).filter(F.col(CHUNK) < last).select(
        *narrow, "_age", F.col(CHUNK).alias("_from"), F.explode(later).alias(CHUNK)
    )
    nearest = Window.partitionBy(*keys, CHUNK).orderBy(F.desc("_from"), "_age")
    copies = (
        sent.withColumn("_place", F.row_number().over(nearest)).filter(F.col("_place") <= rows)
        .select(*narrow, CHUNK, F.lit(True).alias(COPY))
    )
    return based.withColumn(COPY, F.lit(False)).unionByName(copies, allowMissingColumns=True)


def with_lookback(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column | RowChunks, rows: int,
    inputs: Sequence[str] | None = None,
) -> DataFrame:
    """``df`` plus ``_chunk``, ``_copy`` and, marked as copies, each chunk's preceding rows.

    A column for ``chunk`` must be deterministic and must not decrease along ``order`` within a series. ``inputs`` are the
    columns that windows read (all if not given); copies hold these, keys and order, and null elsewhere.
    """
    narrow = df.columns if inputs is None else [c for c in df.columns if c in {*keys, *order, *inputs}]
    if isinstance(chunk, RowChunks):
        return _with_rows_before(df, keys, order, chunk, rows, narrow)
    # Placed once. Where no more columns are asked of the result than copies hold, the tails and the windows
    # read the same shuffle and ``df`` is evaluated once.
    based = df.withColumn(CHUNK, chunk).repartition(*keys, CHUNK)
    tails = (
        _tails(based, keys, order, rows)
        .groupBy(*keys, CHUNK)
        .agg(F.collect_list(F.struct("_age", F.struct(*narrow).alias("row"))).alias("tail"))
        # By age alone: the rows may hold values that cannot be compared, such as maps.
        .withColumn("tail", F.array_sort("tail", lambda a, b: a["_age"] - b["_age"]))
    )
    # Each chunk has at least one row, so `rows` chunks back always reach far enough.
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(-rows, -1)
    copies = (
        tails.select(
            F.col(CHUNK),
            F.slice(F.flatten(F.reverse(F.collect_list("tail").over(earlier))), 1, rows).alias("before"),
        )
        .select(F.explode("before").alias("b"), CHUNK)
        .select(*[F.col("b.row")[c].alias(c) for c in narrow], CHUNK, F.lit(True).alias(COPY))
        .repartition(*keys, CHUNK)
    )
    return based.withColumn(COPY, F.lit(False)).unionByName(copies, allowMissingColumns=True)


def over_chunks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    chunk: Column | RowChunks | None,
    rows: int,
    compute: Callable[[DataFrame, Frames], DataFrame],
    inputs: Sequence[str] | None = None,
) -> DataFrame:
    """Run ``compute(frame, window)`` chunk-wise; ``window(k)`` frames the last k rows.

    ``window()`` without an argument is the unframed spec for lag. ``chunk=None`` keeps series whole.
    """
    if chunk is None:
        return compute(df, _frames(list(keys), order))
    widened = with_lookback(df, keys, order, chunk, rows, inputs)
    return compute(widened, _frames([*keys, CHUNK], order)).filter(~F.col(COPY)).drop(CHUNK, COPY)


def _frames(partition: list[str], order: Sequence[str]) -> Frames:
    spec = Window.partitionBy(*partition).orderBy(*order)

    def frame(last: int | None = None) -> WindowSpec:
        return spec if last is None else spec.rowsBetween(-(last - 1), 0)

    return frame
