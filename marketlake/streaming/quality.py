"""The record stream: decode, score, enrich with carried prices, land, and report.

Enrichment needs the last few prices of each symbol. They are carried between micro-batches in a small
table, and a batch is enriched by the same window operator the batch jobs use. A symbol that dominates a
micro-batch is therefore cut into chunks of rows like any other hot series and is never held by one task.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from marketlake.config import QualityBounds
from marketlake.operators.enrich import REACH, tick_statistics
from marketlake.operators.lookback import RowChunks, over_chunks
from marketlake.operators.quality import (
    VALID,
    emit_metrics,
    late_records,
    observe_totals,
    observed_stats,
    score_records,
    split_valid_invalid,
    typed_records,
)
from marketlake.operators.trades import add_live_spread
from marketlake.sinks.lake import write_raw_json
from marketlake.sources.feeds import decode_stream
from marketlake.streaming.run import SlotTable, run_batches

PRICE_STATE = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("landed", T.TimestampType()),
        T.StructField("trade_id", T.StringType()),
        T.StructField("position", T.LongType()),
    ]
)
# Carried rows come before a batch's own rows in arrival order.
_ORDER = ("position", "landed", "trade_id")


class CarriedPrices:
    """Tick statistics across micro-batches: at most REACH + 1 prices are kept per symbol."""

    def __init__(self, spark: SparkSession, path: str, chunks: RowChunks = RowChunks()):
        self.slots = SlotTable(spark, path, PRICE_STATE)
        self.chunks = replace(chunks, folder=f"{path}/chunks")  # one batch's at a time

    def _merged(self, batch: DataFrame, batch_id: int) -> DataFrame:
        carried = self.slots.before(batch_id)
        return batch.withColumn("position", F.lit(0).cast("bigint")).unionByName(carried, allowMissingColumns=True)

    def enrich(self, batch: DataFrame, batch_id: int) -> DataFrame:
        enriched = over_chunks(
            self._merged(batch, batch_id), ["symbol"], _ORDER, self.chunks, REACH,
            lambda df, w: tick_statistics(df, w, F.col("price")), ["price"],
        )
        return enriched.filter(F.col("position") == 0).drop("position")

    def advance(self, batch: DataFrame, batch_id: int) -> None:
        newest_first = Window.partitionBy("symbol").orderBy(*[F.desc(c) for c in _ORDER])
        newest = (
            self._merged(batch, batch_id).select("symbol", "price", "landed", "trade_id", "position")
            .withColumn("_age", F.row_number().over(newest_first))
            .filter(F.col("_age") <= REACH + 1)
            .withColumn("position", -F.col("_age").cast("bigint"))
        )
        self.slots.save(newest, batch_id)


@dataclass(frozen=True)
class StreamPaths:
    """Folders of one running stream."""

    root: str

    def __getattr__(self, name: str) -> str:
        return f"{self.root}/{name}"


def stateful_enrich(
    spark: SparkSession, records: DataFrame, paths: StreamPaths, chunks: RowChunks = RowChunks(), **trigger
) -> StreamingQuery:
    """Enrich a stream of typed valid records (with ``landed``) and write it as Parquet."""
    prices = CarriedPrices(spark, paths.prices, chunks)

    def step(batch: DataFrame, batch_id: int) -> None:
        prices.enrich(batch, batch_id).write.mode("overwrite").parquet(f"{paths.enriched}/batch={batch_id}")
        prices.advance(batch, batch_id)

    return run_batches(records, step, paths.checkpoint, **trigger)


def stream_quality(
    spark: SparkSession,
    source: DataFrame,
    paths: StreamPaths,
    now: Column | None = None,
    bounds: QualityBounds = QualityBounds(),
    dlq_enabled: bool = False,
    chunks: RowChunks = RowChunks(),
    encoding: str = "base64",
    **trigger,
) -> StreamingQuery:
    """Consume (record_id, data, ...) rows and fill the lake, failed, late, metrics and stats folders.

    Every output of batch n is an overwrite of its own folder, so a repeated batch leaves no doubles.
    """
    moment = F.current_timestamp() if now is None else now
    prices = CarriedPrices(spark, paths.prices, chunks)

    def step(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return  # what is never evaluated is never observed
        decoded = decode_stream(batch, encoding=encoding)
        scored, totals = observe_totals(score_records(decoded, bounds, moment))
        scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_all(scored, totals, batch_id)
        finally:
            scored.unpersist()

    def write_all(scored: DataFrame, totals: Observation, batch_id: int) -> None:
        started = time.monotonic()
        routed = split_valid_invalid(scored, dlq_enabled=dlq_enabled)
        valid = add_live_spread(typed_records(routed.valid, moment)).withColumn("processed_at", F.current_timestamp())
        # The first job on the persisted records evaluates all of them and so counts the totals.
        label = f"{batch_id:012d}"
        at = F.current_timestamp()
        write_raw_json(prices.enrich(valid, batch_id), paths.lake, at, batch=label)
        for name, rows in (
            ("failed", routed.failed),
            ("late", late_records(scored, moment, bounds).select("record_id", "payload", "quality_score")),
            ("stats", observed_stats(spark, totals)),
        ):
            rows.write.mode("overwrite").parquet(f"{getattr(paths, name)}/batch={batch_id}")
        prices.advance(valid, batch_id)
        metrics = emit_metrics(scored, at, time.monotonic() - started)
        metrics.write.mode("overwrite").parquet(f"{paths.metrics}/batch={batch_id}")

    return run_batches(source, step, paths.checkpoint, cache=False, **trigger)


def valid_records(source: DataFrame, now: Column, bounds: QualityBounds = QualityBounds()) -> DataFrame:
    """Decoded, scored and typed valid records of a batch or stream."""
    scored = score_records(decode_stream(source), bounds, now)
    return typed_records(scored.filter(F.col("status") == VALID), now)
