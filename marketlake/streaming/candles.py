"""Candles and indicators of a trade stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketlake.operators.candles import CANDLE_COLUMNS, candle_parts, finish_parts
from marketlake.operators.indicators import MAX_REACH, SERIES, indicators
from marketlake.operators.trades import prepare_trades
from marketlake.streaming.run import SlotTable, run_batches


def stream_candles(trades: DataFrame, minutes: int = 5, delay: str = "5 minutes") -> DataFrame:
    """Continuous candles: a bucket is emitted once, when the watermark passes its end."""
    timed = trades.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    return finish_parts(candle_parts(prepare_trades(timed), minutes), minutes)


def stream_indicators(
    spark: SparkSession, candles: DataFrame, minutes: int, out: str, state: str, checkpoint: str,
    state_count: int | None = None,
) -> StreamingQuery:
    """Indicators of closed candles. Each batch is computed with the series' last candles before it."""
    # Row-frame windows are not allowed on a stream itself, only on its micro-batches.
    schema = candles.schema
    slots = SlotTable(spark, state, schema)
    newest_first = Window.partitionBy(*SERIES).orderBy(F.desc("interval_start"))

    def step(batch: DataFrame, batch_id: int) -> None:
        batch = batch.select(*CANDLE_COLUMNS)
        before = slots.before(batch_id)
        merged = before.withColumn("_old", F.lit(True)).unionByName(batch.withColumn("_old", F.lit(False)))
        fresh = indicators(merged, minutes).filter(~F.col("_old")).drop("_old")
        fresh.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        tail = (
            merged.drop("_old").withColumn("_age", F.row_number().over(newest_first))
            .filter(F.col("_age") <= MAX_REACH)
        )
        slots.save(tail, batch_id)

    return run_batches(candles, step, checkpoint, state_count=state_count)
