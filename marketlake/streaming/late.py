"""Stream candles that late trades mend.

A watermark closes a candle, and a windowed aggregation forgets what comes after that. Here the watermark is carried from
batch to batch and compared with every trade: what comes too late for its candle goes to a table of its own as well,
and the candle is written again. Buckets are kept as mergeable parts, a folder for each day and batch, so a batch reads
only the days it closes or touches; candles are written once for each version, and the newest version counts.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from marketlake.functions.calendar import add_minutes, bucket_start
from marketlake.operators.candles import (
    CANDLE_COLUMNS,
    SERIES,
    candle_parts,
    finish_parts,
    merged_measures,
    trade_order,
)
from marketlake.operators.trades import prepare_trades
from marketlake.streaming.run import SlotTable, run_batches

PROGRESS = T.StructType([
    T.StructField("watermark", T.TimestampNTZType()),
    T.StructField("open_days", T.ArrayType(T.DateType())),
])
_BUCKET = [*SERIES, "interval_start"]


def _end(minutes: int) -> Column:
    return add_minutes(F.col("interval_start"), minutes).cast("timestamp_ntz")


def _moment(at: datetime) -> Column:
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def _days(parts: DataFrame) -> set[date]:
    return {row.day for row in parts.select("day").distinct().collect()}


class MendedCandles:
    """Folders ``candles``, ``late``, ``parts`` and ``progress`` below ``root``, filled batch by batch.

    A repeated batch overwrites what it wrote. A trade is late if its bucket ended at or before the watermark that
    the batches before had reached: the newest trade time less ``delay_seconds``.
    """

    def __init__(self, spark: SparkSession, root: str, minutes: int, delay_seconds: int = 300):
        self.spark, self.root, self.minutes = spark, root, minutes
        self.delay = timedelta(seconds=delay_seconds)
        self.slots = SlotTable(spark, f"{root}/progress", PROGRESS)

    def _write(self, rows: DataFrame, name: str, batch_id: int) -> None:
        (
            rows.withColumn("batch", F.lit(batch_id).cast("long")).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(f"{self.root}/{name}")
        )

    def _parts(self, schema: T.StructType, days: set[date], batch_id: int) -> DataFrame:
        root = f"{self.root}/parts"
        schema = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
        read = self.spark.read.schema(schema).option("basePath", root)
        return read.parquet(*[f"{root}/day={d}" for d in sorted(days)]).filter(F.col("batch") <= batch_id)

    def step(self, batch: DataFrame, batch_id: int) -> None:
        trades = prepare_trades(batch.withColumn("ts", F.col("ts").cast("timestamp_ntz")))
        progress = self.slots.before(batch_id).first()
        watermark, pending = (progress.watermark, set(progress.open_days)) if progress else (datetime.min, set())
        newest = trades.agg(F.max("ts")).first()[0]
        if newest is None:
            self.slots.save(self.spark.createDataFrame([(watermark, sorted(pending))], PROGRESS), batch_id)
            return
        reached = max(watermark, newest - self.delay)
        order = trade_order(trades)
        parts = (
            candle_parts(trades, self.minutes, first_at=F.min(order), last_at=F.max(order))
            .withColumn("day", F.to_date("interval_start"))
        )
        closed_before = _end(self.minutes) <= _moment(watermark)
        late = trades.withColumn("interval_start", bucket_start(F.col("ts"), self.minutes)).filter(closed_before)
        self._write(late.withColumn("day", F.to_date("interval_start")).drop("interval_start"), "late", batch_id)
        self._write(parts, "parts", batch_id)

        days = _days(parts) | pending
        known = self._parts(parts.schema, days, batch_id)
        touched = known.filter((F.col("batch") == batch_id) & closed_before).select(*_BUCKET).distinct()
        closing = known.filter(~closed_before & (_end(self.minutes) <= _moment(reached)))
        again = known.filter(closed_before).join(touched, _BUCKET, "left_semi")
        buckets = closing.unionByName(again).groupBy(*_BUCKET).agg(
            *merged_measures(F.col("first_at"), F.col("last_at"))
        )
        candles = finish_parts(buckets, self.minutes).withColumnRenamed("day", "day_of_month")
        self._write(candles.withColumn("day", F.to_date("interval_start")), "candles", batch_id)
        still_open = _days(known.filter(_end(self.minutes) > _moment(reached)))
        self.slots.save(self.spark.createDataFrame([(reached, sorted(still_open))], PROGRESS), batch_id)


def stream_mended_candles(
    spark: SparkSession, trades: DataFrame, root: str, minutes: int = 5, delay_seconds: int = 300, **trigger
) -> StreamingQuery:
    """Candles of a trade stream below ``root``, written when the watermark passes their end and again for late trades."""
    tables = MendedCandles(spark, root, minutes, delay_seconds)
    return run_batches(trades, tables.step, f"{root}/checkpoint", **trigger)


def mended_candles(spark: SparkSession, root: str) -> DataFrame:
    """The newest version of each closed candle."""
    versions = spark.read.parquet(f"{root}/candles").drop("day").withColumnRenamed("day_of_month", "day")
    measures = [c for c in CANDLE_COLUMNS if c not in _BUCKET]
    newest = versions.groupBy(*_BUCKET).agg(F.max_by(F.struct(*measures), "batch").alias("candle"))
    return newest.select(*_BUCKET, "candle.*").select(*CANDLE_COLUMNS)


def late_trades(spark: SparkSession, root: str) -> DataFrame:
    """Trades that came after their candle was closed, with the micro-batch that brought them."""
    return spark.read.parquet(f"{root}/late")
