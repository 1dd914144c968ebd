"""Alarms on a metric stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketlake.config import AlarmRule
from marketlake.plans.monitor import metric_alarm
from marketlake.streaming.run import SlotTable, run_batches

_STATISTICS = ("avg", "sum", "max", "min", "samples")


def closed_periods(metrics: DataFrame, period_seconds: int, delay: str = "5 minutes") -> DataFrame:
    """Statistics of each metric period, emitted once when the watermark passes its end."""
    return (
        metrics.withWatermark("timestamp", delay)
        .groupBy(
            "name",
            F.try_element_at("dimensions", F.lit("Exchange")).alias("exchange"),
            F.window("timestamp", f"{period_seconds} seconds").alias("_window"),
        )
        .agg(
            F.avg("value").alias("avg"), F.sum("value").alias("sum"), F.max("value").alias("max"),
            F.min("value").alias("min"), F.count("value").alias("samples"),
        )
        .select("name", "exchange", F.col("_window.start").alias("period_start"), *_STATISTICS)
    )


def stream_alarms(
    spark: SparkSession, metrics: DataFrame, rule: AlarmRule, out: str, state: str, checkpoint: str,
    delay: str = "5 minutes", state_count: int | None = None,
) -> StreamingQuery:
    """Alarm states of closed periods. The last periods of each series are carried to the next batch."""
    periods = closed_periods(metrics.filter(F.col("name") == rule.metric), rule.period_seconds, delay)
    slots = SlotTable(spark, state, periods.schema)
    newest_first = Window.partitionBy("name", "exchange").orderBy(F.desc("period_start"))

    def step(batch: DataFrame, batch_id: int) -> None:
        merged = slots.before(batch_id).withColumn("_old", F.lit(True)).unionByName(
            batch.withColumn("_old", F.lit(False))
        )
        fresh = metric_alarm(merged, rule, keep=("_old",)).filter(~F.col("_old")).drop("_old")
        fresh.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        ranked = merged.withColumn("_age", F.row_number().over(newest_first))
        slots.save(ranked.filter(F.col("_age") <= rule.periods), batch_id)

    return run_batches(periods, step, checkpoint, state_count=state_count)
