"""The daily batch job: landed documents of one day to candle tables at every interval."""

from __future__ import annotations

import argparse

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.config import INTERVAL_TABLES
from marketlake.functions.parsing import event_time, field
from marketlake.manifest import day_batches, mark_seen, unseen_days
from marketlake.operators.candles import candles_all_intervals
from marketlake.operators.indicators import indicators
from marketlake.operators.quality import data_quality_metrics
from marketlake.operators.rollups import daily_stats, exchange_performance
from marketlake.operators.trades import prepare_trades
from marketlake.session import configure
from marketlake.sinks.lake import write_candles_parquet, write_metric_table, write_warehouse
from marketlake.sources.lake import parse_date_partition, read_batches


def candles_with_indicators(trades: DataFrame, intervals: tuple[int, ...] = tuple(INTERVAL_TABLES)) -> DataFrame:
    """All intervals with indicators; one pass over the trades, one window pass over all candles."""
    return indicators(
        candles_all_intervals(trades, intervals),
        F.col("interval_minutes"),
        keys=("interval_minutes", "symbol", "exchange"),
    )


def process_day(
    spark: SparkSession,
    raw_path: str,
    processed_path: str,
    date_partition: str | None = None,
    warehouse_table: str | None = None,
    scored: DataFrame | None = None,
    metric_prefix: str = "",
    buckets: int | None = None,
) -> bool:
    """Build a day's candle tables (yesterday by default); False when the day has no trades.

    Only trades of the day itself enter, wherever they were filed: writing replaces whole days, and a stray of
    another day would replace that day by itself. With ``scored`` records, those of the day fill the metric tables
    too. The batches read are noted beside the candles, see ``days_to_rerun``.
    """
    day = parse_date_partition(date_partition)
    noted = day_batches(spark, raw_path, day).collect()  # before reading: what lands in between is seen as new
    records = read_batches(spark, raw_path, date_partition)
    trades = prepare_trades(records.filter(F.to_date("ts") == F.lit(day)))
    if trades.isEmpty():
        mark_seen(spark, runs_path(processed_path), noted)
        return False
    # Candles are small next to the trades; both sinks read them without aggregating again.
    result = candles_with_indicators(trades).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        write_candles_parquet(result, processed_path)
        if warehouse_table:
            write_warehouse(result.filter(F.col("interval_minutes") == 5), warehouse_table, buckets=buckets)
        if scored is not None:
            own = F.to_date(event_time(field(F.col("record"), "timestamp"))) == F.lit(day)
            store_metrics(scored.filter(own), result.filter(F.col("interval_minutes") == 5), metric_prefix)
    finally:
        result.unpersist()
    mark_seen(spark, runs_path(processed_path), noted)
    return True


def runs_path(processed_path: str) -> str:
    """Where the daily job notes the batches that each day was built from; readers of the candles skip it."""
    return f"{processed_path}/_runs"


def days_to_rerun(spark: SparkSession, raw_path: str, processed_path: str) -> DataFrame:
    """(year, month, day, batches): days never built, and days with batches that landed after they were built."""
    return unseen_days(spark, raw_path, runs_path(processed_path))


def store_metrics(scored: DataFrame, candles: DataFrame, prefix: str = "") -> None:
    """Fill the three metric tables from scored records and 5-minute candles with indicators.

    ``prefix`` goes before the tables' names, for a schema or a test. The days present are replaced.
    """
    quality = data_quality_metrics(scored).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        tables = {
            "data_quality_metrics": quality,
            "daily_stats": daily_stats(candles),
            "exchange_performance": exchange_performance(candles, quality),
        }
        for name, rows in tables.items():
            write_metric_table(rows, name, f"{prefix}{name}")
    finally:
        quality.unpersist()


def main() -> None:
    """spark-submit entry point: one day of the lake, or all days that need it, to candle tables."""
    parser = argparse.ArgumentParser(description=main.__doc__)
    parser.add_argument("--raw", required=True, help="folder of landed documents")
    parser.add_argument("--processed", required=True, help="folder of the candle trees")
    parser.add_argument("--date", help="YYYY/MM/DD, yesterday when left out")
    parser.add_argument("--stale", action="store_true", help="all days with batches that their last run hasn't seen")
    parser.add_argument("--table", help="catalog table for 5-minute candles")
    parser.add_argument("--buckets", type=int, help="buckets by symbol of that table")
    parser.add_argument("--scored", help="Parquet folder of scored records, to fill the metric tables")
    parser.add_argument("--metrics", default="", help="prefix of the metric tables")
    args = parser.parse_args()
    spark = configure(SparkSession.builder.appName("marketlake-candles").getOrCreate())
    days = [args.date]
    if args.stale:
        left = days_to_rerun(spark, args.raw, args.processed).orderBy("year", "month", "day").collect()
        days = [f"{row.year}/{row.month}/{row.day}" for row in left]
    scored = spark.read.parquet(args.scored) if args.scored else None
    for day in days:
        built = process_day(
            spark, args.raw, args.processed, day, args.table, scored, args.metrics, args.buckets
        )
        print(day or "yesterday", "candle tables written" if built else "no trades for this day")


if __name__ == "__main__":
    main()
