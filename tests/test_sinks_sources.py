import json
import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marketlake import schemas
from marketlake.functions.parsing import event_time
from marketlake.functions.paths import landing_time, partition_key
from marketlake.operators.candles import candles
from marketlake.operators.indicators import indicators
from marketlake.operators.trades import prepare_trades
from marketlake.plans.jobs import process_day
from marketlake.sinks import lake as K
from marketlake.sources import lake as L
from marketlake.storage import shared_root, work_path

NOW = "2024-03-05 06:07:08"


def _records(spark, n=450, hot=400, start=datetime(2024, 1, 15, 22)):
    rows = [
        (
            "binance" if i < hot else "coinbase", "btcusdt", str(1705356000000 + i * 10_000), 100.0 + i % 7, 1.0, 99.0,
            101.0, str(i), 1.0, start + timedelta(seconds=10 * i),
        )
        for i in range(n)
    ]
    return spark.createDataFrame(
        rows,
        "exchange string, symbol string, timestamp string, price double, volume double, bid double, ask double, "
        "trade_id string, quality_score double, landed timestamp",
    )


def test_partition_key(spark):
    rows = [("binance", "btcusdt", "1640995200000", True), (None, None, None, False), ("b", "s", "soon", True)]
    df = spark.createDataFrame(rows, "e string, s string, t string, present boolean")
    at = landing_time(event_time(F.col("t")), F.col("present"), F.lit(NOW).cast("timestamp"))
    keys = [r[0] for r in df.select(partition_key(F.col("e"), F.col("s"), at)).collect()]
    assert keys == [
        "binance/btcusdt/year=2022/month=01/day=01/hour=00",
        "unknown/unknown/year=1970/month=01/day=01/hour=00",
        "b/s/year=2024/month=03/day=05/hour=06",
    ]


@pytest.mark.parametrize("levels", [schemas.DATE_LEVELS, schemas.PARTITION_COLUMNS])
def test_documents_round_trip(spark, tmp_path, levels):
    path = str(tmp_path / "lake")
    records = _records(spark)
    K.write_raw_json(records, path, F.lit(NOW).cast("timestamp"), limit=50, levels=levels)
    docs = L.read_documents(spark, path, levels)
    assert docs.agg(F.max("count")).first()[0] <= 50
    assert docs.filter(F.size("records") != F.col("count")).count() == 0
    back = L.explode_records(docs)
    same = ["exchange", "symbol", "timestamp", "price", "volume", "bid", "ask", "trade_id", "quality_score"]
    assert sorted(map(tuple, back.select(*same).collect())) == sorted(map(tuple, records.select(*same).collect()))
    assert {r[0] for r in back.select("data_partition").distinct().collect()} == {
        "binance/btcusdt/year=2024/month=01/day=15/hour=22", "binance/btcusdt/year=2024/month=01/day=15/hour=23",
        "coinbase/btcusdt/year=2024/month=01/day=15/hour=23",
    }
    assert L.prune_date(docs, "2024/01/15").count() == docs.count()
    assert L.prune_date(docs, "2024/01/16").count() == 0
    text = next(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".json"))
    first = json.loads(open(text).readline())
    assert set(first) == {"records", "count", "timestamp", "partition"} and first["timestamp"] == 1709618828


def test_repeated_batch_replaces_itself_only(spark, tmp_path):
    path = str(tmp_path / "lake")
    for batch in ("1", "2", "2"):
        K.write_raw_json(_records(spark), path, batch=batch)
    assert L.read_batches(spark, path, "*").count() == 900


def test_date_filter_prunes_directories(spark, tmp_path):
    path = str(tmp_path / "lake")
    K.write_raw_json(_records(spark), path)
    K.write_raw_json(_records(spark, start=datetime(2024, 1, 20)), path)
    day = L.prune_date(L.read_documents(spark, path), "2024/01/15")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert day.agg(F.sum("count")).first()[0] == 450


def test_default_date_is_yesterday():
    assert L.yesterday(datetime(2024, 3, 1)) == date(2024, 2, 29)
    assert L.parse_date_partition("2024/01/15") == date(2024, 1, 15)
    assert L.parse_date_partition(None) == L.yesterday()


def test_inferred_schema(spark, tmp_path):
    path = str(tmp_path / "lake")
    K.write_raw_json(_records(spark), path)
    found = {r.column_name: r.data_type for r in L.infer_raw_schema(spark, path).collect()}
    assert found["count"] == "bigint" and found["partition"] == "string" and found["year"] == "int"
    assert found["records"].startswith("array<struct<")


def _hourly(spark, days=2):
    trades = _records(spark, 2000, 2000, datetime(2024, 1, 15, 22)).withColumn("ts", F.col("landed"))
    return indicators(candles(prepare_trades(trades), 5), 5)


def test_candle_trees(spark, tmp_path):
    root = str(tmp_path / "out")
    rows = _hourly(spark)
    K.write_candles_parquet(rows, root)
    K.write_candles_parquet(rows.filter("day = 16"), root)
    stored = L.scan_candles(spark, K.candle_path(root, 5))
    assert stored.count() == rows.count()
    days = stored.filter(F.make_date("year", "month", "day") == F.lit(date(2024, 1, 16)))
    assert days.count() == rows.filter("day = 16").count()
    assert os.path.isdir(f"{root}/candle_table=ohlcv_5min/year=2024/month=1/day=15")


def test_candle_table_columns(spark):
    rows = _hourly(spark)
    assert "rsi" not in K.project_candle_table(rows, 1).columns
    fifteen = K.project_candle_table(rows, 15)
    assert "rsi" in fifteen.columns and "macd" not in fifteen.columns
    assert "hour" not in K.project_candle_table(rows, 1440).columns
    assert "avg_spread" in K.project_candle_table(rows, 5).columns
    assert "avg_spread" not in K.project_candle_table(rows, 60).columns
    types = dict(K.project_candle_table(rows, 5).dtypes)
    assert (types["close"], types["rsi"], types["trade_count"]) == ("decimal(20,8)", "decimal(10,4)", "int")


def test_candle_table_holds_any_percentage(spark):
    """From 0.01 to 350.24 a close gains 3,502,300 percent; a small bid makes such spreads too."""
    close = F.when(F.col("minute") % 10 == 0, 0.01).otherwise(350.24)
    rows = _hourly(spark).withColumn("minute", F.minute("interval_start")).withColumns({
        "close": close, "price_change_percentage": F.when(F.col("minute") % 10 != 0, (close - 0.01) / 0.01 * 100),
        "avg_spread_percentage": F.lit(1e22),
    })
    for minutes in (5, 15, 60):
        stored = K.project_candle_table(rows, minutes).collect()
        assert {str(r.price_change_percentage) for r in stored} == {"3502300.0000", "None"}
    assert {str(r.avg_spread_percentage) for r in K.project_candle_table(rows, 5).collect()} == {"10000000000000000000000.0000"}
    spark.sql("DROP TABLE IF EXISTS ohlcv_wide")
    K.write_warehouse(rows.drop("minute"), "ohlcv_wide", buckets=2)
    assert spark.table("ohlcv_wide").agg(F.max("price_change_percentage").cast("double")).first()[0] == 3502300
    spark.sql("DROP TABLE ohlcv_wide")


def test_warehouse_table(spark):
    rows = _hourly(spark)
    spark.sql("DROP TABLE IF EXISTS ohlcv_test")
    K.write_warehouse(rows.filter("day = 15"), "ohlcv_test")
    K.write_warehouse(rows.filter("day = 16"), "ohlcv_test")
    K.write_warehouse(rows.filter("day = 16"), "ohlcv_test")  # a rerun leaves no doubles
    stored = spark.table("ohlcv_test")
    assert stored.count() == rows.count()
    assert stored.select("id").distinct().count() == rows.count()
    assert stored.filter("created_at IS NULL").count() == 0
    again = K.with_surrogate_id(rows).select("id").distinct()
    assert again.join(stored, "id", "left_anti").count() == 0


def test_layout_is_sorted_inside_files(spark):
    parts = K.layout(_hourly(spark)).withColumn("part", F.spark_partition_id()).collect()
    for part in {r.part for r in parts}:
        keys = [(r.year, r.month, r.day, r.interval_start, r.symbol) for r in parts if r.part == part]
        assert keys == sorted(keys)


def test_daily_job(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    K.write_raw_json(_records(spark), raw)
    assert process_day(spark, raw, out, "2023/01/01") is False
    assert not os.path.exists(out)
    spark.sql("DROP TABLE IF EXISTS job_5min")
    assert process_day(spark, raw, out, "2024/01/15", "job_5min") is True
    tables = {r[0]: r[1] for r in spark.read.parquet(out).groupBy("candle_table").agg(F.sum("trade_count")).collect()}
    assert tables == dict.fromkeys(
        ["ohlcv_1min", "ohlcv_5min", "ohlcv_15min", "ohlcv_1h", "ohlcv_4h", "ohlcv_daily"], 450
    )
    assert spark.table("job_5min").agg(F.sum("trade_count")).first()[0] == 450


def test_daily_job_leaves_other_days_alone(spark, tmp_path):
    """A trade of the evening that lands after midnight, with an ISO time, belongs to its own day only."""
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    schema = "exchange string, symbol string, timestamp string, price double, volume double, trade_id string"
    evening = [("binance", "btcusdt", f"2024-01-14T23:00:{i % 60:02d}.000Z", 100.0 + i, 1.0, str(i)) for i in range(100)]
    stray = [("coinbase", "btcusd", "2024-01-14T23:59:59.900Z", 50.0, 1.0, "s")]
    after = [("binance", "btcusdt", "1705276801000", 99.0, 1.0, "n")]

    def land(rows, batch):
        records = spark.createDataFrame(rows, schema)
        own = event_time(F.col("timestamp"))
        records = records.withColumn("landed", landing_time(own, F.lit(True), F.lit("2024-01-15 00:00:05").cast("timestamp")))
        K.write_raw_json(records.withColumn("quality_score", F.lit(0.9)), raw, batch=batch)

    def daily():
        rows = L.scan_candles(spark, K.candle_path(out, 1440)).groupBy("day").agg(F.sum("trade_count").alias("n"))
        return {r.day: r.n for r in rows.collect()}

    land(evening, "0")
    assert process_day(spark, raw, out, "2024/01/14") and daily() == {14: 100}
    land(stray + after, "1")
    assert process_day(spark, raw, out, "2024/01/15") and daily() == {14: 100, 15: 1}
    assert process_day(spark, raw, out, "2024/01/14") and daily() == {14: 101, 15: 1}


def test_a_batch_landed_again_under_another_day_leaves_no_doubles(spark, tmp_path):
    path = str(tmp_path / "lake")
    for start in (datetime(2024, 1, 15), datetime(2024, 1, 16)):
        K.write_raw_json(_records(spark, start=start), path, batch="7")
    days = L.read_documents(spark, path).select("day").distinct().collect()
    assert [r.day for r in days] == ["16"]


def test_metric_tables(spark):
    day = date(2024, 1, 15)
    quality = spark.createDataFrame(
        [("x", "s", day, 4, 3, 1, 0.875, 1.5, 2.0, 1.0, 2.0), ("unknown", "unknown", None, 1, 0, 1, None, None, None, None, None)],
        "exchange string, symbol string, date date, total_records bigint, valid_records bigint, invalid_records bigint, "
        "quality_score double, avg_price double, avg_volume double, min_price double, max_price double",
    )
    spark.sql("DROP TABLE IF EXISTS dq_test")
    for _ in range(2):
        K.write_metric_table(quality, "data_quality_metrics", "dq_test")
    stored = spark.table("dq_test")
    types = dict(stored.dtypes)
    assert (types["quality_score"], types["avg_price"], types["total_records"]) == ("decimal(5,4)", "decimal(20,8)", "int")
    row = stored.collect()
    assert len(row) == 1 and row[0].created_at is not None and len(row[0].id) == 32


def test_store_metrics(spark):
    from marketlake.operators.quality import score_records
    from marketlake.plans.jobs import store_metrics
    from marketlake.sources.feeds import decode_stream

    record = '{"exchange":"binance","symbol":"btcusdt","timestamp":"1705313400000","price":1.5,"volume":2}'
    rows = decode_stream(spark.createDataFrame([(1, record), (2, "no json")], "record_id long, data string"), encoding="plain")
    store_metrics(score_records(rows, now=F.lit("2024-01-15 10:10:00").cast("timestamp")), _hourly(spark), "m_")
    counts = {name: spark.table(f"m_{name}").count() for name in schemas.METRIC_TABLE_COLUMNS}
    assert counts["data_quality_metrics"] == 1 and counts["daily_stats"] > 0 and counts["exchange_performance"] > 0
    for name in counts:
        spark.sql(f"DROP TABLE m_{name}")


def test_work_paths_follow_the_session_setting(spark):
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_root(spark) == root
    assert work_path(spark, "a").startswith(f"{root}/marketlake/")
    assert work_path(spark, "a") != work_path(spark, "a")
