"""The lake's manifest, days left to build, the incremental crawl, and tables distributed by symbol."""

import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marketlake import manifest
from marketlake.operators.candles import candles
from marketlake.operators.indicators import indicators
from marketlake.operators.trades import prepare_trades
from marketlake.plans import jobs
from marketlake.plans.monitor import metric_rollup, metric_rollups
from marketlake.sinks import lake as K
from marketlake.sources import crawl as CR
from marketlake.sources import lake as L


def records(spark, n, start, symbols=1, **extra):
    at = [start + timedelta(minutes=i) for i in range(n)]
    rows = [
        ("binance", f"s{i % symbols}", str(int(t.timestamp() * 1000)), 100.0 + i % 7, 1.0, 99.0, 101.0, str(i), 1.0, t)
        for i, t in enumerate(at)
    ]
    df = spark.createDataFrame(
        rows,
        "exchange string, symbol string, timestamp string, price double, volume double, bid double, ask double, "
        "trade_id string, quality_score double, landed timestamp",
    )
    return df.withColumns({name: F.lit(value) for name, value in extra.items()})


def files(df):
    return {f.split("/lake/")[1] for f in df.inputFiles()}


def test_a_day_lists_its_own_folders_only(spark, tmp_path):
    path = str(tmp_path / "lake")
    for n in range(4):
        K.write_raw_json(records(spark, 30, datetime(2024, 1, 14 + n, 23, 45)), path, batch=f"b{n}")
    day = L.read_day(spark, path, "2024/01/15")
    listed = files(day)
    assert listed and all("/year=2024/month=01/day=15/" in f for f in listed)
    assert {f.split("/")[0] for f in listed} == {"batch=b0", "batch=b1"}
    assert len(files(L.read_documents(spark, path))) > len(listed)
    assert L.read_batches(spark, path, "2024/01/15").count() == 30 == L.explode_records(
        L.prune_date(L.read_documents(spark, path), "2024/01/15")
    ).count()
    assert L.read_batches(spark, path, "2024/02/15").count() == 0
    assert set(day.columns) >= set(L.read_documents(spark, path).columns) - {"batch"}


def test_replay_leaves_no_doubles_in_the_manifest(spark, tmp_path):
    path = str(tmp_path / "lake")
    K.write_raw_json(records(spark, 10, datetime(2024, 1, 15)), path, batch="x")
    K.write_raw_json(records(spark, 20, datetime(2024, 1, 15)), path, batch="x")
    assert manifest.day_batches(spark, path).count() == 1
    assert L.read_batches(spark, path, "2024/01/15").count() == 20
    # Landed again under another day: the old entry leads to no file.
    K.write_raw_json(records(spark, 20, datetime(2024, 1, 16)), path, batch="x")
    assert L.read_batches(spark, path, "2024/01/15").count() == 0
    assert L.read_batches(spark, path, "2024/01/16").count() == 20


def test_labels_with_pattern_characters(spark, tmp_path):
    path = str(tmp_path / "lake")
    for label in ("a[1]", "a1", "a,b"):
        K.write_raw_json(records(spark, 5, datetime(2024, 1, 15)), path, batch=label)
    assert L.read_batches(spark, path, "2024/01/15").count() == 15


def test_deep_levels_and_a_lake_without_manifest(spark, tmp_path):
    from marketlake.schemas import PARTITION_COLUMNS

    path = str(tmp_path / "lake")
    K.write_raw_json(records(spark, 90, datetime(2024, 1, 15, 23)), path, batch="d", levels=PARTITION_COLUMNS)
    assert L.read_batches(spark, path, "2024/01/15", PARTITION_COLUMNS).count() == 60
    bare = str(tmp_path / "bare")
    os.makedirs(f"{bare}/batch=1/year=2024/month=01/day=15")
    with open(f"{bare}/batch=1/year=2024/month=01/day=15/a.json", "w") as f:
        f.write('{"records":[{"exchange":"e","symbol":"s"}],"count":1,"timestamp":1,"partition":"p"}\n')
    assert L.read_batches(spark, bare, "2024/01/15").count() == 1
    assert L.read_batches(spark, bare, "2024/01/16").count() == 0


def test_days_to_rerun(spark, tmp_path):
    raw, out = str(tmp_path / "lake"), str(tmp_path / "out")

    def left():
        return {(int(r.day), r.batches) for r in jobs.days_to_rerun(spark, raw, out).collect()}

    K.write_raw_json(records(spark, 30, datetime(2024, 1, 14, 23, 45)), raw, batch="0")
    assert left() == {(14, 1), (15, 1)}
    assert jobs.process_day(spark, raw, out, "2024/01/14") and left() == {(15, 1)}
    assert jobs.process_day(spark, raw, out, "2024/01/15") and left() == set()
    K.write_raw_json(records(spark, 3, datetime(2024, 1, 14, 10)), raw, batch="1")
    assert left() == {(14, 1)}
    assert jobs.process_day(spark, raw, out, "2024/01/14") and left() == set()
    daily = L.scan_candles(spark, K.candle_path(out, 1440)).groupBy("day").agg(F.sum("trade_count").alias("n"))
    assert {r.day: r.n for r in daily.collect()} == {14: 18, 15: 15}


def test_crawl_reads_new_days_only(spark, tmp_path):
    lake, out = str(tmp_path / "lake"), str(tmp_path / "schemas")
    K.write_raw_json(records(spark, 10, datetime(2024, 1, 14)), lake, batch="0")
    K.write_raw_json(records(spark, 10, datetime(2024, 1, 15), processed_at="x"), lake, batch="1")
    assert CR.crawl(spark, lake, out) == [date(2024, 1, 14), date(2024, 1, 15)]
    assert CR.crawl(spark, lake, out) == []
    # A hand-made batch: the price is text, ask is gone, and one line is no JSON.
    folder = f"{lake}/batch=2/year=2024/month=01/day=17"
    os.makedirs(folder)
    with open(f"{folder}/a.json", "w") as f:
        f.write('{"records":[{"exchange":"e","price":"7","bid":1},{"price":null}],"count":2}\nnot json\n')
    manifest.add_batch(spark, lake, "2")
    K.write_raw_json(records(spark, 5, datetime(2024, 1, 14)), lake, batch="3")
    assert CR.crawl(spark, lake, out) == [date(2024, 1, 14), date(2024, 1, 17)]
    crawled = CR.crawled_columns(spark, out)
    got = {(r.day, r.column_name, r.data_type): r.n_values for r in crawled.collect()}
    assert got["14", "records.price", "double"] == 15 and got["15", "records.processed_at", "string"] == 10
    assert got["17", "records.price", "string"] == got["17", "records.price", "void"] == got["17", "_unreadable", "string"] == 1
    assert got["17", "records", "array"] == 1 and got["17", "count", "bigint"] == 1
    whole = {r.column_name: (r.data_type, str(r.first_day), str(r.last_day)) for r in CR.lake_schema(crawled).collect()}
    assert whole["records.price"] == ("string", "2024-01-14", "2024-01-17")
    assert whole["records.bid"] == ("double", "2024-01-14", "2024-01-17")
    drift = {(str(r.date), r.column_name, r.change, r.data_type, r.type_before) for r in CR.schema_drift(crawled).collect()}
    assert {d for d in drift if d[0] == "2024-01-15"} == {("2024-01-15", "records.processed_at", "added", "string", None)}
    assert ("2024-01-17", "records.price", "changed", "string", "double") in drift
    assert ("2024-01-17", "records.bid", "changed", "bigint", "double") in drift
    assert ("2024-01-17", "records.ask", "dropped", None, "double") in drift
    assert ("2024-01-17", "_unreadable", "added", "string", None) in drift


def test_distribution_by_symbol_needs_no_shuffle(spark):
    trades = records(spark, 3000, datetime(2024, 1, 15), symbols=9).withColumn("ts", F.col("landed"))
    rows = indicators(candles(prepare_trades(trades), 5), 5)
    spark.sql("DROP TABLE IF EXISTS by_symbol")
    for _ in range(2):
        K.write_warehouse(rows, "by_symbol", buckets=4)
    stored = spark.table("by_symbol")
    assert stored.count() == rows.count()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        means = stored.groupBy("symbol").agg(F.avg("volume").alias("mean"))
        joined = stored.join(means, "symbol")
        assert joined.count() == rows.count()
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.sql("DROP TABLE by_symbol")


def test_periods_from_one_scan(spark):
    points = spark.createDataFrame(
        [("m", float(i), datetime(2024, 1, 1) + timedelta(seconds=97 * i)) for i in range(3000)] + [("m", None, datetime(2024, 1, 9))],
        "name string, value double, timestamp timestamp",
    ).withColumn("dimensions", F.lit(None).cast("map<string,string>"))
    got = metric_rollups(points, (300, 3600, 86400))
    for seconds in (300, 3600, 86400):
        expected = {r.period_start: r for r in metric_rollup(points, seconds).collect()}
        rows = got.filter(F.col("period_seconds") == seconds).collect()
        assert {r.period_start for r in rows} == set(expected)
        for r in rows:
            e = expected[r.period_start]
            assert (r.max, r.min, r.samples) == (e.max, e.min, e.samples)
            assert (r.sum, r.avg) == (pytest.approx(e.sum), pytest.approx(e.avg))
    assert got._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
