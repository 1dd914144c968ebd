"""Streams over several micro-batches equal their batch twins, also after a restart."""

import base64
import json
import time
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketlake.config import AlarmRule
from marketlake.operators import candles as C
from marketlake.operators import enrich as E
from marketlake.operators import indicators as N
from marketlake.operators.lookback import RowChunks
from marketlake.operators.trades import prepare_trades
from marketlake.plans import monitor as M
from marketlake.sources import lake as L
from marketlake.sources.feeds import union_feeds
from marketlake.streaming import alarms as STA
from marketlake.streaming import candles as STC
from marketlake.streaming import late as STL
from marketlake.streaming import quality as STQ
from marketlake.streaming import state as STS
from marketlake.streaming.run import file_stream

START = datetime(2024, 1, 1)
TRADE_SCHEMA = "symbol string, exchange string, ts timestamp, trade_id bigint, price double, volume double"


def _files(spark, path, rows, schema, files):
    """Write rows as consecutive files, so each micro-batch is one file in order."""
    size = -(-len(rows) // files)
    for i in range(files):
        part = rows[i * size: (i + 1) * size]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    return path


def _trade_rows(n=240):
    return [
        ("hot" if i % 4 else "cold", "x", START + timedelta(minutes=3 * i), i, 100.0 + i * 13 % 29, 1.0 + i % 3)
        for i in range(n)
    ]


def test_stream_candles_and_indicators(spark, tmp_path):
    rows = _trade_rows()
    path = _files(spark, str(tmp_path / "in"), rows, TRADE_SCHEMA, 4)
    stream = file_stream(spark, path, spark.read.parquet(path).schema, files_per_batch=1)
    closed = STC.stream_candles(stream, 15)
    out = str(tmp_path / "out")
    STC.stream_indicators(
        spark, closed, 15, out, str(tmp_path / "state"), str(tmp_path / "cp")
    ).awaitTermination()
    got = spark.read.parquet(out).drop("batch").orderBy("symbol", "interval_start").toPandas()

    batch = N.indicators(C.candles(prepare_trades(spark.createDataFrame(rows, TRADE_SCHEMA)), 15), 15)
    last = rows[-1][2] - timedelta(minutes=5)
    expected = batch.filter(F.col("interval_end") <= F.lit(last)).orderBy("symbol", "interval_start").toPandas()
    assert len(got) == len(expected) > 40
    pd.testing.assert_frame_equal(got[expected.columns.tolist()], expected, check_exact=False)


def test_feeds_unite_in_a_stream(spark, tmp_path):
    rows = [
        ("binance", json.dumps({"e": "trade", "s": "BTCUSDT", "p": "1.5", "q": "2", "T": 1704067200000, "t": "1"})),
        ("binance", json.dumps({"e": "kline", "s": "BTCUSDT"})),
        ("coinbase", json.dumps({"type": "match", "product_id": "BTC-USD", "price": "1.6", "size": "1",
                                 "time": "2024-01-01T00:00:01.000Z", "trade_id": "2"})),
        ("kraken", json.dumps({"pair": "XBT/USD", "price": "-1", "volume": "1", "time": "1704067202000"})),
        ("kraken", "broken"),
    ]
    path = _files(spark, str(tmp_path / "in"), rows, "feed string, message string", 3)
    stream = file_stream(spark, path, spark.read.parquet(path).schema, files_per_batch=1)
    feeds = {name: stream.filter(F.col("feed") == name) for name in ("binance", "coinbase", "kraken")}
    out = str(tmp_path / "out")
    query = (
        union_feeds(feeds).writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = {(r.exchange, r.symbol, r.price) for r in spark.read.parquet(out).collect()}
    assert got == {("binance", "btcusdt", 1.5), ("coinbase", "btcusd", 1.6)}


def _records(n=160):
    rows = []
    for i in range(n):
        at = START + timedelta(seconds=20 * i)
        record = {
            "exchange": "binance", "symbol": "hot" if i % 4 else "cold",
            "timestamp": str(1704067200000 + 20_000 * i), "price": 100.0 + i * 13 % 29, "volume": 1.0,
            "bid": 99.0, "ask": 101.0, "trade_id": f"{i:05d}",
        }
        if i % 10 == 3:
            record["price"] = -1.0
        if i % 10 == 7:
            record["timestamp"] = str(1704067200000 + 20_000 * i - 400_000)
        text = "broken" if i % 40 == 9 else json.dumps(record)
        rows.append((i, at, base64.b64encode(text.encode()).decode()))
    return rows


RECORD_SCHEMA = "record_id bigint, now timestamp, data string"


def _enriched_in_arrival_order(spark, rows, files):
    """What enrichment gives when micro-batches are taken one after the other."""
    history, out = {}, {}
    size = -(-len(rows) // files)
    for i in range(files):
        part = spark.createDataFrame(rows[i * size: (i + 1) * size], RECORD_SCHEMA)
        valid = STQ.valid_records(part, F.col("now")).orderBy("landed", "trade_id").collect()
        for r in valid:
            seen = history.setdefault(r.symbol, [])
            out[r.trade_id] = (
                r.price - seen[-1] if seen else None,
                sum((seen + [r.price])[-5:]) / 5 if len(seen) >= 4 else None,
            )
            seen.append(r.price)
    return out


@pytest.mark.parametrize("chunk", [5, 200_000])
def test_stateful_enrich_over_batches_and_restart(spark, tmp_path, chunk):
    rows, files = _records(), 5
    path = str(tmp_path / "in")
    paths = STQ.StreamPaths(str(tmp_path / "run"))
    size = -(-len(rows) // files)

    def run():
        stream = file_stream(spark, path, spark.read.parquet(path).schema, files_per_batch=1)
        STQ.stateful_enrich(
            spark, STQ.valid_records(stream, F.col("now")), paths, RowChunks(chunk)
        ).awaitTermination()

    # Two files, a stop, then the others: the second run goes on from the checkpoint and carried prices.
    for first, last in ((0, 2), (2, files)):
        for i in range(first, last):
            part = spark.createDataFrame(rows[i * size: (i + 1) * size], RECORD_SCHEMA)
            part.coalesce(1).write.mode("append").parquet(path)
        run()
    got = {r.trade_id: (r.price_change, r.sma_5) for r in spark.read.parquet(paths.enriched).collect()}
    expected = _enriched_in_arrival_order(spark, rows, files)
    assert got.keys() == expected.keys()
    for key, (change, sma) in expected.items():
        assert got[key][0] == (None if change is None else pytest.approx(change)), key
        assert got[key][1] == (None if sma is None else pytest.approx(sma)), key


def test_stream_quality_outputs(spark, tmp_path):
    rows = _records()
    path = _files(spark, str(tmp_path / "in"), rows, RECORD_SCHEMA, 2)
    stream = file_stream(spark, path, spark.read.parquet(path).schema, files_per_batch=1)
    paths = STQ.StreamPaths(str(tmp_path / "run"))
    STQ.stream_quality(spark, stream, paths, now=F.col("now"), dlq_enabled=True).awaitTermination()
    landed = L.read_batches(spark, paths.lake, "*")
    failed = spark.read.parquet(paths.failed)
    broken = sum(1 for i in range(160) if i % 40 == 9)
    invalid = sum(1 for i in range(160) if i % 10 == 3)
    assert landed.count() == 160 - broken - invalid
    assert failed.count() == broken + invalid
    late = sum(1 for i in range(160) if i % 10 == 7)
    assert spark.read.parquet(paths.late).count() == late
    assert landed.filter("quality_score < 0.95").count() == late
    totals = spark.read.parquet(paths.stats).agg(F.sum("total_records"), F.sum("invalid_records")).first()
    assert tuple(totals) == (160, broken + invalid)
    names = {r[0] for r in spark.read.parquet(paths.metrics).select("name").distinct().collect()}
    assert names == {
        "RecordsProcessed", "DataQualityScore", "TotalRecords", "ValidRecords", "InvalidRecords", "ProcessingTime",
    }
    single = E.enrich_records(STQ.valid_records(spark.createDataFrame(rows, RECORD_SCHEMA), F.col("now")))
    assert landed.agg(F.count("volatility")).first()[0] == single.agg(F.count("volatility")).first()[0]


def test_stream_alarms_carry_periods(spark, tmp_path):
    schema = "name string, value double, unit string, timestamp timestamp, dimensions map<string,string>"
    rows = [
        ("E", 1.0, "Count", START + timedelta(seconds=40 * i), None)
        for i in range(200) if (i // 20) % 3 != 1
    ]
    path = _files(spark, str(tmp_path / "in"), rows, schema, 5)
    stream = file_stream(spark, path, spark.read.parquet(path).schema, files_per_batch=1)
    rule = AlarmRule("E", "sum", 4.0, above=True)
    out = str(tmp_path / "out")
    STA.stream_alarms(spark, stream, rule, out, str(tmp_path / "s"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(out).select("period_start", "value", "state")
    batch = M.metric_alarm(M.metric_rollup(spark.createDataFrame(rows, schema), 300), rule)
    limit = rows[-1][3] - timedelta(minutes=10)
    expected = batch.filter(F.col("period_start") <= F.lit(limit)).select("period_start", "value", "state")
    assert sorted(got.collect()) == sorted(expected.collect())
    assert {r.state for r in got.collect()} == {"OK", "ALARM"}


def _append(spark, path, rows, files=1):
    size = -(-len(rows) // files)
    for i in range(files):
        spark.createDataFrame(rows[i * size: (i + 1) * size], RECORD_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def _keyed(spark, tmp_path, idle=None):
    path = str(tmp_path / "in")
    stream = file_stream(spark, path, spark.read.parquet(path).schema, files_per_batch=1)
    return (
        STS.keyed_enrich(STQ.valid_records(stream, F.col("now")), idle).writeStream.format("parquet")
        .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
    )


def test_keyed_state_over_batches_and_restart(spark, tmp_path):
    rows = _records()
    for part, files in ((rows[:64], 2), (rows[64:], 3)):
        _append(spark, str(tmp_path / "in"), part, files)
        _keyed(spark, tmp_path).trigger(availableNow=True).start().awaitTermination()
    got = {r.trade_id: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    expected = _enriched_in_arrival_order(spark, rows, 5)
    assert got.keys() == expected.keys()
    for key, (change, sma) in expected.items():
        assert got[key].price_change == (None if change is None else pytest.approx(change)), key
        assert got[key].sma_5 == (None if sma is None else pytest.approx(sma)), key


@pytest.mark.parametrize("idle", [0.05, 3600])
def test_keyed_state_expires(spark, tmp_path, idle):
    """A symbol silent for longer than the limit starts anew, as the timer has removed its state; else it goes on."""
    rows, path = _records(), str(tmp_path / "in")
    _append(spark, path, rows[:80])
    running = _keyed(spark, tmp_path, idle).trigger(processingTime="200 milliseconds").start()

    def wait_for(batches, seconds=60):
        until = time.monotonic() + seconds
        while time.monotonic() < until:
            if sum(p.numInputRows > 0 for p in running.recentProgress) >= batches:
                return {r.trade_id: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
            time.sleep(0.2)
        raise TimeoutError(str(running.lastProgress))

    try:
        first = wait_for(1)
        assert any(r.sma_10 is not None for r in first.values())
        time.sleep(2)  # batches without data let the timer fire
        _append(spark, path, rows[80:])
        second = {key: r for key, r in wait_for(2).items() if key not in first}
    finally:
        running.stop()
    anew = [r.symbol for r in second.values() if r.price_change is None]
    assert sorted(anew) == (sorted({r.symbol for r in second.values()}) if idle < 1 else [])


def test_tick_columns_by_definition():
    import statistics

    import numpy as np

    prices = [0.0, 3.0, 5.0, 0.0, 2.0, *[float(7 * i % 11) for i in range(30)]]
    for carried in (0, 3, 9, 20):
        got = STS.tick_columns(np.asarray(prices), carried)
        for i in range(carried, len(prices)):
            before = prices[i - 1] if i else 0.0
            want = {
                "price_change": prices[i] - before if before > 0 else None,
                "price_change_percentage": (prices[i] - before) / before * 100 if before > 0 else None,
                "sma_5": sum(prices[i - 4: i + 1]) / 5 if i >= 4 else None,
                "sma_10": sum(prices[i - 9: i + 1]) / 10 if i >= 9 else None,
                "volatility": statistics.pstdev(prices[i - 9: i + 1]) if i >= 9 else None,
            }
            for name, value in want.items():
                x = got[name][i - carried]
                assert np.isnan(x) if value is None else x == pytest.approx(value, abs=1e-9)


def test_late_trades_mend_candles(spark, tmp_path):
    """Stream and batch candles agree although every fifth trade comes hours late; the late ones are listed."""
    rows = _trade_rows()
    on_time = [r for i, r in enumerate(rows) if i % 5]
    late = [r for i, r in enumerate(rows) if i % 5 == 0]
    batches = [on_time[:60], late[:10] + on_time[60:120], on_time[120:], late[10:40], late[40:]]
    path, root = str(tmp_path / "in"), str(tmp_path / "run")
    for stop in (3, 5):  # a restart between
        for part in batches[stop - 3 if stop == 3 else 3: stop]:
            spark.createDataFrame(part, TRADE_SCHEMA).coalesce(1).write.mode("append").parquet(path)
        stream = file_stream(spark, path, spark.read.parquet(path).schema, files_per_batch=1)
        STL.stream_mended_candles(spark, stream, root, 15).awaitTermination()
    order = ["symbol", "exchange", "interval_start"]
    got = STL.mended_candles(spark, root).orderBy(*order).toPandas()
    batch = C.candles(prepare_trades(spark.createDataFrame(rows, TRADE_SCHEMA).withColumn("ts", F.col("ts").cast("timestamp_ntz"))), 15)
    last = max(r[2] for r in rows) - timedelta(minutes=5)
    closed = batch.filter(F.col("interval_end") <= F.lit(last).cast("timestamp_ntz")).orderBy(*order).toPandas()
    assert len(got) == len(closed) > 40
    pd.testing.assert_frame_equal(got[closed.columns.tolist()], closed, check_exact=False)

    expected, reached = set(), datetime.min
    for n, part in enumerate(batches):
        for r in part:
            end = START + (((r[2] - START) // timedelta(minutes=15)) + 1) * timedelta(minutes=15)
            if end <= reached:
                expected.add((r[3], n))
        reached = max(reached, max(r[2] for r in part) - timedelta(minutes=5))
    found = {(r.trade_id, r.batch) for r in STL.late_trades(spark, root).collect()}
    assert found == expected and len(expected) > 20


def test_mended_candles_repeat_a_batch(spark, tmp_path):
    """A batch that runs twice leaves the same tables; batches without a usable trade change nothing."""
    rows = _trade_rows(80)
    tables = STL.MendedCandles(spark, str(tmp_path / "run"), 15)
    parts = [rows[:40], [("hot", "x", START, 1, -1.0, 1.0)], rows[40:] + rows[:3]]
    for n in (0, 0, 1, 2, 2):
        tables.step(spark.createDataFrame(parts[n], TRADE_SCHEMA), n)
    once = STL.MendedCandles(spark, str(tmp_path / "once"), 15)
    for n in (0, 1, 2):
        once.step(spark.createDataFrame(parts[n], TRADE_SCHEMA), n)
    for read in (STL.mended_candles, STL.late_trades):
        a, b = (sorted(map(str, read(spark, t.root).collect())) for t in (tables, once))
        assert a == b and a


def test_records_are_decoded_on_all_cores(spark, tmp_path):
    """Events of one row group: a scan of them, and a micro-batch of one such file, would be one task."""
    from marketlake.queries import inputs, registry

    events = spark.range(0, 4000, 1, 1).selectExpr(
        "id event_id", "timestamp_ntz '2024-01-01' + make_dt_interval(cast(id % 30 as int)) ts", "id % 7 user_id",
        "'click' event_type", "cast(id % 90 as double) value", "'{\"k\":1}' props",
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    cores = spark.sparkContext.defaultParallelism
    assert cores > 1 and inputs.stream_records(spark, str(tmp_path)).rdd.getNumPartitions() == cores

    class Done:
        def awaitTermination(self):
            seen.append(len(list((tmp_path / "run" / "arrived").glob("*.parquet"))))

    seen = []
    registry._by_days(spark, str(tmp_path), STQ.StreamPaths(str(tmp_path / "run")), lambda arrived: Done())
    assert seen == [cores, 2 * cores, 3 * cores, 4 * cores]
    assert spark.read.parquet(str(tmp_path / "run" / "arrived")).exceptAll(events).count() == 0

    # What lands in two parts is decoded once.
    plan = registry.landable(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "base64" not in plan


def test_arrival_order_of_a_large_group():
    """By time and then text, nulls first, equal rows as they come; much faster than by comparing Python objects."""
    import random

    import pandas as pd

    rng = random.Random(5)
    times = [None, *pd.date_range("2024-01-01", periods=300, freq="s")]
    ids = [None, "", "é", "z", "\U0001f600", "\uffee", *[f"t{rng.randrange(10**12)}" for _ in range(200_000)]]
    rows = pd.DataFrame({"landed": rng.choices(times, k=200_000), "trade_id": rng.choices(ids, k=190_000) + ids[:6] * 1666 + ids[:4]})
    rows["landed"] = rows["landed"].astype("datetime64[ns]")

    def key(i, row):
        return (not pd.isna(row[0]), 0 if pd.isna(row[0]) else row[0], row[1] is not None, row[1] or "", i)

    expected = [k[-1] for k in sorted(key(i, r) for i, r in enumerate(zip(rows["landed"], rows["trade_id"])))]

    def seconds(sort):
        started = time.perf_counter()
        found = sort()
        return time.perf_counter() - started, found

    took, got = min((seconds(lambda: STS.arrival_order(rows)) for _ in range(3)), key=lambda x: x[0])
    plain, _ = seconds(lambda: rows.sort_values(["landed", "trade_id"], na_position="first", kind="stable"))
    assert got.tolist() == expected
    assert took < plain / 2
    assert STS.arrival_order(rows[:0]).tolist() == []
