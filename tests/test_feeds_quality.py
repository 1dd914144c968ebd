import json
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marketlake.config import FEEDS, QualityBounds
from marketlake.functions import parsing
from marketlake.functions.quality import source_score
from marketlake.operators import enrich as E
from marketlake.operators.lookback import RowChunks
from marketlake.operators import quality as Q
from marketlake.sources import feeds as FD

BINANCE = {"e": "trade", "s": "BTCUSDT", "p": "50000.00", "q": "1.5", "T": 1640995200000, "t": "12345"}
COINBASE = {
    "type": "match", "product_id": "BTC-USD", "price": "50000.00", "size": "1.5",
    "time": "2022-01-01T00:00:00.000Z", "trade_id": "12345",
}
KRAKEN = {"pair": "XBT/USD", "price": "50025.0", "volume": "1.8", "time": "1640995200000"}


def _messages(spark, *items):
    texts = [(i if isinstance(i, str) else json.dumps(i),) for i in items]
    return spark.createDataFrame(texts, "message string")


def _without(message, *keys):
    return {k: v for k, v in message.items() if k not in keys}


@pytest.mark.parametrize(
    "feed,message,symbol,price,volume,trade_id",
    [
        ("binance", BINANCE, "btcusdt", 50000.0, 1.5, "12345"),
        ("coinbase", COINBASE, "btcusd", 50000.0, 1.5, "12345"),
        ("kraken", KRAKEN, "xbtusd", 50025.0, 1.8, None),
    ],
)
def test_normalised_trade(spark, feed, message, symbol, price, volume, trade_id):
    row = FD.normalize(_messages(spark, message), FEEDS[feed]).first()
    assert (row.exchange, row.symbol, row.price, row.volume, row.trade_id) == (feed, symbol, price, volume, trade_id)
    assert row.quality_score == 1.0
    assert row.ts == datetime(2022, 1, 1)


def test_wrong_type_is_dropped_and_malformed_is_quarantined(spark):
    messages = _messages(
        spark, {**BINANCE, "e": "kline"}, "invalid json", _without(BINANCE, "p"), {**BINANCE, "p": "abc"},
        _without(BINANCE, "T"), "[1, 2]", BINANCE,
    )
    assert FD.normalize(messages, FEEDS["binance"]).count() == 1
    bad = FD.quarantine(messages, FEEDS["binance"])
    assert bad.count() == 5
    assert FD.normalize(_messages(spark, {**COINBASE, "type": "ticker"}), FEEDS["coinbase"]).count() == 0


@pytest.mark.parametrize(
    "message,score",
    [
        (BINANCE, 1.0), (_without(BINANCE, "q", "T"), 0.6), ({**BINANCE, "p": "-100.00"}, 0.7),
        ({**BINANCE, "p": "abc"}, 0.7), ({}, 0.0),
    ],
)
def test_source_score(spark, message, score):
    df = _messages(spark, message).withColumn("record", parsing.json_map(F.col("message")))
    assert df.select(source_score(F.col("record"), FEEDS["binance"])).first()[0] == pytest.approx(score)


def test_ingest_stats(spark):
    df = spark.range(105).withColumn("sent", F.col("id") < 100)
    row = FD.ingest_stats(df, F.col("sent")).first()
    assert (row.total_records_sent, row.failed_records) == (100, 5)
    assert row.success_rate == pytest.approx(0.952, abs=1e-3)
    assert FD.ingest_stats(df.filter("id < 0"), F.col("sent")).first().success_rate == 1.0


def test_numbers_and_times(spark):
    texts = ["1.5", " 2 ", "1e3", ".5", "5d", "7F", "0x10", "", "abc", "nan", "-inf", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(parsing.number(F.col("t"))).collect()]
    assert got[:4] == [1.5, 2.0, 1000.0, 0.5]
    assert got[4:9] == [None] * 5
    assert got[9] != got[9] and got[10] == float("-inf") and got[11] is None
    times = ["1640995200123", "2022-01-01T00:00:00.123Z", "99999999999999999999", "9223372036854775807", "soon"]
    df = spark.createDataFrame([(t,) for t in times], "t string")
    got = [r[0] for r in df.select(parsing.event_time(F.col("t")).cast("timestamp_ntz")).collect()]
    assert got == [datetime(2022, 1, 1, 0, 0, 0, 123000)] * 2 + [None] * 3
    values = spark.createDataFrame([(2e7,), (20000000.5,), (-1.0,), (50.25,)], "v double")
    texts = [r[0] for r in values.select(parsing.plain_decimal_text(F.col("v"))).collect()]
    assert texts == ["20000000.0", "20000000.5", "-1.0", "50.25"]


NOW = datetime(2024, 1, 1, 12)
NOW_MS = int((NOW - datetime(1970, 1, 1)).total_seconds() * 1000)
GOOD = {"exchange": "binance", "symbol": "btcusdt", "timestamp": str(NOW_MS), "price": 50000.0, "volume": 1.5}


def _scored(spark, *records, bounds=QualityBounds()):
    rows = [(i, r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(records)]
    df = spark.createDataFrame(rows, "record_id bigint, payload string")
    df = df.withColumn("record", parsing.json_map(F.col("payload")))
    return Q.score_records(df, bounds, F.lit(NOW.isoformat(sep=" ")).cast("timestamp"))


@pytest.mark.parametrize(
    "record,status,score,errors",
    [
        (GOOD, "valid", 1.0, []),
        (_without(GOOD, "price"), "valid", 0.8, ["Missing required field: price"]),
        (_without(GOOD, "price", "volume"), "invalid", 0.6,
         ["Missing required field: price", "Missing required field: volume"]),
        ({**GOOD, "price": None}, "invalid", 0.7, ["Invalid price format"]),
        ({**GOOD, "price": -1.0}, "invalid", 0.7, ["Price -1.0 outside valid range [0.01, 1000000.0]"]),
        ({**GOOD, "volume": -1.0}, "valid", 0.8, ["Volume -1.0 below minimum 0.0"]),
        ({**GOOD, "timestamp": str(NOW_MS - 300_001)}, "valid", 0.9, [f"Timestamp {NOW_MS - 300_001} too old"]),
        ({**GOOD, "timestamp": str(NOW_MS - 300_000)}, "valid", 1.0, []),
        ({**GOOD, "timestamp": "2022-01-01T00:00:00Z"}, "valid", 0.9, ["Invalid timestamp format"]),
        ({**GOOD, "timestamp": "9223372036854775807"}, "valid", 0.9, ["Timestamp 9223372036854775807 too old"]),
        ({**GOOD, "exchange": "Other"}, "valid", 0.8, ["Invalid exchange: Other"]),
        ({**GOOD, "exchange": "KRAKEN"}, "valid", 1.0, []),
        ({**GOOD, "exchange": None}, "failed", 1.0, []),
        ({"exchange": "binance", "symbol": "BTCUSDT", "price": "invalid_price", "volume": "invalid_volume"}, "invalid",
         0.3, ["Missing required field: timestamp", "Invalid price format", "Invalid volume format"]),
        ("not json", "failed", None, None),
        ({}, "invalid", 0.0, None),
    ],
)
def test_record_score(spark, record, status, score, errors):
    row = _scored(spark, record).first()
    assert row.status == status
    assert row.quality_score == (None if score is None else pytest.approx(score))
    if errors is not None:
        assert row.errors == errors


def test_lower_threshold_fails_unreadable_price(spark):
    row = _scored(spark, {**GOOD, "price": "x"}, bounds=QualityBounds(threshold=0.6)).first()
    assert row.status == "failed"


def test_routing_and_stats(spark):
    scored = _scored(spark, GOOD, {**GOOD, "price": -1.0}, "not json", {**GOOD, "exchange": "it's"})
    routed = Q.split_valid_invalid(scored, dlq_enabled=True)
    assert routed.valid.count() == 2
    reasons = {r.record_id: r.reason for r in routed.failed.collect()}
    assert reasons[1] == "Data quality validation failed: ['Price -1.0 outside valid range [0.01, 1000000.0]']"
    assert reasons[2].startswith("Processing error")
    assert Q.split_valid_invalid(scored).failed.count() == 1
    stats = Q.batch_stats(scored).first()
    assert (stats.total_records, stats.valid_records, stats.invalid_records) == (4, 2, 2)
    assert stats.alert == "High error rate detected: 2/4 records failed"
    assert Q.batch_stats(_scored(spark, GOOD)).first().alert is None
    metrics = {(r.name, (r.dimensions or {}).get("Exchange")): r.value for r in Q.emit_metrics(scored, F.lit(NOW.isoformat(sep=" "))).collect()}
    assert metrics[("RecordsProcessed", "binance")] == 1.0
    assert metrics[("DataQualityScore", "it's")] == pytest.approx(0.8)
    assert metrics[("InvalidRecords", None)] == 2.0 and metrics[("TotalRecords", None)] == 4.0


def test_json_is_parsed_once_per_row(spark):
    """A filter on the verdict must not copy the parser into the plan once per rule."""
    valid = _scored(spark, GOOD).filter(F.col("status") == Q.VALID)
    plan = valid._jdf.queryExecution().optimizedPlan().toString()
    decoded = FD.decode_stream(spark.createDataFrame([(1, "e30=")], "record_id bigint, data string"))
    scored = Q.score_records(decoded, now=F.current_timestamp()).filter(F.col("status") == Q.VALID)
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") <= 1


def _tick_expected(ticks):
    """Row-at-a-time definition of the tick statistics."""
    history, out = {}, {}
    for trade_id, symbol, price in ticks:
        p = 0.0 if price is None else price
        seen = history.setdefault(symbol, [])
        change = p - seen[-1] if seen and seen[-1] > 0 else None
        percent = change / seen[-1] * 100 if change is not None else None
        seen.append(p)
        out[trade_id] = (
            change, percent,
            sum(seen[-5:]) / 5 if len(seen) >= 5 else None,
            sum(seen[-10:]) / 10 if len(seen) >= 10 else None,
            statistics.pstdev(seen[-10:]) if len(seen) >= 10 else None,
        )
    return out


@pytest.mark.parametrize("chunk", [None, 7, 200_000])
def test_tick_statistics_by_definition(spark, chunk):
    rows, at = [], NOW
    for i in range(300):
        at += timedelta(seconds=[0, 1, 20, 400][i * 7 % 4])
        symbol = "hot" if i % 3 else "cold"
        rows.append((i, symbol, at, None if i % 29 == 0 else float(10 + i * 13 % 17)))
    df = spark.createDataFrame(rows, "trade_id bigint, symbol string, ts timestamp_ntz, price double")
    got = {r.trade_id: r for r in E.tick_enrich(df, chunks=None if chunk is None else RowChunks(chunk)).collect()}
    expected = _tick_expected([(r[0], r[1], r[3]) for r in rows])
    assert got.keys() == expected.keys()
    for key, values in expected.items():
        for name, value in zip(E.TICK_COLUMNS, values):
            assert got[key][name] == (None if value is None else pytest.approx(value, abs=1e-9)), (key, name)


def test_ticks_are_read_once(spark, tmp_path):
    """The tails of the chunks come from the shuffle that the windows read too."""
    path = str(tmp_path / "ticks")
    rows = [(i, "hot", NOW + timedelta(seconds=90 * i), float(i), "more") for i in range(300)]
    spark.createDataFrame(rows, "trade_id bigint, symbol string, ts timestamp_ntz, price double, other string").write.parquet(path)
    df = E.tick_enrich(spark.read.parquet(path)).select("trade_id", "symbol", "sma_5", "sma_10")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    assert final.count("Scan parquet") == 1 and "ReusedExchange" in final


def test_feeds_of_one_table_are_read_once(spark, tmp_path):
    path = str(tmp_path / "messages")
    binance = '{"e":"trade","s":"BTCUSDT","p":"1.5","q":"2","T":1640995200000,"t":"1"}'
    coinbase = '{"type":"match","product_id":"BTC-USD","price":"3","size":"1","time":"2022-01-01T00:00:00.000Z","trade_id":"2"}'
    rows = [("binance", binance), ("coinbase", coinbase), ("binance", coinbase), ("nobody", binance), ("kraken", "x")]
    spark.createDataFrame(rows, "feed string, message string").write.parquet(path)
    messages = spark.read.parquet(path)
    once = FD.admit_feeds(messages)
    parts = FD.union_feeds({name: messages.filter(F.col("feed") == name) for name in FD.FEEDS})
    assert sorted(map(str, once.collect())) == sorted(map(str, parts.collect())) and once.count() == 2
    assert once._jdf.queryExecution().executedPlan().toString().count("Scan parquet") == 1


@pytest.mark.parametrize("data,plain", [("?? no base64 ??", False), ("//57fQ==", False), ("e30", False), (None, False), ("", True), (None, True)])
def test_no_payload_ends_the_batch(spark, data, plain):
    df = spark.createDataFrame([(1, data)], "record_id bigint, data string")
    scored = Q.score_records(FD.decode_stream(df, encoding="plain" if plain else "base64"), now=F.current_timestamp())
    assert [r.status for r in scored.collect()] in ([Q.FAILED], [Q.INVALID])


def test_plain_payloads(spark):
    df = spark.createDataFrame([(1, json.dumps(GOOD))], "record_id bigint, data string")
    assert FD.decode_stream(df, encoding="plain").first().record["exchange"] == GOOD["exchange"]


def test_iso_times_can_be_late(spark):
    scored = _scored(spark, {**GOOD, "timestamp": (NOW - timedelta(days=1)).isoformat() + "Z"}, {**GOOD, "timestamp": NOW.isoformat() + "Z"})
    assert Q.late_records(scored, F.lit(NOW.isoformat(sep=" ")).cast("timestamp")).count() == 1


def test_number_texts(spark):
    from marketlake.functions.parsing import plain_decimal_text

    values = [0.0005, 0.0001, 0.00005, 1.5e-7, -1.0, 12.5, 1e7, 123456789.25, 1e15, 1e16, 2e22, 0.0, 1e-100]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(plain_decimal_text(F.col("v"))).collect()]
    assert got == [str(v) for v in values]


def test_symbol_lookup_matches_both_spellings(spark):
    from marketlake.operators.symbols import insert_if_absent, seed_rows, seed_symbols

    trades = spark.createDataFrame([("btcusd", "coinbase"), ("btcusdt", "binance"), ("zzz", "binance")], "symbol string, exchange string")
    got = {r.symbol: r.base_currency for r in E.enrich_symbol_dim(trades, seed_rows(spark)).collect()}
    assert got == {"btcusd": "BTC", "btcusdt": "BTC", "zzz": None}
    once = insert_if_absent(seed_rows(spark).limit(3), seed_rows(spark))
    assert seed_symbols(once).count() == 8
