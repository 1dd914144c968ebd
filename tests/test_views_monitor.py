import math
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marketlake.config import AlarmRule
from marketlake.operators import rollups as R
from marketlake.plans import monitor as M
from marketlake.plans import views as V

NOW = datetime(2024, 1, 30, 12, 30)


def at():
    return F.lit("2024-01-30 12:30:00").cast("timestamp")


def _table(spark, rows):
    base = {
        "symbol": "a", "exchange": "x", "interval_start": NOW, "interval_end": NOW, "open": 1.0, "high": 1.0,
        "low": 1.0, "close": 1.0, "volume": 1.0, "trade_count": 1, "vwap": 1.0, "avg_spread": 1.0,
        "avg_spread_percentage": 1.0, "price_change": 0.0, "price_change_percentage": 0.0, "sma_5": 1.0, "sma_10": 1.0,
        "sma_20": 1.0, "ema_12": 1.0, "ema_26": 1.0, "macd": 0.0, "macd_signal": 0.0, "macd_histogram": 0.0,
        "bb_middle": 1.0, "bb_std": 0.0, "bb_upper": 1.0, "bb_lower": 1.0, "rsi": 50.0, "volatility": 1.0,
    }
    kinds = {"symbol": "string", "exchange": "string", "interval_start": "timestamp_ntz", "interval_end": "timestamp_ntz", "trade_count": "bigint"}
    schema = ", ".join(f"{k} {kinds.get(k, 'double')}" for k in base)
    return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], schema)


@pytest.mark.parametrize(
    "rsi,macd,expected",
    [
        (71.0, 1.0, "STRONG_SELL"), (29.0, -1.0, "STRONG_BUY"), (71.0, -1.0, "SELL"), (29.0, 1.0, "BUY"),
        (70.0, 1.0, "HOLD"), (71.0, 0.0, "SELL"),
    ],
)
def test_sentiment(spark, rsi, macd, expected):
    row = V.market_sentiment(_table(spark, [{"rsi": rsi, "macd": macd}]), NOW).first()
    assert row.overall_sentiment == expected
    assert row.macd_signal_label == ("BULLISH" if macd > 0 else "BEARISH" if macd < 0 else "NEUTRAL")


def test_signals(spark):
    rows = [{"close": 2.0, "rsi": 75.0}, {"close": 0.5, "rsi": 25.0}, {"close": 1.0}, {"rsi": None}, {"sma_20": None}]
    got = [(r.trend_signal, r.rsi_signal) for r in V.technical_indicators(_table(spark, rows), NOW).collect()]
    assert sorted(got) == [("BEARISH", "OVERSOLD"), ("BULLISH", "OVERBOUGHT"), ("NEUTRAL", "NEUTRAL")]


def test_time_filters_count_from_midnight(spark):
    rows = [{"interval_start": datetime(2024, 1, 29)}, {"interval_start": datetime(2024, 1, 28, 23, 59)}]
    assert V.latest_market_data(_table(spark, rows), NOW).count() == 1
    assert V.recent(_table(spark, rows), 2, NOW).count() == 2


def test_alert_order_and_threshold(spark):
    rows = [
        {"symbol": "jump", "price_change_percentage": -6.0, "rsi": 90.0},
        {"symbol": "hot", "rsi": 81.0}, {"symbol": "cold", "rsi": 19.0}, {"symbol": "wild", "volatility": 50.0},
        {"symbol": "calm"}, {"symbol": "old", "rsi": 99.0, "interval_start": NOW - timedelta(hours=2)},
        *[{"symbol": f"n{i}"} for i in range(10)],
    ]
    got = {r.symbol: (r.alert_type, r.alert_message) for r in V.real_time_alerts(_table(spark, rows), NOW).collect()}
    assert got == {
        "jump": ("HIGH_VOLATILITY", "Price change > 5%"), "hot": ("EXTREME_RSI", "RSI > 80 (Overbought)"),
        "cold": ("EXTREME_RSI", "RSI < 20 (Oversold)"), "wild": ("HIGH_VOLATILITY", "High volatility detected"),
    }


def test_day_open_close_and_top_k(spark):
    rows = [
        {"interval_start": NOW - timedelta(hours=h), "open": float(h), "close": 10.0 + h, "price_change_percentage": c}
        for h, c in ((1, 3.0), (2, None), (3, 7.0))
    ]
    day = V.daily_market_summary(_table(spark, rows), NOW).first()
    assert (day.open_price, day.close_price, day.total_trades) == (3.0, 11.0, 3)
    top = V.top_performing_symbols(_table(spark, rows), NOW, top_k=1).collect()
    assert [r.price_change_percentage for r in top] == [7.0]


def test_correlation_pairs(spark):
    rows = []
    for d in range(10):
        at = NOW - timedelta(days=d)
        rows += [
            {"symbol": "a", "interval_start": at, "close": float(d)},
            {"symbol": "b", "interval_start": at, "close": 5.0 - 2 * d},
            {"symbol": "z", "interval_start": at},
        ]
    got = V.correlation_analysis(_table(spark, rows), NOW, ("a", "b")).collect()
    assert [(r.symbol1, r.symbol2, r.exchange) for r in got] == [("a", "b", "x")]
    assert got[0].price_correlation == pytest.approx(-1.0)
    assert got[0].volume_correlation is None


def test_views_register(spark):
    quality = spark.createDataFrame(
        [("x", "a", date(2024, 1, 29), 3, 2, 1, 0.9, 1.0, 1.0, 1.0, 1.0)],
        "exchange string, symbol string, date date, total_records bigint, valid_records bigint, invalid_records bigint, "
        "quality_score double, avg_price double, avg_volume double, min_price double, max_price double",
    )
    V.register_views(spark, _table(spark, [{}]), quality, NOW)
    for name in V.CANDLE_VIEWS:
        spark.sql(f"SELECT * FROM {name}").collect()
    assert float(spark.sql("SELECT success_rate FROM v_data_quality_summary").first()[0]) == 66.67


def test_exchange_uptime(spark):
    rows = [{"interval_start": datetime(2024, 1, 30) + timedelta(minutes=5 * i)} for i in range(144)]
    quality = spark.createDataFrame(
        [("x", date(2024, 1, 30), 1.0, 3), ("x", date(2024, 1, 30), 0.5, 1)],
        "exchange string, date date, quality_score double, total_records bigint",
    )
    row = R.exchange_performance(_table(spark, rows), quality).first()
    assert row.uptime_percentage == 50.0 and row.data_quality_score == pytest.approx(0.875)
    gap = R.exchange_performance(_table(spark, rows), quality.filter("false")).first()
    assert gap.uptime_percentage == 50.0 and gap.data_quality_score is None


def _metrics(spark, rows):
    return spark.createDataFrame(
        [(n, float(v), "Count", t, d) for n, v, t, d in rows],
        "name string, value double, unit string, timestamp timestamp, dimensions map<string,string>",
    )


@pytest.mark.parametrize("score,status", [(0.69, "CRITICAL"), (0.75, "WARNING"), (0.8, "HEALTHY"), (None, "UNKNOWN")])
def test_health_quality(spark, score, status):
    rows = [] if score is None else [("DataQualityScore", score, NOW, None)]
    assert M.health_quality(_metrics(spark, rows), at()).first().status == status


@pytest.mark.parametrize("lag,status", [(60_000, "HEALTHY"), (60_001, "WARNING"), (300_001, "CRITICAL"), (None, "HEALTHY")])
def test_health_lag(spark, lag, status):
    rows = [] if lag is None else [("LagMilliseconds", lag, NOW, None)]
    assert M.health_lag(_metrics(spark, rows), at()).first().status == status


@pytest.mark.parametrize("errors,status", [(5, "HEALTHY"), (6, "WARNING"), (11, "CRITICAL")])
def test_health_errors(spark, errors, status):
    rows = [("InvalidRecords", 1, NOW - timedelta(minutes=1), None)] * errors
    rows += [("InvalidRecords", 1, NOW - timedelta(minutes=6), None)] * 50
    assert M.health_errors(_metrics(spark, rows), at()).first().status == status


def test_health_freshness_and_overall(spark):
    stale = _table(spark, [{"interval_start": NOW - timedelta(hours=3)}])
    checks = M.health_checks(_metrics(spark, []), stale, F.lit("2024-01-30 12:30:00").cast("timestamp_ntz"))
    row = M.health_rollup(checks).first()
    assert (row.critical, row.warning, row.healthy, row.unknown) == (0, 1, 2, 1)
    assert row.overall_status == "WARNING"
    only_unknown = checks.filter("status = 'UNKNOWN'")
    assert M.health_rollup(only_unknown).first().overall_status == "HEALTHY"


def test_alarm_needs_adjacent_periods(spark):
    start = datetime(2024, 1, 30)
    breached = [0, 2, 3, 4, 8]
    rows = [("E", 5.0, start + timedelta(minutes=5 * i), None) for i in breached]
    rollup = M.metric_rollup(_metrics(spark, rows), 300)
    states = M.metric_alarm(rollup, AlarmRule("E", "sum", 1.0, above=True)).orderBy("period_start").collect()
    assert [s.state for s in states] == ["OK", "OK", "ALARM", "ALARM", "OK"]
    below = M.metric_alarm(rollup, AlarmRule("E", "avg", 9.0, above=False)).filter("breach").count()
    assert below == len(breached)


@pytest.mark.parametrize("n", [1, 19, 20, 100, 101, 337])
def test_latency_percentile_position(spark, n):
    """Position int(n * p / 100) of the sorted values, also when n * p / 100 is whole."""
    values = [(i * 7919 % 4001) * 997 for i in range(n)]
    rows = [("c", NOW, NOW + timedelta(seconds=2), v) for v in values] + [("c", NOW, NOW, None)]
    df = spark.createDataFrame(rows, "component string, sent_at timestamp, done_at timestamp, latency_us bigint")
    row = M.latency_summary(df).first()
    ordered = sorted(values)
    for p in (95, 99):
        assert row[f"p{p}_latency_ms"] == ordered[int(n * p / 100)] / 1000
    assert row.error_rate == pytest.approx(1 / (n + 1))
    assert row.throughput_rps == pytest.approx(n / 2)
    assert row.max_latency_ms == max(values) / 1000 and row.min_latency_ms == min(values) / 1000


def test_latency_of_errors_only(spark):
    df = spark.createDataFrame(
        [("c", NOW, NOW, None)], "component string, sent_at timestamp, done_at timestamp, latency_us bigint"
    )
    row = M.latency_summary(df).first()
    assert (row.error_rate, row.p95_latency_ms, row.avg_latency_ms, row.throughput_rps) == (1.0, 0.0, 0.0, 0.0)


def test_ingest_delay_overall(spark):
    rows = [("x", NOW, NOW + timedelta(seconds=1)), ("x", NOW, NOW + timedelta(seconds=3)), ("y", NOW, NOW + timedelta(seconds=8))]
    df = spark.createDataFrame(rows, "exchange string, ts timestamp, processed_at timestamp")
    got = {r.exchange: r.avg_delay_ms for r in M.ingest_delay(df).collect()}
    assert got == {"x": 2000.0, "y": 8000.0, None: 4000.0}


def test_latest_rows_take_ordered(spark):
    df = spark.range(1000).select(F.timestamp_seconds("id").alias("ts"), "id")
    top = M.latest_log_rows(df, "ts", ("id",), 3)
    assert [r.id for r in top.collect()] == [999, 998, 997]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
