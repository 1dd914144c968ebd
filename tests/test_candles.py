import math
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketlake.operators import candles as C
from marketlake.operators import indicators as N
from marketlake.operators.trades import admit_trades, prepare_trades, with_quotes

START = datetime(2024, 1, 1)


def _trades(spark, prices, volumes, step=timedelta(seconds=1), symbol="btcusdt", exchange="binance"):
    rows = [
        (symbol, exchange, START + i * step, i, float(p), float(v)) for i, (p, v) in enumerate(zip(prices, volumes))
    ]
    return prepare_trades(
        spark.createDataFrame(
            rows, "symbol string, exchange string, ts timestamp_ntz, trade_id bigint, price double, volume double"
        )
    )


def test_golden_candle(spark):
    # Fixed values of the golden candle.
    trades = _trades(spark, [50000, 50100, 49900, 50050, 50150], [1.0, 1.5, 0.8, 1.2, 1.8])
    row = C.candles(trades, 5).first()
    assert (row.open, row.high, row.low, row.close) == (50000.0, 50150.0, 49900.0, 50150.0)
    assert row.volume == pytest.approx(6.3)
    assert row.trade_count == 5
    assert row.vwap == pytest.approx(50040.0)
    assert row.avg_spread is None
    assert row.interval_end - row.interval_start == timedelta(minutes=5)


def test_equal_times_are_ordered_by_trade_id(spark):
    rows = [("s", "e", START, i, float(p), 1.0) for i, p in [(3, 30.0), (1, 10.0), (2, 20.0)]]
    schema = "symbol string, exchange string, ts timestamp_ntz, trade_id {}, price double, volume double"
    for kind in ("bigint", "string"):
        typed = [(*r[:3], str(r[3]) if kind == "string" else r[3], *r[4:]) for r in rows]
        row = C.candles(prepare_trades(spark.createDataFrame(typed, schema.format(kind))), 1).first()
        assert (row.open, row.close) == (10.0, 30.0)


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_missing_ids_keep_open_and_close(spark, kind):
    rows = [("s", "e", START + timedelta(seconds=i), None, float(i), 1.0) for i in (1, 2, 3)]
    schema = f"symbol string, exchange string, ts timestamp_ntz, trade_id {kind}, price double, volume double"
    row = C.candles(prepare_trades(spark.createDataFrame(rows, schema)), 1).first()
    assert (row.open, row.close) == (1.0, 3.0)


def test_text_ids_are_ordered_as_numbers(spark):
    rows = [("s", "e", START, i, float(i), 1.0) for i in ("10", "9", "100")]
    schema = "symbol string, exchange string, ts timestamp_ntz, trade_id string, price double, volume double"
    out = C.candles(prepare_trades(spark.createDataFrame(rows, schema)), 1)
    assert (out.first().open, out.first().close) == (9.0, 100.0)
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()
    mixed = [("s", "e", START, i, p, 1.0) for i, p in (("a-1", 1.0), ("b-2", 2.0), (None, 3.0))]
    again = [C.candles(prepare_trades(spark.createDataFrame(m, schema)), 1).first() for m in (mixed, mixed[::-1])]
    assert again[0] == again[1] and again[0].open == 3.0


def test_order_key_separates_extreme_ids(spark):
    """The packed key never lets an id outweigh a microsecond."""
    big = 2**63 - 1
    rows = [("s", "e", START + timedelta(microseconds=m), i, p, 1.0) for m, i, p in [(0, big, 1.0), (1, -big, 2.0)]]
    df = spark.createDataFrame(
        rows, "symbol string, exchange string, ts timestamp_ntz, trade_id bigint, price double, volume double"
    )
    row = C.candles(prepare_trades(df), 1).first()
    assert (row.open, row.close) == (1.0, 2.0)


def test_all_intervals_equal_single_intervals(spark):
    n = 3000
    prices = [100 + math.sin(i / 7) * 10 for i in range(n)]
    trades = _trades(spark, prices, [1 + i % 5 for i in range(n)], step=timedelta(seconds=47))
    everything = C.candles_all_intervals(trades).toPandas()
    for minutes in (1, 5, 15, 60, 240, 1440):
        single = C.candles(trades, minutes).toPandas().sort_values("interval_start").reset_index(drop=True)
        part = everything[everything.interval_minutes == minutes]
        part = part.sort_values("interval_start").reset_index(drop=True)
        pd.testing.assert_frame_equal(part, single, check_exact=False)
    volumes = everything.groupby("interval_minutes").volume.sum()
    assert volumes.nunique() == 1
    assert (everything.low <= everything[["open", "close"]].min(axis=1)).all()
    assert (everything.high >= everything[["open", "close"]].max(axis=1)).all()


def test_all_intervals_scan_once(spark, tmp_path):
    path = str(tmp_path / "t")
    _trades(spark, range(1, 200), range(1, 200)).write.parquet(path)
    out = C.candles_all_intervals(spark.read.parquet(path))
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert plan.count("FileScan") == 1
    with pytest.raises(ValueError):
        C.candles_all_intervals(spark.read.parquet(path), (7,))


def test_candles_hash_aggregate_and_pushdown(spark, tmp_path):
    path = str(tmp_path / "t")
    _trades(spark, range(1, 50), range(1, 50)).withColumn("unused", F.lit("x")).write.parquet(path)
    out = C.candles(prepare_trades(spark.read.parquet(path)), 5)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    assert "GreaterThan(price,0.0)" in plan and "IsNotNull(symbol)" in plan
    assert "unused" not in plan


def test_cleaning(spark):
    rows = [("s", "e", 1.0, 0.0), ("s", "e", 0.0, 1.0), ("s", "e", 1.0, -1.0), (None, "e", 1.0, 1.0), ("s", None, 1.0, 1.0), ("s", "e", None, 1.0)]
    df = spark.createDataFrame(rows, "symbol string, exchange string, price double, volume double")
    assert prepare_trades(df).count() == 1
    assert {"bid", "ask"} <= set(with_quotes(df).columns)


@pytest.mark.parametrize(
    "change,admitted",
    [
        ({}, True), ({"price": -100.0}, False), ({"price": 0.0}, False), ({"volume": -1.0}, False),
        ({"volume": 0.0}, True), ({"exchange": ""}, False), ({"symbol": ""}, False), ({"timestamp": None}, False),
        ({"price": 1_000_000.01}, False),
    ],
)
def test_admission(spark, change, admitted):
    base = {"exchange": "binance", "symbol": "btcusdt", "timestamp": "1640995200000", "price": 50000.0, "volume": 1.5}
    row = {**base, **change}
    df = spark.createDataFrame(
        [tuple(row.values())], "exchange string, symbol string, timestamp string, price double, volume double"
    )
    assert (admit_trades(df).count() == 1) is admitted


def _closes(spark, closes, minutes=60, gap=lambda i: i):
    rows = [("s", "e", START + timedelta(minutes=minutes * gap(i)), float(c)) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "symbol string, exchange string, interval_start timestamp_ntz, close double")


def _by_definition(closes):
    """Indicator values computed one row at a time from their definitions."""

    def mean(values):
        return sum(values) / len(values)

    def trailing(values, i, k):
        return values[max(0, i - k + 1): i + 1]

    def ema(values, period):
        a, out = 2.0 / (period + 1), []
        for i, x in enumerate(values):
            out.append(a * x + (1 - a) * mean(trailing(values, i - 1, period)) if i else x)
        return out

    n = len(closes)
    e12, e26 = ema(closes, 12), ema(closes, 26)
    macd = [a - b for a, b in zip(e12, e26)]
    moves = [0.0] + [closes[i] - closes[i - 1] for i in range(1, n)]
    rsi = []
    for i in range(n):
        gain = mean([max(m, 0) for m in trailing(moves, i, 14)])
        loss = mean([max(-m, 0) for m in trailing(moves, i, 14)])
        rsi.append(None if loss == 0 else 100 - 100 / (1 + gain / loss))
    frame = pd.Series(closes).rolling(20, min_periods=1)
    return {
        "sma_5": [mean(trailing(closes, i, 5)) for i in range(n)], "ema_12": e12, "ema_26": e26, "macd": macd,
        "macd_signal": ema(macd, 9), "rsi": rsi, "bb_std": frame.std().tolist(), "volatility": frame.std().tolist(),
        "bb_upper": (frame.mean() + 2 * frame.std()).tolist(),
    }


@pytest.mark.parametrize("chunk", [None, 16, 4096])
def test_indicators_by_definition(spark, chunk):
    closes = [100 + 10 * math.sin(i / 3) + (i * 37 % 11) for i in range(120)]
    df = _closes(spark, closes, gap=lambda i: i + 40 * (i // 10))
    got = N.indicators(df, 60, candles_per_chunk=chunk).orderBy("interval_start").toPandas()
    for name, values in _by_definition(closes).items():
        for i, (a, b) in enumerate(zip(got[name], values)):
            if b is None or (isinstance(b, float) and math.isnan(b)):
                assert a is None or math.isnan(a), (name, i)
            else:
                assert a == pytest.approx(b, abs=1e-9), (name, i)


def test_golden_sma_and_rising_rsi(spark):
    rows = N.indicators(_closes(spark, [100, 101, 102, 103, 104]), 60).orderBy("interval_start").collect()
    assert rows[-1].sma_5 == 102.0
    assert rows[-1].rsi is None
    assert rows[0].price_change is None and rows[0].volatility is None
    assert rows[1].price_change == 1.0 and rows[1].price_change_percentage == pytest.approx(1.0)


@pytest.mark.parametrize("period,steps", [(5, 256), (5, 3), (1, 256), (26, 7), (200, 256)])
def test_recursive_ema(spark, period, steps):
    closes = [100 + 20 * math.cos(i / 5) + (i * 31 % 17) for i in range(300)]
    df = _closes(spark, closes, gap=lambda i: i + 100 * (i // 50))
    got = N.ema_recursive(df, period, 60, steps_per_chunk=steps).orderBy("interval_start").toPandas()
    a = 2.0 / (period + 1)
    expected = [closes[0]]
    for x in closes[1:]:
        expected.append(x * a + expected[-1] * (1 - a))
    assert got[f"ema_recursive_{period}"].tolist() == pytest.approx(expected, rel=1e-10)


def test_recursive_ema_golden_bounds(spark):
    rows = N.ema_recursive(_closes(spark, [100, 101, 102, 103, 104]), 5, 60).orderBy("interval_start").collect()
    assert 0 < rows[-1].ema_recursive_5 <= 104
