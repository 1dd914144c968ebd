"""One query per operator over the driver tables. Results are rounded to six decimals for comparison."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.config import ALARMS, FEEDS, INTERVAL_TABLES
from marketlake.functions import market, parsing, quality as q
from marketlake.functions.paths import landing_time, partition_key
from marketlake.operators import candles as C
from marketlake.operators import enrich as E
from marketlake.operators import indicators as N
from marketlake.operators import quality as Q
from marketlake.operators import rollups as R
from marketlake.operators import symbols as S
from marketlake.operators import trades as TR
from marketlake.plans import jobs, monitor as M, views as V
from marketlake.queries import inputs as I
from marketlake.sinks import lake as K
from marketlake.sources import crawl as CR
from marketlake.sources import feeds as FD
from marketlake.sources import lake as L
from marketlake.storage import stored, work_path
from marketlake.streaming import alarms as STA
from marketlake.streaming import candles as STC
from marketlake.streaming import late as STL
from marketlake.streaming import quality as STQ
from marketlake.streaming import state as STS
from marketlake.streaming.run import file_stream, state_partitions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The test tables' event types that stand in for the listed pair symbols.
PAIR_SYMBOLS = ("click", "purchase", "view")
SHORT_NAMES = {1: "1m", 5: "5m", 15: "15m", 60: "1h", 240: "4h", 1440: "1d"}


def comparable(df: DataFrame) -> DataFrame:
    """Doubles to six decimals by way of nine (see the SQL's ``r6``), decimals as text, zoned times to zone-less."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):
            c = F.round(F.round(c, 9), 6)
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DecimalType):
            c = F.round(c, min(6, f.dataType.scale)).cast("string")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(build(spark, sf_dir))

        QUERIES[name] = run
        return build

    return register


# --- shared inputs -------------------------------------------------------------------------------


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TR.prepare_trades(I.trades(spark, sf_dir))


def candles(spark: SparkSession, sf_dir: str, minutes: int) -> DataFrame:
    return C.candles(prepared(spark, sf_dir), minutes)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.score_records(FD.decode_stream(I.stream_records(spark, sf_dir)), now=F.col("now"))


def valid_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.typed_records(scored(spark, sf_dir).filter(F.col("status") == Q.VALID), F.col("now"), ("now",))


def landable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid records for a lake that lands in parts, stored: they are decoded once, whatever the number of parts."""
    return stored(TR.add_live_spread(valid_typed(spark, sf_dir)), "landable")


_stored: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, label: str, write: Callable[[str], None]) -> str:
    """Path of a table written once per application and input folder."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _stored:
        path = work_path(spark, label)
        write(path)
        _stored[key] = path
    return _stored[key]


def candle_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored 5-minute candle table the serving views scan."""

    def write(path: str) -> None:
        K.write_candles_parquet(N.indicators(candles(spark, sf_dir, 5), 5), path)

    return L.scan_candles(spark, K.candle_path(_once(spark, sf_dir, "candles", write), 5))


def raw_lake(spark: SparkSession, sf_dir: str) -> str:
    """Landed documents of all valid stream records."""

    def write(path: str) -> None:
        records = valid_typed(spark, sf_dir)
        K.write_raw_json(TR.add_live_spread(records), path, F.lit("2024-02-01").cast("timestamp"), batch="first")

    return _once(spark, sf_dir, "lake", write)


def read_and_drop(spark: SparkSession, table: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``build`` makes of a catalog table, written, so that the table can leave the catalog."""
    result = stored(build(spark.table(table)), "read")
    spark.sql(f"drop table {table}")
    return result


def metric_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scored(spark, sf_dir)
    event_ts = parsing.event_time(parsing.field(F.col("record"), "timestamp"))
    return Q.metric_points(s, F.col("now"), event_ts)


def now_column(spark: SparkSession, sf_dir: str) -> Column:
    return F.lit(I.as_of(spark, sf_dir).isoformat(sep=" ")).cast("timestamp_ntz")


# --- scans and sources ---------------------------------------------------------------------------

_RECORD_COLUMNS = ("exchange", "symbol", "timestamp", "price", "volume", "bid", "ask", "trade_id", "quality_score")


@query("read_batches")
def _(spark, sf_dir):
    rows = L.read_batches(spark, raw_lake(spark, sf_dir), "*")
    return rows.select("data_partition", "batch_timestamp", *_RECORD_COLUMNS, "spread", "ts")


@query("prune_date")
def _(spark, sf_dir):
    rows = L.read_batches(spark, raw_lake(spark, sf_dir), "2024/01/15")
    return rows.select(*_RECORD_COLUMNS)


@query("stream_decode")
def _(spark, sf_dir):
    decoded = FD.decode_stream(I.stream_records(spark, sf_dir))
    return decoded.select(
        "record_id",
        "payload",
        F.col("record").isNotNull().alias("is_object"),
        *[parsing.field(F.col("record"), c).alias(c) for c in ("exchange", "symbol", "timestamp", "trade_id")],
    )


@query("infer_raw_schema")
def _(spark, sf_dir):
    return L.infer_raw_schema(spark, raw_lake(spark, sf_dir))


#: Day of the month from which the crawled lake's records have processed_at, and from which they have no ask.
_DRIFT_DAYS = (16, 20)


def _crawled(spark: SparkSession, sf_dir: str) -> str:
    """Column table of a lake that lands in two batches, crawled after each."""

    def write(path: str) -> None:
        lake = work_path(spark, "drift-lake")
        day = F.dayofmonth("landed")
        records = landable(spark, sf_dir).withColumns({
            "processed_at": F.when(day >= _DRIFT_DAYS[0], F.col("timestamp")),
            "ask": F.when(day < _DRIFT_DAYS[1], F.col("ask")),
        })
        for label, part in (("first", day < 18), ("second", day >= 18)):
            K.write_raw_json(records.filter(part), lake, batch=label)
            CR.crawl(spark, lake, path)

    return _once(spark, sf_dir, "crawl", write)


@query("schema_crawl")
def _(spark, sf_dir):
    rows = CR.crawled_columns(spark, _crawled(spark, sf_dir))
    return rows.filter(F.col("column_name").startswith("records."))


@query("schema_drift")
def _(spark, sf_dir):
    return CR.schema_drift(CR.crawled_columns(spark, _crawled(spark, sf_dir)))


@query("scan_candles")
def _(spark, sf_dir):
    return candle_table(spark, sf_dir).select("symbol", "exchange", "interval_start", "close", "volume")


# --- normalisers ---------------------------------------------------------------------------------


def feed_messages(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    return I.raw_messages(spark, sf_dir).filter(F.col("feed") == feed)


_TRADE_OUT = ("message_id", "exchange", "symbol", "timestamp", "price", "volume", "trade_id", "quality_score")


def _normalized(feed: str) -> Query:
    def build(spark, sf_dir):
        rows = FD.normalize(feed_messages(spark, sf_dir, feed), FEEDS[feed], keep=("message_id",))
        return rows.select(*_TRADE_OUT)

    return build


query("normalize_binance")(_normalized("binance"))
query("normalize_coinbase")(_normalized("coinbase"))
query("normalize_by_config")(_normalized("kraken"))


@query("filter_event_type")
def _(spark, sf_dir):
    return FD.filter_event_types(I.raw_messages(spark, sf_dir)).select("message_id", "feed")


@query("canonical_symbol")
def _(spark, sf_dir):
    rows = FD.normalize_feeds(I.raw_messages(spark, sf_dir))
    return rows.groupBy("exchange", "symbol").agg(F.count(F.lit(1)).alias("trades"))


@query("source_quality_score")
def _(spark, sf_dir):
    parsed = FD.parse_feeds(I.raw_messages(spark, sf_dir)).filter(F.col("record").isNotNull())
    score = FD.by_feed(lambda feed: q.source_score(F.col("record"), feed))
    return parsed.select("message_id", score.alias("quality_score"))


@query("parse_event_time")
def _(spark, sf_dir):
    parsed = FD.parse_feeds(I.raw_messages(spark, sf_dir))
    texts = parsed.select("message_id", FD.by_feed(lambda f: parsing.field(F.col("record"), f.time)).alias("time_text"))
    return texts.withColumn("event_time", parsing.event_time(F.col("time_text")))


@query("quarantine_malformed")
def _(spark, sf_dir):
    parsed = FD.parse_feeds(I.raw_messages(spark, sf_dir))
    return parsed.filter(F.col("status") == FD.STATUS_BAD).select("message_id", "message")


@query("admit_trade")
def _(spark, sf_dir):
    rows = FD.normalize_feeds(I.raw_messages(spark, sf_dir), keep=("message_id",))
    return TR.admit_trades(rows).select(*_TRADE_OUT)


@query("union_feeds")
def _(spark, sf_dir):
    """All feeds of one table in a single pass."""
    rows = FD.admit_feeds(I.raw_messages(spark, sf_dir), keep=("message_id",))
    return rows.select(*_TRADE_OUT, "ts")


@query("partition_by_symbol")
def _(spark, sf_dir):
    placed = FD.partition_by_symbol(I.trades(spark, sf_dir), splits=8)
    return placed.groupBy("symbol").agg(F.count(F.lit(1)).alias("trades"), F.sum("volume").alias("volume"))


@query("ingest_stats")
def _(spark, sf_dir):
    parsed = FD.parse_feeds(I.raw_messages(spark, sf_dir)).filter(F.col("status") != FD.STATUS_IGNORED)
    return FD.ingest_stats(parsed, F.col("status") == FD.STATUS_OK)


# --- projections and predicates ------------------------------------------------------------------


@query("calendar_parts")
def _(spark, sf_dir):
    rows = TR.add_calendar_parts(I.trades(spark, sf_dir))
    return rows.select("trade_id", "year", "month", "day", "hour", "minute")


@query("clean_trades")
def _(spark, sf_dir):
    return TR.clean_trades(I.trades(spark, sf_dir)).select("trade_id", "symbol", "exchange", "price", "volume")


@query("cast_numeric")
def _(spark, sf_dir):
    text = I.table(spark, sf_dir, "events").select(
        "event_id", F.col("value").cast("string").alias("price"), F.get_json_object("props", "$.k").alias("volume")
    )
    return TR.cast_numeric(text)


@query("spread_batch")
def _(spark, sf_dir):
    rows = TR.add_batch_spread(I.trades(spark, sf_dir))
    return rows.select("trade_id", "spread", "spread_percentage")


@query("spread_stream")
def _(spark, sf_dir):
    rows = TR.add_live_spread(I.trades(spark, sf_dir))
    return rows.select("trade_id", "spread", "spread_percentage")


@query("recent_filter")
def _(spark, sf_dir):
    rows = candle_table(spark, sf_dir)
    return V.recent(rows, 7, I.as_of(spark, sf_dir)).select("symbol", "exchange", "interval_start")


def _labelled(name: str, label: Callable[[], Column], *columns: str) -> None:
    @query(name)
    def _(spark, sf_dir):
        rows = candle_table(spark, sf_dir)
        return rows.select("symbol", "exchange", "interval_start", *columns, label().alias("label"))


_labelled("trend_signal", market.trend_signal, "close", "sma_20")
_labelled("rsi_signal", market.rsi_signal, "rsi")
_labelled("macd_signal_label", market.macd_signal_label, "macd", "macd_signal")
_labelled("bollinger_signal", market.bollinger_signal, "close")
_labelled("overall_sentiment", market.overall_sentiment, "rsi")


@query("alert_type")
def _(spark, sf_dir):
    table, as_of = candle_table(spark, sf_dir), I.as_of(spark, sf_dir)
    threshold = V.volatility_threshold(table, as_of).scalar()
    rows = V.add_alerts(V.recent(table, 7, as_of), threshold)
    return rows.select("symbol", "exchange", "interval_start", "alert_type", "alert_message")


def quality_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.data_quality_metrics(scored(spark, sf_dir))


@query("success_rate")
def _(spark, sf_dir):
    rate = market.success_rate(F.col("valid_records"), F.col("total_records")).cast("double")
    return quality_table(spark, sf_dir).select("exchange", "symbol", "date", rate.alias("success_rate"))


# --- validation ----------------------------------------------------------------------------------


def _rule(name: str, faults: Callable[[q.RecordFields, Column], list]) -> None:
    @query(name)
    def _(spark, sf_dir):
        rows = FD.decode_stream(I.stream_records(spark, sf_dir)).filter(F.col("record").isNotNull())
        pack, fields = q.unpacked_fields("parsed")
        rows, found = rows.withColumn("parsed", pack(F.col("record"))), faults(fields, F.col("now"))
        return rows.select(
            "record_id",
            q.penalised_score(found).alias("score"),
            F.array_join(q.fault_messages(found), "; ").alias("messages"),
        )


_BOUNDS = Q.QualityBounds()
_rule("check_required", lambda f, now: q.required_faults(f))
_rule("check_price", lambda f, now: q.price_faults(f, _BOUNDS))
_rule("check_volume", lambda f, now: q.volume_faults(f, _BOUNDS))
_rule("check_timestamp", lambda f, now: q.timestamp_faults(f, _BOUNDS, now))
_rule("check_exchange", lambda f, now: q.exchange_faults(f, _BOUNDS))


@query("quality_score")
def _(spark, sf_dir):
    return scored(spark, sf_dir).select("record_id", "quality_score", (F.col("status") == Q.VALID).alias("is_valid"))


@query("validation_errors")
def _(spark, sf_dir):
    return scored(spark, sf_dir).select("record_id", F.array_join("errors", "; ").alias("errors"))


@query("split_valid_invalid")
def _(spark, sf_dir):
    routed = Q.split_valid_invalid(scored(spark, sf_dir), dlq_enabled=True)
    valid = routed.valid.select("record_id", "status", F.lit(None).cast("string").alias("reason"))
    return valid.unionByName(routed.failed)


@query("batch_stats")
def _(spark, sf_dir):
    return Q.batch_stats(scored(spark, sf_dir))


@query("emit_metrics")
def _(spark, sf_dir):
    rows = Q.emit_metrics(scored(spark, sf_dir), F.lit("2024-02-01").cast("timestamp"), processing_seconds=1.5)
    return rows.select("name", "value", "unit", F.try_element_at("dimensions", F.lit("Exchange")).alias("exchange"))


# --- enrichment ----------------------------------------------------------------------------------


@query("processed_at")
def _(spark, sf_dir):
    rows = E.enrich_records(valid_typed(spark, sf_dir), processed_at=F.col("now"))
    return rows.select("trade_id", "processed_at")


def _ticks(name: str, *columns: str) -> None:
    @query(name)
    def _(spark, sf_dir):
        return E.tick_enrich(I.trades(spark, sf_dir)).select("trade_id", "symbol", *columns)


_ticks("tick_price_change", "price_change", "price_change_percentage")
_ticks("tick_sma", "sma_5", "sma_10")
_ticks("tick_volatility", "volatility")


@query("attach_quality")
def _(spark, sf_dir):
    return E.enrich_records(valid_typed(spark, sf_dir), processed_at=F.col("now")).select(
        "trade_id", "exchange", "symbol", "price", "quality_score", "spread", "spread_percentage", *E.TICK_COLUMNS
    )


def symbol_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lookup derived from the data: all symbols of two exchanges, spelled with a separator."""
    pairs = I.trades(spark, sf_dir).filter(F.col("exchange") != "kraken").select("symbol", "exchange").distinct()
    return pairs.select(
        F.concat(F.upper("symbol"), F.lit("-USD")).alias("symbol"),
        "exchange",
        F.upper("symbol").alias("base_currency"),
        F.lit("USD").alias("quote_currency"),
        F.lit(True).alias("is_active"),
    )


@query("enrich_symbol_dim")
def _(spark, sf_dir):
    trades = I.trades(spark, sf_dir).withColumn("symbol", F.concat("symbol", F.lit("usd")))
    rows = E.enrich_symbol_dim(trades, symbol_lookup(spark, sf_dir))
    return rows.select("trade_id", "symbol", "exchange", "base_currency", "quote_currency")


# --- joins ---------------------------------------------------------------------------------------


def _means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.daily_means(candle_table(spark, sf_dir).filter(F.col("symbol").isin(*PAIR_SYMBOLS)))


@query("correlation_pairs")
def _(spark, sf_dir):
    return R.correlation_pairs(_means(spark, sf_dir), PAIR_SYMBOLS)


@query("insert_if_absent")
def _(spark, sf_dir):
    """Every series of the data into a lookup that already holds two exchanges of it."""
    target = symbol_lookup(spark, sf_dir).withColumn("symbol", parsing.canonical_symbol(F.col("symbol")))
    series = I.trades(spark, sf_dir).select(F.concat("symbol", F.lit("usd")).alias("symbol"), "exchange").distinct()
    rows = series.withColumns(
        {"base_currency": F.lit("NEW"), "quote_currency": F.lit("USD"), "is_active": F.lit(False)}
    )
    return S.insert_if_absent(target, rows)


@query("seed_symbols")
def _(spark, sf_dir):
    return S.seed_symbols(symbol_lookup(spark, sf_dir))


@query("scalar_threshold")
def _(spark, sf_dir):
    table, as_of = candle_table(spark, sf_dir), I.as_of(spark, sf_dir)
    threshold = V.volatility_threshold(table, as_of, factor=1.0).scalar()
    above = V.recent(table, 1, as_of).filter(F.col("volatility") > threshold)
    return above.select("symbol", "exchange", "interval_start", "volatility")


# --- candles -------------------------------------------------------------------------------------


def _ohlcv(minutes: int) -> Query:
    return lambda spark, sf_dir: candles(spark, sf_dir, minutes)


for _minutes, _short in SHORT_NAMES.items():
    query(f"ohlcv_{_short}")(_ohlcv(_minutes))


def _by_candle(name: str, measures: Callable[[DataFrame], dict[str, Column]]) -> None:
    @query(name)
    def _(spark, sf_dir):
        rows = prepared(spark, sf_dir)
        return rows.groupBy("symbol", "exchange", F.window("ts", "4 hours")["start"].alias("interval_start")).agg(
            *[c.alias(n) for n, c in measures(rows).items()]
        )


_by_candle("open_close", lambda df: C.open_close(F.col("price"), C.trade_order(df)))
_by_candle("high_low_volume_count", lambda df: C.high_low_volume(F.col("price"), F.col("volume")))
_by_candle("vwap_ref", lambda df: {"vwap": F.avg("price")})
_by_candle("vwap_weighted", lambda df: {"vwap_weighted": C.weighted_vwap(F.col("price"), F.col("volume"))})
_by_candle(
    "avg_spread",
    lambda df: {"avg_spread": F.avg("spread"), "avg_spread_percentage": F.avg("spread_percentage")},
)


@query("candles_all_intervals")
def _(spark, sf_dir):
    return C.candles_all_intervals(prepared(spark, sf_dir))


@query("candles_large")
def _(spark, sf_dir):
    return C.candles(TR.prepare_trades(I.large_trades(spark, sf_dir)), 1440).drop("avg_spread", "avg_spread_percentage")


# --- rollups -------------------------------------------------------------------------------------


@query("exchange_daily")
def _(spark, sf_dir):
    return R.exchange_daily(candle_table(spark, sf_dir))


@query("hourly_volume")
def _(spark, sf_dir):
    return R.hourly_volume(candle_table(spark, sf_dir))


@query("daily_volatility")
def _(spark, sf_dir):
    return R.daily_volatility(candle_table(spark, sf_dir))


@query("pair_correlation")
def _(spark, sf_dir):
    return R.pair_correlation(R.correlation_pairs(_means(spark, sf_dir), PAIR_SYMBOLS))


@query("data_quality_metrics")
def _(spark, sf_dir):
    return quality_table(spark, sf_dir)


@query("daily_stats")
def _(spark, sf_dir):
    return R.daily_stats(candle_table(spark, sf_dir))


@query("exchange_performance")
def _(spark, sf_dir):
    return R.exchange_performance(candle_table(spark, sf_dir), quality_table(spark, sf_dir))


@query("day_open_close")
def _(spark, sf_dir):
    first_open, last_close = R.day_open_close()
    rows = candle_table(spark, sf_dir).withColumn("date", F.to_date("interval_start"))
    return rows.groupBy("symbol", "exchange", "date").agg(
        first_open.alias("open_price"), last_close.alias("close_price")
    )


# --- indicators ----------------------------------------------------------------------------------


def _indicator(name: str, stages: tuple[N.Stage, ...], *columns: str) -> None:
    @query(name)
    def _(spark, sf_dir):
        series = candles(spark, sf_dir, 60).select("symbol", "exchange", "interval_start", "close")
        return N.indicators(series, 60, stages).select("symbol", "exchange", "interval_start", *columns)


_indicator("price_change", (N.PRICE_CHANGE,), "price_change")
_indicator("price_change_pct", (N.PRICE_CHANGE,), "price_change_percentage")
_indicator("sma", (N.SMA,), *N.SMA.outputs)
_indicator("ema", (N.EMA,), *N.EMA.outputs)
_indicator("macd", (N.MACD,), "macd")
_indicator("macd_signal", (N.MACD,), "macd_signal")
_indicator("macd_histogram", (N.MACD,), "macd_histogram")
_indicator("bollinger", (N.BOLLINGER,), *N.BOLLINGER.outputs)
_indicator("rsi", (N.RSI,), "rsi")
_indicator("volatility", (N.VOLATILITY,), "volatility")


@query("indicators_1h")
def _(spark, sf_dir):
    return N.indicators(candles(spark, sf_dir, 60), 60)


@query("ema_recursive")
def _(spark, sf_dir):
    series = candles(spark, sf_dir, 60).select("symbol", "exchange", "interval_start", "close")
    return N.ema_recursive(series, 5, 60).drop("close")


# --- serving views -------------------------------------------------------------------------------


def _view(name: str, build: Callable[..., DataFrame], **options) -> None:
    @query(name)
    def _(spark, sf_dir):
        return build(candle_table(spark, sf_dir), I.as_of(spark, sf_dir), **options)


for _name, _build in V.CANDLE_VIEWS.items():
    _view(_name, _build, **({"symbols": PAIR_SYMBOLS} if _name == "v_correlation_analysis" else {}))
_view("top_k_symbols", V.top_performing_symbols, top_k=20)


@query("v_data_quality_summary")
def _(spark, sf_dir):
    rows = V.data_quality_summary(quality_table(spark, sf_dir), I.as_of(spark, sf_dir))
    return rows.withColumn("success_rate", F.col("success_rate").cast("double"))


@query("latest_log_rows")
def _(spark, sf_dir):
    rows = I.table(spark, sf_dir, "events")
    return M.latest_log_rows(rows, "ts", ("ts", "event_id", "props"), ties=("event_id",))


# --- sinks ---------------------------------------------------------------------------------------


@query("partition_key")
def _(spark, sf_dir):
    rows = FD.decode_stream(I.stream_records(spark, sf_dir)).filter(F.col("record").isNotNull())
    record = F.col("record")
    own = parsing.event_time(parsing.field(record, "timestamp"))
    at = landing_time(own, q.has(record, "timestamp"), F.col("now"))
    key = partition_key(parsing.field(record, "exchange"), parsing.field(record, "symbol"), at)
    return rows.select("record_id", key.alias("partition_key"))


@query("write_raw_json")
def _(spark, sf_dir):
    """Records per partition directory, as read back from the landed documents."""
    docs = L.read_documents(spark, raw_lake(spark, sf_dir))
    return docs.groupBy("partition").agg(
        F.sum("count").alias("records"), (F.max("count") <= K.DOCUMENT_RECORDS).alias("within_limit")
    )


@query("write_candles_parquet")
def _(spark, sf_dir):
    """All intervals written as trees and counted back per table and day."""
    path = work_path(spark, "trees")
    K.write_candles_parquet(jobs.candles_with_indicators(prepared(spark, sf_dir)), path)
    return spark.read.parquet(path).groupBy("candle_table", "year", "month", "day").agg(
        F.count(F.lit(1)).alias("candles"), F.sum("volume").alias("volume"), F.avg("rsi").alias("avg_rsi")
    )


@query("write_warehouse")
def _(spark, sf_dir):
    """5-minute candles written to a catalog table, half of the days twice, and read back."""
    table = f"candles_5min_{uuid.uuid4().hex}"
    rows = candle_table(spark, sf_dir)
    K.write_warehouse(rows, table)
    K.write_warehouse(rows.filter(F.col("day") % 2 == 0), table)
    return read_and_drop(spark, table, lambda rows: rows.groupBy("symbol", "exchange").agg(
        F.count(F.lit(1)).alias("candles"),
        F.count_distinct("id").alias("ids"),
        F.sum("volume").cast("double").alias("volume"),
    ))


@query("distributed_by_symbol")
def _(spark, sf_dir):
    """Each candle with its symbol's mean volume: a group and a join on the table's distribution."""
    table = f"candles_by_symbol_{uuid.uuid4().hex}"
    rows = candle_table(spark, sf_dir)
    K.write_warehouse(rows, table, buckets=4)
    K.write_warehouse(rows.filter(F.col("day") % 2 == 0), table, buckets=4)

    def beside_mean(stored_rows: DataFrame) -> DataFrame:
        volume = F.col("volume").cast("double")
        means = stored_rows.groupBy("symbol").agg(F.avg(volume).alias("mean_volume"))
        return stored_rows.join(means, "symbol").select(
            "symbol", "exchange", "interval_start", volume.alias("volume"), "mean_volume"
        )

    return read_and_drop(spark, table, beside_mean)


def _stored_table(minutes: int) -> Query:
    def build(spark, sf_dir):
        rows = N.indicators(candles(spark, sf_dir, minutes), minutes)
        return K.project_candle_table(rows, minutes)

    return build


for _minutes, _short in SHORT_NAMES.items():
    query(f"project_candle_table_{_short}")(_stored_table(_minutes))


@query("surrogate_id_defaults")
def _(spark, sf_dir):
    rows = K.with_surrogate_id(candles(spark, sf_dir, 1440).select("symbol", "exchange", "interval_start"))
    return rows.groupBy("symbol", "exchange").agg(
        F.count(F.lit(1)).alias("candles"), F.count_distinct("id").alias("ids")
    )


@query("layout")
def _(spark, sf_dir):
    return K.layout(candles(spark, sf_dir, 60)).select("symbol", "exchange", "interval_start", "close", "volume")


@query("skip_empty")
def _(spark, sf_dir):
    """The daily job over a day without trades writes nothing, over a day with trades all six tables."""
    lake, out = raw_lake(spark, sf_dir), work_path(spark, "job")
    skipped = not jobs.process_day(spark, lake, out, "1999/01/01")
    built = jobs.process_day(spark, lake, out, "2024/01/15")
    return (
        spark.read.parquet(out).groupBy("candle_table")
        .agg(F.count(F.lit(1)).alias("candles"), F.sum("trade_count").alias("trades"))
        .withColumns({"skipped_empty": F.lit(skipped), "built": F.lit(built)})
    )


@query("days_to_rerun")
def _(spark, sf_dir):
    """Two days are built, then every eleventh record lands: never built days and the two with late records are left."""
    lake, out = work_path(spark, "late-lake"), work_path(spark, "late-out")
    records = landable(spark, sf_dir)
    late = F.col("trade_id").cast("long") % 11 == 0
    K.write_raw_json(records.filter(~late), lake, batch="first")
    for day in ("2024/01/14", "2024/01/15"):
        jobs.process_day(spark, lake, out, day)
    K.write_raw_json(records.filter(late), lake, batch="second")
    return jobs.days_to_rerun(spark, lake, out)


@query("process_day_metrics")
def _(spark, sf_dir):
    """The daily job with scored records: rows and records of the three metric tables that it fills."""
    prefix = f"day_{uuid.uuid4().hex}_"
    jobs.process_day(
        spark, raw_lake(spark, sf_dir), work_path(spark, "day-metrics"), "2024/01/15",
        scored=scored(spark, sf_dir), metric_prefix=prefix,
    )
    counted = {"data_quality_metrics": "total_records", "daily_stats": "total_trades", "exchange_performance": "total_trades"}
    parts = [
        read_and_drop(spark, f"{prefix}{name}", lambda rows, name=name, column=column: rows.groupBy("date").agg(
            F.lit(name).alias("metric_table"), F.count(F.lit(1)).alias("n_rows"), F.sum(column).alias("records")
        ))
        for name, column in counted.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("process_two_days")
def _(spark, sf_dir):
    """The daily job over two days, run in either order and once again; ISO times are part of both days."""
    lake, out = raw_lake(spark, sf_dir), work_path(spark, "two-days")
    for day in ("2024/01/15", "2024/01/14", "2024/01/15"):
        jobs.process_day(spark, lake, out, day)
    return spark.read.parquet(out).groupBy("candle_table", "year", "month", "day").agg(
        F.count(F.lit(1)).alias("candles"), F.sum("trade_count").alias("trades")
    )


def _metric_table(name: str, build: Query) -> None:
    @query(f"stored_{name}")
    def _(spark, sf_dir):
        """Written to a catalog table twice and read back in its stored types."""
        table = f"{name}_{uuid.uuid4().hex}"
        rows = build(spark, sf_dir)
        K.write_metric_table(rows, name, table)
        K.write_metric_table(rows, name, table)
        fields = [f for f in spark.table(table).schema.fields if f.name != "created_at"]
        types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
        return read_and_drop(spark, table, lambda t: t.drop("id", "created_at").withColumn("types", F.lit(types)))


_metric_table("data_quality_metrics", quality_table)
_metric_table("daily_stats", lambda spark, sf_dir: R.daily_stats(candle_table(spark, sf_dir)))
_metric_table(
    "exchange_performance",
    lambda spark, sf_dir: R.exchange_performance(candle_table(spark, sf_dir), quality_table(spark, sf_dir)),
)


# --- monitoring ----------------------------------------------------------------------------------


@query("metric_rollup")
def _(spark, sf_dir):
    return M.metric_rollup(metric_rows(spark, sf_dir), 3600)


@query("metric_rollup_periods")
def _(spark, sf_dir):
    return M.metric_rollups(metric_rows(spark, sf_dir), (300, 3600, 86400))


def _alarm(rule_name: str) -> Query:
    def build(spark, sf_dir):
        rollup = M.metric_rollup(M.across_dimensions(metric_rows(spark, sf_dir)), 3600)
        rule = ALARMS[rule_name]
        return M.metric_alarm(rollup, type(rule)(rule.metric, rule.statistic, rule.threshold, rule.above, 3600)).drop(
            "exchange"
        )

    return build


query("metric_alarm")(_alarm("errors"))
query("metric_alarm_lag")(_alarm("lag"))
query("metric_alarm_data_quality")(_alarm("data_quality"))


def _health(name: str, build: Callable[[SparkSession, str, Column], DataFrame], detail: str) -> None:
    @query(name)
    def _(spark, sf_dir):
        rows = build(spark, sf_dir, now_column(spark, sf_dir))
        return rows.select("component", "status", "message").withColumn("check", F.lit(detail))


_health("health_quality", lambda s, d, at: M.health_quality(metric_rows(s, d), at), "quality_score")
_health("health_lag", lambda s, d, at: M.health_lag(metric_rows(s, d), at), "lag_ms")
_health("health_errors", lambda s, d, at: M.health_errors(metric_rows(s, d), at, minutes=1440), "error_count")
_health("health_freshness", lambda s, d, at: M.health_freshness(candle_table(s, d), at), "recent_records")


@query("health_rollup")
def _(spark, sf_dir):
    checks = M.health_checks(metric_rows(spark, sf_dir), candle_table(spark, sf_dir), now_column(spark, sf_dir))
    return M.health_rollup(checks)


@query("validation_error_types")
def _(spark, sf_dir):
    return Q.validation_error_types(scored(spark, sf_dir))


@query("validation_error_periods")
def _(spark, sf_dir):
    return Q.validation_error_types(scored(spark, sf_dir), at=F.col("now"))


@query("symbol_coverage")
def _(spark, sf_dir):
    return M.symbol_coverage(I.trades(spark, sf_dir), 3600)


@query("data_freshness")
def _(spark, sf_dir):
    at = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    return M.data_freshness(I.trades(spark, sf_dir), at)


@query("ingest_delay")
def _(spark, sf_dir):
    return M.ingest_delay(valid_typed(spark, sf_dir).filter(F.col("exchange").isNotNull()), processed_at="now")


@query("latency_summary")
def _(spark, sf_dir):
    """Latencies made of each trade's price and microseconds; one trade in twenty is an error without a latency."""
    ticks = I.trades(spark, sf_dir)
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    failed = F.col("trade_id") % 20 == 9
    samples = ticks.select(
        F.concat_ws("/", "symbol", "exchange").alias("component"),
        F.col("ts").alias("sent_at"),
        F.col("ts").alias("done_at"),
        F.when(~failed, (F.col("price") * 1000).cast("bigint") + F.pmod(micros, F.lit(1000))).alias("latency_us"),
    )
    return M.latency_summary(samples)


# --- streams -------------------------------------------------------------------------------------


#: Days of a month whose events a stream query gets in one micro-batch.
STREAM_DAYS = 8


def _cores(spark: SparkSession) -> int:
    """State partitions of a stream: as many as the application has cores."""
    return spark.sparkContext.defaultParallelism


def _paths(spark: SparkSession, label: str) -> STQ.StreamPaths:
    return STQ.StreamPaths(work_path(spark, label))


def _in_runs(
    spark: SparkSession, events: DataFrame, run: Column, paths: STQ.StreamPaths, start: Callable[[DataFrame], object]
) -> None:
    """Events arrive run by run; the stream is started for each and goes on from where the last one stopped.

    A run is one micro-batch of as many files as there are cores, so that its records are decoded by all of them.
    """
    for n in range(0, 31, STREAM_DAYS):
        I.spread(events.filter(run == n // STREAM_DAYS)).write.mode("append").parquet(paths.arrived)
        start(file_stream(spark, paths.arrived, events.schema)).awaitTermination()


def _by_days(spark: SparkSession, sf_dir: str, paths: STQ.StreamPaths, start: Callable[[DataFrame], object]) -> None:
    """All events in several micro-batches, one for each run of days of the month."""
    _in_runs(spark, I.table(spark, sf_dir, "events"), F.floor((F.dayofmonth("ts") - 1) / STREAM_DAYS), paths, start)


def _stream_candles(minutes: int) -> Query:
    def build(spark, sf_dir):
        paths = _paths(spark, "stream-candles")

        def start(arrived: DataFrame):
            writer = (
                STC.stream_candles(I.trades_from(arrived), minutes).writeStream.format("parquet").outputMode("append")
                .option("checkpointLocation", paths.checkpoint).option("path", paths.candles).trigger(availableNow=True)
            )
            with state_partitions(spark, _cores(spark)):
                return writer.start()

        _by_days(spark, sf_dir, paths, start)
        return spark.read.parquet(paths.candles)

    return build


query("stream_candles")(_stream_candles(60))
query("stream_candles_5m")(_stream_candles(5))


@query("stream_indicators")
def _(spark, sf_dir):
    paths = _paths(spark, "stream-indicators")
    _by_days(spark, sf_dir, paths, lambda arrived: STC.stream_indicators(
        spark, STC.stream_candles(I.trades_from(arrived), 60), 60, paths.out, paths.state, paths.checkpoint,
        state_count=_cores(spark),
    ))
    return spark.read.parquet(paths.out).drop("batch")


@query("stateful_enrich")
def _(spark, sf_dir):
    paths = _paths(spark, "stream-enrich")
    _by_days(spark, sf_dir, paths, lambda arrived: STQ.stateful_enrich(
        spark, STQ.valid_records(I.stream_records_from(arrived), F.col("now")), paths
    ))
    return spark.read.parquet(paths.enriched).select("trade_id", "symbol", "price", *E.TICK_COLUMNS)


@query("stateful_enrich_keyed")
def _(spark, sf_dir):
    """Prices in the stream's own state store; it stops and restarts between the runs of days."""
    paths = _paths(spark, "stream-keyed")

    def start(arrived: DataFrame):
        records = STQ.valid_records(I.stream_records_from(arrived), F.col("now"))
        with state_partitions(spark, _cores(spark)):
            return (
                STS.keyed_enrich(records).writeStream.format("parquet").option("path", paths.enriched)
                .option("checkpointLocation", paths.checkpoint).trigger(availableNow=True).start()
            )

    _by_days(spark, sf_dir, paths, start)
    return spark.read.parquet(paths.enriched).select("trade_id", "symbol", "price", *E.TICK_COLUMNS)


def _mended(spark: SparkSession, sf_dir: str) -> str:
    """Hourly candles of a stream to which every eleventh trade comes a run of days late, but for the last run's."""

    def write(path: str) -> None:
        run = F.floor((F.dayofmonth("ts") - 1) / STREAM_DAYS) + (F.col("event_id") % 11 == 0).cast("int")
        last = F.lit(30 // STREAM_DAYS)
        _in_runs(
            spark, I.table(spark, sf_dir, "events"), F.least(run, last), STQ.StreamPaths(path),
            lambda arrived: STL.stream_mended_candles(spark, I.trades_from(arrived), path, 60),
        )

    return _once(spark, sf_dir, "stream-mended", write)


@query("stream_candles_mended")
def _(spark, sf_dir):
    return STL.mended_candles(spark, _mended(spark, sf_dir))


@query("late_trades")
def _(spark, sf_dir):
    return STL.late_trades(spark, _mended(spark, sf_dir)).select("trade_id", "symbol", "price", F.col("batch").alias("run"))


def _quality_stream(spark: SparkSession, sf_dir: str) -> STQ.StreamPaths:
    def write(path: str) -> None:
        paths = STQ.StreamPaths(path)
        _by_days(spark, sf_dir, paths, lambda arrived: STQ.stream_quality(
            spark, I.stream_records_from(arrived), paths, now=F.col("now"), dlq_enabled=True
        ))

    return STQ.StreamPaths(_once(spark, sf_dir, "stream-quality", write))


@query("late_data")
def _(spark, sf_dir):
    return spark.read.parquet(_quality_stream(spark, sf_dir).late).select("record_id", "quality_score")


@query("stream_quality")
def _(spark, sf_dir):
    rows = L.read_batches(spark, _quality_stream(spark, sf_dir).lake, "*")
    return rows.select(*_RECORD_COLUMNS, "spread", "spread_percentage", *E.TICK_COLUMNS)


@query("stream_quality_failed")
def _(spark, sf_dir):
    return spark.read.parquet(_quality_stream(spark, sf_dir).failed).select("record_id", "status", "reason")


@query("stream_quality_stats")
def _(spark, sf_dir):
    return spark.read.parquet(_quality_stream(spark, sf_dir).stats).withColumnRenamed("batch", "run")


@query("stream_alarms")
def _(spark, sf_dir):
    paths = _paths(spark, "stream-alarms")
    rule = ALARMS["errors"]
    hourly = type(rule)(rule.metric, rule.statistic, rule.threshold, rule.above, 3600)

    def start(arrived: DataFrame):
        s = Q.score_records(FD.decode_stream(I.stream_records_from(arrived)), now=F.col("now"))
        event_ts = parsing.event_time(parsing.field(F.col("record"), "timestamp"))
        points = M.across_dimensions(Q.metric_points(s, F.col("now"), event_ts))
        return STA.stream_alarms(
            spark, points, hourly, paths.out, paths.state, paths.checkpoint, state_count=_cores(spark)
        )

    _by_days(spark, sf_dir, paths, start)
    return spark.read.parquet(paths.out).select("name", "period_start", "value", "breach", "state")
