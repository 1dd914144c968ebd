"""Independent SQL for the registered queries, written for DuckDB over the same tables.

Indicators are spelled in their staged form here (means first, then lagged means), unlike the one-frame
form of the operators.
"""

from __future__ import annotations

SQL: dict[str, str] = {}

def r6(expr: str, name: str | None = None) -> str:
    """A double to six decimals, as every query returns it. The order of a sum changes the sixteenth digit or so,
    which nine decimals leave out; so it can't decide a half at the sixth."""
    return f"{rounded(expr)} as {name or expr}"


def rounded(expr: str) -> str:
    return f"round(try_cast(({expr})::double as decimal(38,9)), 6)::double"


def r6s(*names: str) -> str:
    return ", ".join(r6(n) for n in names)


K_AS_DOUBLE = "cast(json_extract_string(props, '$.k') as double)"

TRADES = """trades as (
  select event_type as symbol, ['binance', 'coinbase', 'kraken'][user_id % 3 + 1] as exchange, ts,
         event_id as trade_id, value as price, cast(json_extract_string(props, '$.k') as double) as volume,
         value - 0.5 as bid, value + 0.5 as ask
  from events)"""

PREPARED = (
    TRADES
    + """, prepared as (
  select *, ask - bid as spread, case when bid > 0 then (ask - bid) / bid * 100 end as spread_percentage
  from trades where price > 0 and volume >= 0)"""
)


def candles(minutes: int, name: str = "candles", source: str = "prepared") -> str:
    return f"""{name} as (
  select symbol, exchange, time_bucket(interval '{minutes} minutes', ts) as interval_start,
         time_bucket(interval '{minutes} minutes', ts) + interval '{minutes} minutes' as interval_end,
         {minutes}::int as interval_minutes,
         arg_min(price, (ts, trade_id)) as open, max(price) as high, min(price) as low,
         arg_max(price, (ts, trade_id)) as close, sum(volume) as volume, count(price) as trade_count,
         avg(price) as vwap, avg(spread) as avg_spread, avg(spread_percentage) as avg_spread_percentage,
         year(time_bucket(interval '{minutes} minutes', ts))::int as year,
         month(time_bucket(interval '{minutes} minutes', ts))::int as month,
         day(time_bucket(interval '{minutes} minutes', ts))::int as day,
         hour(time_bucket(interval '{minutes} minutes', ts))::int as hour
  from {source} group by all)"""


def indicators(source: str = "candles", name: str = "ind", extra_key: str = "") -> str:
    def over(rows: int) -> str:
        return f"(partition by {extra_key}symbol, exchange order by interval_start rows between {rows - 1} preceding and current row)"

    w = f"(partition by {extra_key}symbol, exchange order by interval_start)"
    return f"""i1 as (
  select *, lag(close) over {w} as prev,
         avg(close) over {over(5)} as sma_5, avg(close) over {over(10)} as sma_10,
         avg(close) over {over(20)} as sma_20, avg(close) over {over(12)} as m12, avg(close) over {over(26)} as m26,
         stddev_samp(close) over {over(20)} as sd20
  from {source}),
i2 as (
  select *, lag(m12) over {w} as l12, lag(m26) over {w} as l26,
         case when close > prev then close - prev else 0.0::double end as gain,
         case when close < prev then prev - close else 0.0::double end as loss
  from i1),
i3 as (
  select *,
         case when l12 is not null then (2.0::double / 13) * close + (1 - 2.0::double / 13) * l12 else m12 end as ema_12,
         case when l26 is not null then (2.0::double / 27) * close + (1 - 2.0::double / 27) * l26 else m26 end as ema_26,
         avg(gain) over {over(14)} as ag, avg(loss) over {over(14)} as al
  from i2),
i4 as (select *, ema_12 - ema_26 as macd from i3),
i5 as (select *, avg(macd) over {over(9)} as m9 from i4),
i6 as (select *, lag(m9) over {w} as l9 from i5),
i7 as (
  select *, case when l9 is not null then (2.0::double / 10) * macd + (1 - 2.0::double / 10) * l9 else m9 end
         as macd_signal
  from i6),
{name} as (
  select * exclude (prev, m12, m26, sd20, l12, l26, gain, loss, ag, al, m9, l9),
         close - prev as price_change,
         case when prev > 0 then (close - prev) / prev * 100 end as price_change_percentage,
         macd - macd_signal as macd_histogram, sma_20 as bb_middle, sd20 as bb_std,
         sma_20 + sd20 * 2 as bb_upper, sma_20 - sd20 * 2 as bb_lower,
         case when al <> 0 then 100 - 100.0::double / (1 + ag / al) end as rsi, sd20 as volatility
  from i7)"""


TABLE_5M = f"with {PREPARED}, {candles(5)}, {indicators()}"
AS_OF = "(select max(ts) from events)"


def since_days(days: int) -> str:
    return f"interval_start >= date_trunc('day', {AS_OF}) - interval '{days} days'"


_SERIES = "symbol, exchange, interval_start"
_CANDLE_DOUBLES = r6s("open", "high", "low", "close", "volume", "vwap", "avg_spread", "avg_spread_percentage")
_CANDLE_REST = f"{_SERIES}, interval_end, interval_minutes, trade_count, year, month, day, hour"
_INDICATORS = (
    "price_change", "price_change_percentage", "sma_5", "sma_10", "sma_20", "ema_12", "ema_26", "macd",
    "macd_signal", "macd_histogram", "bb_middle", "bb_std", "bb_upper", "bb_lower", "rsi", "volatility",
)

# --- messages and records ------------------------------------------------------------------------

_FAULTY = """src as (
  select t.*, trade_id % 20 as fault, epoch_us(ts) // 1000 - case when trade_id % 20 in (5, 11) then 3600000 else 0 end as ms
  from trades t)"""

MESSAGES = (
    TRADES
    + ", "
    + _FAULTY
    + """, parts as (
  select *, upper(symbol) as pair,
         case fault when 1 then 'null' when 2 then '"n/a"' when 3 then '"-1"' else '"' || price::varchar || '"' end as p,
         case fault when 4 then '"-1"' else '"' || volume::varchar || '"' end as v
  from src),
raw as (
  select trade_id as message_id, exchange as feed, ts,
         case when fault = 9 then 'invalid json'
              when exchange = 'binance' then
                '{"e":"' || case when fault = 8 then 'kline' else 'trade' end || '","s":"' || pair || 'USD","T":' || ms
                || ',' || case when fault = 0 then '' else '"p":' || p || ',' end || '"q":' || v
                || ',"t":"' || trade_id || '"}'
              when exchange = 'coinbase' then
                '{"type":"' || case when fault = 8 then 'ticker' else 'match' end || '","product_id":"' || pair
                || '-USD","time":"' || strftime(epoch_ms(ms), '%Y-%m-%dT%H:%M:%S.%g') || 'Z",'
                || case when fault = 0 then '' else '"price":' || p || ',' end || '"size":' || v
                || ',"trade_id":"' || trade_id || '"}'
              else
                '{"pair":"' || pair || '/USD","time":"' || ms || '",'
                || case when fault = 0 then '' else '"price":' || p || ',' end || '"volume":' || v
                || ',"trade_id":"' || trade_id || '"}' end as message
  from parts),
parsed as (
  select *, case when json_valid(message) then message end as j from raw),
msg as (
  select message_id, feed, ts, message, j,
         case feed when 'binance' then json_extract_string(j, '$.e') = 'trade'
                   when 'coinbase' then json_extract_string(j, '$.type') = 'match' else true end as is_trade,
         case feed when 'binance' then json_extract_string(j, '$.s')
                   when 'coinbase' then json_extract_string(j, '$.product_id')
                   else json_extract_string(j, '$.pair') end as m_symbol,
         case feed when 'binance' then json_extract_string(j, '$.T') else json_extract_string(j, '$.time') end as m_time,
         case feed when 'binance' then json_extract_string(j, '$.p') else json_extract_string(j, '$.price') end as m_price,
         case feed when 'binance' then json_extract_string(j, '$.q')
                   when 'coinbase' then json_extract_string(j, '$.size')
                   else json_extract_string(j, '$.volume') end as m_volume,
         case feed when 'binance' then json_extract_string(j, '$.t') else json_extract_string(j, '$.trade_id') end as m_id,
         case feed when 'binance' then json_exists(j, '$.p') else json_exists(j, '$.price') end as has_price
  from parsed),
norm as (
  select message_id, feed as exchange, replace(replace(lower(m_symbol), '-', ''), '/', '') as symbol,
         m_time as timestamp, try_cast(m_price as double) as price, try_cast(m_volume as double) as volume,
         m_id as trade_id,
         case when try_cast(m_price as double) > 0 then 1.0::double else 1.0::double - 0.3::double end as quality_score,
         coalesce(epoch_ms(try_cast(m_time as bigint)), try_cast(m_time as timestamp)) as ts
  from msg
  where j is not null and is_trade and try_cast(m_price as double) is not null
    and try_cast(m_volume as double) is not null)"""
)

_NORM = f"message_id, exchange, symbol, timestamp, {r6s('price', 'volume', 'quality_score')}, trade_id"
_ADMIT = "price > 0 and price between 0.01 and 1000000 and volume >= 0 and symbol <> '' and timestamp <> ''"

RECORDS = (
    TRADES
    + ", "
    + _FAULTY
    + """, stream as (
  select trade_id as record_id, ts as now,
         case when fault in (12, 13) then null when fault = 9 then 'invalid json' else
           '{' || case when fault = 7 then '' else
             '"exchange":"' || case when fault = 6 then 'other' else exchange end || '",' end
           || '"symbol":"' || symbol || '","timestamp":"'
           || case when fault in (10, 11) then strftime(epoch_ms(ms), '%Y-%m-%dT%H:%M:%S.%g') || 'Z' else ms::varchar end
           || '",' || case fault when 0 then '' when 1 then '"price":null,' when 2 then '"price":"n/a",'
                         when 3 then '"price":-1.0,'
                         when 14 then '"price":0.0005,' else '"price":' || price::varchar || ',' end
           || '"volume":' || case when fault = 4 then '-1.0' else volume::varchar end
           || ',"bid":' || bid::varchar || ',"ask":' || ask::varchar || ',"trade_id":"' || trade_id || '"}' end as payload
  from src),
fields as (
  select record_id, now, payload, coalesce(json_valid(payload), false) as ok,
         case when json_valid(payload) then payload end as j from stream),
rec as (
  select record_id, now, payload, ok,
         json_extract_string(j, '$.exchange') as exchange, json_extract_string(j, '$.symbol') as symbol,
         json_extract_string(j, '$.timestamp') as timestamp, json_extract_string(j, '$.price') as price_text,
         json_extract_string(j, '$.trade_id') as trade_id,
         json_exists(j, '$.exchange') as has_exchange, json_exists(j, '$.price') as has_price,
         try_cast(json_extract_string(j, '$.price') as double) as price,
         try_cast(json_extract_string(j, '$.volume') as double) as volume,
         try_cast(json_extract_string(j, '$.bid') as double) as bid,
         try_cast(json_extract_string(j, '$.ask') as double) as ask,
         try_cast(json_extract_string(j, '$.timestamp') as bigint) as millis,
         coalesce(try_cast(json_extract_string(j, '$.timestamp') as bigint),
                  epoch_ms(try_cast(json_extract_string(j, '$.timestamp') as timestamp))) as ms
  from fields),
judged as (
  select *,
         case when has_exchange then 0.0::double else 0.2::double end as p_exchange_missing,
         case when has_price then 0.0::double else 0.2::double end as p_price_missing,
         case when has_price and (price is null or price < 0.01 or price > 1000000) then 0.3::double
              else 0.0::double end as p_price,
         case when volume < 0 then 0.2::double else 0.0::double end as p_volume,
         case when (ok and millis is null) or abs(epoch_us(now) // 1000 - millis) > 300000 then 0.1::double
              else 0.0::double end as p_time,
         case when has_exchange and lower(exchange) not in ('binance', 'coinbase', 'kraken') then 0.2::double
              else 0.0::double end as p_exchange,
         case when not has_exchange then 'Missing required field: exchange' end as m_exchange_missing,
         case when not has_price then 'Missing required field: price' end as m_price_missing,
         case when has_price and price is null then 'Invalid price format'
              when price < 0.01 or price > 1000000
                then 'Price ' || price::varchar || ' outside valid range [0.01, 1000000.0]' end as m_price,
         case when volume < 0 then 'Volume ' || volume::varchar || ' below minimum 0.0' end as m_volume,
         case when ok and millis is null then 'Invalid timestamp format'
              when abs(epoch_us(now) // 1000 - millis) > 300000 then 'Timestamp ' || millis::varchar || ' too old' end as m_time,
         case when has_exchange and lower(exchange) not in ('binance', 'coinbase', 'kraken')
              then 'Invalid exchange: ' || exchange end as m_exchange
  from rec),
totals as (
  select *,
         1.0::double - p_exchange_missing - p_price_missing - p_price - p_volume - p_time - p_exchange as raw_score,
         list_filter([m_exchange_missing, m_price_missing, m_price, m_volume, m_time, m_exchange],
                     lambda x: x is not null) as errors
  from judged),
scored as (
  select *, case when ok then greatest(0.0::double, raw_score) end as quality_score,
         case when not ok then 'failed' when raw_score >= 0.8 then 'valid' else 'invalid' end as status
  from totals)"""
)

_W_TICK = "partition by symbol order by ts, trade_id"


def ticks(source: str, order: str) -> str:
    return f"""t1 as (
  select *, lag(coalesce(price, 0)) over w as prev,
         avg(coalesce(price, 0)) over w5 as a5, avg(coalesce(price, 0)) over w10 as a10,
         stddev_pop(coalesce(price, 0)) over w10 as s10, count(*) over w10 as n
  from {source}
  window w as (partition by symbol order by {order}),
         w5 as (partition by symbol order by {order} rows 4 preceding),
         w10 as (partition by symbol order by {order} rows 9 preceding)),
ticks as (
  select *, case when prev > 0 then coalesce(price, 0) - prev end as price_change,
         case when prev > 0 then (coalesce(price, 0) - prev) / prev * 100 end as price_change_percentage,
         case when n >= 5 then a5 end as sma_5, case when n >= 10 then a10 end as sma_10,
         case when n >= 10 then s10 end as volatility
  from t1)"""


_TICK_COLUMNS = ("price_change", "price_change_percentage", "sma_5", "sma_10", "volatility")
_VALID = f"{RECORDS}, valid as (select * from scored where status = 'valid')"
_LIVE_SPREAD_ONLY = r6("case when bid > 0 and ask > 0 then ask - bid end", "spread")
_LIVE_SPREAD = (
    _LIVE_SPREAD_ONLY
    + ", "
    + r6("case when bid > 0 and ask > 0 then (ask - bid) / bid * 100 end", "spread_percentage")
)
_PATH = (
    "coalesce(exchange, 'unknown') || '/' || coalesce(symbol, 'unknown') "
    "|| strftime(epoch_ms(ms), '/year=%Y/month=%m/day=%d/hour=%H')"
)

# --- scans and sources ---------------------------------------------------------------------------

_RECORD_OUT = f"exchange, symbol, timestamp, {r6s('price', 'volume', 'bid', 'ask')}, trade_id, {r6s('quality_score')}"
SQL["read_batches"] = (
    f"with {_VALID} select {_PATH} as data_partition, 1706745600::bigint as batch_timestamp, {_RECORD_OUT}, "
    f"{_LIVE_SPREAD_ONLY}, epoch_ms(ms) as ts from valid"
)
SQL["prune_date"] = (
    f"with {_VALID} select {_RECORD_OUT} from valid where cast(epoch_ms(ms) as date) = date '2024-01-15'"
)
SQL["stream_decode"] = (
    f"with {RECORDS} select record_id, payload, ok as is_object, exchange, symbol, timestamp, trade_id from rec"
)
# Names and types of the landed documents (fixed values); fields of records come in order of their names.
_RAW_RECORD = (
    "array<struct<ask:double,bid:double,exchange:string,price:double,quality_score:double,spread:double,"
    "spread_percentage:double,symbol:string,timestamp:string,trade_id:string,volume:double>>"
)
_RAW_COLUMNS = (
    ("count", "bigint"), ("partition", "string"), ("records", _RAW_RECORD), ("timestamp", "bigint"),
    ("batch", "string"), ("year", "int"), ("month", "int"), ("day", "int"),
)
SQL["infer_raw_schema"] = " union all ".join(
    f"select {n} as position, '{name}' as column_name, '{kind}' as data_type, true as nullable"
    for n, (name, kind) in enumerate(_RAW_COLUMNS)
)
# Columns of the crawled lake's records and when they have a value (fixed values).
_CRAWLED_COLUMNS = (
    *[(c, "string", f"{c} is not null") for c in ("exchange", "symbol", "timestamp", "trade_id")],
    *[(c, "double", f"{c} is not null") for c in ("price", "volume", "bid", "quality_score")],
    *[(c, "double", "bid > 0 and ask > 0") for c in ("spread", "spread_percentage")],
    ("ask", "double", "ask is not null and day(epoch_ms(ms)) < 20"),
    ("processed_at", "string", "timestamp is not null and day(epoch_ms(ms)) >= 16"),
)
_CRAWL = f"{_VALID}, cols as (" + " union all ".join(
    f"select cast(epoch_ms(ms) as date) as date, 'records.{name}' as column_name, '{kind}' as data_type, "
    f"count(*) as n_values from valid where {filled} group by 1" for name, kind, filled in _CRAWLED_COLUMNS
) + ")"
SQL["schema_crawl"] = f"""with {_CRAWL} select strftime(date, '%Y') as year, strftime(date, '%m') as month,
  strftime(date, '%d') as day, column_name, data_type, n_values from cols"""
SQL["schema_drift"] = f"""with {_CRAWL}, days as (
  select date, lag(date) over (order by date) as before from (select distinct date from cols)),
now_and_before as (
  select d.date, c.column_name, 'now' as side, c.data_type from days d join cols c on c.date = d.date
  where before is not null
  union all select d.date, c.column_name, 'before', c.data_type from days d join cols c on c.date = d.before)
select date, column_name, case when bool_and(side = 'now') then 'added' else 'dropped' end as change,
  max(case when side = 'now' then data_type end) as data_type, max(case when side = 'before' then data_type end) as type_before
from now_and_before group by date, column_name having count(*) = 1"""
SQL["scan_candles"] = f"with {PREPARED}, {candles(5)} select {_SERIES}, {r6s('close', 'volume')} from candles"

# --- normalisers ---------------------------------------------------------------------------------

for _key, _feed in (
    ("normalize_binance", "binance"), ("normalize_coinbase", "coinbase"), ("normalize_by_config", "kraken")
):
    SQL[_key] = f"with {MESSAGES} select {_NORM} from norm where exchange = '{_feed}'"
SQL["filter_event_type"] = (
    f"with {MESSAGES} select message_id, feed from msg where feed = 'kraken' or (j is not null and is_trade)"
)
SQL["canonical_symbol"] = f"with {MESSAGES} select exchange, symbol, count(*) as trades from norm group by all"
SQL["source_quality_score"] = f"""with {MESSAGES} select message_id,
  {r6("greatest(0.0::double, 1.0::double - case when has_price then 0.0::double else 0.2::double end "
      "- case when try_cast(m_price as double) > 0 then 0.0::double else 0.3::double end)", "quality_score")}
  from msg where j is not null"""
SQL["parse_event_time"] = f"""with {MESSAGES} select message_id, m_time as time_text,
  coalesce(epoch_ms(try_cast(m_time as bigint)), try_cast(m_time as timestamp)) as event_time from msg"""
SQL["quarantine_malformed"] = f"""with {MESSAGES} select message_id, message from msg
  where j is null or (is_trade and (try_cast(m_price as double) is null or try_cast(m_volume as double) is null))"""
SQL["admit_trade"] = f"with {MESSAGES} select {_NORM} from norm where {_ADMIT}"
SQL["union_feeds"] = f"with {MESSAGES} select {_NORM}, ts from norm where {_ADMIT}"
SQL["partition_by_symbol"] = (
    f"with {TRADES} select symbol, count(*) as trades, {r6('sum(volume)', 'volume')} from trades group by symbol"
)
SQL["ingest_stats"] = f"""with {MESSAGES}, tried as (
  select try_cast(m_price as double) is not null and try_cast(m_volume as double) is not null and j is not null as sent
  from msg where j is null or is_trade)
  select count(*) filter (sent) as total_records_sent, count(*) filter (not sent) as failed_records,
  {r6("count(*) filter (sent) / count(*)::double", "success_rate")} from tried"""

# --- projections and predicates ------------------------------------------------------------------

SQL["calendar_parts"] = """select event_id as trade_id, year(ts)::int as year, month(ts)::int as month,
  day(ts)::int as day, hour(ts)::int as hour, minute(ts)::int as minute from events"""
SQL["clean_trades"] = f"""with {TRADES} select trade_id, symbol, exchange, {r6s('price', 'volume')} from trades
  where price > 0 and volume >= 0 and symbol is not null and exchange is not null"""
SQL["cast_numeric"] = (
    f"select event_id, {r6('value', 'price')}, {r6(K_AS_DOUBLE, 'volume')} from events"
)
SQL["spread_batch"] = f"""with {TRADES} select trade_id, {r6('ask - bid', 'spread')},
  {r6('case when bid > 0 then (ask - bid) / bid * 100 end', 'spread_percentage')} from trades"""
SQL["spread_stream"] = f"with {TRADES} select trade_id, {_LIVE_SPREAD} from trades"
SQL["recent_filter"] = f"{TABLE_5M} select {_SERIES} from ind where {since_days(7)}"

_TREND = "case when close > sma_20 then 'BULLISH' when close < sma_20 then 'BEARISH' else 'NEUTRAL' end"
_RSI = "case when rsi > 70 then 'OVERBOUGHT' when rsi < 30 then 'OVERSOLD' else 'NEUTRAL' end"
_MACD = "case when macd > macd_signal then 'BULLISH' when macd < macd_signal then 'BEARISH' else 'NEUTRAL' end"
_BAND = "case when close > bb_upper then 'OVERBOUGHT' when close < bb_lower then 'OVERSOLD' else 'NORMAL' end"
_SENTIMENT = (
    "case when rsi > 70 and macd > macd_signal then 'STRONG_SELL' "
    "when rsi < 30 and macd < macd_signal then 'STRONG_BUY' when rsi > 70 then 'SELL' when rsi < 30 then 'BUY' "
    "else 'HOLD' end"
)
for _key, _label, _columns in (
    ("trend_signal", _TREND, ("close", "sma_20")),
    ("rsi_signal", _RSI, ("rsi",)),
    ("macd_signal_label", _MACD, ("macd", "macd_signal")),
    ("bollinger_signal", _BAND, ("close",)),
    ("overall_sentiment", _SENTIMENT, ("rsi",)),
):
    SQL[_key] = f"{TABLE_5M} select {_SERIES}, {r6s(*_columns)}, {_label} as label from ind"

_LIMIT = f"(select avg(volatility) * 2 from ind where {since_days(1)})"
_ALERT = f"""case when abs(price_change_percentage) > 5 then 'HIGH_VOLATILITY'
  when rsi > 80 or rsi < 20 then 'EXTREME_RSI' when volatility > {_LIMIT} then 'HIGH_VOLATILITY'
  else 'NORMAL' end as alert_type,
  case when abs(price_change_percentage) > 5 then 'Price change > 5%' when rsi > 80 then 'RSI > 80 (Overbought)'
  when rsi < 20 then 'RSI < 20 (Oversold)' when volatility > {_LIMIT} then 'High volatility detected'
  else 'No alert' end as alert_message"""
SQL["alert_type"] = f"{TABLE_5M} select {_SERIES}, {_ALERT} from ind where {since_days(7)}"

_DQ = f"""{RECORDS}, dq as (
  select coalesce(exchange, 'unknown') as exchange, coalesce(symbol, 'unknown') as symbol,
         cast(epoch_ms(ms) as date) as date, count(*) as total_records,
         count(*) filter (status = 'valid') as valid_records, count(*) filter (status <> 'valid') as invalid_records,
         avg(quality_score) as quality_score, avg(price) as avg_price, avg(volume) as avg_volume,
         min(price) as min_price, max(price) as max_price
  from scored group by 1, 2, 3)"""
SQL["success_rate"] = f"""with {_DQ} select exchange, symbol, date,
  {r6("round(valid_records::decimal(20,0) / total_records * 100, 2)", "success_rate")} from dq"""

# --- validation ----------------------------------------------------------------------------------

for _key, _score, _messages in (
    ("check_required", "1.0::double - p_exchange_missing - p_price_missing", "m_exchange_missing, m_price_missing"),
    ("check_price", "1.0::double - p_price", "m_price"),
    ("check_volume", "1.0::double - p_volume", "m_volume"),
    ("check_timestamp", "1.0::double - p_time", "m_time"),
    ("check_exchange", "1.0::double - p_exchange", "m_exchange"),
):
    SQL[_key] = f"""with {RECORDS} select record_id, {r6(_score, 'score')},
      coalesce(concat_ws('; ', {_messages}), '') as messages from judged where ok"""
SQL["quality_score"] = (
    f"with {RECORDS} select record_id, {r6s('quality_score')}, status = 'valid' as is_valid from scored"
)
SQL["validation_errors"] = (
    f"with {RECORDS} select record_id, case when ok then array_to_string(errors, '; ') end as errors from scored"
)
_REASON = """case status when 'invalid' then 'Data quality validation failed: ['
  || array_to_string(list_transform(errors, lambda e: '''' || e || ''''), ', ') || ']'
  when 'failed' then 'Processing error: unreadable record' end"""
SQL["split_valid_invalid"] = f"with {RECORDS} select record_id, status, {_REASON} as reason from scored"
SQL["batch_stats"] = f"""with {RECORDS}, s as (
  select count(*) as total_records, count(*) filter (status = 'valid') as valid_records,
         count(*) filter (status <> 'valid') as invalid_records from scored)
  select *, case when total_records > 0 and invalid_records / total_records::double > 0.1
    then 'High error rate detected: ' || invalid_records || '/' || total_records || ' records failed' end as alert
  from s"""
SQL["emit_metrics"] = f"""with {RECORDS}, e as (
  select coalesce(exchange, 'unknown') as exchange, count(*)::double as n, avg(quality_score) as s
  from scored where status = 'valid' group by 1)
  select 'RecordsProcessed' as name, n as value, 'Count' as unit, exchange from e
  union all select 'DataQualityScore', {rounded('s')}, 'None', exchange from e
  union all select 'TotalRecords', count(*)::double, 'Count', null from scored
  union all select 'ValidRecords', count(*)::double, 'Count', null from scored where status = 'valid'
  union all select 'InvalidRecords', count(*)::double, 'Count', null from scored where status <> 'valid'
  union all select 'ProcessingTime', 1.5::double, 'Seconds', null"""

# --- enrichment ----------------------------------------------------------------------------------

SQL["processed_at"] = f"with {_VALID} select trade_id, now as processed_at from valid"
for _key, _columns in (
    ("tick_price_change", _TICK_COLUMNS[:2]), ("tick_sma", _TICK_COLUMNS[2:4]), ("tick_volatility", _TICK_COLUMNS[4:])
):
    SQL[_key] = f"with {TRADES}, {ticks('trades', 'ts, trade_id')} select trade_id, symbol, {r6s(*_columns)} from ticks"
_VALID_TICKS = f"with {_VALID}, {ticks('valid', 'ms, trade_id')}"
SQL["attach_quality"] = f"""{_VALID_TICKS} select trade_id, exchange, symbol, {r6s('price', 'quality_score')},
  {_LIVE_SPREAD}, {r6s(*_TICK_COLUMNS)} from ticks"""
SQL["enrich_symbol_dim"] = f"""with {TRADES} select trade_id, symbol || 'usd' as symbol, exchange,
  case when exchange <> 'kraken' then upper(symbol) end as base_currency,
  case when exchange <> 'kraken' then 'USD' end as quote_currency from trades"""

# --- joins ---------------------------------------------------------------------------------------

_MEANS = f"""{TABLE_5M}, means as (
  select symbol, exchange, cast(interval_start as date) as date, avg(close) as avg_price, avg(volume) as avg_volume,
         avg(volatility) as avg_volatility
  from ind where symbol in ('click', 'purchase', 'view') group by 1, 2, 3),
pairs as (
  select a.exchange, a.date, a.symbol as symbol_1, a.avg_price as avg_price_1, a.avg_volume as avg_volume_1,
         a.avg_volatility as avg_volatility_1, b.symbol as symbol_2, b.avg_price as avg_price_2,
         b.avg_volume as avg_volume_2, b.avg_volatility as avg_volatility_2
  from means a join means b on a.exchange = b.exchange and a.date = b.date and a.symbol < b.symbol)"""
SQL["correlation_pairs"] = f"""{_MEANS} select exchange, date, symbol_1, symbol_2,
  {r6s('avg_price_1', 'avg_volume_1', 'avg_volatility_1', 'avg_price_2', 'avg_volume_2', 'avg_volatility_2')}
  from pairs"""


def _corr(name: str) -> str:
    c = f"corr(avg_{name}_1, avg_{name}_2)"
    return r6(f"case when not isnan({c}) then {c} end", f"{name}_correlation")


SQL["pair_correlation"] = f"""{_MEANS} select symbol_1 as symbol1, symbol_2 as symbol2, exchange,
  {_corr('price')}, {_corr('volume')}, {_corr('volatility')} from pairs group by 1, 2, 3"""
_MEANS_30 = _MEANS.replace("from ind where symbol in", f"from ind where {since_days(30)} and symbol in")
SQL["v_correlation_analysis"] = SQL["pair_correlation"].replace(_MEANS, _MEANS_30)
SQL["insert_if_absent"] = f"""with {TRADES}, series as (select distinct symbol, exchange from trades)
  select symbol || 'usd' as symbol, exchange,
  case when exchange = 'kraken' then 'NEW' else upper(symbol) end as base_currency, 'USD' as quote_currency,
  exchange <> 'kraken' as is_active from series"""
# The eight seed rows are fixed values.
SQL["seed_symbols"] = f"""with {TRADES}, held as (
  select distinct upper(symbol) || '-USD' as symbol, exchange, upper(symbol) as base_currency from trades
  where exchange <> 'kraken')
  select symbol, exchange, base_currency, 'USD' as quote_currency, true as is_active from held
  union all
  select symbol, exchange, base_currency, quote_currency, true from (values
    ('btcusdt', 'binance', 'BTC', 'USDT'), ('ethusdt', 'binance', 'ETH', 'USDT'),
    ('bnbusdt', 'binance', 'BNB', 'USDT'), ('adausdt', 'binance', 'ADA', 'USDT'),
    ('btc-USD', 'coinbase', 'BTC', 'USD'), ('eth-USD', 'coinbase', 'ETH', 'USD'),
    ('ltc-USD', 'coinbase', 'LTC', 'USD'), ('bch-USD', 'coinbase', 'BCH', 'USD'))
    v(symbol, exchange, base_currency, quote_currency)
  where (symbol, exchange) not in (select (symbol, exchange) from held)"""
SQL["scalar_threshold"] = f"""{TABLE_5M} select {_SERIES}, {r6s('volatility')} from ind
  where {since_days(1)} and volatility > (select avg(volatility) from ind where {since_days(1)})"""

# --- candles -------------------------------------------------------------------------------------

INTERVALS = {"1m": 1, "5m": 5, "15m": 15, "1h": 60, "4h": 240, "1d": 1440}
for _short, _minutes in INTERVALS.items():
    SQL[f"ohlcv_{_short}"] = (
        f"with {PREPARED}, {candles(_minutes)} select {_CANDLE_REST}, {_CANDLE_DOUBLES} from candles"
    )
for _key, _measures in (
    ("open_close", r6("arg_min(price, (ts, trade_id))", "open") + ", " + r6("arg_max(price, (ts, trade_id))", "close")),
    (
        "high_low_volume_count",
        ", ".join([r6("max(price)", "high"), r6("min(price)", "low"), r6("sum(volume)", "volume")])
        + ", count(price) as trade_count",
    ),
    ("vwap_ref", r6("avg(price)", "vwap")),
    ("vwap_weighted", r6(
        "sum((price * volume)::decimal(30,8))::double / nullif(sum(volume::decimal(20,8))::double, 0)", "vwap_weighted")),
    ("avg_spread", r6("avg(spread)", "avg_spread") + ", " + r6("avg(spread_percentage)", "avg_spread_percentage")),
):
    SQL[_key] = f"""with {PREPARED} select symbol, exchange, time_bucket(interval '4 hours', ts) as interval_start,
      {_measures} from prepared group by symbol, exchange, time_bucket(interval '4 hours', ts)"""

_ALL = ", ".join(candles(m, f"c{s}") for s, m in INTERVALS.items())
_UNION = " union all ".join(f"select * from c{s}" for s in INTERVALS)
SQL["candles_all_intervals"] = (
    f"with {PREPARED}, {_ALL}, al as ({_UNION}) select {_CANDLE_REST}, {_CANDLE_DOUBLES} from al"
)
SQL["candles_large"] = f"""with prepared as (
  select p_brand as symbol, l_returnflag as exchange, l_shipdate as ts,
         (l_orderkey, l_linenumber, l_partkey, l_suppkey) as trade_id, l_extendedprice / l_quantity as price,
         l_quantity as volume, null::double as spread, null::double as spread_percentage
  from lineitem join part on l_partkey = p_partkey
  where l_extendedprice / l_quantity > 0 and l_quantity >= 0), {candles(1440)}
  select {_CANDLE_REST}, {r6s('open', 'high', 'low', 'close', 'volume', 'vwap')} from candles"""

# --- rollups -------------------------------------------------------------------------------------

_DATE = "cast(interval_start as date)"
_EXCHANGE_DAILY = ", ".join(
    [
        "count(distinct symbol) as symbols_traded", r6("sum(volume)", "total_volume"),
        "sum(trade_count)::bigint as total_trades", r6("avg(price_change_percentage)", "avg_price_change"),
        r6("avg(rsi)", "avg_rsi"), r6("avg(volatility)", "avg_volatility"),
        r6("avg(avg_spread_percentage)", "avg_spread_percentage"),
    ]
)


def _grouped(keys: str, measures: str, where: str = "true") -> str:
    count = keys.count(",") + 1
    positions = ", ".join(str(i + 1) for i in range(count))
    return f"{TABLE_5M} select {keys}, {measures} from ind where {where} group by {positions}"


_DAY_KEYS = f"symbol, exchange, {_DATE} as date"
_HOURLY = ", ".join(
    [
        r6("sum(volume)", "hourly_volume"), "count(*) as candle_count", r6("avg(volume)", "avg_volume_per_candle"),
        r6("max(volume)", "max_volume"), r6("min(volume)", "min_volume"),
    ]
)
_HOUR_KEYS = f"{_DAY_KEYS}, hour(interval_start)::int as hour"
_VOLATILITY = ", ".join(
    [
        r6("avg(volatility)", "avg_volatility"), r6("max(volatility)", "max_volatility"),
        r6("min(volatility)", "min_volatility"), r6("stddev_samp(close)", "price_stddev"),
        r6("(max(high) - min(low)) / avg(close) * 100", "daily_range_percentage"),
    ]
)
_SUMMARY = ", ".join(
    [
        r6("arg_min(open, interval_start)", "open_price"), r6("arg_max(close, interval_start)", "close_price"),
        r6("max(high)", "high_price"), r6("min(low)", "low_price"), r6("sum(volume)", "total_volume"),
        "sum(trade_count)::bigint as total_trades", r6("avg(vwap)", "avg_vwap"),
        r6("avg(price_change_percentage)", "avg_price_change_percentage"), r6("avg(rsi)", "avg_rsi"),
        r6("avg(volatility)", "avg_volatility"),
    ]
)
SQL["exchange_daily"] = _grouped(f"exchange, {_DATE} as date", _EXCHANGE_DAILY)
SQL["hourly_volume"] = _grouped(_HOUR_KEYS, _HOURLY)
SQL["daily_volatility"] = _grouped(_DAY_KEYS, _VOLATILITY)
SQL["day_open_close"] = _grouped(
    _DAY_KEYS,
    r6("arg_min(open, interval_start)", "open_price") + ", " + r6("arg_max(close, interval_start)", "close_price"),
)
SQL["data_quality_metrics"] = f"""with {_DQ} select exchange, symbol, date, total_records, valid_records,
  invalid_records, {r6s('quality_score', 'avg_price', 'avg_volume', 'min_price', 'max_price')} from dq"""
_FIRST, _LAST = "arg_min(open, interval_start)", "arg_max(close, interval_start)"
SQL["daily_stats"] = _grouped(
    _DAY_KEYS,
    ", ".join(
        [
            r6(_FIRST, "open_price"), r6(_LAST, "close_price"), r6("max(high)", "high_price"),
            r6("min(low)", "low_price"), r6("sum(volume)", "total_volume"),
            "sum(trade_count)::bigint as total_trades", r6("avg(avg_spread)", "avg_spread"),
            r6("avg(avg_spread_percentage)", "avg_spread_percentage"), r6("stddev_samp(close)", "volatility"),
            r6("avg(rsi)", "rsi_avg"), r6(f"{_LAST} - {_FIRST}", "price_change"),
            r6(f"({_LAST} - {_FIRST}) / {_FIRST} * 100", "price_change_percentage"),
        ]
    ),
)
SQL["exchange_performance"] = f"""with {_DQ}, prepared as (
  select *, ask - bid as spread, case when bid > 0 then (ask - bid) / bid * 100 end as spread_percentage
  from trades where price > 0 and volume >= 0), {candles(5)}, traded as (
  select exchange, {_DATE} as date, sum(volume) as total_volume, sum(trade_count)::bigint as total_trades,
         avg(avg_spread) as avg_spread, avg(avg_spread_percentage) as avg_spread_percentage,
         count(distinct interval_start) * 100.0::double / 288 as uptime_percentage
  from candles group by 1, 2),
  quality as (
  select exchange, date, sum(quality_score * total_records) / sum(total_records) as data_quality_score
  from dq group by 1, 2)
  select exchange, date, {r6s('total_volume')}, total_trades,
  {r6s('avg_spread', 'avg_spread_percentage', 'uptime_percentage', 'data_quality_score')}
  from traded left join quality using (exchange, date)"""

# --- indicators ----------------------------------------------------------------------------------

HOURLY = f"with {PREPARED}, {candles(60)}, {indicators()}"
for _key, _columns in {
    "price_change": ("price_change",),
    "price_change_pct": ("price_change_percentage",),
    "sma": ("sma_5", "sma_10", "sma_20"),
    "ema": ("ema_12", "ema_26"),
    "macd": ("macd",),
    "macd_signal": ("macd_signal",),
    "macd_histogram": ("macd_histogram",),
    "bollinger": ("bb_middle", "bb_std", "bb_upper", "bb_lower"),
    "rsi": ("rsi",),
    "volatility": ("volatility",),
}.items():
    SQL[_key] = f"{HOURLY} select {_SERIES}, {r6s(*_columns)} from ind"
SQL["indicators_1h"] = f"{HOURLY} select {_CANDLE_REST}, {_CANDLE_DOUBLES}, {r6s(*_INDICATORS)} from ind"
SQL["ema_recursive"] = f"""with recursive {PREPARED}, {candles(60)}, numbered as (
  select symbol, exchange, interval_start, close,
         row_number() over (partition by symbol, exchange order by interval_start) as n from candles),
fold as (
  select symbol, exchange, interval_start, n, close as e from numbered where n = 1
  union all
  select f.symbol, f.exchange, c.interval_start, c.n, c.close * (2.0::double / 6) + f.e * (1 - 2.0::double / 6)
  from fold f join numbered c on c.symbol = f.symbol and c.exchange = f.exchange and c.n = f.n + 1)
select {_SERIES}, {r6('e', 'ema_recursive_5')} from fold"""

# --- serving views -------------------------------------------------------------------------------

SQL["v_latest_market_data"] = f"""{TABLE_5M} select {_SERIES}, interval_end, trade_count,
  {r6s('open', 'high', 'low', 'close', 'volume', 'vwap', 'price_change', 'price_change_percentage', 'sma_5', 'sma_10',
       'sma_20', 'rsi', 'volatility')} from ind where {since_days(1)}"""
SQL["v_daily_market_summary"] = _grouped(_DAY_KEYS, _SUMMARY, since_days(30))
SQL["v_exchange_performance"] = _grouped(f"exchange, {_DATE} as date", _EXCHANGE_DAILY, since_days(7))
_TOP = f"""{TABLE_5M} select symbol, exchange, {_DATE} as date,
  {r6s('price_change_percentage', 'volume', 'rsi', 'volatility')} from ind
  where {since_days(1)} and price_change_percentage is not null"""
SQL["v_top_performing_symbols"] = _TOP
SQL["top_k_symbols"] = f"{_TOP} order by ind.price_change_percentage desc limit 20"
SQL["v_technical_indicators"] = f"""{TABLE_5M} select {_SERIES},
  {r6s('close', 'sma_5', 'sma_10', 'sma_20', 'ema_12', 'ema_26', 'macd', 'macd_signal', 'macd_histogram', 'bb_middle',
       'bb_upper', 'bb_lower', 'rsi', 'volatility')}, {_TREND} as trend_signal, {_RSI} as rsi_signal
  from ind where {since_days(7)} and sma_20 is not null and rsi is not null"""
SQL["v_data_quality_summary"] = f"""with {_DQ} select exchange, symbol, date, total_records, valid_records,
  invalid_records, {r6s('quality_score')},
  {r6("round(valid_records::decimal(20,0) / total_records * 100, 2)", "success_rate")},
  {r6s('avg_price', 'avg_volume', 'min_price', 'max_price')} from dq
  where date >= cast({AS_OF} as date) - interval '30 days'"""
SQL["v_volume_analysis"] = _grouped(_HOUR_KEYS, _HOURLY, since_days(7))
SQL["v_volatility_analysis"] = _grouped(_DAY_KEYS, _VOLATILITY, since_days(30))
SQL["v_market_sentiment"] = f"""{TABLE_5M} select {_SERIES}, {r6s('close', 'volume', 'rsi', 'macd', 'macd_signal')},
  {_MACD} as macd_signal_label, {_BAND} as bb_signal, {_SENTIMENT} as overall_sentiment from ind
  where {since_days(1)} and rsi is not null and macd is not null and bb_upper is not null"""
SQL["v_real_time_alerts"] = f"""{TABLE_5M} select {_SERIES},
  {r6s('close', 'price_change_percentage', 'volume', 'rsi', 'volatility')}, {_ALERT} from ind
  where interval_start >= {AS_OF} - interval '1 hour'
    and (abs(price_change_percentage) > 5 or rsi > 80 or rsi < 20 or volatility > {_LIMIT})"""
SQL["latest_log_rows"] = (
    "select ts, event_id, props from events order by ts desc, event_id desc limit 100"
)

# --- sinks ---------------------------------------------------------------------------------------

SQL["partition_key"] = f"with {RECORDS} select record_id, {_PATH} as partition_key from rec where ok"
SQL["write_raw_json"] = (
    f"with {_VALID} select {_PATH} as partition, count(*) as records, true as within_limit from valid group by 1"
)
_NAMES = {"1m": "ohlcv_1min", "5m": "ohlcv_5min", "15m": "ohlcv_15min", "1h": "ohlcv_1h", "4h": "ohlcv_4h", "1d": "ohlcv_daily"}
_NAME_CASE = "case interval_minutes " + " ".join(f"when {INTERVALS[s]} then '{n}'" for s, n in _NAMES.items()) + " end"
_IND_ALL = f"with {PREPARED}, {_ALL}, al as ({_UNION}), {indicators('al', extra_key='interval_minutes, ')}"
SQL["write_candles_parquet"] = f"""{_IND_ALL} select {_NAME_CASE} as candle_table, year, month, day,
  count(*) as candles, {r6('sum(volume)', 'volume')}, {r6('avg(rsi)', 'avg_rsi')} from ind group by 1, 2, 3, 4"""
SQL["write_warehouse"] = f"""with {PREPARED}, {candles(5)} select symbol, exchange, count(*) as candles,
  count(*) as ids, {r6('sum(volume)', 'volume')} from candles group by 1, 2"""


def _decimal_text(expr: str, stored: int) -> str:
    """A decimal stored with so many digits, which it gets by way of nine, as text of six at most."""
    return f"round(round(try_cast(({expr})::double as decimal(38,9)), {stored}), {min(stored, 6)})::varchar"


def _decimal(column: str) -> str:
    if column in ("symbol", "exchange", "interval_start", "interval_end"):
        return column
    if column in ("trade_count", "year", "month", "day", "hour"):
        return f"{column}::int as {column}"
    if column in ("avg_spread_percentage", "price_change_percentage", "rsi"):
        return f"{_decimal_text(column, 4)} as {column}"
    return f"{_decimal_text(column, 8)} as {column}"


_BASE_COLUMNS = ["symbol", "exchange", "interval_start", "interval_end", "open", "high", "low", "close", "volume",
                 "trade_count", "vwap"]
_TREND_COLUMNS = ["price_change", "price_change_percentage", "sma_5", "sma_10", "sma_20"]
_MOMENTUM_COLUMNS = ["ema_12", "ema_26", "macd", "macd_signal", "macd_histogram", "bb_middle", "bb_upper", "bb_lower",
                     "bb_std"]
_TAIL_COLUMNS = ["rsi", "volatility"]
_PARTS = ["year", "month", "day", "hour"]
_FULL = _BASE_COLUMNS + _TREND_COLUMNS + _MOMENTUM_COLUMNS + _TAIL_COLUMNS
for _short, _columns in {
    "1m": _BASE_COLUMNS + _PARTS,
    "5m": _FULL + ["avg_spread", "avg_spread_percentage"] + _PARTS,
    "15m": _BASE_COLUMNS + _TREND_COLUMNS + _TAIL_COLUMNS + _PARTS,
    "1h": _FULL + _PARTS,
    "4h": _FULL + _PARTS,
    "1d": _FULL + ["year", "month", "day"],
}.items():
    SQL[f"project_candle_table_{_short}"] = (
        f"with {PREPARED}, {candles(INTERVALS[_short])}, {indicators()} "
        f"select {', '.join(_decimal(c) for c in _columns)} from ind"
    )
SQL["surrogate_id_defaults"] = f"""with {PREPARED}, {candles(1440)} select symbol, exchange, count(*) as candles,
  count(*) as ids from candles group by 1, 2"""
SQL["distributed_by_symbol"] = f"""{TABLE_5M}, kept as (
  select symbol, exchange, interval_start, round(volume, 8) as volume from ind)
select symbol, exchange, interval_start, {r6s('volume')}, {r6('avg(volume) over (partition by symbol)', 'mean_volume')}
from kept"""
SQL["layout"] = f"with {PREPARED}, {candles(60)} select {_SERIES}, {r6s('close', 'volume')} from candles"
_DAY_TRADES = f"""{_VALID}, day as (
  select symbol, exchange, epoch_ms(ms) as ts, trade_id, price, volume, null::double as spread,
         null::double as spread_percentage
  from valid where cast(epoch_ms(ms) as date) = date '2024-01-15' and price > 0 and volume >= 0
    and exchange is not null)"""
_DAY_ALL = ", ".join(candles(m, f"c{s}", "day") for s, m in INTERVALS.items())
SQL["skip_empty"] = f"""with {_DAY_TRADES}, {_DAY_ALL}, al as ({_UNION})
  select {_NAME_CASE} as candle_table, count(*) as candles, sum(trade_count)::bigint as trades,
  true as skipped_empty, true as built from al group by 1"""

SQL["days_to_rerun"] = f"""with {_VALID}, landed as (
  select cast(epoch_ms(ms) as date) as date, trade_id::bigint % 11 = 0 as late from valid),
unseen as (
  select distinct date, late from landed where late or date not in (date '2024-01-14', date '2024-01-15'))
select strftime(date, '%Y') as year, strftime(date, '%m') as month, strftime(date, '%d') as day, count(*) as batches
from unseen group by date"""
SQL["process_day_metrics"] = f"""with {_DAY_TRADES}, dq as (
  select distinct coalesce(exchange, 'unknown') as e, coalesce(symbol, 'unknown') as s from scored
  where cast(epoch_ms(ms) as date) = date '2024-01-15')
select date '2024-01-15' as date, 'data_quality_metrics' as metric_table, (select count(*) from dq) as n_rows,
  (select count(*) from scored where cast(epoch_ms(ms) as date) = date '2024-01-15') as records
union all select date '2024-01-15', 'daily_stats', count(distinct (symbol, exchange)), count(*) from day
union all select date '2024-01-15', 'exchange_performance', count(distinct exchange), count(*) from day"""

_TWO_DAYS = _DAY_TRADES.replace("= date '2024-01-15'", "in (date '2024-01-14', date '2024-01-15')")
SQL["process_two_days"] = f"""with {_TWO_DAYS}, {_DAY_ALL}, al as ({_UNION})
  select {_NAME_CASE} as candle_table, year, month, day, count(*) as candles, sum(trade_count)::bigint as trades
  from al group by 1, 2, 3, 4"""

# Stored columns and types of the metric tables (fixed values); the day is the partition and comes last.
_STORED = {
    "data_quality_metrics": "exchange string, symbol string, total_records int, valid_records int, "
    "invalid_records int, quality_score decimal(5,4), avg_price decimal(20,8), avg_volume decimal(20,8), "
    "min_price decimal(20,8), max_price decimal(20,8), id string, date date",
    "daily_stats": "symbol string, exchange string, open_price decimal(20,8), close_price decimal(20,8), "
    "high_price decimal(20,8), low_price decimal(20,8), total_volume decimal(20,8), total_trades int, "
    "price_change decimal(20,8), price_change_percentage decimal(10,4), avg_spread decimal(20,8), "
    "avg_spread_percentage decimal(10,4), volatility decimal(20,8), rsi_avg decimal(10,4), id string, date date",
    "exchange_performance": "exchange string, total_volume decimal(20,8), total_trades int, "
    "avg_spread decimal(20,8), avg_spread_percentage decimal(10,4), data_quality_score decimal(5,4), "
    "uptime_percentage decimal(5,2), id string, date date",
}


def _as_stored(types: str) -> str:
    out = []
    for name, kind in (part.split(" ") for part in types.split(", ")):
        if kind == "decimal(20,8)":
            out.append(f"{_decimal_text(name, 8)} as {name}")
        elif kind.startswith("decimal"):
            out.append(f"{_decimal_text(name, int(kind[-2]))} as {name}")
        elif name != "id":
            out.append(name)
    return f"select {', '.join(out)}, '{types}' as types"


def _unrounded(sql: str) -> str:
    """The same query with its doubles as they are: a stored decimal is rounded once."""
    return sql.replace("round(try_cast((", "((").replace(")::double as decimal(38,9)), 6)::double", ")::double)")


for _name, _rows in (
    ("data_quality_metrics", f"with {_DQ} {_as_stored(_STORED['data_quality_metrics'])} from dq"),
    ("daily_stats", f"with rows as ({_unrounded(SQL['daily_stats'])}) {_as_stored(_STORED['daily_stats'])} from rows"),
    (
        "exchange_performance",
        f"with rows as ({_unrounded(SQL['exchange_performance'])}) {_as_stored(_STORED['exchange_performance'])} from rows",
    ),
):
    SQL[f"stored_{_name}"] = f"{_rows} where date is not null"

# --- monitoring ----------------------------------------------------------------------------------

_METRICS = f"""{RECORDS}, metrics as (
  select 'RecordsProcessed' as name, coalesce(exchange, 'unknown') as exchange, 1.0::double as value, now
  from scored where status = 'valid'
  union all select 'DataQualityScore', coalesce(exchange, 'unknown'), quality_score, now from scored
  where status = 'valid'
  union all select 'LagMilliseconds', coalesce(exchange, 'unknown'), (epoch_us(now) // 1000 - ms)::double, now from scored
  where status = 'valid'
  union all select 'InvalidRecords', null, 1.0::double, now from scored where status <> 'valid')"""
SQL["metric_rollup"] = f"""with {_METRICS} select name, exchange, time_bucket(interval '1 hour', now) as period_start,
  {r6('avg(value)', 'avg')}, {r6('sum(value)', 'sum')}, {r6('max(value)', 'max')}, {r6('min(value)', 'min')},
  count(value) as samples from metrics group by 1, 2, 3"""


SQL["metric_rollup_periods"] = f"with {_METRICS} " + " union all ".join(
    f"select name, exchange, {seconds} as period_seconds, time_bucket(interval '{seconds} seconds', now) as period_start, "
    f"{r6('avg(value)', 'avg')}, {r6('sum(value)', 'sum')}, {r6('max(value)', 'max')}, {r6('min(value)', 'min')}, "
    "count(value) as samples from metrics group by name, exchange, 4" for seconds in (300, 3600, 86400)
)


def _alarm(metric: str, statistic: str, breach: str) -> str:
    return f"""{_METRICS}, periods as (
  select name, time_bucket(interval '1 hour', now) as period_start, {statistic}(value) as value from metrics
  where name = '{metric}' group by 1, 2),
alarm as (
  select *, value {breach} as breach,
         count(*) filter (value {breach}) over (order by period_start
           range between interval '1 hour' preceding and current row) as n
  from periods)"""


_ALARM = _alarm("InvalidRecords", "sum", "> 1")
_ALARM_OUT = f"name, period_start, {r6s('value')}, breach, case when n >= 2 then 'ALARM' else 'OK' end as state"
SQL["metric_alarm"] = f"with {_ALARM} select {_ALARM_OUT} from alarm"
SQL["metric_alarm_lag"] = f"with {_alarm('LagMilliseconds', 'max', '> 60000')} select {_ALARM_OUT} from alarm"
SQL["metric_alarm_data_quality"] = f"with {_alarm('DataQualityScore', 'avg', '< 0.8')} select {_ALARM_OUT} from alarm"


def _status(value: str, warning: str, critical: str) -> str:
    return (
        f"case when {value} is null then 'UNKNOWN' when {value} {critical} then 'CRITICAL' "
        f"when {value} {warning} then 'WARNING' else 'HEALTHY' end"
    )


_QUALITY = "(select avg(value) as v from metrics where name = 'DataQualityScore')"
_LAG = "(select coalesce(max(value), 0) as v from metrics where name = 'LagMilliseconds')"
_ERRORS = f"""(select count(*) as v from metrics where name = 'InvalidRecords'
  and now > {AS_OF} - interval '1440 minutes' and now <= {AS_OF})"""
SQL["health_quality"] = f"""with {_METRICS} select 'Data Quality' as component, {_status('v', '< 0.8', '< 0.7')} as status,
  case when v is null then 'No data quality metrics available'
  when v < 0.7 then printf('Low data quality score: %.2f', v)
  when v < 0.8 then printf('Below target data quality score: %.2f', v)
  else printf('Data quality is good: %.2f', v) end as message, 'quality_score' as check from {_QUALITY}"""
SQL["health_lag"] = f"""with {_METRICS} select 'Stream Lag' as component, {_status('v', '> 60000', '> 300000')} as status,
  case when v > 300000 then printf('High lag: %.1f seconds', v / 1000)
  when v > 60000 then printf('Elevated lag: %.1f seconds', v / 1000) else 'Stream is healthy' end as message,
  'lag_ms' as check from {_LAG}"""
SQL["health_errors"] = f"""with {_METRICS} select 'Stream Processing' as component, {_status('v', '> 5', '> 10')} as status,
  case when v > 10 then 'High error rate: ' || v || ' errors in last 1440 minutes'
  when v > 5 then 'Elevated error rate: ' || v || ' errors in last 1440 minutes'
  else 'Processing is healthy' end as message, 'error_count' as check from {_ERRORS}"""
_FRESH = f"(select count(*) as v from candles where interval_start >= {AS_OF} - interval '1 hour')"
SQL["health_freshness"] = f"""with {PREPARED}, {candles(5)} select 'Candle Table' as component,
  case when v = 0 then 'WARNING' else 'HEALTHY' end as status,
  case when v = 0 then 'No recent data found' else 'Candle table is healthy' end as message,
  'recent_records' as check from {_FRESH}"""
_ERRORS_5 = _ERRORS.replace("1440 minutes", "5 minutes")
SQL["health_rollup"] = f"""with {_METRICS}, prepared as (
  select *, null::double as spread, null::double as spread_percentage from trades where price > 0 and volume >= 0),
  {candles(5)}, checks as (
  select {_status('v', '< 0.8', '< 0.7')} as status from {_QUALITY}
  union all select {_status('v', '> 60000', '> 300000')} from {_LAG}
  union all select {_status('v', '> 5', '> 10')} from {_ERRORS_5}
  union all select case when v = 0 then 'WARNING' else 'HEALTHY' end from {_FRESH})
  select count(*) filter (status = 'CRITICAL') as critical, count(*) filter (status = 'WARNING') as warning,
  count(*) filter (status = 'HEALTHY') as healthy, count(*) filter (status = 'UNKNOWN') as unknown,
  case when count(*) filter (status = 'CRITICAL') > 0 then 'CRITICAL'
  when count(*) filter (status = 'WARNING') > 0 then 'WARNING' else 'HEALTHY' end as overall_status from checks"""
SQL["validation_error_types"] = f"""with {RECORDS}, m as (select unnest(errors) as e from scored where ok)
  select case when e like 'Missing%' then 'missing_fields'
  when e like 'Price %' or e = 'Invalid price format' then 'invalid_price'
  when e like 'Volume %' or e = 'Invalid volume format' then 'invalid_volume'
  when e like 'Timestamp %' or e = 'Invalid timestamp format' then 'invalid_timestamp'
  else 'invalid_exchange' end as error_type, count(*) as errors from m group by 1"""
SQL["validation_error_periods"] = f"""with {RECORDS}, m as (select now, unnest(errors) as e from scored where ok)
  select time_bucket(interval '5 minutes', now) as period_start, case when e like 'Missing%' then 'missing_fields'
  when e like 'Price %' or e = 'Invalid price format' then 'invalid_price'
  when e like 'Volume %' or e = 'Invalid volume format' then 'invalid_volume'
  when e like 'Timestamp %' or e = 'Invalid timestamp format' then 'invalid_timestamp'
  else 'invalid_exchange' end as error_type, count(*) as errors from m group by 1, 2"""
SQL["symbol_coverage"] = """select event_type as symbol, time_bucket(interval '1 hour', ts) as period_start,
  count(*) as trades from events group by 1, 2"""
SQL["data_freshness"] = f"""select {r6("(epoch_us(timestamp '2024-02-01 00:00:00') // 1000 - epoch_us(max(ts)) // 1000) / 1000.0::double",
  'data_freshness_seconds')} from events"""
SQL["ingest_delay"] = f"""with {_VALID} select exchange, {r6('avg(epoch_us(now) // 1000 - ms)', 'avg_delay_ms')},
  count(*) as records from valid where exchange is not null group by rollup (exchange)"""
SQL["latency_summary"] = f"""with {TRADES}, samples as (
  select symbol || '/' || exchange as component, ts,
         case when trade_id % 20 <> 9 then trunc(price * 1000)::bigint + epoch_us(ts) % 1000 end as us
  from trades),
ranked as (
  select component, us, row_number() over (partition by component order by us) - 1 as pos,
         count(*) over (partition by component) as n
  from samples where us is not null),
picked as (
  select component, max(us) filter (pos = floor(n * 95 / 100.0)) as p95, max(us) filter (pos = floor(n * 99 / 100.0)) as p99
  from ranked group by component),
total as (
  select component, count(us) as records_processed, count(*) filter (us is null) as errors, avg(us) as a,
         max(us) as mx, min(us) as mn, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 as seconds
  from samples group by component)
select component, records_processed, errors, {r6('errors / (records_processed + errors)::double', 'error_rate')},
  {r6('case when seconds > 0 then records_processed / seconds else 0 end', 'throughput_rps')},
  {r6('coalesce(a / 1000.0::double, 0)', 'avg_latency_ms')}, {r6('coalesce(p95 / 1000.0::double, 0)', 'p95_latency_ms')},
  {r6('coalesce(p99 / 1000.0::double, 0)', 'p99_latency_ms')}, {r6('coalesce(mx / 1000.0::double, 0)', 'max_latency_ms')},
  {r6('coalesce(mn / 1000.0::double, 0)', 'min_latency_ms')}
from total left join picked using (component)"""

# --- streams -------------------------------------------------------------------------------------
# A stream emits a bucket once the watermark (newest time minus 5 minutes) has passed its end.

_CLOSED = f"interval_end <= {AS_OF} - interval '5 minutes'"
SQL["stream_candles"] = SQL["ohlcv_1h"] + f" where {_CLOSED}"
SQL["stream_candles_5m"] = SQL["ohlcv_5m"] + f" where {_CLOSED}"
SQL["stream_indicators"] = SQL["indicators_1h"] + f" where {_CLOSED}"
# Micro-batches come one after the other, each with the events of eight days; a late record is late in its own.
_ARRIVED_TICKS = f"with {_VALID}, {ticks('valid', '(day(now) - 1) // 8, ms, trade_id')}"
SQL["stateful_enrich"] = (
    f"{_ARRIVED_TICKS} select trade_id, symbol, {r6s('price')}, {r6s(*_TICK_COLUMNS)} from ticks"
)
SQL["stateful_enrich_keyed"] = SQL["stateful_enrich"]
SQL["stream_candles_mended"] = SQL["stream_candles"]
# A trade is late if its hour had ended at the newest time of the runs before its own, less 5 minutes.
SQL["late_trades"] = f"""with {PREPARED}, arrived as (
  select *, least(3, (day(ts) - 1) // 8 + (trade_id % 11 = 0)::int)::bigint as run from prepared),
marks as (
  select run, max(max(ts)) over (order by run rows between unbounded preceding and 1 preceding) - interval '5 minutes' as mark
  from arrived group by run)
select trade_id, symbol, {r6s('price')}, run from arrived join marks using (run)
where time_bucket(interval '1 hour', ts) + interval '1 hour' <= mark"""
SQL["late_data"] = (
    f"with {RECORDS} select record_id, {r6s('quality_score')} from scored where abs(epoch_us(now) // 1000 - ms) > 300000"
)
SQL["stream_quality"] = f"{_ARRIVED_TICKS} select {_RECORD_OUT}, {_LIVE_SPREAD}, {r6s(*_TICK_COLUMNS)} from ticks"
SQL["stream_quality_failed"] = (
    f"with {RECORDS} select record_id, status, {_REASON} as reason from scored where status <> 'valid'"
)
SQL["stream_quality_stats"] = f"""with {RECORDS}, s as (
  select ((day(now) - 1) // 8)::int as run, count(*) as total_records, count(*) filter (status = 'valid') as valid_records,
         count(*) filter (status <> 'valid') as invalid_records from scored group by 1)
  select *, case when invalid_records / total_records::double > 0.1
    then 'High error rate detected: ' || invalid_records || '/' || total_records || ' records failed' end as alert from s"""
SQL["stream_alarms"] = (
    f"with {_ALARM} select {_ALARM_OUT} from alarm "
    "where period_start + interval '1 hour' <= "
    "(select max(now) from metrics where name = 'InvalidRecords') - interval '5 minutes'"
)
