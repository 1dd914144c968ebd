"""The driver tables seen as trades, raw messages and stream records (FIXTURES.md, part B)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.config import EXCHANGES
from marketlake.session import configure


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def spread(events: DataFrame) -> DataFrame:
    """Events in as many tasks as the application has cores, by time, for work that costs more than a shuffle.

    A scan has at most one task for each row group of its files, however many rows that holds.
    """
    return events.repartitionByRange(events.sparkSession.sparkContext.defaultParallelism, "ts", "event_id")


def _exchange(user_id: Column) -> Column:
    return F.element_at(F.array(*[F.lit(e) for e in EXCHANGES]), (user_id % 3 + 1).cast("int"))


def trades_from(events: DataFrame) -> DataFrame:
    """Events as trades; quotes half a unit around the price."""
    value = F.col("value")
    return events.select(
        F.col("event_type").alias("symbol"),
        _exchange(F.col("user_id")).alias("exchange"),
        "ts",
        F.col("event_id").alias("trade_id"),
        value.alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("volume"),
        (value - 0.5).alias("bid"),
        (value + 0.5).alias("ask"),
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades_from(table(spark, sf_dir, "events"))


def large_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as trades of their part's brand."""
    items = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return items.join(parts, items.l_partkey == parts.p_partkey).select(
        F.col("p_brand").alias("symbol"),
        F.col("l_returnflag").alias("exchange"),
        F.col("l_shipdate").alias("ts"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("trade_id"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("volume"),
    )


def raw_messages_from(events: DataFrame) -> DataFrame:
    """Wire messages, one per event, in the spelling of the event's exchange. Faults by event_id % 20."""
    t = trades_from(events).withColumn("fault", F.col("trade_id") % 20)
    fault, pair = F.col("fault"), F.upper("symbol")
    millis = F.unix_millis(F.col("ts").cast("timestamp")) - F.when(fault.isin(5, 11), 3_600_000).otherwise(0)
    iso = F.concat(
        F.date_format(F.timestamp_millis(millis), "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("Z")
    )
    price = (
        F.when(fault == 1, "null").when(fault == 2, '"n/a"').when(fault == 3, '"-1"')
        .otherwise(F.concat(F.lit('"'), F.col("price").cast("string"), F.lit('"')))
    )
    volume = F.when(fault == 4, '"-1"').otherwise(F.concat(F.lit('"'), F.col("volume").cast("string"), F.lit('"')))
    trade_id = F.col("trade_id").cast("string")

    def message(price_name: str, before: Column, after: Column) -> Column:
        named = F.concat(F.lit(f'"{price_name}":'), price, F.lit(","))
        return F.concat(F.lit("{"), before, F.when(fault == 0, "").otherwise(named), after, F.lit("}"))

    binance = message(
        "p",
        F.concat(
            F.lit('"e":"'), F.when(fault == 8, "kline").otherwise("trade"), F.lit('","s":"'), pair,
            F.lit('USD","T":'), millis.cast("string"), F.lit(","),
        ),
        F.concat(F.lit('"q":'), volume, F.lit(',"t":"'), trade_id, F.lit('"')),
    )
    coinbase = message(
        "price",
        F.concat(
            F.lit('"type":"'), F.when(fault == 8, "ticker").otherwise("match"), F.lit('","product_id":"'), pair,
            F.lit('-USD","time":"'), iso, F.lit('",'),
        ),
        F.concat(F.lit('"size":'), volume, F.lit(',"trade_id":"'), trade_id, F.lit('"')),
    )
    kraken = message(
        "price",
        F.concat(F.lit('"pair":"'), pair, F.lit('/USD","time":"'), millis.cast("string"), F.lit('",')),
        F.concat(F.lit('"volume":'), volume, F.lit(',"trade_id":"'), trade_id, F.lit('"')),
    )
    text = F.when(F.col("exchange") == "binance", binance).when(F.col("exchange") == "coinbase", coinbase)
    return t.select(
        F.col("trade_id").alias("message_id"),
        F.col("exchange").alias("feed"),
        "ts",
        F.when(fault == 9, "invalid json").otherwise(text.otherwise(kraken)).alias("message"),
    )


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_messages_from(table(spark, sf_dir, "events"))


def stream_records_from(events: DataFrame) -> DataFrame:
    """Published records as the stream carries them: base64 JSON, faults by event_id % 20.

    Beside the messages' faults: 10 and 11 have ISO times, 12 is no base64, 13 no UTF-8, 14 has a price far below
    the least. ``now`` is the record's own time, so only faults 5 and 11 are late.
    """
    t = trades_from(events).withColumn("fault", F.col("trade_id") % 20)
    fault = F.col("fault")
    millis = F.unix_millis(F.col("ts").cast("timestamp")) - F.when(fault.isin(5, 11), 3_600_000).otherwise(0)
    iso = F.concat(F.date_format(F.timestamp_millis(millis), "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("Z"))
    stamp = F.when(fault.isin(10, 11), iso).otherwise(millis.cast("string"))
    exchange = F.when(fault == 7, "").otherwise(
        F.concat(F.lit('"exchange":"'), F.when(fault == 6, "other").otherwise(F.col("exchange")), F.lit('",'))
    )
    price = (
        F.when(fault == 0, "").when(fault == 1, '"price":null,').when(fault == 2, '"price":"n/a",')
        .when(fault == 3, '"price":-1.0,').when(fault == 14, '"price":0.0005,')
        .otherwise(F.concat(F.lit('"price":'), F.col("price").cast("string"), F.lit(",")))
    )
    volume = F.when(fault == 4, "-1.0").otherwise(F.col("volume").cast("string"))
    payload = F.concat(
        F.lit("{"), exchange, F.lit('"symbol":"'), F.col("symbol"), F.lit('","timestamp":"'),
        stamp, F.lit('",'), price, F.lit('"volume":'), volume,
        F.lit(',"bid":'), F.col("bid").cast("string"), F.lit(',"ask":'), F.col("ask").cast("string"),
        F.lit(',"trade_id":"'), F.col("trade_id").cast("string"), F.lit('"}'),
    )
    return t.select(
        F.col("trade_id").alias("record_id"),
        F.col("ts").cast("timestamp").alias("now"),
        F.when(fault == 12, "?? no base64 ??")
        .when(fault == 13, F.base64(F.unhex(F.lit("FFFE7B7D"))))
        .otherwise(F.base64(F.when(fault == 9, "invalid json").otherwise(payload).cast("binary")))
        .alias("data"),
    )


def stream_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_records_from(spread(table(spark, sf_dir, "events")))


def as_of(spark: SparkSession, sf_dir: str):
    """Latest event time: the moment "now" is taken to be, so relative filters give stable results."""
    return table(spark, sf_dir, "events").agg(F.max("ts")).first()[0]
