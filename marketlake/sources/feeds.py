"""Raw exchange messages to admitted trades. Works on batch and streaming frames alike."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.config import FEEDS, FeedFormat, QualityBounds
from marketlake.functions.once import evaluated
from marketlake.functions.parsing import canonical_symbol, event_time, field, json_map, number
from marketlake.functions.quality import has, source_score
from marketlake.operators.trades import admit_trades

STATUS_OK, STATUS_IGNORED, STATUS_BAD = "ok", "ignored", "malformed"


def decode_stream(df: DataFrame, data: str = "data", encoding: str = "base64") -> DataFrame:
    """Transport payload to text and to a record map (null when it is not a JSON object).

    ``encoding`` is "base64" or "plain" (text as it is). A payload that is no base64 or no UTF-8 gives null
    text: it is a failed record like any other and never ends the batch.
    """
    if encoding not in ("base64", "plain"):
        raise ValueError("encoding is base64 or plain")
    raw = F.col(data).cast("string")
    if encoding == "base64":
        raw = F.try_to_binary(raw, F.lit("base64")).cast("string")
    decoded = df.withColumn("payload", F.try_validate_utf8(raw))
    return evaluated(decoded.withColumn("record", json_map(F.col("payload"))), "record")


def message_status(record: Column, feed: FeedFormat) -> Column:
    """ok, ignored (another event type) or malformed (not JSON, a field missing, or a bad number)."""
    other_type = F.lit(False)
    if feed.type_field:
        other_type = ~F.coalesce(field(record, feed.type_field) == feed.type_value, F.lit(False))
    usable = (
        has(record, feed.symbol) & has(record, feed.time)
        & field(record, feed.symbol).isNotNull()
        & number(field(record, feed.price)).isNotNull()
        & number(field(record, feed.volume)).isNotNull()
    )
    return (
        F.when(record.isNull(), STATUS_BAD)
        .when(other_type, STATUS_IGNORED)
        .when(usable, STATUS_OK)
        .otherwise(STATUS_BAD)
    )


def parse_feed(messages: DataFrame, feed: FeedFormat, text: str = "message") -> DataFrame:
    """Add ``record`` and ``status`` for one exchange's messages."""
    parsed = evaluated(messages.withColumn("record", json_map(F.col(text))), "record")
    return parsed.withColumn("status", message_status(F.col("record"), feed))


def filter_event_type(messages: DataFrame, feed: FeedFormat, text: str = "message") -> DataFrame:
    """Messages of the feed's trade type only."""
    if feed.type_field is None:
        return messages
    value = field(json_map(F.col(text)), feed.type_field)
    return messages.filter(value == feed.type_value)


def filter_event_types(
    messages: DataFrame, feeds: dict[str, FeedFormat] = FEEDS, text: str = "message", feed: str = "feed"
) -> DataFrame:
    """``filter_event_type`` for feeds that lie in one table: each message by its own feed's rule, in one scan."""

    def kept(own: FeedFormat) -> Column:
        if own.type_field is None:
            return F.lit(True)
        return field(F.col("_record"), own.type_field) == own.type_value

    parsed = evaluated(messages.withColumn("_record", json_map(F.col(text))), "_record")
    return parsed.filter(by_feed(kept, feeds, feed)).drop("_record")


def normalize(messages: DataFrame, feed: FeedFormat, keep: tuple[str, ...] = ()) -> DataFrame:
    """Trades of one feed. The feed's field map is all that differs between exchanges."""
    record = F.col("record")
    trade_id = field(record, feed.trade_id) if feed.trade_id else F.lit(None).cast("string")
    return (
        parse_feed(messages, feed)
        .filter(F.col("status") == STATUS_OK)
        .select(
            *keep,
            F.lit(feed.exchange).alias("exchange"),
            canonical_symbol(field(record, feed.symbol)).alias("symbol"),
            field(record, feed.time).alias("timestamp"),
            number(field(record, feed.price)).alias("price"),
            number(field(record, feed.volume)).alias("volume"),
            F.lit(None).cast("double").alias("bid"),
            F.lit(None).cast("double").alias("ask"),
            trade_id.alias("trade_id"),
            source_score(record, feed).alias("quality_score"),
            event_time(field(record, feed.time)).alias("ts"),
        )
    )


def quarantine(messages: DataFrame, feed: FeedFormat) -> DataFrame:
    """Messages no trade could be read from; other event types are not faults."""
    return parse_feed(messages, feed).filter(F.col("status") == STATUS_BAD).drop("record", "status")


def union_feeds(
    messages: dict[str, DataFrame],
    bounds: QualityBounds = QualityBounds(),
    feeds: dict[str, FeedFormat] = FEEDS,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Feeds that are separate sources as one stream of admitted trades."""
    parts = [admit_trades(normalize(df, feeds[name], keep), bounds) for name, df in messages.items()]
    return reduce(DataFrame.unionByName, parts)


def by_feed(build: Callable[[FeedFormat], Column], feeds: dict[str, FeedFormat] = FEEDS, feed: str = "feed") -> Column:
    """What ``build`` makes of the format that the ``feed`` column names; null for unknown feeds."""
    chosen = F
    for name, form in feeds.items():
        chosen = chosen.when(F.col(feed) == name, build(form))
    return chosen


def parse_feeds(
    messages: DataFrame, feeds: dict[str, FeedFormat] = FEEDS, feed: str = "feed", text: str = "message"
) -> DataFrame:
    """``parse_feed`` for messages of several feeds in one table, told apart by a column: one pass over them."""
    parsed = evaluated(messages.withColumn("record", json_map(F.col(text))), "record")
    return parsed.withColumn("status", by_feed(lambda form: message_status(F.col("record"), form), feeds, feed))


def normalize_feeds(
    messages: DataFrame, feeds: dict[str, FeedFormat] = FEEDS, keep: tuple[str, ...] = (), feed: str = "feed"
) -> DataFrame:
    """``normalize`` for messages of several feeds in one table."""
    record = F.col("record")

    def of(name: str) -> Column:
        return by_feed(
            lambda form: field(record, getattr(form, name)) if getattr(form, name) else F.lit(None).cast("string"),
            feeds, feed,
        )

    nothing = F.lit(None).cast("double")
    return (
        parse_feeds(messages, feeds, feed)
        .filter(F.col("status") == STATUS_OK)
        .select(
            *keep,
            by_feed(lambda form: F.lit(form.exchange), feeds, feed).alias("exchange"),
            canonical_symbol(of("symbol")).alias("symbol"),
            of("time").alias("timestamp"),
            number(of("price")).alias("price"),
            number(of("volume")).alias("volume"),
            nothing.alias("bid"),
            nothing.alias("ask"),
            of("trade_id").alias("trade_id"),
            by_feed(lambda form: source_score(record, form), feeds, feed).alias("quality_score"),
            event_time(of("time")).alias("ts"),
        )
    )


def admit_feeds(
    messages: DataFrame,
    bounds: QualityBounds = QualityBounds(),
    feeds: dict[str, FeedFormat] = FEEDS,
    keep: tuple[str, ...] = (),
    feed: str = "feed",
) -> DataFrame:
    """``union_feeds`` for feeds that lie in one table: a single scan instead of one for each feed."""
    return admit_trades(normalize_feeds(messages, feeds, keep, feed), bounds)


def partition_by_symbol(trades: DataFrame, splits: int = 1, partitions: int | None = None) -> DataFrame:
    """Co-locate a symbol's trades; ``splits`` spreads each symbol over that many partitions."""
    salt = F.pmod(F.xxhash64("trade_id"), F.lit(splits))
    keys = ["symbol"] if splits == 1 else ["symbol", salt]
    return trades.repartition(partitions, *keys) if partitions else trades.repartition(*keys)


def ingest_stats(messages: DataFrame, sent: Column) -> DataFrame:
    """Sent and failed counts and the success rate (1.0 when nothing was tried)."""
    return messages.agg(
        F.count_if(sent).alias("total_records_sent"),
        F.count_if(~sent).alias("failed_records"),
        F.coalesce(F.try_divide(F.count_if(sent), F.count(F.lit(1))), F.lit(1.0)).alias("success_rate"),
    )
