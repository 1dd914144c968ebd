"""Scoring rules as expressions over a record kept as ``map<string,string>``.

A map keeps "key absent" apart from "key present but null", which the rules treat differently.
Penalties are subtracted one by one in a fixed order, so scores equal the sequential definition to
the last bit (a single 0.2 fault still reaches a threshold of 0.8).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketlake.config import REQUIRED_FIELDS, FeedFormat, QualityBounds
from marketlake.functions.parsing import field, number, plain_decimal_text, whole_number

Fault = tuple[Column, float, Column]  # (holds?, penalty, message)


def has(record: Column, name: str) -> Column:
    return F.map_contains_key(record, name)


def _holds(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


@dataclass(frozen=True)
class RecordFields:
    """What the rules look at: which keys a record has, and its values as typed columns."""

    present: dict[str, Column]
    price: Column
    volume: Column
    millis: Column
    exchange: Column


def record_fields(record: Column) -> RecordFields:
    return RecordFields(
        present={name: has(record, name) for name in REQUIRED_FIELDS},
        price=number(field(record, "price")),
        volume=number(field(record, "volume")),
        millis=whole_number(field(record, "timestamp")),
        exchange=field(record, "exchange"),
    )


def unpacked_fields(parsed: str) -> tuple[Callable[[Column], Column], RecordFields]:
    """A struct column holding the fields of a record, and the fields read from that column."""

    def pack(record: Column) -> Column:
        f = record_fields(record)
        typed = {"price": f.price, "volume": f.volume, "millis": f.millis, "exchange": f.exchange}
        flags = {f"has_{name}": c for name, c in f.present.items()}
        return F.struct(*[c.alias(name) for name, c in {**typed, **flags}.items()])

    def value(name: str) -> Column:
        return F.col(f"{parsed}.{name}")

    present = {name: value(f"has_{name}") for name in REQUIRED_FIELDS}
    return pack, RecordFields(present, value("price"), value("volume"), value("millis"), value("exchange"))


def required_faults(f: RecordFields) -> list[Fault]:
    return [(~f.present[name], 0.2, F.lit(f"Missing required field: {name}")) for name in REQUIRED_FIELDS]


def price_faults(f: RecordFields, bounds: QualityBounds) -> list[Fault]:
    outside = f.present["price"] & ~f.price.between(bounds.min_price, bounds.max_price)
    unreadable = f.present["price"] & f.price.isNull()
    text = F.concat(
        F.lit("Price "), plain_decimal_text(f.price),
        F.lit(f" outside valid range [{bounds.min_price}, {bounds.max_price}]"),
    )
    return [(_holds(outside), 0.3, text), (unreadable, 0.3, F.lit("Invalid price format"))]


def volume_faults(f: RecordFields, bounds: QualityBounds) -> list[Fault]:
    below = f.present["volume"] & (f.volume < bounds.min_volume)
    unreadable = f.present["volume"] & f.volume.isNull()
    text = F.concat(F.lit("Volume "), plain_decimal_text(f.volume), F.lit(f" below minimum {bounds.min_volume}"))
    return [(_holds(below), 0.2, text), (unreadable, 0.2, F.lit("Invalid volume format"))]


def timestamp_faults(f: RecordFields, bounds: QualityBounds, now: Column) -> list[Fault]:
    # Bounds around now, not a difference: a huge timestamp must not overflow the subtraction.
    tolerance, at = bounds.tolerance_seconds * 1000, F.unix_millis(now.cast("timestamp"))
    stale = f.present["timestamp"] & ~f.millis.between(at - tolerance, at + tolerance)
    unreadable = f.present["timestamp"] & f.millis.isNull()
    text = F.concat(F.lit("Timestamp "), f.millis.cast("string"), F.lit(" too old"))
    return [(_holds(stale), 0.1, text), (unreadable, 0.1, F.lit("Invalid timestamp format"))]


def exchange_faults(f: RecordFields, bounds: QualityBounds) -> list[Fault]:
    unknown = f.present["exchange"] & ~F.lower(f.exchange).isin(*bounds.exchanges)
    return [(_holds(unknown), 0.2, F.concat(F.lit("Invalid exchange: "), f.exchange))]


def record_faults(f: RecordFields, bounds: QualityBounds, now: Column) -> list[Fault]:
    """All rules in scoring order."""
    return [
        *required_faults(f),
        *price_faults(f, bounds),
        *volume_faults(f, bounds),
        *timestamp_faults(f, bounds, now),
        *exchange_faults(f, bounds),
    ]


def penalised_score(faults: list[Fault]) -> Column:
    """1.0 minus the penalties, in order; may be negative."""
    return reduce(
        lambda score, fault: score - F.when(fault[0], F.lit(fault[1])).otherwise(F.lit(0.0)),
        faults,
        F.lit(1.0),
    )


def fault_messages(faults: list[Fault]) -> Column:
    return F.array_compact(F.array(*[F.when(holds, message) for holds, _, message in faults]))


def floor_zero(score: Column) -> Column:
    return F.greatest(F.lit(0.0), score)


def source_score(record: Column, feed: FeedFormat) -> Column:
    """Score of a raw message against its feed's required fields."""
    price = number(field(record, feed.price))
    missing = [(~has(record, f), 0.2, F.lit(f)) for f in feed.required]
    bad_price = (~_holds(has(record, feed.price) & (price > 0)), 0.3, F.lit("price"))
    return floor_zero(penalised_score([*missing, bad_price]))


def error_type(message: Column) -> Column:
    """Chart category of a validation message."""
    return (
        F.when(message.startswith("Missing required field"), "missing_fields")
        .when(message.startswith("Price ") | (message == "Invalid price format"), "invalid_price")
        .when(message.startswith("Volume ") | (message == "Invalid volume format"), "invalid_volume")
        .when(message.startswith("Timestamp ") | (message == "Invalid timestamp format"), "invalid_timestamp")
        .otherwise("invalid_exchange")
    )
