"""Text to typed values. Every function is total: bad input gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The JVM also reads "5d" and "0x1p3" as numbers; feeds do not mean that.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|[nN][aA][nN]|[iI][nN][fF](inity)?)\s*$"
_WHOLE = r"^\s*[+-]?\d+\s*$"
# Milliseconds of 0001-01-01 and 9999-12-31, the range of the timestamp type.
_MIN_MILLIS, _MAX_MILLIS = -62_135_596_800_000, 253_402_300_799_999


def number(text: Column) -> Column:
    """Double, or null when the text is not a number."""
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def whole_number(text: Column) -> Column:
    """64-bit integer, or null when the text is not one."""
    return F.when(text.rlike(_WHOLE), F.trim(text).try_cast("bigint"))


def millis_to_time(millis: Column) -> Column:
    return F.when(millis.between(_MIN_MILLIS, _MAX_MILLIS), F.timestamp_millis(millis))


def event_time(text: Column) -> Column:
    """Epoch-millisecond text or ISO-8601 text to a timestamp, milliseconds kept."""
    return F.coalesce(millis_to_time(whole_number(text)), F.try_to_timestamp(text))


def canonical_symbol(text: Column) -> Column:
    """Lower case without pair separators, so all feeds agree on one spelling."""
    return F.lower(F.translate(text, "-/", ""))


def plain_decimal_text(value: Column) -> Column:
    """A double as its shortest text, with an exponent below 1e-4 and from 1e16 on ("5e-05", "1e+16").

    The message texts have numbers in this form. The JVM's own text has exponents from 1e-3 and 1e7 on.
    """
    text = value.cast("string")
    mantissa = F.regexp_replace(F.split_part(text, F.lit("E"), F.lit(1)), r"\.0$", "")
    power = F.split_part(text, F.lit("E"), F.lit(2)).try_cast("int")
    digits = F.abs(power).cast("string")
    digits = F.when(F.length(digits) < 2, F.concat(F.lit("0"), digits)).otherwise(digits)
    short = F.concat(mantissa, F.when(power < 0, "e-").otherwise("e+"), digits)
    whole = F.rtrim(value.try_cast("decimal(38,21)").cast("string"), F.lit("0"))
    whole = F.when(whole.endswith("."), F.concat(whole, F.lit("0"))).otherwise(whole)
    size = F.abs(value)
    return F.when(~text.contains("E"), text).when((size >= 1e-4) & (size < 1e16), whole).otherwise(short)


def field(record: Column, name: str) -> Column:
    """Value of a key of a string map; null when absent."""
    return F.try_element_at(record, F.lit(name))


def json_map(text: Column) -> Column:
    """JSON object text as a string map; null when the text is not a JSON object."""
    return F.from_json(text, "map<string,string>")
