"""Text expressions that must follow ASCII rules exactly, whatever else a text holds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as the operators' contracts define it: 0x20 and 0x09 to 0x0D.
SPACES = " \t\n\x0b\f\r"
#: A word is a longest run of anything else.
WORD = "[^\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else.

    ``lower`` changes other letters too, ``translate`` is slow. ``lower`` is right where a text is ASCII or where
    its other characters are lower-case already.
    """
    others = F.regexp_replace(text, "[\\x00-\\x7F]+", "")
    return (
        F.when(F.octet_length(text) == F.length(text), F.lower(text))
        .when(F.lower(others) == others, F.lower(text))
        .otherwise(F.translate(text, UPPER, LOWER))
    )


def stripped(text: Column) -> Column:
    return F.trim(text, F.lit(SPACES))
