"""Keeping expensive expressions evaluated once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def evaluated(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` with ``columns`` fixed: later filters use their values, not copies of their expressions.

    Pushing a filter below a projection copies the projected expression into it, once per mention. For a
    parsed JSON document that means parsing every row dozens of times. A one-element inline between the
    two keeps the projection whole; rows stay in generated code and nothing is shuffled.
    """
    others = [c for c in df.columns if c not in columns]
    return df.select(*others, F.inline(F.array(F.struct(*columns)))).select(*df.columns)
