"""The symbol lookup table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.config import SEED_SYMBOLS


def seed_rows(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        SEED_SYMBOLS, "symbol string, exchange string, base_currency string, quote_currency string"
    ).withColumn("is_active", F.lit(True))


def insert_if_absent(target: DataFrame, rows: DataFrame, keys: tuple[str, ...] = ("symbol", "exchange")) -> DataFrame:
    """``target`` plus the rows whose key it does not hold yet; existing rows win."""
    return target.unionByName(rows.join(target, list(keys), "left_anti"))


def seed_symbols(target: DataFrame) -> DataFrame:
    return insert_if_absent(target, seed_rows(target.sparkSession))
