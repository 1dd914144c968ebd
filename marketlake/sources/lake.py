"""Reading what the sinks wrote: landed JSON documents and candle tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake import schemas
from marketlake.functions.parsing import event_time
from marketlake.manifest import day_pattern, exists, manifest_path


def read_documents(spark: SparkSession, path: str, levels: Sequence[str] = schemas.DATE_LEVELS) -> DataFrame:
    """Landed batch documents with their directory levels as columns."""
    # Levels are read as text: symbols like "1e5" or months like "01" stay what they are.
    directories = [T.StructField(c, T.StringType()) for c in levels]
    return spark.read.schema(T.StructType(schemas.BATCH_DOCUMENT.fields + directories)).json(path)


def explode_records(documents: DataFrame) -> DataFrame:
    """One row per record, with the envelope's time and partition beside it."""
    return documents.select(
        F.col("timestamp").alias("batch_timestamp"),
        F.col("partition").alias("data_partition"),
        F.inline("records"),
    ).withColumn("ts", event_time(F.col("timestamp")))


def yesterday(now: datetime | None = None) -> date:
    return (now or datetime.now(timezone.utc)).date() - timedelta(days=1)


def parse_date_partition(text: str | None) -> date:
    """``YYYY/MM/DD``; yesterday (UTC) when not given."""
    return datetime.strptime(text, "%Y/%m/%d").date() if text else yesterday()


def prune_date(documents: DataFrame, date_partition: str | None = None) -> DataFrame:
    """One day of documents. The filter is on directory levels: other days' folders are listed, their files not read."""
    day = parse_date_partition(date_partition)
    return documents.filter(
        (F.col("year") == f"{day.year}") & (F.col("month") == f"{day.month:02d}") & (F.col("day") == f"{day.day:02d}")
    )


def read_day(
    spark: SparkSession, path: str, date_partition: str | None = None, levels: Sequence[str] = schemas.DATE_LEVELS
) -> DataFrame:
    """One day of documents from the folders that the lake's manifest names; no other day's are listed.

    A lake without a manifest is listed whole and pruned.
    """
    if not exists(spark, manifest_path(path)):
        return prune_date(read_documents(spark, path, levels), date_partition)
    directories = [T.StructField(c, T.StringType()) for c in levels]
    schema = T.StructType(schemas.BATCH_DOCUMENT.fields + directories)
    pattern = day_pattern(spark, path, parse_date_partition(date_partition), levels)
    if pattern is not None:
        try:
            return spark.read.schema(schema).option("basePath", path).json(pattern)
        except AnalysisException as missing:  # its batches have landed again, under other days only
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
    return spark.createDataFrame([], schema)


def read_batches(
    spark: SparkSession, path: str, date_partition: str | None = None, levels: Sequence[str] = schemas.DATE_LEVELS
) -> DataFrame:
    """Records of a day (or of the whole lake with ``date_partition="*"``)."""
    if date_partition == "*":
        return explode_records(read_documents(spark, path, levels))
    return explode_records(read_day(spark, path, date_partition, levels))


def infer_raw_schema(spark: SparkSession, path: str, sample: float = 1.0) -> DataFrame:
    """Columns and types found in the landed documents and their directories, from a share of the documents."""
    found = spark.read.option("samplingRatio", sample).json(path).schema
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(found.fields)]
    return spark.createDataFrame(rows, "position int, column_name string, data_type string, nullable boolean")


def scan_candles(spark: SparkSession, path: str, columns: tuple[str, ...] = ("*",)) -> DataFrame:
    """Rows of a stored candle table; only the named columns are read."""
    return spark.read.parquet(path).select(*columns)
