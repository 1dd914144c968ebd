"""The manifest of a lake: which batches hold documents of which day, and which of them a job has seen.

Batches have folders of their own above the date levels, so a day's documents lie in many folders. The sink notes
(day, batch) for every batch, filed by day; a day is then read from the folders named there and no other is listed.
A job notes what it has read in the same form, and the difference is the work that is left.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

#: Folder beside the batches; readers of the lake skip names that begin with an underscore.
FOLDER = "_days"
DAY = ("year", "month", "day")
COLUMNS = (*DAY, "batch", "files", "bytes", "landed_at")
SCHEMA = "batch string, files long, bytes long, landed_at timestamp, year string, month string, day string"


def manifest_path(lake: str) -> str:
    return f"{lake}/{FOLDER}"


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def day_folder(day: date) -> str:
    return f"year={day.year}/month={day.month:02d}/day={day.day:02d}"


def _quoted(label: str) -> str:
    """A batch label that a path pattern takes as it is."""
    return re.sub(r"([\\*?\[\]{},])", r"\\\1", label)


def add_batch(spark: SparkSession, lake: str, batch: str) -> None:
    """Notes the days of a batch from the names of its files; no content is read.

    A batch that is noted again replaces its entries of the days it has now. An entry of a day that it has no
    longer stays and leads to no file.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{lake}/batch={_quoted(batch)}")
    days = [F.regexp_extract("path", f"/{level}=([^/]*)/", 1).alias(level) for level in DAY]
    (
        files.groupBy(*days)
        .agg(F.count("*").alias("files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("landed_at"))
        .withColumns({"batch": F.lit(batch), "entry": F.md5(F.lit(batch))})
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*DAY, "entry").parquet(manifest_path(lake))
    )


def _noted(spark: SparkSession, root: str, day: date | None) -> DataFrame:
    try:
        rows = spark.read.schema(SCHEMA).option("basePath", root).parquet(
            root if day is None else f"{root}/{day_folder(day)}"
        )
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], SCHEMA)
    return rows.select(*COLUMNS)


def day_batches(spark: SparkSession, lake: str, day: date | None = None) -> DataFrame:
    """(year, month, day, batch, files, bytes, landed_at) of a day, or of all days; empty where nothing is noted."""
    return _noted(spark, manifest_path(lake), day)


def day_pattern(spark: SparkSession, lake: str, day: date, levels: Sequence[str] = DAY) -> str | None:
    """A path pattern that names the day's folders in its batches; None where no batch has the day.

    The labels of one day's batches come to the driver, which lists their folders anyway.
    """
    labels = sorted(row.batch for row in day_batches(spark, lake, day).select("batch").distinct().collect())
    if not labels:
        return None
    quoted = ",".join(map(_quoted, labels))
    values = dict(part.split("=") for part in day_folder(day).split("/"))
    below = "/".join(f"{level}={values.get(level, '*')}" for level in levels)
    return f"{lake}/batch={{{quoted}}}/{below}"


def mark_seen(spark: SparkSession, done: str, noted: Sequence[Row]) -> None:
    """Replaces what a job has seen of the days in ``noted``, rows of ``day_batches`` from before it read them."""
    if noted:
        rows = spark.createDataFrame([tuple(row) for row in noted], _ordered_schema())
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*DAY).parquet(done)


def _ordered_schema() -> str:
    kinds = dict(part.split(" ") for part in SCHEMA.split(", "))
    return ", ".join(f"{name} {kinds[name]}" for name in COLUMNS)


def unseen_days(spark: SparkSession, lake: str, done: str) -> DataFrame:
    """(year, month, day, batches): days with batches that landed, or landed again, since ``done`` has seen the day."""
    key = [*DAY, "batch", "landed_at"]
    seen = _noted(spark, done, None).select(*key)
    return (
        day_batches(spark, lake).join(seen, key, "left_anti")
        .groupBy(*DAY).agg(F.count_distinct("batch").alias("batches"))
    )
