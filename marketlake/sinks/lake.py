"""Writing landed documents and candle tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake import schemas
from marketlake.config import INTERVAL_TABLES
from marketlake.functions.paths import partition_columns, partition_key
from marketlake.manifest import add_batch

DOCUMENT_RECORDS = 100


def documents(
    records: DataFrame, at: Column, limit: int = DOCUMENT_RECORDS
) -> DataFrame:
    """Envelope documents of at most ``limit`` records, with their directory levels as columns.

    A partition key (exchange, symbol, hour) can hold any number of records. What one input task has of a key
    is a group: it is numbered and cut every ``limit`` records, and only those few are collected into one row.
    So no task gets more of a key than an input task had, and numbering and collecting share one shuffle.
    """
    levels = partition_columns(F.col("exchange"), F.col("symbol"), F.col("landed"))
    key = partition_key(F.col("exchange"), F.col("symbol"), F.col("landed"))
    names = [f"_{name}" for name in levels]
    keyed = records.withColumns({f"_{name}": c for name, c in levels.items()}).withColumns(
        {"_key": key, "_split": F.spark_partition_id()}
    )
    group = ["_key", "_split"]
    numbered = keyed.withColumn(
        "_doc",
        F.floor((F.row_number().over(Window.partitionBy(*group).orderBy("landed", "trade_id")) - 1) / limit),
    )
    record = F.struct("landed", "trade_id", F.struct(*_record_columns(records)).alias("record"))
    return (
        numbered.groupBy(*group, "_doc", *names)
        .agg(F.array_sort(F.collect_list(record)).alias("_ordered"))
        .select(
            F.col("_ordered.record").alias("records"),
            F.size("_ordered").alias("count"),
            F.unix_seconds(at.cast("timestamp")).alias("timestamp"),
            F.col("_key").alias("partition"),
            *[F.col(f"_{name}").alias(name) for name in levels],
        )
    )


def _record_columns(records: DataFrame) -> list[Column]:
    """The record fields of the declared schema, absent ones as null."""
    return [
        (F.col(f.name) if f.name in records.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schemas.ENRICHED.fields
    ]


def write_raw_json(
    records: DataFrame,
    path: str,
    at: Column | None = None,
    batch: str | None = None,
    limit: int = DOCUMENT_RECORDS,
    levels: Sequence[str] = schemas.DATE_LEVELS,
) -> None:
    """Land records as JSON documents under the given directory levels and a batch level.

    A batch has a folder of its own above those levels, so a repeated write of a batch replaces its files,
    all of them and no others, even where its records are filed under another day this time. A write without
    a label is a batch of its own. Its days are noted in the lake's manifest once its files are there.
    """
    label = batch or uuid.uuid4().hex
    docs = documents(records, F.current_timestamp() if at is None else at, limit)
    fields = schemas.BATCH_DOCUMENT.fieldNames()
    # Rebalancing keeps a directory's documents together yet splits an oversized one.
    (
        docs.select(*fields, *levels)
        .hint("rebalance", *levels)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*levels)
        .json(f"{path}/batch={label}")
    )
    add_batch(records.sparkSession, path, label)


def layout(candles: DataFrame, *directories: str) -> DataFrame:
    """File layout of a candle table: one day's rows together, sorted by time then symbol.

    The sort makes Parquet's row-group ranges selective for time filters. Rebalance lets AQE size the
    files and split a day that is too large, whatever the symbol mix. Sorting by the directory levels
    first is the order the writer needs, so it adds no sort of its own.
    """
    levels = [*directories, "year", "month", "day"]
    return candles.hint("rebalance", *levels).sortWithinPartitions(*levels, "interval_start", "symbol")


def project_candle_table(candles: DataFrame, minutes: int) -> DataFrame:
    """The interval's warehouse columns in their storage types."""
    columns = []
    for name in schemas.CANDLE_TABLE_COLUMNS[minutes]:
        columns.append(_as_stored(name, schemas.candle_storage_type(name)))
    return candles.select(*columns)


def _as_stored(name: str, kind: T.DataType | None) -> Column:
    """A column in its storage type. A decimal is rounded from nine digits, which the order of a sum can't change."""
    if kind is None:
        return F.col(name)
    value = F.round(name, 9) if isinstance(kind, T.DecimalType) else F.col(name)
    return value.cast(kind).alias(name)


def with_surrogate_id(df: DataFrame, key: tuple[str, ...] = ("symbol", "exchange", "interval_start")) -> DataFrame:
    """Row id and creation time. The id is a 128-bit hash of the natural key: the same row gets the same id again.

    Ids that are counted up would need all rows in order; 64 bits would collide at billions of rows.
    """
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in key]
    return df.withColumns({"id": F.md5(F.concat_ws("\x1f", *parts)), "created_at": F.current_timestamp()})


def write_candles_parquet(candles: DataFrame, root: str) -> None:
    """Replace the days present in ``candles``, one directory tree per interval, in a single job."""
    names = F.create_map(*[F.lit(v) for pair in INTERVAL_TABLES.items() for v in pair])
    (
        layout(candles.withColumn("candle_table", F.try_element_at(names, F.col("interval_minutes"))), "candle_table")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy("candle_table", "year", "month", "day")
        .parquet(root)
    )


def candle_path(root: str, minutes: int) -> str:
    return f"{root}/candle_table={INTERVAL_TABLES[minutes]}"


def _replace_days(rows: DataFrame, table: str, levels: Sequence[str], buckets: int | None = None) -> None:
    """Write rows to a catalog table partitioned by day; days that it has already are replaced, others stay."""
    spark = rows.sparkSession
    if buckets:
        rows = rows.repartition(buckets, "symbol")  # a bucket's rows in one task, so that a day has a file a bucket
    if not spark.catalog.tableExists(table):
        writer = rows.write.option("compression", "zstd").format("parquet").partitionBy(*levels)
        if buckets:
            writer = writer.bucketBy(buckets, "symbol").sortBy("interval_start", "symbol")
        writer.saveAsTable(table)
        return
    # Dynamic overwrite is a session setting of configure(); inserting goes by position.
    rows.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)


def write_warehouse(candles: DataFrame, table: str, minutes: int = 5, buckets: int | None = None) -> None:
    """An interval's candles in a catalog table. A day that is written again is replaced, so reruns leave no doubles.

    With ``buckets`` the table is distributed by symbol and sorted by time inside a bucket: joins and groups by
    symbol over it need no shuffle. A later write must give the same number. A series has at most one candle for
    each step of its grid, so a bucket's size follows from the number of symbols, not of trades.
    """
    rows = with_surrogate_id(project_candle_table(candles, minutes))
    _replace_days(rows, table, ("year", "month", "day"), buckets)


def project_metric_table(rows: DataFrame, table: str) -> DataFrame:
    """The stored columns of ``data_quality_metrics``, ``daily_stats`` or ``exchange_performance`` in their types."""
    kinds = {name: schemas.storage_type(name) for name in schemas.METRIC_TABLE_COLUMNS[table]}
    return rows.select(*[_as_stored(name, kind) for name, kind in kinds.items()])


def write_metric_table(rows: DataFrame, table: str, catalog_table: str | None = None) -> None:
    """One of the three metric tables with id and creation time; days written again are replaced.

    Records without a day (unreadable ones) have no place in a table by day and are left out here.
    """
    key = schemas.METRIC_TABLE_KEYS[table]
    stored = with_surrogate_id(project_metric_table(rows.filter("date is not null"), table), key)
    ordered = stored.hint("rebalance", "date").sortWithinPartitions("date", key[0])
    _replace_days(ordered, catalog_table or table, ("date",))


def write_jdbc(candles: DataFrame, url: str, table: str, minutes: int = 5, mode: str = "append", **options) -> None:
    """Append an interval's candles to an external warehouse; executors write in parallel.

    It appends whatever is there, so a rerun doubles; untested, since it needs a database server.
    """
    with_surrogate_id(project_candle_table(candles, minutes)).write.format("jdbc").options(
        url=url, dbtable=table, **options
    ).mode(mode).save()
