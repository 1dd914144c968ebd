"""Running streams: sources, and the two-slot state table used by micro-batch operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
    glob: str | None = None,
) -> DataFrame:
    """Files of a folder as an unbounded stream; ``files_per_batch`` bounds a micro-batch."""
    options = {"maxFilesPerTrigger": files_per_batch, "pathGlobFilter": glob}
    reader = spark.readStream.format(fmt).schema(schema)
    return reader.options(**{k: v for k, v in options.items() if v is not None}).load(path)


def broker_stream(
    spark: SparkSession, servers: str, topic: str, records_per_batch: int | None = None
) -> DataFrame:
    """A message broker topic from its latest position, as (record_id, partition_key, data).

    The value is the payload as text (decode it with ``encoding="plain"``, or "base64" where producers encode),
    the key the symbol. ``records_per_batch`` bounds a micro-batch over the whole topic.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
    )
    if records_per_batch is not None:
        reader = reader.option("maxOffsetsPerTrigger", records_per_batch)
    return reader.load().selectExpr(
        "concat_ws('-', topic, partition, offset) AS record_id", "CAST(key AS STRING) AS partition_key",
        "CAST(value AS STRING) AS data",
    )


_starting = Lock()


@contextmanager
def state_partitions(spark: SparkSession, count: int | None) -> Iterator[None]:
    """Start a stream with this many state partitions (fixed for its lifetime by its first batch).

    A stream copies the session settings when it starts, so the session's own value is put back at once.
    One stream is started at a time, so that none takes another's value.
    """
    if count is None:
        yield
        return
    setting = "spark.sql.shuffle.partitions"
    with _starting:
        before = spark.conf.get(setting)
        spark.conf.set(setting, str(count))
        try:
            yield
        finally:
            spark.conf.set(setting, before)


def run_batches(
    stream: DataFrame,
    step: Callable[[DataFrame, int], None],
    checkpoint: str,
    cache: bool = True,
    state_count: int | None = None,
    **trigger,
) -> StreamingQuery:
    """Start ``step`` on every micro-batch; by default all data present now, then stop.

    ``cache`` keeps a batch while a step writes it to more than one place; without it every write would
    read the source and update the stream's state again.
    """

    def cached(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            step(batch, batch_id)
        finally:
            batch.unpersist()

    writer = (
        stream.writeStream.foreachBatch(cached if cache else step)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
    )
    with state_partitions(stream.sparkSession, state_count):
        return writer.start()


class SlotTable:
    """A small table carried from micro-batch to micro-batch in two alternating folders.

    Batch n reads what batch n-1 wrote and writes the other folder, so a repeated batch sees the same
    input again and nothing accumulates.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path, schema

    def _slot(self, batch_id: int) -> str:
        return f"{self.path}/slot{batch_id % 2}"

    def before(self, batch_id: int) -> DataFrame:
        if batch_id == 0:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self._slot(batch_id - 1))

    def save(self, rows: DataFrame, batch_id: int) -> None:
        rows.select(*self.schema.fieldNames()).write.mode("overwrite").parquet(self._slot(batch_id))
