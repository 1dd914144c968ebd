"""What several operators share: stored intermediate tables, joins that stand a hot key, distributed ranks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlake.storage import work_path

#: Keys with over this share of all rows are joined by broadcast; so there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 1 / 1000


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and safe when executors are lost."""
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def join_unique(left: DataFrame, right: DataFrame, key: Sequence[str], count: str, total: int) -> DataFrame:
    """Inner join with a side that is unique in ``key`` and knows how many rows of ``left`` each key has.

    The keys with more than ``HOT_SHARE`` of the ``total`` rows are at most ``1 / HOT_SHARE``, so that they
    can be broadcast; their rows stay where they are. All others are joined by a shuffle. ``key`` has no nulls.
    """
    bound = total * HOT_SHARE
    hot = F.broadcast(right.where(F.col(count) > bound))
    cold = right.where(F.col(count) <= bound)
    rest = left.join(F.broadcast(hot.select(*key)), list(key), "left_anti")
    return left.join(hot, list(key)).unionByName(rest.join(cold, list(key)))


def ranked(df: DataFrame, group: Sequence[str], bucket: str, order: Sequence[Column], name: str) -> DataFrame:
    """Adds the position from 0 of each row in its group, by ``bucket`` and then by ``order``.

    Only a bucket of a group meets in one task: positions inside it are added to the running count of the
    buckets before it. ``group`` and ``bucket`` have no nulls.
    """
    keys = [*group, bucket]
    counts = df.groupBy(*keys).agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    return (
        df.withColumn("__inside", inside)
        .join(starts, keys)
        .withColumn(name, F.col("__start") + F.col("__inside"))
        .drop("__inside", "__start")
    )


def running(
    df: DataFrame, group: Sequence[str], bucket: str, order: Sequence[Column], values: Mapping[str, Column]
) -> DataFrame:
    """Adds running sums of ``values`` in each group, the row's own included, by ``bucket`` and then by ``order``.

    Only a bucket of a group meets in one task, and one row for each bucket. ``df`` is read twice, so it should be
    stored. ``group`` and ``bucket`` have no nulls.
    """
    keys = [*group, bucket]
    totals = df.groupBy(*keys).agg(*[F.sum(value).alias(f"__{name}") for name, value in values.items()])
    earlier = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*keys, *[F.coalesce(F.sum(f"__{n}").over(earlier), F.lit(0)).alias(f"__{n}") for n in values])
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        df.withColumns({name: F.sum(value).over(inside) for name, value in values.items()})
        .join(starts, keys)
        .withColumns({name: F.col(name) + F.col(f"__{name}") for name in values})
        .drop(*[f"__{name}" for name in values])
    )


def whole_row(df: DataFrame) -> Column:
    """All columns as one, ``row``, so that none of their names can clash with an operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


def field(name: str) -> Column:
    """A column of the row that ``whole_row`` holds."""
    return F.col("row").getField(name).alias(name)
