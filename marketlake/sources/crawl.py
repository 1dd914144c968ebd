"""An incremental crawl of a lake: which columns and types its documents hold, day by day.

The schema of a day is an aggregate of its documents, so days are crawled apart and their tables put together. Only
days with batches that the last crawl hasn't seen are read. What changes from one day to the next is the drift.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlake.manifest import DAY, day_batches, day_pattern, mark_seen, unseen_days

COLUMNS = "columns"
SEEN = "_seen"
CRAWLED = "column_name string, data_type string, n_values long, year string, month string, day string"


def _kind(value: Column) -> Column:
    """The type of a JSON value. Numbers with a fraction are doubles, whatever their digits."""
    name = F.schema_of_variant(value)
    return (
        F.when(name.startswith("DECIMAL") | name.startswith("FLOAT"), "double")
        .when(name.startswith("ARRAY"), "array")
        .when(name.startswith("OBJECT"), "object")
        .otherwise(F.lower(name))
    )


def _members(members: Column, prefix: str) -> Column:
    return F.transform(
        F.map_entries(members),
        lambda e: F.struct(F.concat(F.lit(prefix), e["key"]).alias("column_name"), _kind(e["value"]).alias("data_type")),
    )


def _array_members(name: str) -> Column:
    rows = F.expr(f"try_variant_get(v, '$.{name}', 'array<map<string,variant>>')")
    inner = F.flatten(F.transform(rows, lambda row: _members(row, f"{name}.")))
    return F.coalesce(inner, F.array().cast("array<struct<column_name:string,data_type:string>>"))


def column_types(lines: DataFrame, nested: tuple[str, ...] = ("records",), keys: tuple[str, ...] = DAY) -> DataFrame:
    """How many values of each type every column has, for each ``keys``, from JSON lines in ``value``.

    Fields of the objects in a ``nested`` array are columns ``array.field``. A column of several types has several
    rows, and counts of two inputs add up. Lines that are no JSON object have the column ``_unreadable``. JSON nulls
    are values of type ``void``.
    """
    parsed = lines.select(*keys, F.try_parse_json("value").alias("v"))
    top = F.expr("try_variant_get(v, '$', 'map<string,variant>')")
    unreadable = F.array(F.struct(F.lit("_unreadable").alias("column_name"), F.lit("string").alias("data_type")))
    found = [F.when(top.isNull(), unreadable).otherwise(_members(top, ""))]
    found += map(_array_members, nested)
    return (
        parsed.select(*keys, F.inline(F.concat(*found)))
        .groupBy("column_name", "data_type", *keys).agg(F.count("*").alias("n_values"))
        .select("column_name", "data_type", "n_values", *keys)
    )


def crawl(spark: SparkSession, lake: str, out: str, levels: tuple[str, ...] = DAY) -> list[date]:
    """Brings the column table in ``out`` up to date with the lake; the days that were read are returned.

    A day with a new batch is read anew and replaces its rows. The driver holds the days left to crawl.
    """
    left = sorted(date(*map(int, row)) for row in unseen_days(spark, lake, f"{out}/{SEEN}").select(*DAY).collect())
    if not left:
        return left
    # Noted before reading: what lands in between is left for the next crawl.
    noted = [row for day in left for row in day_batches(spark, lake, day).collect()]
    patterns = [day_pattern(spark, lake, day, levels) for day in left]
    lines = spark.read.option("basePath", lake).text([p for p in patterns if p])
    padded = {"year": F.col("year").cast("string"), **{c: F.lpad(F.col(c).cast("string"), 2, "0") for c in DAY[1:]}}
    (
        column_types(lines.withColumns(padded)).hint("rebalance", *DAY)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*DAY).parquet(f"{out}/{COLUMNS}")
    )
    mark_seen(spark, f"{out}/{SEEN}", noted)
    return left


def crawled_columns(spark: SparkSession, out: str) -> DataFrame:
    """(column_name, data_type, n_values, year, month, day) of all days crawled so far."""
    return spark.read.schema(CRAWLED).parquet(f"{out}/{COLUMNS}")


def _day(df: DataFrame) -> Column:
    return F.to_date(F.concat_ws("-", *[df[c] for c in DAY]))


def _one_type(types: Column) -> Column:
    """The type that holds values of all the types: itself, a double for numbers, else text."""
    numbers = F.forall(types, lambda t: t.isin("bigint", "double"))
    return F.when(F.size(types) == 1, types[0]).when(F.size(types) == 0, "void").when(numbers, "double").otherwise("string")


def lake_schema(crawled: DataFrame) -> DataFrame:
    """(column_name, data_type, n_values, first_day, last_day) over all crawled days; nulls fit any type."""
    return crawled.groupBy("column_name").agg(
        _one_type(F.array_sort(F.collect_set(F.when(F.col("data_type") != "void", F.col("data_type"))))).alias("data_type"),
        F.sum("n_values").alias("n_values"),
        F.min(_day(crawled)).alias("first_day"),
        F.max(_day(crawled)).alias("last_day"),
    )


def schema_drift(crawled: DataFrame) -> DataFrame:
    """(date, column_name, change, data_type, type_before): what differs from the crawled day before.

    ``added`` and ``dropped`` columns and those whose type ``changed``. A column has one row a day here, and the
    days themselves are numbered in one short list.
    """
    daily = crawled.groupBy(_day(crawled).alias("date"), "column_name").agg(
        _one_type(F.array_sort(F.collect_set(F.when(F.col("data_type") != "void", F.col("data_type"))))).alias("data_type")
    )
    days = crawled.select(_day(crawled).alias("date")).distinct()
    ordered = Window.orderBy("date")
    days = days.select("date", F.lag("date").over(ordered).alias("before"), F.lead("date").over(ordered).alias("after"))
    series = Window.partitionBy("column_name").orderBy("date")
    seen = daily.join(days, "date").withColumns({
        "last_seen": F.lag("date").over(series), "next_seen": F.lead("date").over(series),
        "last_type": F.lag("data_type").over(series),
    })

    def change(when: Column, at: Column, name: str, new: Column, old: Column) -> Column:
        return F.when(when, F.struct(at.alias("date"), F.lit(name).alias("change"), new.alias("data_type"), old.alias("type_before")))

    kind, nothing = F.col("data_type"), F.lit(None).cast("string")
    new_here = F.col("before").isNotNull() & ~F.col("last_seen").eqNullSafe(F.col("before"))
    gone_after = F.col("after").isNotNull() & ~F.col("next_seen").eqNullSafe(F.col("after"))
    same_run = F.col("last_seen") == F.col("before")
    changes = F.array_compact(F.array(
        change(new_here, F.col("date"), "added", kind, nothing),
        change(same_run & (kind != F.col("last_type")), F.col("date"), "changed", kind, F.col("last_type")),
        change(gone_after, F.col("after"), "dropped", nothing, kind),
    ))
    return seen.select("column_name", F.inline(changes)).select("date", "column_name", "change", "data_type", "type_before")
