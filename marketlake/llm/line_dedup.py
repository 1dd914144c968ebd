"""Line deduplication with levelled sorted runs of line hashes.

Documents are taken in batches of rising doc_id. A run holds the hashes first seen in one batch, with the
document that has them, as a table bucketed and sorted by hash. A batch's own first lines are merge-anti-joined
with every run (bucket to bucket, the runs are not shuffled) and what is left becomes a run of level 0. A level
that is full is merged into one run of the next level, so a batch meets few runs however many came before.

A line is dropped where its document is not the one that its hash was first seen in. That is asked by
(hash, document), so a line that a third of all documents share is spread over all tasks.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions.once import evaluated
from marketlake.llm.common import shuffle_partitions, stored, whole_row
from marketlake.llm.textkeys import ascii_lower, stripped
from marketlake.storage import work_path

#: Shorter keys never count as repeated.
MIN_KEY = 10
#: Place in the order of documents that have no doc_id.
LAST = (1 << 63) - 1
HASH = ["h1", "h2"]


class LineRuns:
    """The hashes seen so far: levels of runs, each run disjoint from all others."""

    def __init__(self, spark: SparkSession, fanout: int = 2):
        self.spark, self.fanout = spark, fanout
        self.buckets = shuffle_partitions(spark)
        self.levels: list[list[str]] = []

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (
            rows.write.format("parquet").bucketBy(self.buckets, *HASH).sortBy(*HASH)
            .option("path", work_path(self.spark, "line-run")).saveAsTable(name)
        )
        return name

    def _place(self, run: str, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        if len(self.levels[level]) == self.fanout:
            full, self.levels[level] = self.levels[level], []
            merged = reduce(DataFrame.unionByName, map(self.spark.table, full))
            self._place(self._write(merged.repartition(self.buckets, *HASH)), level + 1)
            for name in full:
                self.spark.sql(f"drop table {name}")
        self.levels[level].append(run)

    def runs(self) -> list[str]:
        return [run for level in self.levels for run in level]

    def add(self, lines: DataFrame) -> None:
        """Adds a batch (h1, h2, place) of documents that come after all documents added before."""
        new = lines.groupBy(*HASH).agg(F.min("place").alias("place"))
        for run in reversed(self.runs()):
            new = new.join(self.spark.table(run).select(*HASH).hint("merge"), HASH, "left_anti")
        self._place(self._write(new), 0)

    def first_seen(self) -> DataFrame:
        """(h1, h2, place): each hash with the document that holds it first."""
        return reduce(DataFrame.unionByName, map(self.spark.table, self.runs()))

    def drop(self) -> None:
        for run in self.runs():
            self.spark.sql(f"drop table if exists {run}")
        self.levels = []


def _row_key() -> Column:
    return F.xxhash64(F.lit("row"), F.col("text"))


def long_lines(docs: DataFrame, min_key: int = MIN_KEY) -> DataFrame:
    """(place, row_key, pos, h1, h2) of every line whose key has at least ``min_key`` code points."""
    split = docs.select(
        F.coalesce("doc_id", F.lit(LAST)).alias("place"),
        _row_key().alias("row_key"),
        F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("pos", "line"),
    )
    keyed = evaluated(split.select("place", "row_key", "pos", stripped(F.col("line")).alias("key")), "key")
    lower = evaluated(
        keyed.where(F.length("key") >= min_key).withColumn("key", ascii_lower(F.col("key"))), "key"
    )
    return lower.select(
        "place", "row_key", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), F.col("key")).alias("h2")
    )


def _bounds(lines: DataFrame, batches: int) -> list[int]:
    """Last place of every batch but the last; about the same number of lines lies between two of them."""
    shares = [i / batches for i in range(1, batches)]
    found = lines.agg(F.percentile_approx("place", shares, 10_000).alias("q")).first()["q"] if shares else []
    return sorted(set(found or []))


def dedup_lines(
    docs: DataFrame, carry: bool = False, batches: int = 4, fanout: int = 2, min_key: int = MIN_KEY
) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped, kept_text) for every row of ``docs``; ``carry`` adds the row as ``row``.

    A line's key is the line without ASCII white space at both ends, A-Z lower-cased. Of the lines with one key
    of at least ``min_key`` code points only those in the smallest doc_id stay; other lines always stay. Rows
    with the same doc_id are one document, whose lines all stay; null ids are one document that comes last. A
    null or empty text is one empty line and stays as it is. A very long text is split whole; its lines are spread
    by their hashes. Repeated rows get the same result each. Other columns are ignored, whatever their names. An empty
    table gives an empty one. The runs' tables leave the catalog whether or not all went well.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", *([whole_row(docs)] if carry else []))
    lines = stored(long_lines(docs.select("doc_id", "text"), min_key), "lines")
    bounds = _bounds(lines, batches)
    runs = LineRuns(spark, fanout)
    try:
        for low, high in zip([None, *bounds], [*bounds, None]):
            batch = lines if low is None else lines.where(F.col("place") > low)
            runs.add(batch if high is None else batch.where(F.col("place") <= high))
        dropped = (
            lines.join(runs.first_seen(), [*HASH, "place"], "left_anti")
            .groupBy("place", "row_key").agg(F.collect_set("pos").alias("gone"))
        )
        dropped = stored(dropped, "dropped-lines")
    finally:
        runs.drop()

    marked = docs.withColumns({"place": F.coalesce("doc_id", F.lit(LAST)), "row_key": _row_key()}).join(
        dropped, ["place", "row_key"], "left"
    )
    marked = evaluated(
        marked.withColumn("lines", F.split(F.coalesce("text", F.lit("")), "\n", -1)), "lines"
    )
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.array_join(F.transform(left, lambda i: F.get(F.col("lines"), i)), "\n")
    return marked.select(
        "doc_id", "text",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("kept_text"),
        *(["row"] if carry else []),
    )


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped",
        F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"),
    )


SQL = r"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as pos
  from documents),
keyed as (
  select *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from lines),
marked as (
  select *, length(key) >= 10 and doc_id > min(doc_id) over (partition by key) as gone from keyed)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from marked group by doc_id
"""
