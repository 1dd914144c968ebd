"""Exact deduplication by a tree-merge of sorted digest runs.

Every row belongs to one of ``fan ** rounds`` runs, by its doc_id. In each round ``fan`` runs exchange slices and
each takes over one of them: one digit of the run number is replaced by a digit of the digest, and equal digests
from the ``fan`` sorted runs are merged into one entry. After the last round a digest lies in one run only, and no
task ever held more than its share of the digests. An entry carries the identifier that stays and the number of
rows it stands for; entries merge only if text length and a second, independent hash agree with the digest.

The way back down the tree is two joins: final entries to the entries of the first runs (at most one a run and
digest), and those to the rows of the same run. Copies of one text are spread over all runs throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlake.llm.common import shuffle_partitions, stored

ENTRY = ["digest", "n_bytes", "check"]


def _rounds(runs: int, fan: int) -> int:
    rounds = 1
    while fan**rounds < runs:
        rounds += 1
    return rounds


def _exchanged(digit: int, fan: int) -> Column:
    """The run number with its ``digit`` taken from the digest's check hash."""
    place = fan**digit
    own = F.floor(F.col("run") / place) % fan
    other = F.pmod(F.shiftright("check", 8 * (digit % 8)), F.lit(fan))
    return (F.col("run") - own * place + other * place).cast("long")


def exact_groups(docs: DataFrame, keep: str = "largest", fan: int = 8, runs: int | None = None) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), a row for each row of ``docs``.

    Texts are equal when identical; null counts as empty. Of equal texts the row with the ``keep`` ("largest" or
    "smallest") doc_id stays; a null id stays only if all of them are null, and of repeated rows with that id one
    stays. ``group_size`` counts rows. Other columns are ignored. An empty table gives an empty one.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is largest or smallest")
    best = F.max if keep == "largest" else F.min
    order = F.desc_nulls_last("doc_id") if keep == "largest" else F.asc_nulls_last("doc_id")
    rounds = _rounds(runs or shuffle_partitions(docs.sparkSession), fan)
    text = F.coalesce("text", F.lit(""))
    digests = docs.select(
        "doc_id",
        F.sha2(text, 256).alias("digest"),
        F.octet_length(text).alias("n_bytes"),
        F.xxhash64(text).alias("check"),
    )
    rows = stored(
        digests.groupBy("doc_id", *ENTRY).agg(F.count("*").alias("copies"))
        .withColumn("run", F.pmod(F.xxhash64("doc_id"), F.lit(fan**rounds))),
        "digests",
    )
    first = rows.groupBy("run", *ENTRY).agg(best("doc_id").alias("doc_id"), F.sum("copies").alias("copies"))
    merged = first
    for digit in range(rounds):
        group = Window.partitionBy("run", *ENTRY)
        merged = (
            merged.withColumn("run", _exchanged(digit, fan))
            .repartition("run")
            .withColumns({
                "nth": F.row_number().over(group.orderBy(order)),
                "copies": F.sum("copies").over(group.orderBy(order).rowsBetween(
                    Window.unboundedPreceding, Window.unboundedFollowing)),
            })
            .where("nth = 1").drop("nth")
        )
    final = merged.select(*ENTRY, F.col("doc_id").alias("keep_id"), F.col("copies").alias("group_size"))
    answers = first.select("run", *ENTRY).join(final, ENTRY)
    joined = rows.join(answers, ["run", *ENTRY]).withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    )
    return joined.select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
  doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents window same as (partition by coalesce(text, ''))
"""
