"""Sharding by a minimax contiguous partition of ordered atomic groups.

Documents of equal text are one group, which is never cut. Groups stand in order of their smallest doc_id, with the
running sum of their bytes; a shard is a stretch of that order, so a partition is a choice of running sums to cut at.
The smallest capacity that no shard need exceed is found by binary search, and a capacity is checked greedily: each
shard ends at the last running sum that still fits.

Running sums stay distributed. The search sees them at a resolution: the first and the last running sum in each of a
bounded number of buckets. From those every greedy step is known between two bounds, so a capacity is surely
feasible, surely not, or open. What is open lies in one stretch of sums for each cut; the next round takes buckets of
those stretches alone, until the capacity and its cuts are exact.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlake.llm.common import field, join_unique, running, shuffle_partitions, stored, whole_row

SHARDS = 16
#: Stretches that running sums are cut into in a round of the search, by number and once more by bytes.
BUCKETS = 8_192
#: Copies of a text are numbered in stretches of so many ids and rows.
STRETCH = 4_096


@dataclass(frozen=True)
class Resolution:
    """The running sums as a round of the search knows them: of each bucket the least and the largest, and how many."""

    least: list[int]
    largest: list[int]
    count: list[int]

    @classmethod
    def of(cls, groups: DataFrame, stretches: list[tuple[int, int]], by_bytes: int, by_count: int) -> Resolution:
        merged: list[tuple[int, int]] = []
        for low, high in sorted(stretches):
            if merged and low <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
            else:
                merged.append((low, high))
        inside = F.lit(False)
        for low, high in merged:
            inside = inside | F.col("upto").between(low, high)
        buckets = (
            groups.where(inside)
            .groupBy(F.floor(F.col("upto") / F.lit(by_bytes)), F.floor(F.col("nth") / F.lit(by_count)))
            .agg(F.min("upto").alias("least"), F.max("upto").alias("largest"), F.count("*").alias("n"))
        )
        rows = sorted((r.least, r.largest, r.n) for r in buckets.collect())
        return cls([0, *(r[0] for r in rows)], [0, *(r[1] for r in rows)], [1, *(r[2] for r in rows)])

    def last_until(self, x: int) -> tuple[int, int]:
        """Bounds of the largest running sum that is ``x`` at most."""
        i = bisect_right(self.least, x) - 1
        return (self.largest[i],) * 2 if self.largest[i] <= x else (self.least[i], x)

    def inside(self, stretches: list[tuple[int, int]]) -> tuple[int, int]:
        """How many running sums, and bytes between the ends of their buckets, the stretches have at most."""
        hit = {
            i
            for low, high in stretches
            for i in range(max(0, bisect_right(self.least, low) - 1), bisect_right(self.least, high))
        }
        return sum(self.count[i] for i in hit), sum(self.largest[i] - self.least[i] + 1 for i in hit)


def _chains(seen: Resolution, capacity: int, within: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Bounds of the greedy cuts; ``within`` has those that are known from earlier rounds."""
    low = high = 0
    cuts = []
    for known_low, known_high in within:
        low = max(known_low, seen.last_until(low + capacity)[0])
        high = min(known_high, seen.last_until(high + capacity)[1])
        cuts.append((low, high))
    return cuts


def _first_true(low: int, high: int, holds) -> int:
    """The smallest number in (low, high] that a monotone condition holds for; it holds for ``high``."""
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (low, middle) if holds(middle) else (middle, high)
    return high


def smallest_capacity(groups: DataFrame, shards: int, buckets: int = BUCKETS) -> tuple[int, list[int]]:
    """The least capacity with which greedy shards, ``shards`` at most, hold all groups; and running sums to cut at.

    ``groups`` has ``bytes``, their running sum ``upto`` and their running number ``nth``, and at least one row. The
    running sums returned are 0, the last one, some spread over all of them, and all greedy cuts of that capacity.
    """
    whole = groups.agg(F.max("upto"), F.max("bytes"), F.count("*")).first()
    total, largest, n = (int(x) for x in whole)
    even = -(-total // shards)
    # Shards of less than the mean or the largest group can't do; with both together greedy shards always do.
    infeasible, feasible = max(even, largest) - 1, even + largest
    within = [(0, total)] * shards
    by_bytes, by_count = -(-total // buckets), -(-n // buckets)
    known = {0}
    while True:
        seen = Resolution.of(groups, within, by_bytes, by_count)
        known.update(seen.least, seen.largest)
        surely = lambda c: _chains(seen, c, within)[-1][0] >= total
        perhaps = lambda c: _chains(seen, c, within)[-1][1] >= total
        feasible = _first_true(infeasible, feasible, surely)
        infeasible = _first_true(infeasible, feasible, perhaps) - 1
        if feasible - infeasible == 1:
            return feasible, sorted(known)
        within = [(low[0], high[1]) for low, high in zip(
            _chains(seen, infeasible + 1, within), _chains(seen, feasible, within)
        )]
        count, spread = seen.inside(within)
        # Finer by half at least, so that the search ends whatever the sums look like.
        by_bytes = max(1, min(by_bytes // 2, -(-spread // buckets)))
        by_count = max(1, min(by_count // 2, -(-count // buckets)))


def even_cuts(known: list[int], shards: int, capacity: int) -> list[int]:
    """Running sums to cut at, ``shards - 1`` of them: no shard exceeds ``capacity``, and each is near its fair part.

    Greedy cuts alone would fill the first shards and leave the last ones empty where a large group sets the
    capacity. Each cut is the known running sum nearest to an even split of what is left, but no earlier than where
    greedy shards still hold the rest. The greedy cuts from 0 are known, so there always is one.
    """
    total = known[-1]

    def holds_rest(i: int, left: int) -> bool:
        at = known[i]
        for _ in range(left):
            at = known[bisect_right(known, at + capacity) - 1]
        return at >= total

    cuts, before = [], 0
    for j in range(1, shards):
        start, end = bisect_right(known, before) - 1, bisect_right(known, before + capacity) - 1
        goal = before + (total - before) / (shards - j + 1)
        i = min(max(bisect_right(known, goal) - 1, min(start + 1, end)), end)
        if i < end and known[i + 1] - goal < goal - known[i]:
            i += 1
        if not holds_rest(i, shards - j):
            i = _first_true(i, end, lambda k: holds_rest(k, shards - j))
        before = known[i]
        cuts.append(before)
    return cuts


def _stretch(row_id: Column) -> Column:
    """Copies are numbered by stretches of ids; many rows of one id go by where they were stored."""
    ids = F.coalesce(F.floor(F.col("doc_id") / STRETCH), F.lit(-(1 << 62)))
    return F.struct(ids.alias("ids"), F.floor(row_id / STRETCH).alias("rows"))


def minimax_shards(docs: DataFrame, shards: int = SHARDS, carry: bool = False, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), a row for each row of ``docs``.

    ``size`` is the text's bytes plus 1, ``text_crc32`` its checksum. Shards hold equal sizes as nearly as groups of
    equal texts allow (``law`` is ``bytes``), and no partition of the ordered groups has a smaller largest shard.
    ``slot`` numbers a shard's rows from 0. ``grown_shard`` is null: one more shard moves all cuts. ``carry`` adds
    the whole row as ``row``.

    A null text counts as empty. Null ids come first, as an own id. Repeated rows are copies with slots of their
    own. Very long texts are groups like others; one over the mean has a shard to itself. With fewer groups than
    shards some shards stay empty. An empty table gives an empty one. Other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    row = [whole_row(docs)] if carry else []
    text = F.coalesce("text", F.lit(""))
    sized = stored(
        docs.select("doc_id", "text", *row).select(
            "doc_id", *(["row"] if carry else []),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
            F.monotonically_increasing_id().alias("row_id"),
        ),
        "sized",
    )
    grouped = sized.groupBy("digest").agg(
        F.sum("size").alias("bytes"), F.count("*").alias("n"), F.min("doc_id").alias("first_id")
    )
    order = [F.asc_nulls_first("first_id"), F.col("digest")]
    placed = stored(
        grouped.repartitionByRange(shuffle_partitions(spark), *order).withColumn("part", F.spark_partition_id()), "groups"
    )
    sums = {"upto": F.col("bytes"), "rows_upto": F.col("n"), "nth": F.lit(1)}
    groups = stored(running(placed, [], "part", order, sums), "sums")
    if groups.isEmpty():
        cuts: list[int] = []
    else:
        capacity, known = smallest_capacity(groups, shards, buckets)
        cuts = even_cuts(known, shards, capacity)
    shard = sum((F.when(F.col("upto") > cut, 1).otherwise(0) for cut in cuts), F.lit(0)).cast("int")
    cut_groups = groups.select("digest", "n", (F.col("rows_upto") - F.col("n")).alias("rows_before"), shard.alias("shard"))
    first = cut_groups.groupBy("shard").agg(F.min("rows_before").alias("shard_start"))
    # One row a shard: as bounded as their number.
    cut_groups = cut_groups.join(F.broadcast(first), "shard")
    dealt = join_unique(sized, cut_groups, ["digest"], "n", sized.count())
    dealt = dealt.withColumn("stretch", _stretch(F.col("row_id")))
    counted = running(dealt, ["digest"], "stretch", [F.asc_nulls_first("doc_id"), F.col("row_id")], {"copy": F.lit(1)})
    return counted.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("rows_before") - F.col("shard_start") + F.col("copy") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        *(["row"] if carry else []),
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """The rows of ``docs`` as Parquet, a folder ``shard=K`` for each shard, its files in order of the slots."""
    placed = minimax_shards(docs, shards, carry=True)
    columns = [field(c) for c in docs.columns if c != "shard"]
    spread = placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    spread.select(*columns, "shard").write.partitionBy("shard").parquet(path)


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minimax_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"))
