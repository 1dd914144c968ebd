"""Mixing sources to target weights: a multivariate-hypergeometric splitting tree over blocks of documents.

A source's documents are permuted by a hash of their ids and cut into blocks, about as many as a block has
documents. Its target says how many words the mix takes: whole passes over the source, then blocks in permuted
order, then documents of the block where the target is reached. Every pass over a block is one unit of the
source's quota. The tree hands the units to the output shards: at each node a random half of its units goes
left and the rest right, which is a draw of the sources' quotas without replacement (multivariate
hypergeometric), with sums that are exact at every level. Units are disjoint, and a shard's documents are ordered
by a hash of their own for the local shuffle.

All of it is aggregation, windows over blocks and joins on (source, block): a source with a third of all rows
is spread over its blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlake.llm.common import join_unique, ranked, stored, whole_row
from marketlake.llm.textkeys import WORD

#: Weights of the sources in code point order, repeated; null comes last.
WEIGHTS = (1, 2, 3)
#: A source is taken at most so many times.
MAX_PASSES = 3
#: Hash values of the permutation lie below this.
SPACE = 1 << 32
#: Hex digits of a unit's chance that name its range: 4,096 ranges, the size of what one task numbers.
RANGE_DIGITS = 3


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_passes: int = MAX_PASSES) -> DataFrame:
    """Adds ``target`` to rows with source and source_size, one a source: all words, shared by weight under the cap.

    A source whose share is above ``max_passes`` times its size stops there and the rest is shared again. That
    ends where every source gets the smaller of its cap and weight times one level; the level is found by
    sorting the sources by cap per weight. There is one row for each source, so one task holds them.
    """
    by_source = Window.orderBy(F.asc_nulls_last("source"))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_source) - 1) % len(weights) + 1).cast("int"))
    s = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_passes)
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumns({
        "nth": F.row_number().over(by_cap),
        # The level if all sources before this one are capped and none from here on.
        "level_here": (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        / F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing)),
    })
    fits = F.col("level_here") * F.col("weight") <= F.col("cap")
    level = F.min(F.when(fits, F.struct("nth", "level_here"))).over(everything)["level_here"]
    share = F.coalesce(level, F.lit(0.0)) * F.col("weight")
    return s.select(*sizes.columns, F.least(F.col("cap").cast("double"), share).alias("target"))


def _split(units: DataFrame, depth: int, seed: int) -> DataFrame:
    """Adds ``shard``: each level of the tree sends a random half of a node's units to the left.

    Units are numbered by ranges of their chance with the counts of the ranges before them, so that a node with all
    units is no single task. Levels are written, since each reads its units twice.
    """
    units = units.withColumn("shard", F.lit(0))
    for level in range(depth):
        chance = F.md5(F.concat_ws(":", F.lit(seed), F.lit(level), "source_key", "pass", "block"))
        drawn = stored(units.withColumn("chance", chance).withColumn("range", F.substring("chance", 1, RANGE_DIGITS)), "level")
        nodes = drawn.groupBy("shard").agg(F.count("*").alias("node_units"))
        order = [F.col("chance"), F.col("source_key"), F.col("pass"), F.col("block")]
        placed = ranked(drawn, ["shard"], "range", order, "place").join(F.broadcast(nodes), "shard")
        left = F.col("place") < F.floor((F.col("node_units") + 1) / 2)
        units = placed.withColumn("shard", F.col("shard") * 2 + F.when(left, 0).otherwise(1)).select(*units.columns)
    return units


def _quotas(sized: DataFrame, weights: tuple[int, ...], max_passes: int) -> DataFrame:
    """Each source's words to take, as whole passes and words of one more; and the number of its blocks."""
    sources = sized.groupBy("source", "source_key").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("n")
    )
    quota = F.round("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(quota / F.col("source_size"))).otherwise(0)
    return targets(sources, weights, max_passes).select(
        "source_key", "source_size", "n", "target",
        F.ceil(F.sqrt("n")).alias("blocks"),
        passes.alias("passes"),
        (quota - passes * F.col("source_size")).alias("rest_words"),
    )


def mix(
    docs: DataFrame,
    carry: bool = False,
    weights: tuple[int, ...] = WEIGHTS,
    max_passes: int = MAX_PASSES,
    depth: int = 4,
    seed: int = 42,
) -> DataFrame:
    """(doc_id, size, source_size, target, taken, draws), a row for each row of ``docs``.

    ``carry`` adds that row as ``row``. ``draws`` has an entry (pass, words, shard, shuffle_key) for each time the mix takes the document: whole
    passes first, and a last one of fewer words where the target is reached inside the document; ``taken`` is
    the sum of their words. An entry is a unit that the tree has given to a shard. There are ``2 ** depth`` shards; ``shuffle_key`` is the order inside a shard.
    A null or wordless text has size 0 and is never taken. Null sources are one source, the last. Null ids and
    repeated rows are documents of their own. An empty table gives an empty one. Other columns are
    ignored, whatever their names. Everything follows from ids, texts and ``seed``, so reruns agree.
    """
    row = ["row"] if carry else []
    sized = docs.select("doc_id", "source", "text", *([whole_row(docs)] if carry else [])).select(
        "doc_id", "source", *row,
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("order_key"),
        F.xxhash64("text").alias("tie"),
        # Null must differ from every name.
        F.when(F.col("source").isNull(), "null").otherwise(F.concat(F.lit("="), "source")).alias("source_key"),
    )
    sized = stored(sized, "sizes")
    quotas = stored(_quotas(sized, weights, max_passes), "quotas")
    spot = F.conv(F.substring("order_key", 1, 8), 16, 10).cast("long")
    placed = join_unique(sized.drop("source"), quotas, ["source_key"], "n", sized.count()).withColumn(
        "block", F.floor(spot * F.col("blocks") / F.lit(SPACE)).cast("long")
    )
    before = Window.partitionBy("source_key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = stored(
        placed.groupBy("source_key", "block").agg(
            F.sum("size").alias("block_words"),
            F.max("passes").alias("whole"),
            F.max("rest_words").alias("quota_left"),
        ).withColumn("words_before", F.coalesce(F.sum("block_words").over(before), F.lit(0))),
        "blocks",
    )
    passes = F.col("whole") + (F.col("words_before") < F.col("quota_left")).cast("int")
    units = blocks.where(passes > 0).select(
        "source_key", "block", F.explode(F.sequence(F.lit(1).cast("long"), passes)).alias("pass")
    )
    # What the tree dealt out, and nothing else, is what a row can be taken for.
    shards = stored(
        _split(units, depth, seed).groupBy("source_key", "block").agg(
            F.array_sort(F.collect_list(F.struct("pass", "shard"))).alias("units")
        ),
        "units",
    )
    inside = Window.partitionBy("source_key", "block").orderBy("order_key", "doc_id", "tie").rowsBetween(
        Window.unboundedPreceding, -1
    )
    drawn = (
        placed.join(blocks.select("source_key", "block", "words_before"), ["source_key", "block"])
        .withColumn("before", F.col("words_before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .withColumn("extra", F.greatest(F.lit(0), F.least("size", F.col("rest_words") - F.col("before"))))
        .join(shards, ["source_key", "block"], "left")
    )
    draws = F.transform(
        "units",
        lambda u: F.struct(
            u["pass"].alias("pass"),
            F.when(u["pass"] <= F.col("passes"), F.col("size")).otherwise(F.col("extra")).alias("words"),
            u["shard"].alias("shard"),
            F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("tie"), u["pass"]).alias("shuffle_key"),
        ),
    )
    drawn = drawn.withColumn("draws", F.filter(draws, lambda d: d["words"] > 0))
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda total, d: total + d["words"])
    return drawn.select(
        "doc_id", "size", "source_size", "target",
        F.coalesce(taken, F.lit(0)).cast("long").alias("taken"),
        F.when(F.size("draws") > 0, F.col("draws")).alias("draws"),
        *row,
    )


def dealt(draws: Column | str = "draws") -> Column:
    """The draws as text: ``pass:shard:words``, comma-joined; null where the mix doesn't take the row."""
    parts = F.transform(draws, lambda d: F.concat_ws(":", d["pass"], d["shard"], d["words"]))
    return F.when(F.size(parts) > 0, F.array_join(parts, ","))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", dealt().alias("draws"))


def _split_sql(depth: int, seed: int) -> str:
    """Each level as a table: the units of level ``n`` with the node that they are in."""
    tables = ["tree0 as (select *, 0 as shard from units)"]
    for level in range(depth):
        chance = f"md5('{seed}:{level}:' || source_key || ':' || pass || ':' || block)"
        tables.append(f"""tree{level + 1} as (
  select source_key, pass, block, shard * 2 + case when
    row_number() over (partition by shard order by {chance}, source_key, pass, block)
    <= (count(*) over (partition by shard) + 1) // 2 then 0 else 1 end as shard from tree{level})""")
    return ",\n".join(tables)


SQL = r"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
    md5(cast(doc_id as varchar)) as order_key from documents),
sources as (
  select source, count(*) as n, sum(size)::bigint as source_size, 3 * sum(size)::bigint as cap,
    (row_number() over (order by source nulls last) - 1) % 3 + 1 as weight from sized group by source),
levels as (
  select *, row_number() over by_cap as nth,
    ((sum(source_size) over ())::bigint
      - coalesce(sum(cap) over (by_cap rows between unbounded preceding and 1 preceding), 0)::bigint)
      / (sum(weight) over (by_cap rows between current row and unbounded following))::bigint as level_here
  from sources window by_cap as (order by cap / weight, source nulls last)),
chosen as (select arg_min(level_here, nth) as level from levels where level_here * weight <= cap),
shares as (
  select source, source_size, n, least(cap::double, coalesce(level, 0) * weight) as target,
    cast(round(least(cap::double, coalesce(level, 0) * weight)) as bigint) as quota
  from levels, chosen),
quotas as (
  select *, ceil(sqrt(n))::bigint as blocks, case when source_size > 0 then quota // source_size else 0 end as passes
  from shares),
ordered as (
  select s.doc_id, s.size, q.source_size, q.target, coalesce('=' || s.source, 'null') as source_key,
    floor(cast('0x' || substr(order_key, 1, 8) as bigint) * q.blocks / 4294967296.0)::bigint as block,
    q.passes, q.quota - q.passes * q.source_size as rest,
    coalesce(sum(s.size) over (partition by s.source order by order_key, doc_id
      rows between unbounded preceding and 1 preceding), 0) as before
  from sized s join quotas q on s.source is not distinct from q.source),
units as (
  select source_key, block, unnest(range(1, passes + case when first < rest then 2 else 1 end)) as pass
  from (select source_key, block, max(passes) as passes, max(rest) as rest, min(before) as first
    from ordered group by all)),
""" + _split_sql(4, 42) + r""",
draws as (
  select o.doc_id, t.pass, t.shard,
    case when t.pass <= o.passes then o.size else greatest(0, least(o.size, o.rest - o.before)) end as words
  from ordered o join tree4 t on t.source_key = o.source_key and t.block = o.block),
drawn as (
  select doc_id, sum(words)::bigint as taken,
    string_agg(pass || ':' || shard || ':' || words::bigint, ',' order by pass) as draws
  from draws where words > 0 group by doc_id)
select o.doc_id, o.size, o.source_size, o.target, coalesce(d.taken, 0) as taken, d.draws
from ordered o left join drawn d on d.doc_id = o.doc_id
"""
