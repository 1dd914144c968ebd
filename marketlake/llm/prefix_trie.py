"""Prefix trie of conversations: who shares which first turns, and what sharing them saves.

A node is a distinct sequence of first turns, known by sums of hashes that depend on a turn and its position; so a
long conversation's prefixes are running sums, which can be cut anywhere. What holds for whole subtrees comes from an
Euler tour: every node has an enter and an exit arc, each arc knows the next, the list of arcs is ranked, and a
subtree's leaves and savings are differences of running sums over the ranked arcs, between its exit and its enter.

The list is ranked by contraction. Every arc has a coin of its own for each round; heads swallow the tails that
follow them, which takes a quarter of the list away, and one equi-join. What is left in the end is bounded and ranked
on the driver; then the rounds are undone, and each swallowed arc stands behind the one that swallowed it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlake.llm.common import join_unique, running, shuffle_partitions, stored
from marketlake.llm.textkeys import WORD

#: Fixed values of the contract: conversations c - c % GROUP lend up to crc32(c) % LENT first turns.
GROUP, LENT = 20, 4
#: Turns of a conversation that are summed, and siblings that are put in order, in one task.
STRETCH, SIBLINGS = 4_096, 256
#: Arcs of the tour that are summed in one task.
TOUR_STRETCH = 65_536
#: The contracted list is ranked on the driver once it is no longer than this.
LIST_END = 16_384
#: Conversations whose ids become one piece of a node's list of ids: those of a range of so many ids.
IDS = 256
_EMPTY = hashlib.sha256(b"").hexdigest()
#: Sums of 32-bit parts of hashes, so that a long holds those of 2**31 turns.
LANES = ["lane0", "lane1", "lane2", "lane3"]
KEY = ["depth", *LANES]


def _order(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, words): every turn with its position from 1 in its conversation, null turns first.

    Equal turn numbers go by role and then by the turn's digest.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    slim = stored(
        turns.where("conv_id is not null").select(
            F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"),
            F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
            F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("words"),
        ),
        "turns",
    )
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "digest"]
    placed = stored(
        slim.repartitionByRange(shuffle_partitions(turns.sparkSession), *order).withColumn("part", F.spark_partition_id()),
        "placed",
    )
    numbered = running(placed, ["conv_id"], "part", order[1:], {"pos": F.lit(1)})
    return stored(numbered.select("conv_id", F.col("pos").cast("long").alias("pos"), "digest", "words"), "numbered")


def _lent(conv: Column) -> Column:
    return F.crc32(conv.cast("string")) % LENT


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, pos, length, digest, words) of the rebuilt conversations, and all conversations (conv_id, length).

    Conversation c has the first h turns of c - c % 20 (fewer if it has fewer, none if there is none) and then its own
    turns after its first h, with h = crc32(c) % 4.
    """
    own = _order(turns)
    counts = own.groupBy("conv_id").agg(F.count("*").alias("n"))
    lenders = counts.where(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("lender"), F.col("n").alias("lender_n"))
    convs = stored(
        counts.withColumns({"lender": F.col("conv_id") - F.col("conv_id") % GROUP, "h": _lent(F.col("conv_id"))})
        .join(lenders, "lender", "left")
        .withColumn("taken", F.least("h", F.coalesce("lender_n", F.lit(0))))
        .select("conv_id", "lender", "h", "n", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")),
        "conversations",
    )
    # A lender has fewer than LENT turns to lend, to fewer than 2 * GROUP conversations.
    heads = own.where((F.col("pos") < LENT) & (F.col("conv_id") % GROUP == 0)).withColumnRenamed("conv_id", "lender")
    borrowed = convs.join(heads, "lender").where(F.col("pos") <= F.col("taken")).select("conv_id", "pos", "length", "digest", "words")
    rest = join_unique(
        own.where(F.col("pos") > _lent(F.col("conv_id"))), convs.select("conv_id", "n", "h", "taken", "length"),
        ["conv_id"], "n", own.count(),
    ).select("conv_id", (F.col("taken") + F.col("pos") - F.col("h")).alias("pos"), "length", "digest", "words")
    return stored(borrowed.unionByName(rest), "rebuilt"), convs.select("conv_id", "length")


def _prefixes(turns: DataFrame) -> DataFrame:
    """Turns with the sums of their prefix, their own hash included, and of the prefix without it (``before_*``)."""
    hashes = [F.xxhash64(F.lit(seed), "pos", "digest") for seed in (1, 2)]
    low = F.lit((1 << 32) - 1)
    parts = [p for h in hashes for p in (F.shiftrightunsigned(h, 32), h.bitwiseAND(low))]
    hashed = turns.withColumn("stretch", F.floor(F.col("pos") / STRETCH)).withColumns(
        {f"own_{lane}": part for lane, part in zip(LANES, parts)}
    )
    summed = running(hashed, ["conv_id"], "stretch", [F.col("pos")], {lane: F.col(f"own_{lane}") for lane in LANES})
    return summed.select(
        "conv_id", F.col("pos").alias("depth"), "length", "words", *LANES,
        *[(F.col(lane) - F.col(f"own_{lane}")).alias(f"before_{lane}") for lane in LANES],
    )


def trie_nodes(prefixes: DataFrame, convs: DataFrame) -> DataFrame:
    """One row a node: its key and id (``node``), conv_id, n_convs, words, n_children, and its parent's id and conv_id."""
    before = [f"before_{lane}" for lane in LANES]
    # The lanes before are the same in all rows of a node.
    inner = prefixes.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words"),
        *[F.min(b).alias(b) for b in before],
    )
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        *[zero.alias(k) for k in KEY], "conv_id", "n_convs", zero.alias("words"), *[zero.alias(b) for b in before]
    )
    nodes = stored(inner.unionByName(root).withColumn("node", F.monotonically_increasing_id()), "nodes")
    parent_key = [(F.col("depth") - 1).alias("depth"), *[F.col(b).alias(lane) for b, lane in zip(before, LANES)]]
    children = nodes.where("depth > 0").select(*parent_key, "node")
    families = children.groupBy(*KEY).agg(F.count("*").alias("n_children"))
    parents = stored(nodes.join(families, KEY, "left").fillna(0, ["n_children"]), "parents")
    known = parents.where("n_children > 0").select(
        *KEY, F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("siblings")
    )
    placed = join_unique(children, known, KEY, "siblings", nodes.count()).select("node", "parent", "parent_conv_id", "siblings")
    return stored(parents.drop(*before).join(placed, "node", "left"), "trie")


def _enter(node: Column) -> Column:
    return node * 2


def _exit(node: Column) -> Column:
    return node * 2 + 1


def euler_tour(nodes: DataFrame) -> DataFrame:
    """(arc, next): for every node an enter arc (twice its id) and an exit arc; the root's exit has no next.

    Siblings follow each other in stretches by a hash, then by id.
    """
    stretch = F.pmod(F.xxhash64("node"), F.ceil(F.col("siblings") / SIBLINGS))
    siblings = nodes.where("parent is not null").select("node", "parent", stretch.alias("stretch"))
    firsts = siblings.groupBy("parent", "stretch").agg(F.min("node").alias("first"))
    by_stretch = Window.partitionBy("parent").orderBy("stretch")
    firsts = stored(
        firsts.withColumns({"next_first": F.lead("first").over(by_stretch), "nth": F.row_number().over(by_stretch)}), "firsts"
    )
    inside = Window.partitionBy("parent", "stretch").orderBy("node")
    exits = (
        siblings.withColumn("sibling", F.lead("node").over(inside))
        .join(firsts.select("parent", "stretch", "next_first"), ["parent", "stretch"])
        .select(
            _exit(F.col("node")).alias("arc"),
            F.coalesce(_enter(F.col("sibling")), _enter(F.col("next_first")), _exit(F.col("parent"))).alias("next"),
        )
    )
    first_child = firsts.where("nth = 1").select(F.col("parent").alias("node"), F.col("first").alias("child"))
    enters = nodes.join(first_child, "node", "left").select(
        _enter(F.col("node")).alias("arc"), F.coalesce(_enter(F.col("child")), _exit(F.col("node"))).alias("next")
    )
    last = nodes.where("depth = 0").select(_exit(F.col("node")).alias("arc"), F.lit(None).cast("long").alias("next"))
    return enters.unionByName(exits).unionByName(last)


def list_rank(links: DataFrame, end: int = LIST_END, seed: int = 42) -> DataFrame:
    """(arc, place): positions from 0 in the list that ``links`` (arc, next) is; the last arc's next is null.

    Coins are hashes of arc and round, so nobody has to ask for them: an arc is swallowed if its coin is tails and
    the coin of the one before it heads, and the join on ``next`` tells that one all it needs.
    """
    spark = links.sparkSession
    alive = stored(links.withColumn("weight", F.lit(1).cast("long")), "links")
    swallowed: list[DataFrame] = []
    while alive.count() > end:
        turn = len(swallowed)
        heads = lambda arc: F.pmod(F.xxhash64(F.lit(seed), F.lit(turn), arc), F.lit(2)) == 0  # noqa: B023, E731
        tails = alive.where(~heads(F.col("arc"))).select(
            F.col("arc").alias("next"), F.col("next").alias("after"), F.col("weight").alias("more")
        )
        # Only heads look for the one behind them; nulls and heads behind them find nothing.
        seen = stored(
            alive.withColumn("sought", F.when(heads(F.col("arc")), F.col("next"))).join(
                tails.withColumnRenamed("next", "sought"), "sought", "left"
            ).select("arc", "next", "weight", "sought", "after", "more"),
            "seen",
        )
        swallowed.append(seen.where("more is not null").select(
            F.col("sought").alias("arc"), F.col("arc").alias("by"), F.col("weight").alias("offset")
        ))
        # A tail survives unless the one before it was a head.
        grown = F.col("more").isNotNull()
        left = seen.select(
            "arc", F.when(grown, F.col("after")).otherwise(F.col("next")).alias("next"),
            (F.col("weight") + F.coalesce("more", F.lit(0))).alias("weight"),
        )
        alive = stored(left.join(swallowed[-1].select("arc"), "arc", "left_anti"), "alive")
    following = {row.arc: (row.next, row.weight) for row in alive.collect()}
    at = next(iter(following.keys() - {after for after, _ in following.values()}), None)
    ranked, place = [], 0
    while at is not None:
        ranked.append((at, place))
        at, place = following[at][0], place + following[at][1]
    if len(ranked) != len(following):
        raise ValueError("links are not one list")
    places = spark.createDataFrame(ranked, "arc long, place long")
    for gone in reversed(swallowed):
        behind = gone.join(places.select(F.col("arc").alias("by"), "place"), "by").select(
            "arc", (F.col("place") + F.col("offset")).alias("place")
        )
        places = stored(places.unionByName(behind), "places")
    return places


def subtree_sums(nodes: DataFrame, places: DataFrame) -> DataFrame:
    """(node, n_leaves, saved_tokens) from running sums over the tour: what is entered between enter and exit."""
    values = nodes.select(
        _enter(F.col("node")).alias("arc"), (F.col("n_children") == 0).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )
    tour = stored(
        places.join(values, "arc", "left").withColumn("stretch", F.floor(F.col("place") / TOUR_STRETCH)), "tour"
    )
    sums = running(tour, [], "stretch", [F.col("place")], {
        "leaves_until": F.coalesce("leaf", F.lit(0)), "saved_until": F.coalesce("saved", F.lit(0)),
    })
    entered = F.col("arc") % 2 == 0
    between = lambda until, own: (
        F.sum(F.when(entered, F.col(own) - F.col(until)).otherwise(F.col(until))).cast("long")
    )
    return sums.groupBy(F.shiftright("arc", 1).alias("node")).agg(
        between("leaves_until", "leaf").alias("n_leaves"), between("saved_until", "saved").alias("saved_tokens")
    )


_HASHED = pa.schema([*[(k, pa.int64()) for k in KEY], ("ends_sha256", pa.string())])


def _hash_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of each key, which come one after the other; only the state of one hash is held."""
    current, state, done = None, None, []

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*[(*key, digest) for key, digest in rows])
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _HASHED)], schema=_HASHED)

    for batch in batches:
        keys = zip(*(batch.column(i).to_pylist() for i in range(len(KEY))))
        for key, piece in zip(keys, batch.column(len(KEY))):
            if key != current:
                if state is not None:
                    done.append((current, state.hexdigest()))
                current, state = key, hashlib.sha256()
            else:
                state.update(b",")
            state.update(piece.as_buffer())
        if len(done) >= 10_000:
            yield batch_of(done)
            done = []
    if state is not None:
        done.append((current, state.hexdigest()))
    if done:
        yield batch_of(done)


def _ends(prefixes: DataFrame, convs: DataFrame) -> DataFrame:
    """(key, ends_sha256): the hash of the ids of those conversations that end at a node, for nodes where some do.

    Ids become pieces by ranges; pieces are sorted and hashed in a stream, so no list of ids is ever gathered.
    """
    ends = prefixes.where("depth = length").select(*KEY, "conv_id").unionByName(
        convs.where("length = 0").select(*[F.lit(0).cast("long").alias(k) for k in KEY], "conv_id")
    )
    ids = F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string"))
    pieces = ends.groupBy(*KEY, F.floor(F.col("conv_id") / IDS).alias("range")).agg(
        F.encode(F.array_join(ids, ","), "UTF-8").alias("piece")
    )
    in_order = pieces.repartition(shuffle_partitions(prefixes.sparkSession), *KEY).sortWithinPartitions(*KEY, "range")
    ddl = ", ".join(f"{k} long" for k in KEY) + ", ends_sha256 string"
    return in_order.select(*KEY, "piece").mapInArrow(_hash_runs, ddl)


def prefix_trie(turns: DataFrame, list_end: int = LIST_END) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), a row for each node.

    ``turns`` has conv_id, turn, role and text. Turns are ordered by turn, null first, equal ones by role and then by
    a hash of role and text; so repeated rows are turns of their own. Null role or text counts as empty. Rows without
    a conv_id belong to no conversation and are left out. Very long texts and conversations are whole. Without any
    conversation there is no root and no row. Other columns are ignored, whatever their names.
    """
    rows, convs = rebuilt(turns.select("conv_id", "turn", "role", "text"))
    prefixes = stored(_prefixes(rows), "prefixes")
    nodes = trie_nodes(prefixes, convs)
    sums = subtree_sums(nodes, list_rank(euler_tour(nodes), list_end))
    return (
        nodes.join(_ends(prefixes, convs), KEY, "left")
        .join(sums, "node")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
        )
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


#: DuckDB has no crc32; the fold below is its definition, bit by bit, over the digits of a conv_id.
SQL = r"""
with ids as (select distinct conv_id from conversations where conv_id is not null),
hashed as (
  select conv_id, list_reduce(
    list_prepend(4294967295::bigint, flatten(list_transform(string_split(cast(conv_id as varchar), ''),
      lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda crc, step: case when step >= 0 then xor(crc, step)
      when crc & 1 = 1 then xor(crc >> 1, 3988292384) else crc >> 1 end) as inverted from ids),
lent as (select conv_id, xor(inverted, 4294967295) % 4 as h, conv_id - conv_id % 20 as lender from hashed),
own as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''),
      sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) as pos
  from conversations where conv_id is not null),
parts as (
  select l.conv_id, 0 as part, o.pos, o.role, o.text from lent l join own o on o.conv_id = l.lender and o.pos <= l.h
  union all
  select l.conv_id, 1, o.pos, o.role, o.text from lent l join own o on o.conv_id = l.conv_id and o.pos > l.h),
turns as (
  select conv_id, row_number() over (partition by conv_id order by part, pos) as depth,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as words, sha256(length(role) || ':' || role || text) as digest
  from parts),
prefixes as (
  select conv_id, depth, words, string_agg(digest, '') over (partition by conv_id order by depth) as path from turns
  union all select conv_id, 0, 0, '' from ids),
lengths as (select conv_id, max(depth) as length from prefixes group by conv_id),
nodes as (
  select p.depth, p.path, min(p.conv_id) as conv_id, count(*) as n_convs, any_value(p.words) as words,
    sha256(coalesce(string_agg(cast(p.conv_id as varchar), ',' order by p.conv_id) filter (where p.depth = l.length), ''))
      as ends_sha256
  from prefixes p join lengths l using (conv_id) group by p.depth, p.path),
family as (
  select n.*, up.conv_id as parent_conv_id
  from nodes n left join nodes up on up.depth = n.depth - 1 and up.path = left(n.path, 64 * (n.depth - 1)::int)),
counted as (
  select f.*, (select count(*) from family c where c.depth = f.depth + 1 and left(c.path, 64 * f.depth::int) = f.path)
    as n_children
  from family f),
above as (
  select a.depth, a.path, sum((c.n_children = 0)::int) as n_leaves, sum((c.n_convs - 1) * c.words) as saved_tokens
  from counted c join prefixes a on a.conv_id = c.conv_id and a.depth <= c.depth group by a.depth, a.path)
select c.conv_id, cast(c.depth as bigint) as depth, c.parent_conv_id, c.n_convs, c.n_children,
  cast(a.n_leaves as bigint) as n_leaves, cast(a.saved_tokens as bigint) as saved_tokens, c.ends_sha256
from counted c join above a on a.depth = c.depth and a.path = c.path
"""
