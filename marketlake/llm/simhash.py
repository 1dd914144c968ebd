"""SimHash near-duplicates: vantage-point trees over fingerprints, split over shards.

The fingerprints' 64 bits are seen as a few blocks. Two fingerprints at most r bits apart are at most r / blocks
bits apart in one of them, so there is a tree for each block, with the Hamming distance of that block as its
metric. (In all 64 bits unrelated fingerprints lie 32 bits from anything and a tree can prune next to nothing.)
A node has a vantage point and a radius; fingerprints within the radius go to one side, the rest to the other.
By the triangle inequality only fingerprints of the far side whose distance is within reach of the radius can
have partners on the near side: they visit it as well. The upper tree, made from a bounded sample, cuts the
fingerprints into shards and their boundary visitors; every shard builds its own lower tree and compares what is
left in the leaves on all bits. So the pairs are exact, and each is met in one shard at least.

Only distinct fingerprints take part; copies are members of a class. A shard joins its pairs to components at
once and gives one link for each fingerprint, so a group of near copies never becomes all its pairs. Links of all
shards are joined to components by alternating star contraction, in tables that are written in each round.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlake.llm.common import field, join_unique, stored, whole_row

BITS = 64
#: The upper tree is made from so many fingerprints at most.
SAMPLE = 32_768
#: Fingerprints of their own that a shard should have.
SHARD_ROWS = 8_192
#: A leaf of a lower tree.
LEAF = 256


# --- fingerprints --------------------------------------------------------------------------------


#: Steps from one print of a text to its next.
_STEP = 0x9E3779B97F4A7C15
_MIX_A, _MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _remixed(hashes: np.ndarray, n: int) -> np.ndarray:
    """Other hashes of what has these: the same ones for n = 0, else those mixed with n."""
    if n:
        hashes = hashes + np.uint64(_STEP * n % (1 << BITS))
        hashes = (hashes ^ (hashes >> np.uint64(30))) * _MIX_A
        hashes = (hashes ^ (hashes >> np.uint64(27))) * _MIX_B
        hashes = hashes ^ (hashes >> np.uint64(31))
    return hashes


def shingle_hashes(text: str, words: int, seed: int = 42) -> np.ndarray:
    """Hashes of a text's word shingles in order, repeats too; none without words."""
    from xxhash import xxh64_digest

    split = text.encode("utf-8", "replace").lower().split()
    if not split:
        return np.zeros(0, np.uint64)
    whole = b" ".join(split)
    lengths = np.fromiter(map(len, split), np.int64, len(split))
    ends = np.cumsum(lengths) + np.arange(len(split))
    starts = ends - lengths
    size = min(words, len(split))
    first, last = starts[: len(split) - size + 1].tolist(), ends[size - 1 :].tolist()
    return np.frombuffer(b"".join([xxh64_digest(whole[s:e], seed) for s, e in zip(first, last)]), ">u8").astype(np.uint64)


def majority(hashes: np.ndarray, prints: int = 1) -> np.ndarray:
    """The bits that most of some hashes have, in ``prints`` numbers of 64 bits; 0 without hashes."""
    ones = np.zeros((prints, BITS), np.int64)
    for at in range(0, len(hashes), 16_384):
        for n in range(prints):
            digests = _remixed(hashes[at : at + 16_384], n).astype(">u8").view(np.uint8).reshape(-1, 8)
            ones[n] += np.unpackbits(digests, axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes), axis=1).view(">u8").astype(np.uint64).ravel()


def fingerprint(text: str, words: int, prints: int = 1, seed: int = 42) -> np.ndarray:
    """SimHash of a text's word shingles, repeats counted, in ``prints`` numbers of 64 bits; 0 without words."""
    return majority(shingle_hashes(text, words, seed), prints)


def _names(prints: int) -> list[str]:
    return [f"fp{n}" for n in range(prints)]


def _longs(names: list[str]) -> tuple[str, list[tuple[str, pa.DataType]]]:
    return ", ".join(f"{n} long" for n in names), [(n, pa.int64()) for n in names]


def _printer(words: int, prints: int):
    _, columns = _longs(["doc_id", "row_key", *_names(prints)])

    def run(batches):
        for batch in batches:
            found = [fingerprint(v.as_py() or "", words, prints) for v in batch.column("text")]
            table = np.asarray(found, np.uint64).reshape(-1, prints).view(np.int64)
            own = [pa.array(np.ascontiguousarray(table[:, n])) for n in range(prints)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_key"), *own], schema=pa.schema(columns)
            )

    return run


def fingerprints(docs: DataFrame, words: int, prints: int = 1) -> DataFrame:
    """(doc_id, row_key, fp0, ...): the fingerprint as signed numbers; row_key tells texts with one id apart."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row_key"), "text")
    return rows.mapInArrow(_printer(words, prints), _longs(["doc_id", "row_key", *_names(prints)])[0])


# --- trees ---------------------------------------------------------------------------------------


def _distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def _far_apart(prints: np.ndarray, a, b) -> np.ndarray:
    """Differing bits of all prints; a and b index points and are broadcast."""
    total = _distance(prints[0][a], prints[0][b]).astype(np.int16)
    for own in prints[1:]:
        total += _distance(own[a], own[b])
    return total


@dataclass
class Node:
    vantage: int
    radius: int
    near: Node | int  # a number is a shard
    far: Node | int


@dataclass
class Block:
    """Some bits of one print, and the upper tree over them."""

    number: int
    shift: int
    mask: int
    reach: int  # bits that partners can differ by here
    tree: Node | int = 0

    def of(self, prints: np.ndarray) -> np.ndarray:
        return (prints[self.number] >> np.uint64(self.shift)) & np.uint64(self.mask)


def _vantage(values: np.ndarray) -> tuple[int, int] | None:
    """A vantage point and a radius that leave some values on either side; None if all are equal."""
    for place in (0.5, 0.25, 0.75, 0.1, 0.9):
        point = values[int(place * (len(values) - 1))]
        distances = _distance(values, point)
        radius = min(int(np.median(distances)), int(distances.max()) - 1)
        if radius >= 0:
            return int(point), radius
    return None


def _blocks(prints: int, each: int, reach: int) -> list[Block]:
    edges = [BITS * i // each for i in range(each + 1)]
    return [
        Block(n, low, (1 << (high - low)) - 1, reach) for n in range(prints) for low, high in zip(edges, edges[1:])
    ]


def _upper_trees(sample: np.ndarray, depth: int, blocks: list[Block]) -> None:
    """Gives each block its tree; shards are numbered through."""
    shards = 0

    def grow(values: np.ndarray, depth: int) -> Node | int:
        nonlocal shards
        split = _vantage(values) if depth and len(values) > 1 else None
        if split is None:
            shards += 1
            return shards - 1
        near = _distance(values, np.uint64(split[0])) <= split[1]
        return Node(*split, grow(values[near], depth - 1), grow(values[~near], depth - 1))

    for block in blocks:
        block.tree = grow(block.of(sample), depth)


def _sides(values: np.ndarray, vantage: int, radius: int, reach: int, home: np.ndarray, visit: np.ndarray):
    """Who goes near and far: (home, visitors) of either side. Far homes visit the near side, not the reverse."""
    at_home = _distance(values[home], np.uint64(vantage)).astype(np.int16)
    away = _distance(values[visit], np.uint64(vantage)).astype(np.int16)
    near = at_home <= radius
    bound = home[~near & (at_home - reach <= radius)]
    return (
        (home[near], np.concatenate([visit[away - reach <= radius], bound])),
        (home[~near], visit[away + reach > radius]),
    )


def _points(batch: pa.RecordBatch | pa.Table, prints: int) -> np.ndarray:
    """Fingerprints as unsigned numbers, a row for each print."""
    return np.stack([np.asarray(batch.column(n).to_numpy(), np.int64) for n in _names(prints)]).view(np.uint64)


def _router(blocks: list[Block], prints: int, others: tuple[str, ...] = ()):
    """Fingerprints by shard; ``others`` are further columns of numbers that go with them."""
    schema = pa.schema([("shard", pa.int32()), ("home", pa.bool_()), *_longs([*_names(prints), *others])[1]])

    def run(batches):
        for batch in batches:
            points = _points(batch, prints)
            carried = [batch.column(n).to_numpy() for n in others]
            found: list[tuple[int, bool, np.ndarray]] = []

            def walk(node: Node | int, values: np.ndarray, reach: int, home: np.ndarray, visit: np.ndarray) -> None:
                if isinstance(node, int):
                    found.append((node, True, home))
                    found.append((node, False, visit))
                    return
                near, far = _sides(values, node.vantage, node.radius, reach, home, visit)
                walk(node.near, values, reach, *near)
                walk(node.far, values, reach, *far)

            for block in blocks:
                everyone = np.arange(points.shape[1])
                walk(block.tree, block.of(points), block.reach, everyone, everyone[:0])
            for shard, home, rows in found:
                if len(rows):
                    own = [pa.array(x) for x in np.ascontiguousarray(points[:, rows]).view(np.int64)]
                    own += [pa.array(x[rows]) for x in carried]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), shard, np.int32)), pa.array(np.full(len(rows), home)), *own],
                        schema=schema,
                    )

    return run


# --- inside a shard ------------------------------------------------------------------------------


class _Components:
    """Components of numbered points, as the smallest number that each is joined to."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.root[a], self.root[b]
            open_ = x != y
            a, b = a[open_], b[open_]
            if not len(a):
                return
            low, high = np.minimum(x, y)[open_], np.maximum(x, y)[open_]
            np.minimum.at(self.root, high, low)
            self.flatten()

    def flatten(self) -> None:
        while True:
            above = self.root[self.root]
            if np.array_equal(above, self.root):
                return
            self.root = above


def _leaf(prints: np.ndarray, home: np.ndarray, visit: np.ndarray, bits_apart: int, parts: _Components) -> None:
    """All pairs of a home point and another point, in pieces of bounded size."""
    for at in range(0, len(home), LEAF):
        rows = home[at : at + LEAF]
        others = np.concatenate([home[at:], visit])
        for to in range(0, len(others), 8_192):
            columns = others[to : to + 8_192]
            a, b = np.nonzero(_far_apart(prints, rows[:, None], columns[None, :]) <= bits_apart)
            parts.join(rows[a], columns[b])


def _dense_leaf(prints: np.ndarray, points: np.ndarray, bits_apart: int, parts: _Components) -> None:
    """A large leaf of one value, as near copies make it: points that are joined already are not met again."""
    waiting = points
    while len(waiting):
        reached, waiting = [waiting[0]], waiting[1:]
        start = reached[0]
        while reached and len(waiting):
            close = _far_apart(prints, waiting, reached.pop()) <= bits_apart
            if close.any():
                new, waiting = waiting[close], waiting[~close]
                parts.join(np.full(len(new), start), new)
                reached.extend(new)


def _search(prints: np.ndarray, values: np.ndarray, home: np.ndarray, reach: int, bits_apart: int) -> np.ndarray:
    """The root of each point, joining all points at most ``bits_apart`` of which one is at home."""
    parts = _Components(prints.shape[1])
    everyone = np.arange(prints.shape[1])
    waiting = [(everyone[home], everyone[~home])]
    while waiting:
        own, visit = waiting.pop()
        if not len(own):
            continue
        split = _vantage(values[own]) if len(own) > LEAF else None
        if split is not None:
            waiting += _sides(values, *split, reach, own, visit)
        elif len(own) > LEAF:
            _dense_leaf(prints, np.concatenate([own, visit]), bits_apart, parts)
        else:
            _leaf(prints, own, visit, bits_apart, parts)
    return parts.root


def _key(prints: int) -> Column:
    """What names a fingerprint in links: the number itself, or the text of several."""
    return F.col("fp0") if prints == 1 else F.concat_ws("-", *[F.hex(n) for n in _names(prints)])


def _linker(blocks: list[Block], owner: list[int], bits_apart: int, prints: int):
    kind = pa.int64() if prints == 1 else pa.string()

    def names(points: np.ndarray) -> pa.Array:
        if prints == 1:
            return pa.array(points[0].view(np.int64))
        return pa.array(["-".join(f"{int(x):X}" for x in column) for column in points.T], kind)

    def run(table: pa.Table) -> pa.Table:
        points = _points(table, prints)
        home = table.column("home").to_numpy(zero_copy_only=False).astype(bool)
        block = blocks[owner[table.column("shard")[0].as_py()]]
        root = _search(points, block.of(points), home, block.reach, bits_apart)
        joined = root != np.arange(len(root))
        return pa.Table.from_arrays(
            [names(points[:, joined]), names(points[:, root[joined]])], schema=pa.schema([("a", kind), ("b", kind)])
        )

    return run


def links(
    classes: DataFrame, bits_apart: int, prints: int = 1, each: int = 3, reach: int | None = None,
    sample: int = SAMPLE, shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """(a, b): links of distinct fingerprints, whose components are those of all pairs within reach.

    Each print has ``each`` blocks. Pairs are exact if ``reach`` is at least ``bits_apart`` over the number of
    blocks, as it is by default; a smaller reach finds most pairs with less work.
    """
    names = _names(prints)
    if reach is None:
        reach = bits_apart // (prints * each)
    total = classes.count()
    chosen = classes.select(*names).orderBy(F.xxhash64(*names), *names).limit(sample).toArrow()
    blocks = _blocks(prints, each, reach)
    depth = max(0, math.ceil(math.log2(max(1, total) / shard_rows)))
    _upper_trees(_points(chosen, prints), depth, blocks)
    owner = [n for n, block in enumerate(blocks) for _ in range(_shard_count(block.tree))]
    ddl = _longs(names)[0]
    routed = classes.select(*names).mapInArrow(_router(blocks, prints), f"shard int, home boolean, {ddl}")
    kind = "long" if prints == 1 else "string"
    return routed.groupBy("shard").applyInArrow(
        _linker(blocks, owner, bits_apart, prints), f"a {kind}, b {kind}"
    )


def _shard_count(node: Node | int) -> int:
    return 1 if isinstance(node, int) else _shard_count(node.near) + _shard_count(node.far)


# --- components ----------------------------------------------------------------------------------


def star_components(edges: DataFrame) -> DataFrame:
    """(a, b): every linked node a with the smallest node b of its component; roots have no row.

    Alternating star contraction: in each round a node hands its larger neighbours, and then its smaller ones,
    to its smallest. The minimum of a node's neighbours is pre-aggregated, and the join that hands it on is a
    plain equi-join, which adaptive execution splits where one node has very many neighbours.
    """
    edges = stored(edges.distinct(), "links")
    seen = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large.where("a <> b"), "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
        edges = stored(small.select("e.a", "e.b").where("a <> b").distinct(), "small-star")
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
        if state == seen:
            return edges
        seen = state


def near_groups(
    docs: DataFrame, words: int = 5, bits_apart: int = 4, prints: int = 1, each: int = 3, reach: int | None = None,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """(doc_id, row_key, fp0, ..., component, component_id), a row for each row of ``docs``.

    Documents whose fingerprints (``prints`` numbers of 64 bits) differ in at most ``bits_apart`` bits are
    linked; ``component`` names what links reach, component_id is its smallest doc_id (null if all are null). Null, empty
    and wordless texts have the fingerprint 0 and are linked like any other. Columns other than doc_id and text
    are ignored. An empty table gives an empty one. For ``each`` and ``reach`` see ``links``.
    """
    names = _names(prints)
    printed = stored(fingerprints(docs, words, prints), "fingerprints")
    classes = printed.groupBy(*names).agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    classes = stored(classes.withColumn("key", _key(prints)), "classes")
    stars = star_components(links(classes, bits_apart, prints, each, reach, shard_rows=shard_rows))
    rooted = classes.join(stars.select(F.col("a").alias("key"), F.col("b").alias("root")), "key", "left")
    rooted = stored(rooted.withColumn("root", F.coalesce("root", "key")), "rooted")
    firsts = rooted.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("size"))
    answers = join_unique(rooted, firsts, ["root"], "size", rooted.count()).select(
        *names, "n", F.col("root").alias("component"), "component_id"
    )
    return join_unique(printed, answers, names, "n", printed.count()).select(
        "doc_id", "row_key", *names, "component", "component_id"
    )


def keep_one(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """The row of ``docs`` with the smallest doc_id of each component of ``groups``, with all its columns.

    Of several rows with that id one stays, null ids come last.
    """
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_key")
    chosen = groups.groupBy("component").agg(F.min(order).alias("first")).select("first.doc_id", "first.row_key")
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row_key"), whole_row(docs)
    ).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("d.row_key") == F.col("c.row_key"))
    repeated = Window.partitionBy("d.doc_id", "d.row_key").orderBy(F.xxhash64("row"))
    kept = keyed.join(chosen.alias("c"), same).withColumn("nth", F.row_number().over(repeated)).where("nth = 1")
    return kept.select(*[field(c) for c in docs.columns])


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=4, bits_apart=4)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp0"), 16, "0")).alias("fingerprint"), "component_id")
