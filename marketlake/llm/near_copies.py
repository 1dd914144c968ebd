"""Near copies by the similarity of their shingle sets, with SimHash's vantage-point trees as the search.

A document is its set of hashed word shingles; two are linked if their sets' Jaccard similarity is ``LEAST`` or
more. The trees of ``simhash`` join the sets by their fingerprints, widely enough that hardly a pair of that similarity
is lost, into coarse groups: a shard gives one link for each fingerprint, whatever the size of a group. The sets of
a coarse group then meet and decide themselves: a set is compared with those that are not joined to it yet, and again at
most one link for each set comes back, never the pairs.

Sets of that similarity differ in size by a quarter of the smaller at most. So the search goes by bands of sizes: a
band's sets meet each other and those of the band below that are large enough, in trees of the band's own depth.
Inside a task the lower tree is over the distinct values of a block, however many sets have them; only sets whose
values are within reach are compared.

A coarse group is dealt into blocks of bounded size by a hash, and every two of its blocks meet in one task; so a group
of any size is whole, and no task has more than two blocks of it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import join_unique, stored
from marketlake.llm.simhash import (
    BITS,
    LEAF,
    SAMPLE,
    Block,
    Node,
    _blocks,
    _Components,
    _distance,
    _longs,
    _names,
    _points,
    _sides,
    _upper_trees,
    _vantage,
    majority,
    shingle_hashes,
    star_components,
)

#: Linked sets share LEAST[0] / LEAST[1] of their union at least.
LEAST = (4, 5)
#: Shingles of a block, about; a set of more is a block's part like any other.
BLOCK_SHINGLES = 1 << 17
#: Neighbouring shards that one task takes, so that their visitors from each other don't travel.
TOGETHER = 8
#: Sets that are dealt out at once.
DEALT_ROWS = 1 << 16
#: Pairs of sets that are compared at once, and links that are joined at once.
PAIRS = 1 << 18
#: Two values with more pairs of sets than this, as many near copies have them, leave out what is joined already.
DENSE = 1 << 14


def _edges() -> np.ndarray:
    """The sizes that bands begin with: a set can be similar to those of its own band and of the next ones only."""
    edges = [0, 1]
    while edges[-1] < 1 << 40:
        edges.append(max(edges[-1] + 1, -(-edges[-1] * LEAST[1] // LEAST[0])))
    return np.asarray(edges)


EDGES = _edges()


def shingle_set(text: str | None, words: int) -> np.ndarray:
    return np.unique(shingle_hashes(text or "", words))


def _name(found: np.ndarray) -> int:
    """A number for a set, equal for equal sets."""
    from xxhash import xxh64_intdigest

    number = xxh64_intdigest(found.tobytes())
    return number - (1 << BITS) if number >> (BITS - 1) else number


def _printer(words: int, prints: int):
    _, columns = _longs(["doc_id", "row_key", "set_id", "size", *_names(prints)])

    def run(batches):
        for batch in batches:
            sets = [shingle_set(v.as_py(), words) for v in batch.column("text")]
            table = np.asarray([majority(x, prints) for x in sets], np.uint64).reshape(-1, prints).view(np.int64)
            own = [pa.array(np.ascontiguousarray(table[:, n])) for n in range(prints)]
            named = [pa.array([_name(x) for x in sets], pa.int64()), pa.array([len(x) for x in sets], pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_key"), *named, *own], schema=pa.schema(columns)
            )

    return run


def _set_reader(words: int):
    schema = pa.schema([("set_id", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            sets = [shingle_set(v.as_py(), words) for v in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_name(x) for x in sets], pa.int64()), pa.array([x.view(np.int64) for x in sets], schema[1].type)],
                schema=schema,
            )

    return run


# --- search --------------------------------------------------------------------------------------


def _kind(prints: int) -> np.dtype:
    """A set as the search sees it."""
    return np.dtype([("prints", "<u8", (prints,)), ("set_id", "<i8"), ("size", "<i4")])


def _band(sizes: np.ndarray) -> np.ndarray:
    return np.searchsorted(EDGES, sizes, "right") - 1


def _count_bands(batches):
    counts = np.zeros(len(EDGES), np.int64)
    for batch in batches:
        counts += np.bincount(_band(batch.column("size").to_numpy()), minlength=len(EDGES))
    found = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[found])], names=["band", "n"])


def _held(batches: Iterator[pa.RecordBatch], prints: int) -> Iterator[np.ndarray]:
    """The sets of some batches, many at a time."""
    waiting, held = [], 0
    for batch in batches:
        points = np.empty(batch.num_rows, _kind(prints))
        points["prints"] = _points(batch, prints).T
        points["set_id"], points["size"] = batch.column("set_id").to_numpy(), batch.column("size").to_numpy()
        waiting.append(points)
        held += len(points)
        if held >= DEALT_ROWS:
            yield np.concatenate(waiting)
            waiting, held = [], 0
    if held:
        yield np.concatenate(waiting)


def _dealer(blocks: list[Block], depths: dict[int, int], prints: int):
    """Sets by band, block and node of the block's upper tree at the band's depth, packed; and its visitors."""
    schema = pa.schema([("place", pa.int64()), ("home", pa.binary()), ("visit", pa.binary())])

    def run(batches):
        for points in _held(batches, prints):
            sizes = points["size"].astype(np.int64)
            band = _band(sizes)
            large = np.flatnonzero(LEAST[1] * sizes >= LEAST[0] * EDGES[band + 1])  # enough for the next band
            met = [
                (b, depth, np.flatnonzero(band == b), large[band[large] == b - 1]) for b, depth in depths.items()
            ]
            for nth, block in enumerate(blocks):
                values, found = block.of(points["prints"].T), []

                def walk(node: Node | int, depth: int, place: int, home: np.ndarray, visit: np.ndarray) -> None:
                    if not len(home) and not len(visit):
                        return
                    if not depth or isinstance(node, int):
                        found.append((place, points[home].tobytes(), points[visit].tobytes()))
                        return
                    near, far = _sides(values, node.vantage, node.radius, block.reach, home, visit)  # noqa: B023
                    above, below = place >> 32 << 32, 2 * (place & 0xFFFFFFFF)
                    walk(node.near, depth - 1, above | below, *near)
                    walk(node.far, depth - 1, above | below + 1, *far)

                for b, depth, home, visit in met:
                    walk(block.tree, depth, b << 48 | nth << 32 | 1, home, visit)
                columns = list(zip(*found)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema)], schema=schema)

    return run


class _Search:
    """Joins sets at most ``bits_apart`` whose sizes are near enough, and whose values of a block are within reach."""

    def __init__(self, points: np.ndarray, homes: int, block: Block, bits_apart: int):
        """The first ``homes`` points are at home, the others visit."""
        self.block, self.bits_apart = block, bits_apart
        values = block.of(points["prints"].T)
        away = np.arange(len(points)) >= homes
        self.order = np.lexsort((values, away))
        points, values, away = points[self.order], values[self.order], away[self.order]
        self.prints = np.ascontiguousarray(points["prints"].T)
        self.sizes = points["size"].astype(np.int64)
        # Entries: the points at home with one value, then the visitors with one value.
        self.begins = np.flatnonzero(np.r_[True, (values[1:] != values[:-1]) | (away[1:] != away[:-1])])
        self.counts = np.diff(np.r_[self.begins, len(points)])
        self.values = values[self.begins]
        if block.mask >> 16 == 0:
            self.values = self.values.astype(np.uint16)
        self.home = int(np.searchsorted(self.begins, homes))
        self.parts = _Components(len(points))
        self.pending: list[tuple[np.ndarray, np.ndarray]] = []
        self.dense: list[tuple[int, int]] = []
        self.waiting = 0
        self.met = 0  # pairs that were compared

    def roots(self) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the points that are joined to another, and of those."""
        everything = np.arange(len(self.values))
        waiting = [(everything[: self.home], everything[self.home :])]
        while waiting:
            own, visit = waiting.pop()
            if not len(own):
                continue
            split = _vantage(self.values[own]) if len(own) > LEAF else None
            if split is None:
                self._leaf(own, visit)
            else:
                waiting += self._sides(*split, own, visit)
        self._join()
        for a, b in self.dense:
            self._dense(np.r_[self._of(a), self._of(b)] if a != b else self._of(a))
        joined = np.flatnonzero(self.parts.root != np.arange(len(self.parts.root)))
        return self.order[joined], self.order[self.parts.root[joined]]

    def _sides(self, vantage: int, radius: int, own: np.ndarray, visit: np.ndarray):
        return _sides(self.values, self.values.dtype.type(vantage), radius, self.block.reach, own, visit)

    def _of(self, entry: int) -> np.ndarray:
        return np.arange(self.begins[entry], self.begins[entry] + self.counts[entry])

    def _leaf(self, own: np.ndarray, visit: np.ndarray) -> None:
        """The pairs of values within reach, one of them at home."""
        for at in range(0, len(own), LEAF):
            rows = own[at : at + LEAF]
            others = np.concatenate([own[at:], visit])
            for to in range(0, len(others), 8_192):
                columns = others[to : to + 8_192]
                near = _distance(self.values[rows][:, None], self.values[columns][None, :]) <= self.block.reach
                a, b = np.divmod(np.flatnonzero(near), len(columns))
                once = b + to >= a  # of two at home
                self._meet(rows[a[once]], columns[b[once]])

    def _meet(self, a: np.ndarray, b: np.ndarray) -> None:
        pairs = self.counts[a] * self.counts[b]
        many = pairs > DENSE
        self.dense += zip(a[many].tolist(), b[many].tolist())
        a, b, pairs = a[~many], b[~many], pairs[~many]
        ends = np.cumsum(pairs)
        at = 0
        while at < len(a):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS)))
            self._compare(a[at:to], b[at:to])
            at = to

    def _compare(self, a: np.ndarray, b: np.ndarray) -> None:
        """All points of some entries with those of others."""
        each, others = self.counts[a], self.counts[b]
        x = np.repeat(self.begins[a] - (np.cumsum(each) - each), each) + np.arange(each.sum())
        n = np.repeat(others, each)
        y = np.repeat(np.repeat(self.begins[b], each) - (np.cumsum(n) - n), n) + np.arange(n.sum())
        x = np.repeat(x, n)
        fits = self._alike(x, y) & (x != y)
        x, y = x[fits], y[fits]
        self.met += len(x)
        apart = np.zeros(len(x), np.uint16)
        for nth, own in enumerate(self.prints):
            apart += _distance(own[x], own[y])
            if 4 * (nth + 1) >= 3 * len(self.prints):  # before, next to none is too far
                fits = apart <= self.bits_apart
                x, y, apart = x[fits], y[fits], apart[fits]
        if len(x):
            self.pending.append((x, y))
            self.waiting += len(x)
            if self.waiting > PAIRS:
                self._join()

    def _alike(self, x, y) -> np.ndarray:
        a, b = self.sizes[x], self.sizes[y]
        return LEAST[0] * np.maximum(a, b) <= LEAST[1] * np.minimum(a, b)

    def _join(self) -> None:
        if self.pending:
            self.parts.join(*map(np.concatenate, zip(*self.pending)))
        self.pending, self.waiting = [], 0

    def _dense(self, points: np.ndarray) -> None:
        """Points of near values, of which many are joined already or will be: these are not met again."""
        waiting, pairs = points, []
        roots = self.parts.root[points]
        while len(waiting):
            same = roots == roots[0]
            start, reached = waiting[0], waiting[same].tolist()
            waiting, roots = waiting[~same], roots[~same]
            while reached and len(waiting):
                x = reached.pop()
                apart = sum(_distance(own[waiting], own[x]).astype(np.uint16) for own in self.prints)
                close = (apart <= self.bits_apart) & self._alike(waiting, x)
                self.met += len(waiting)
                if close.any():
                    new = np.isin(roots, roots[close])
                    pairs.append((np.full(int(close.sum()), start), waiting[close]))
                    reached.extend(waiting[new].tolist())
                    waiting, roots = waiting[~new], roots[~new]
        if pairs:
            self.parts.join(*map(np.concatenate, zip(*pairs)))


def _meeter(blocks: list[Block], bits_apart: int, prints: int):
    def run(table: pa.Table) -> pa.Table:
        home, visit = (
            np.frombuffer(b"".join(table.column(n).to_pylist()), _kind(prints)) for n in ("home", "visit")
        )
        ids, a, b = np.r_[home["set_id"], visit["set_id"]], [], []
        if len(home):
            block = blocks[table.column("place")[0].as_py() >> 32 & 0xFFFF]
            a, b = _Search(np.concatenate([home, visit]), len(home), block, bits_apart).roots()
        return pa.table({"a": pa.array(ids[a], pa.int64()), "b": pa.array(ids[b], pa.int64())})

    return run


def _coarse_links(
    sets: DataFrame, bits_apart: int, prints: int, each: int, reach: int, shard_rows: int
) -> DataFrame:
    """(a, b): links of set_ids, whose components are those of all pairs within reach that are alike in size."""
    names = _names(prints)
    chosen = sets.select(*names).orderBy(F.xxhash64(*names), *names).limit(SAMPLE).toArrow()
    counted = sets.select("size").mapInArrow(_count_bands, "band long, n long")
    bands = {r.band: r.n for r in counted.groupBy("band").agg(F.sum("n").alias("n")).collect()}
    depths = {b: max(0, math.ceil(math.log2(n / (shard_rows * TOGETHER)))) for b, n in sorted(bands.items())}
    blocks = _blocks(prints, each, reach)
    _upper_trees(_points(chosen, prints), max(depths.values(), default=0), blocks)
    dealt = sets.select(*names, "set_id", "size").mapInArrow(
        _dealer(blocks, depths, prints), "place long, home binary, visit binary"
    )
    return dealt.groupBy("place").applyInArrow(_meeter(blocks, bits_apart, prints), "a long, b long")


# --- decisions -----------------------------------------------------------------------------------


def _similar(shingles: np.ndarray, sizes: np.ndarray, side: np.ndarray, apart: bool) -> np.ndarray:
    """The root of each set, joining sets that are similar enough; ``apart``: only those of different sides.

    Reached sets look at those that are not reached yet, by the lists of the sets that have a shingle.
    """
    n = len(sizes)
    _, at = np.unique(shingles, return_inverse=True)
    owner = np.repeat(np.arange(n), sizes)[np.argsort(at, kind="stable")]
    ends = np.cumsum(np.bincount(at, minlength=1))
    begins = ends - np.bincount(at, minlength=1)
    last = np.cumsum(sizes)
    first = last - sizes
    root, waiting = np.arange(n), np.ones(n, bool)

    def near(x: int) -> np.ndarray:
        own = at[first[x] : last[x]]
        count = ends[own] - begins[own]
        places = np.repeat(begins[own] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        shared = np.bincount(owner[places], minlength=n)
        # shared / union >= LEAST, with union = both sizes - shared
        fits = waiting & (shared * sum(LEAST) >= (sizes + sizes[x]) * LEAST[0])
        return np.flatnonzero(fits & (side != side[x]) if apart else fits)

    for start in range(n):
        if not waiting[start]:
            continue
        waiting[start], reached = False, [start]
        while reached:
            new = near(reached.pop())
            root[new], waiting[new] = start, False
            reached.extend(new.tolist())
    return root


def _decide(table: pa.Table) -> pa.Table:
    """Two blocks of a coarse group: a link from each set that is joined to the first of those it is joined to."""
    sets = table.column("shingles").combine_chunks()
    sizes = sets.value_lengths().to_numpy(zero_copy_only=False)
    side = table.column("block").to_numpy()
    apart = table.column("low")[0].as_py() != table.column("high")[0].as_py()
    root = _similar(sets.flatten().to_numpy(zero_copy_only=False), sizes, side, apart)
    ids, joined = table.column("set_id").to_numpy(), root != np.arange(len(root))
    a, b = ids[joined], ids[root[joined]]
    return pa.table({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64())})


def _grouped(sets: DataFrame, prints: int, each: int, reach: int, bits_apart: int, shard_rows: int) -> DataFrame:
    """The sets of coarse groups of more than one set, with their group, its number of blocks and their own block."""
    stars = star_components(_coarse_links(sets, bits_apart, prints, each, reach, shard_rows))
    rooted = sets.join(stars.select(F.col("a").alias("set_id"), F.col("b").alias("root")), "set_id", "left")
    rooted = stored(rooted.select("set_id", "size", "first", F.coalesce("root", "set_id").alias("coarse")), "coarse")
    groups = rooted.groupBy("coarse").agg(F.count("*").alias("n_sets"), F.sum("size").alias("shingles")).where("n_sets > 1")
    groups = groups.select("coarse", "n_sets", F.ceil((F.col("shingles") + 1) / BLOCK_SHINGLES).alias("blocks"))
    found = join_unique(rooted, groups, ["coarse"], "n_sets", rooted.count())
    return stored(found.withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("blocks"))), "grouped")


def _linked(grouped: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """(a, b): links whose components are those of all similar pairs. Only sets in groups are made again."""
    source = grouped.select("first.doc_id", "first.row_key").alias("s")
    same = F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.row_key") == F.col("s.row_key"))
    texts = docs.alias("d").join(source, same, "left_semi").select("text")
    made = texts.mapInArrow(_set_reader(words), "set_id long, shingles array<long>").dropDuplicates(["set_id"])
    met = made.join(grouped.select("set_id", "coarse", "block", "blocks"), "set_id").withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    )
    cells = met.select(
        "coarse", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "set_id", "block", "shingles",
    )
    return cells.groupBy("coarse", "low", "high").applyInArrow(_decide, "a long, b long")


def near_copies(
    docs: DataFrame, words: int, prints: int, each: int, reach: int, bits_apart: int, shard_rows: int
) -> DataFrame:
    """(doc_id, row_key, component), a row for each row of ``docs``.

    Documents whose sets of shingles of ``words`` words have a Jaccard similarity of 0.8 or more are linked, and
    ``component`` names what links reach. Nothing under 0.8 is linked. Sets are compared if links of fingerprints
    (``prints`` numbers of 64 bits, ``each`` blocks in each) that differ in at most ``bits_apart`` bits, and in at most
    ``reach`` bits of one block, lead from one to the other. Texts without words are one component. Very long texts
    are whole sets. Repeated rows and equal texts are one set. An empty table gives an empty one.
    """
    names = _names(prints)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row_key"), "text")
    ddl = _longs(["doc_id", "row_key", "set_id", "size", *names])[0]
    printed = stored(rows.mapInArrow(_printer(words, prints), ddl), "prints")
    sets = printed.groupBy("set_id", "size", *names).agg(F.min(F.struct("doc_id", "row_key")).alias("first"), F.count("*").alias("n"))
    sets = stored(sets, "sets")
    similar = star_components(_linked(_grouped(sets, prints, each, reach, bits_apart, shard_rows), rows, words))
    final = sets.select("set_id", "n").join(
        similar.select(F.col("a").alias("set_id"), F.col("b").alias("root")), "set_id", "left"
    ).select("set_id", "n", F.coalesce("root", "set_id").alias("component"))
    return join_unique(printed, stored(final, "labelled"), ["set_id"], "n", printed.count()).select(
        "doc_id", "row_key", "component"
    )
