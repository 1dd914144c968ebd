"""The coarse search of near copies against all pairs, and how many pairs it compares."""

import math

import numpy as np
import pyarrow as pa
import pytest

from marketlake.llm import near_copies, simhash

PRINTS, BITS_APART = 4, 72


def points_of(n, near, sizes=(1, 400), seed=1):
    """Random sets, ``near`` of which are made from others by turning some bits and changing the size."""
    rng = np.random.default_rng(seed)
    points = np.empty(n, near_copies._kind(PRINTS))
    points["prints"] = rng.integers(0, 1 << 64, (n, PRINTS), dtype=np.uint64)
    points["set_id"], points["size"] = rng.permutation(n) - n // 2, rng.integers(*sizes, n)
    for _ in range(near):
        a, b = rng.integers(0, n, 2)
        turned = np.packbits(rng.random(64 * PRINTS) < 0.15).view(np.uint64)
        points["prints"][b] = points["prints"][a] ^ turned
        points["size"][b] = max(1, points["size"][a] * rng.uniform(0.7, 1.4))
    return points


def all_pairs(points, blocks, homes=None):
    """Roots by all pairs of which one is at home: near on all bits, within reach in a block, alike in size."""
    parts, sizes = simhash._Components(len(points)), points["size"].astype(int)
    values = [block.of(points["prints"].T) for block in blocks]
    for i in range(len(points) if homes is None else homes):
        near = np.bitwise_count(points["prints"] ^ points["prints"][i]).sum(axis=1) <= BITS_APART
        near &= np.any([np.bitwise_count(v ^ v[i]) <= b.reach for v, b in zip(values, blocks)], axis=0)
        near &= 4 * np.maximum(sizes, sizes[i]) <= 5 * np.minimum(sizes, sizes[i])
        to = np.flatnonzero(near)
        parts.join(np.full(len(to), i), to)
    return parts.root


def joined(n, a, b):
    parts = simhash._Components(n)
    parts.join(np.asarray(a, int), np.asarray(b, int))
    return parts.root


def test_alike_sizes_lie_in_neighbouring_bands():
    edges, sizes = near_copies.EDGES, np.arange(0, 5_000)
    band = near_copies._band(sizes)
    assert band[0] == 0 and (edges[band] <= sizes).all() and (sizes < edges[band + 1]).all()
    for size in sizes.tolist():
        alike = sizes[(sizes >= size) & (4 * sizes <= 5 * size)]
        assert set(band[alike]) <= {band[size], band[size] + 1}
        if band[alike[-1]] > band[size]:
            assert 5 * size >= 4 * edges[band[size] + 1]


@pytest.mark.parametrize("homes", [1_500, 2_000])
def test_search_joins_what_all_pairs_join(homes):
    points = points_of(2_000, 1_000)
    for block in simhash._blocks(PRINTS, 4, 2)[::5]:
        got = near_copies._Search(points, homes, block, BITS_APART).roots()
        assert np.array_equal(joined(len(points), *got), all_pairs(points, [block], homes))


def test_search_of_many_copies_compares_no_square():
    """A thousand near copies of one set with one value are joined by fewer comparisons than they have pairs."""
    points = points_of(1_500, 0, (100, 110))
    block = simhash._blocks(PRINTS, 4, 2)[0]
    points["prints"][:1_000] = points["prints"][0]
    points["prints"][:1_000, 3] ^= np.uint64(1) << (np.arange(1_000) % 64).astype(np.uint64)
    search = near_copies._Search(points, len(points), block, BITS_APART)
    assert np.array_equal(joined(len(points), *search.roots()), all_pairs(points, [block]))
    assert search.met < 100_000


def test_search_compares_values_within_reach_only():
    """Before, leaves compared all they held: at 20,000 sets several pairs in a hundred, instead of two in a thousand."""
    points = points_of(20_000, 0, (100, 110))
    block = simhash._blocks(PRINTS, 4, 2)[2]
    search = near_copies._Search(points, len(points), block, BITS_APART)
    search.roots()
    in_reach = (1 + 16 + 120) / (1 << 16)
    assert search.met < 1.1 * in_reach * math.comb(20_000, 2)


@pytest.mark.parametrize("depth", [0, 3])
def test_dealt_sets_meet_like_all_pairs(monkeypatch, depth):
    """Over all bands, blocks and nodes of the upper trees; in several packets, which hold each set a few times only."""
    monkeypatch.setattr(near_copies, "DEALT_ROWS", 500)
    points = points_of(2_000, 1_200)
    blocks = simhash._blocks(PRINTS, 4, 2)
    simhash._upper_trees(np.ascontiguousarray(points["prints"].T), depth, blocks)
    depths = dict.fromkeys(np.unique(near_copies._band(points["size"])).tolist(), depth)
    names = [f"fp{n}" for n in range(PRINTS)]
    columns = [pa.array(x) for x in np.ascontiguousarray(points["prints"].T).view(np.int64)]
    batch = pa.RecordBatch.from_arrays(
        [*columns, pa.array(points["set_id"]), pa.array(points["size"].astype(np.int64))], names=[*names, "set_id", "size"]
    )
    batches = [batch.slice(at, 300) for at in range(0, len(points), 300)]
    dealt = pa.Table.from_batches(near_copies._dealer(blocks, depths, PRINTS)(batches))
    meet, found = near_copies._meeter(blocks, BITS_APART, PRINTS), []
    for place in set(dealt.column("place").to_pylist()):
        found.append(meet(dealt.filter(pa.compute.equal(dealt.column("place"), place))))
    links = pa.concat_tables(found)
    at = np.argsort(points["set_id"])
    a, b = (at[np.searchsorted(points["set_id"][at], links.column(n).to_numpy())] for n in "ab")
    assert np.array_equal(joined(len(points), a, b), all_pairs(points, blocks))
    # Without a tree a set is at home in one place of a block and visits one more at most.
    size = near_copies._kind(PRINTS).itemsize
    copies = sum(len(x) for n in ("home", "visit") for x in dealt.column(n).to_pylist()) / size / len(points)
    assert copies <= 2 * len(blocks) if depth == 0 else copies > len(blocks)
