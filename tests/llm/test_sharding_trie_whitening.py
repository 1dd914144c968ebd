"""Sharding, the prefix trie and whitening against versions that hold everything in memory."""

from __future__ import annotations

import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import empty, frame, rows
from pyspark.sql import functions as F

from marketlake.llm import prefix_trie, sharding, whitening


# --- sharding ---------------------------------------------------------------------------------------------------


def least_capacity(sizes: list[int], shards: int) -> int:
    """By dynamic programming over all contiguous partitions."""
    sums = [0, *itertools.accumulate(sizes)]
    best = sums[:]
    for _ in range(shards - 1):
        best = [min(max(best[j], sums[i] - sums[j]) for j in range(i + 1)) for i in range(len(sums))]
    return best[-1]


def ordered_groups(data) -> list[tuple[str, int]]:
    """(text, bytes) of the groups in order; null ids come first."""
    ids, sizes = defaultdict(list), Counter()
    for doc_id, text, *_ in data:
        ids[text or ""].append(doc_id)
        sizes[text or ""] += len((text or "").encode()) + 1
    def first(text):
        known = [i for i in ids[text] if i is not None]
        return (bool(known), min(known, default=0), hashlib.sha256(text.encode()).digest())
    return [(text, sizes[text]) for text in sorted(ids, key=first)]


@pytest.mark.parametrize("shards, buckets", [(1, 4), (3, 2), (5, 3), (16, 8192), (200, 5)])
def test_no_partition_has_a_smaller_largest_shard(spark, shards, buckets):
    out = sharding.minimax_shards(frame(spark), shards, buckets=buckets).collect()
    data = rows()
    groups = ordered_groups(data)
    assert len(out) == len(data)
    sizes = Counter()
    for r in out:
        sizes[r.shard] += r.size
    assert max(sizes.values()) == least_capacity([s for _, s in groups], shards)
    assert set(sizes) <= set(range(shards)) and sum(sizes.values()) == sum(s for _, s in groups)
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_groups_are_whole_and_in_order(spark):
    out = sharding.minimax_shards(frame(spark), 5, carry=True).collect()
    shard_of = defaultdict(set)
    for r in out:
        text = r.row.text or ""
        assert (r.size, r.text_crc32) == (len(text.encode()) + 1, zlib.crc32(text.encode()))
        assert (r.law, r.grown_shard, r.row.doc_id, r.row.shard) == ("bytes", None, r.doc_id, "7")
        shard_of[text].add(r.shard)
    assert all(len(s) == 1 for s in shard_of.values())
    in_order = [min(shard_of[text]) for text, _ in ordered_groups(rows())]
    assert in_order == sorted(in_order)


@pytest.mark.parametrize("buckets", [2, 7, 1000])
def test_capacity_whatever_the_sums_look_like(spark, buckets):
    rng = random.Random(buckets)
    for sizes in ([1] * 50, [rng.randint(1, 5000) for _ in range(300)], [3, 10**9, 2, 10**9, 1], [10**12, *[1] * 200], [5]):
        upto = list(itertools.accumulate(sizes))
        groups = spark.createDataFrame([(s, u, i + 1) for i, (s, u) in enumerate(zip(sizes, upto))], "bytes long, upto long, nth long")
        for shards in (1, 2, 7):
            capacity, known = sharding.smallest_capacity(groups, shards, buckets)
            assert capacity == least_capacity(sizes, shards)
            cuts = [0, *sharding.even_cuts(known, shards, capacity), upto[-1]]
            assert len(cuts) == shards + 1 and set(cuts) <= {0, *upto}
            assert all(0 <= b - a <= capacity for a, b in zip(cuts, cuts[1:]))


def test_large_group_leaves_no_shard_empty(spark):
    data = [(i, "x" * 100 if i % 3 == 0 else f"text {i}", None, None, None) for i in range(600)]
    out = sharding.minimax_shards(frame(spark, data, clashing=False), 8).groupBy("shard").agg(F.sum("size").alias("s")).collect()
    sizes = sorted(r.s for r in out)
    assert len(sizes) == 8 and sizes[-1] == 200 * 101 and sizes[-2] < 2 * sizes[0]


def test_shards_of_nothing_and_written_shards(spark, tmp_path):
    assert sharding.minimax_shards(empty(spark)).count() == 0
    sharding.write_shards(frame(spark, clashing=False), str(tmp_path / "shards"), 4)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert Counter((r.doc_id, r.text) for r in back.collect()) == Counter((r[0], r[1]) for r in rows())
    sizes = back.groupBy("shard").count().collect()
    assert len(sizes) == 4


# --- prefix trie ------------------------------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, node string, depth double"


def conversations(seed: int = 3) -> list[tuple]:
    rng = random.Random(seed)
    said = ["hello", "hello there", "", None, " \t", "go on then", "é à", "word " * 3000]
    out = []
    for c in [*range(45), -20, -7, -1, 1000, 1003, 10**12]:
        for t in range(rng.choice([1, 1, 2, 3, 4, 6])):
            out.append((c, t, ["user", "assistant", None][t % 3], rng.choice(said[: 3 if t < 2 else 8])))
    out += [(7, None, "system", "null comes first"), (7, 0, "user", "a tie"), (8, 5, "user", "again"), (8, 5, "user", "again")]
    out += [(21, t, "user", "same") for t in range(30)] + [(None, 0, "user", "no conversation"), (41, None, None, None)]
    rng.shuffle(out)
    return [(*r, "clash", 1.5) for r in out]


def brute_trie(data) -> set[tuple]:
    own = defaultdict(list)
    for c, turn, role, text, *_ in data:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own[c].append(((turn is not None, turn or 0), role, digest, (role, text)))
    own = {c: [t[-1] for t in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        lender = c - int(np.fmod(c, 20))
        whole[c] = tuple(own.get(lender, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    parents = Counter(p[:-1] for p in members if p)
    out = set()
    for p, convs in members.items():
        below = [q for q in members if q[: len(p)] == p]
        ends = ",".join(str(c) for c in sorted(convs) if len(whole[c]) == len(p))
        out.add((
            min(convs), len(p), min(members[p[:-1]]) if p else None, len(convs), parents[p],
            sum(not parents[q] for q in below),
            sum((len(members[q]) - 1) * len(q[-1][1].split()) for q in below if q), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


@pytest.mark.parametrize("end, stretch", [(16_384, 4_096), (10, 2)])
def test_trie_is_the_brute_force_trie(spark, monkeypatch, end, stretch):
    """Also with a list that is contracted many times over, and with everything cut into stretches of two."""
    monkeypatch.setattr(prefix_trie, "STRETCH", stretch)
    monkeypatch.setattr(prefix_trie, "SIBLINGS", stretch)
    monkeypatch.setattr(prefix_trie, "TOUR_STRETCH", stretch * 3)
    data = conversations()
    out = prefix_trie.prefix_trie(spark.createDataFrame(data, TURNS).repartition(3), end).collect()
    assert len(out) == len({tuple(r) for r in out})
    assert {tuple(r) for r in out} == brute_trie(data)


def test_list_rank_undoes_its_rounds(spark):
    rng = random.Random(5)
    arcs = rng.sample(range(10**9), 500)
    links = spark.createDataFrame(list(zip(arcs, [*arcs[1:], None])), "arc long, next long").repartition(3)
    places = {r.arc: r.place for r in prefix_trie.list_rank(links, end=4).collect()}
    assert places == {arc: i for i, arc in enumerate(arcs)}


def test_hash_of_many_ids_comes_in_pieces(spark):
    """One node where 2,000 conversations end, some ids far apart."""
    ids = [*range(0, 38_000, 20), *range(10**9, 10**9 + 2_000, 20)]
    data = [(c, 0, "user", "same") for c in ids]
    out = prefix_trie.prefix_trie(spark.createDataFrame(data, "conv_id long, turn long, role string, text string")).collect()
    leaf = next(r for r in out if r.depth == 1)
    assert leaf.ends_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert (leaf.n_convs, leaf.saved_tokens, len(out)) == (len(ids), len(ids) - 1, 2)


def test_trie_of_nothing(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], TURNS)).count() == 0
    assert prefix_trie.prefix_trie(spark.createDataFrame([(None, 1, "user", "x", "", 0.0)], TURNS)).count() == 0


# --- whitening --------------------------------------------------------------------------------------------------

VECTORS = "vec_id long, vector array<float>, n string, x int"


def vectors(n: int = 300, dim: int = 12, seed: int = 2) -> list[tuple]:
    rng = np.random.default_rng(seed)
    made = (rng.normal(size=(n, dim)) * np.geomspace(2, 0.2, dim)).astype(np.float32)
    out = [(i, v.tolist(), "clash", 1) for i, v in enumerate(made)]
    nan, inf = float("nan"), float("inf")
    fill = [0.0] * (dim - 1)
    bad = [None, [], [nan, *fill], [inf, *fill], [None, *fill], [-inf, *fill], [1e30, *fill], [1.0, 2.0]]
    return out + out[:40] + [(None, out[0][1], "", 1)] + [(1000 + i, v, "", 1) for i, v in enumerate(bad)]


def test_whitening_equals_a_full_decomposition(spark):
    data = vectors()
    out = whitening.whiten(spark.createDataFrame(data, VECTORS).repartition(3), "vector", components=5).collect()
    good = [r for r in data if r[0] is None or r[0] < 1000]
    assert Counter((r.vec_id, r.component) for r in out) == Counter((r[0], k) for r in good for k in range(1, 6))
    x = np.floor(np.asarray([r[1] for r in good], np.float32).astype(float) * 64).astype(np.int64) + 1_000_000
    n = len(x)
    z = (x * n - x.sum(axis=0)) / n
    v = z.T @ z / n
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1], axes[:, ::-1]
    white = z @ axes / np.sqrt(values)
    expected = {(r[0], k + 1): white[i, k] for i, r in enumerate(good) for k in range(5)}
    deviation = {r[0]: int(((x[i] * n - x.sum(axis=0)) ** 2).sum()) for i, r in enumerate(good)}
    signs = defaultdict(set)
    for r in out:
        want = expected[r.vec_id, r.component]
        assert abs(r.whitened) == pytest.approx(abs(want), rel=1e-9, abs=1e-9)
        signs[r.component].add(np.sign(r.whitened * want))
        assert (r.n, r.deviation) == (n, deviation[r.vec_id])
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(v), rel=1e-12)
        assert r.identity_error < 1e-12
    assert all(len(s - {0.0}) == 1 for s in signs.values())


@pytest.mark.parametrize("dim, wanted, block, kind", [
    (64, 32, None, "spread"), (120, 6, 3, "steep"), (150, 5, 3, "repeated"), (90, 8, 4, "rank"), (1, 4, None, "spread"),
])
def test_jacobi_davidson_reaches_double_precision(dim, wanted, block, kind):
    rng = np.random.default_rng(4)
    values = {
        "spread": np.sort(rng.exponential(1, dim))[::-1], "steep": 0.8 ** np.arange(dim),
        "repeated": np.where(np.arange(dim) < 7, 3.0, 1.0), "rank": np.where(np.arange(dim) < 3, 3.0 - np.arange(dim), 0.0),
    }[kind]
    q = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    a = (q * values) @ q.T
    found, axes, residuals = whitening.jacobi_davidson(lambda c: a @ c, dim, wanted, block=block)
    want = values[: min(wanted, dim)]
    assert np.abs(found - want).max() < 1e-13 * want[0] * dim
    assert residuals.max() < 1e-12 * want[0]
    assert np.abs(axes.T @ axes - np.eye(len(want))).max() < 1e-12


def test_corrections_solve_the_projected_equations():
    rng = np.random.default_rng(6)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    found = np.linalg.qr(rng.standard_normal((30, 4)))[0]
    values, rhs = np.asarray([0.3, -0.7]), rng.standard_normal((30, 2))
    t = whitening.corrections(lambda c: a @ c, found, values, rhs, steps=80, gain=1e-12)
    off = np.eye(30) - found @ found.T
    for k in range(2):
        assert np.abs(off @ (a - values[k] * np.eye(30)) @ t[:, k] + off @ rhs[:, k]).max() < 1e-8
        assert np.abs(found.T @ t[:, k]).max() < 1e-12


def test_deviations_beyond_a_long_are_exact_or_null(spark):
    # n * x still fits where the sum of squares does not.
    data = [(1, [2.0**40, 1.0], "", 1), (2, [0.0, 2.0], "", 1), (3, [1.0, 1.0], "", 1)]
    out = whitening.whiten(spark.createDataFrame(data, VECTORS), "vector", 2).collect()
    assert {r.deviation for r in out} == {None} and {r.component for r in out} <= {1, 2}


def test_whitening_without_variance_or_vectors(spark):
    for data in ([], [(1, None, "", 1)], [(1, [1.0, 2.0], "", 1)], [(i, [0.5, 0.25], "", 1) for i in range(50)]):
        assert whitening.whiten(spark.createDataFrame(data, VECTORS), "vector").count() == 0
    # Two of three directions vary.
    rng = np.random.default_rng(8)
    data = [(i, [float(a), float(b), 1.0], "", 1) for i, (a, b) in enumerate(rng.normal(size=(40, 2)))]
    assert {r.component for r in whitening.whiten(spark.createDataFrame(data, VECTORS), "vector").collect()} == {1, 2}
