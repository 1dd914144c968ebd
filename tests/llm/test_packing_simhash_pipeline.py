"""Packing by exact round trip, SimHash groups and the pipeline by brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import cases
import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from marketlake.llm import mixing, near_copies, packing, simhash
from marketlake.llm.common import stored

# --- packing -------------------------------------------------------------------------------------

TOKENIZER = Tokenizer.from_file(packing.tokenizer_path())
ODD = [
    "l'été d'Été's 'S don'T it'LL", "÷×µªº ÿŸß ẞ œ", "á é é", "a\x0bb\x1cc\x85d\xa0e f", "<|endoftext|> x<|endoftext|>y",
    "日本語 テスト", "Σας ΟΔΟΣ", "İstanbul KK", "123 4567 a1b2 ²½", "---...!!!%%%", "\x00a b", "🙂👍🏽", "x" * 300, "",
]


def test_word_ids_are_the_tokenizers():
    words = packing.WordIds(packing.tokenizer_path())
    for text in ODD + [t or "" for t in cases.texts()]:
        assert np.frombuffer(words.of(text), "<u4").tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


def histogram(lengths):
    return Counter(length for n in lengths for _, length, *_ in packing._cut(bytes(4 * n)))


@pytest.mark.parametrize("lengths", [
    [], [1], [4096] * 3, [64] * 65, [2570] * 100, [2600, 2100] * 50, [4095] * 50, list(range(1, 5000, 7)),
    np.random.default_rng(1).lognormal(6, 1, 3000).astype(int) + 1,
])
def test_plan_uses_every_rank_once_without_gaps(lengths):
    counts = histogram(lengths)
    plan = packing.plan_packing(counts)
    sequences = defaultdict(list)
    for length, n in counts.items():
        for rank in range(n):
            at = 0
            for start, size, sequence, offset in plan.place(length, rank):
                assert start == at and size > 0
                at += size
                sequences[sequence].append((offset, size))
            assert at == length
    assert sorted(sequences) == list(range(plan.sequences))
    for parts in sequences.values():
        end = 0
        for offset, size in sorted(parts):
            assert offset == end
            end += size
        assert end <= packing.CAPACITY
    assert plan.sequences <= sum(lengths) // packing.CAPACITY + 2


def test_column_generation_finds_the_optimum():
    # 2 of 5 and 3 of 3 fill 10 and 9 of 10; 20 pieces of 5 and 30 of 3 need 10 + 10 sequences
    patterns, cuts = packing.column_generation(np.asarray([3, 5]), np.asarray([30.0, 20.0]), 10, None)
    assert not cuts and sum(x for _, x in patterns) == pytest.approx(20, abs=0.01)


def test_crcs_of_units_are_joined():
    data = random.Random(1).randbytes(4 * packing.UNIT * 5)
    units = np.asarray([zlib.crc32(data[i : i + 4 * packing.UNIT]) for i in range(0, len(data), 4 * packing.UNIT)])
    assert packing._joined_crc(units) == zlib.crc32(data)


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


@pytest.mark.parametrize("few", [False, True])
def test_pack_round_trip(spark, few):
    rng = random.Random(4)
    rows = cases.rows() + [(2000 + i, cases.sentence(rng, 1500), None, None, 0) for i in range(0 if few else 20)]
    got = packing.pack(cases.frame(spark, rows)).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    expected = defaultdict(list)
    for doc_id, text, *_ in rows:
        expected[doc_id].append(ids_of(text))
    assert set(pieces) == set(expected)
    for doc_id, documents in expected.items():
        # Repeated rows are equal, so their pieces can be told apart by nothing.
        ids, times = documents[0], len(documents)
        covered = Counter()
        for start, length, crc, tokens in pieces[doc_id]:
            assert tokens == len(ids) and crc == zlib.crc32(np.asarray(ids[start : start + length], "<u4").tobytes())
            covered.update(range(start, start + length))
        assert covered == Counter(dict.fromkeys(range(len(ids)), times))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= packing.CAPACITY
    total = sum(r.length for r in got)
    assert len(sequences) * packing.CAPACITY - total < 2 * packing.CAPACITY


def test_pack_of_nothing(spark):
    assert packing.pack(cases.empty(spark)).count() == 0


# --- SimHash -------------------------------------------------------------------------------------


def simhash_by_hand(text, words):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    split = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not split:
        return 0
    shingles = [" ".join(split[i : i + words]) for i in range(len(split) - words + 1)] or [" ".join(split)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(n, linked):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        root[find(a)] = find(b)
    return [find(x) for x in range(n)]


def test_fingerprints():
    for text in [*cases.texts(), *ODD]:
        assert int(simhash.fingerprint(text or "", 4)[0]) == simhash_by_hand(text, 4)
    several = simhash.fingerprint("some words that are hashed three times over", 5, prints=3)
    assert len({int(x) for x in several}) == 3
    assert several[0] == simhash.fingerprint("some words that are hashed three times over", 5)[0]


def test_near_groups(spark):
    rows = cases.rows()
    got = simhash.near_groups(cases.frame(spark), words=4, bits_apart=4).collect()
    prints = [simhash_by_hand(r[1], 4) for r in rows]
    linked = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    root = components(len(rows), linked)
    smallest = {}
    for r, (doc_id, *_) in zip(root, rows):
        if doc_id is not None:
            smallest[r] = min(smallest.get(r, doc_id), doc_id)
    expected = Counter((row[0], p, smallest.get(r)) for row, p, r in zip(rows, prints, root))
    assert Counter((r.doc_id, r.fp0 % (1 << 64), r.component_id) for r in got) == expected
    assert simhash.near_groups(cases.empty(spark)).count() == 0


@pytest.mark.parametrize("shard_rows,prints,bits_apart,each", [(100, 1, 4, 3), (37, 1, 7, 4), (60, 2, 6, 2), (10_000, 1, 4, 3)])
def test_links_are_exact(spark, shard_rows, prints, bits_apart, each):
    """Random fingerprints, chains of neighbours and a dense ball, which brute force can still compare."""
    rng = random.Random(shard_rows)
    points = {tuple(rng.getrandbits(64) for _ in range(prints)) for _ in range(500)}
    for _ in range(20):
        point = list(rng.choice(sorted(points)))
        for _ in range(15):
            point[rng.randrange(prints)] ^= sum(1 << rng.randrange(64) for _ in range(rng.randint(1, 4)))
            points.add(tuple(point))
    centre = [rng.getrandbits(64) for _ in range(prints)]
    for _ in range(700):
        points.add(tuple(c ^ (1 << rng.randrange(8)) ^ (1 << rng.randrange(64)) for c in centre))
    points = sorted(points)
    signed = [tuple(x - (1 << 64) if x >> 63 else x for x in p) for p in points]
    names = [f"fp{n}" for n in range(prints)]
    classes = spark.createDataFrame(signed, ", ".join(f"{n} long" for n in names))
    keyed = classes.withColumn("key", simhash._key(prints))
    stars = simhash.star_components(simhash.links(classes, bits_apart, prints, each, shard_rows=shard_rows))
    root = {r.a: r.b for r in stars.collect()}
    got = defaultdict(set)
    for r in keyed.collect():
        got[root.get(r.key, r.key)].add(tuple(r[n] for n in names))
    matrix = np.asarray(points, np.uint64)
    linked = [
        (i, int(j)) for i in range(len(points))
        for j in np.flatnonzero(np.bitwise_count(matrix ^ matrix[i]).sum(axis=1) <= bits_apart) if j < i
    ]
    expected = defaultdict(set)
    for r, p in zip(components(len(points), linked), signed):
        expected[r].add(p)
    assert {frozenset(x) for x in got.values()} == {frozenset(x) for x in expected.values()}


def test_star_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 90), (90, 95), (95, 100)] + [(500, x) for x in range(501, 540)]
    df = spark.createDataFrame(edges + edges[:3], "a long, b long")
    got = {r.a: r.b for r in simhash.star_components(df).collect()}
    assert got == {**{i: 0 for i in range(1, 31)}, 95: 90, 100: 90, **{x: 500 for x in range(501, 540)}}


# --- the pipeline --------------------------------------------------------------------------------


def ran(spark, docs, until):
    for name, stage in pipeline.STAGES:
        docs = stored(stage(spark, docs, ""), name)
        yield name, docs
        if name == until:
            return


def test_pipeline_stages(spark):
    rng = random.Random(9)
    rows = cases.rows()
    base = [cases.sentence(rng, 120) for _ in range(10)]
    near = [t.rsplit(" ", 2)[0] + " something else" for t in base]
    rows += [(3000 + i, t, "en", "a", len(t)) for i, t in enumerate(base)]
    rows += [(4000 + i, t, "en", "b", len(t)) for i, t in enumerate(near)]
    docs = cases.frame(spark, rows)
    columns = docs.columns
    results = dict(ran(spark, docs, "packing"))
    assert all(results[name].columns == columns for name in ("language_id", "line_dedup", "near_dedup", "mixing"))

    has_letter = Counter(r[0] for r in rows if r[1] and any(c.isalpha() for c in r[1]))
    kept = Counter(r.doc_id for r in results["language_id"].collect())
    assert kept <= has_letter and sum(kept.values()) > 0.9 * sum(has_letter.values())

    lines = {(r.doc_id, r.text) for r in results["line_dedup"].collect()}
    assert sum(kept.values()) == results["line_dedup"].count()
    assert all(r.n_chars == len(r.text) for r in results["line_dedup"].collect())
    keys = Counter(
        key for _, text in lines for key in {x.strip(" \t\n\x0b\f\r").lower() for x in text.split("\n")} if len(key) >= 10
    )
    assert not [key for key, n in keys.items() if n > 1 and key.isascii()]

    alone = results["near_dedup"].collect()
    texts = {r.text for r in alone}
    assert texts <= {text for _, text in lines} and len(texts) == len(alone)
    for i in range(10):
        assert sum(r.doc_id in (3000 + i, 4000 + i) for r in alone) == 1
    far = [r for r in lines if r[0] is not None and r[0] < 1000 and len(r[1].split()) > 60]
    assert sum(r[0] in {x.doc_id for x in alone} for r in far) > 0.9 * len(far)

    mixed = results["mixing"].collect()
    assert max(Counter((r.doc_id, r.text) for r in mixed).values()) <= 3
    assert {(r.doc_id, r.text) for r in mixed} <= {(r.doc_id, r.text) for r in alone}

    packed = results["packing"].collect()
    assert sum(r.length for r in packed) == sum(len(ids_of(r.text)) for r in mixed)


def planted(shared, own, at):
    """Two texts of distinct words; their sets have ``shared`` shingles in common and ``own`` more each."""
    words = [f"w{at}x{i}" for i in range(shared + 4)]
    return [" ".join([*words, *(f"{side}{at}y{i}" for i in range(own))]) for side in "ab"]


def test_near_dedup_decides_by_the_shingles(spark):
    """Pairs of a Jaccard similarity of 0.75 stay, pairs of 0.80 and 0.85 lose one."""
    kinds = {0.75: (150, 25), 0.80: (160, 20), 0.85: (170, 15)}
    rows, pair_of = [], {}
    for kind, (shared, own) in kinds.items():
        for _ in range(60):
            for text in planted(shared, own, len(rows)):
                pair_of[len(rows)] = (kind, len(rows) // 2)
                rows.append((len(rows), text, "en", "a", len(text)))
    kept = Counter(pair_of[r.doc_id] for r in pipeline.near_dedup(spark, cases.frame(spark, rows), "").collect())
    assert len(kept) == 180
    for kind in kinds:
        assert {n for (k, _), n in kept.items() if k == kind} == {2 if kind < 0.8 else 1}


def test_near_dedup_links_like_all_pairs(spark):
    """Chains, a large group, short texts and repeats, over several shards."""
    rng = random.Random(6)
    texts = [" ".join(f"v{rng.randrange(3000)}" for _ in range(rng.choice([6, 9, 14, 60, 200]))) for _ in range(150)]
    for _ in range(250):
        words = rng.choice(texts).split()
        words[rng.randrange(len(words))] = "changed"
        texts.append(" ".join(words + ["more"] * rng.randrange(2)))
    hot = texts[0].split() * 3 + [f"h{i}" for i in range(200)]
    texts += [" ".join([*hot, f"last{i}"]) for i in range(400)] + ["", " ", None, texts[3], texts[3]]
    docs = cases.frame(spark, [(i, t, "en", "a", 0) for i, t in enumerate(texts)])
    got = defaultdict(set)
    for r in near_copies.near_copies(docs, **{**pipeline.NEAR, "shard_rows": 100}).collect():
        got[r.component].add(r.doc_id)
    sets = [{" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := (t or "").split()) else set() for t in texts]
    linked = [(i, j) for i in range(len(sets)) for j in range(i) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    expected = defaultdict(set)
    for i, root in enumerate(components(len(sets), linked)):
        expected[root].add(i)
    assert {frozenset(x) for x in got.values()} == {frozenset(x) for x in expected.values()}


def test_mixing_is_written_by_shard(spark):
    rng = random.Random(3)
    rows = [(i, cases.sentence(rng, 20) + f" {i}", "en", "ab"[i % 2], 0) for i in range(300)]
    docs = cases.frame(spark, rows)
    draws = [(d.shard, d.shuffle_key, r.doc_id) for r in mixing.mix(docs).collect() for d in r.draws or () if 2 * d.words >= r["size"]]
    assert [r.doc_id for r in pipeline.mixing(spark, docs, "").collect()] == [doc_id for *_, doc_id in sorted(draws)]


def test_pipeline_of_nothing(spark):
    assert [df.count() for _, df in ran(spark, cases.empty(spark), "packing")] == [0] * 5


def test_pipeline_run(spark, tmp_path):
    cases.frame(spark, clashing=False).write.parquet(str(tmp_path / "documents.parquet"))
    assert pipeline.run(spark, str(tmp_path)).count() > 0
