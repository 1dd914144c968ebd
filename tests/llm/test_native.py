"""Line dedup, exact dedup, mixing and URL filters against row-at-a-time definitions."""

import hashlib
import re
from collections import Counter, defaultdict

import cases
import pytest

from marketlake.llm import exact_dedup, line_dedup, mixing, textkeys, url_filter

SPACES = " \t\n\x0b\f\r"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def test_ascii_lower(spark):
    odd = ["ABC xyz", "ÀÉ É", "\u212aK İI Σ", "straße ABC", "", None, "ünÜ"]
    df = spark.createDataFrame([(x,) for x in odd], "t string")
    got = [r[0] for r in df.select(textkeys.ascii_lower(df.t)).collect()]
    assert got == [None if x is None else lowered(x) for x in odd]


# --- line dedup ----------------------------------------------------------------------------------


def lines_by_hand(rows):
    place = lambda d: line_dedup.LAST if d is None else d
    first = {}
    for doc_id, text, *_ in rows:
        for line in (text or "").split("\n"):
            key = lowered(line.strip(SPACES))
            if len(key) >= 10:
                first[key] = min(first.get(key, place(doc_id)), place(doc_id))
    out = []
    for doc_id, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if first.get(lowered(x.strip(SPACES)), place(doc_id)) == place(doc_id)]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


@pytest.mark.parametrize("batches,fanout", [(1, 2), (5, 2), (9, 3)])
def test_line_dedup(spark, batches, fanout):
    got = line_dedup.dedup_lines(cases.frame(spark), batches=batches, fanout=fanout).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_text or "") for r in got) == lines_by_hand(cases.rows())
    assert all(r.kept_text is None for r in got if r.text is None)


def test_line_dedup_carries_the_row(spark):
    got = line_dedup.dedup_lines(cases.frame(spark), carry=True).select("doc_id", "text", "row.*").collect()
    assert len(got) == len(cases.rows()) and all(r["size"] == "7" for r in got)


def test_runs_are_compacted_and_dropped(spark):
    runs = line_dedup.LineRuns(spark, fanout=2)
    for n in range(5):
        df = spark.createDataFrame([(h, h, n) for h in range(n * 3, n * 3 + 5)], "h1 long, h2 long, place long")
        runs.add(df)
    assert [len(level) for level in runs.levels] == [1, 2] or len(runs.runs()) <= 4
    seen = {(r.h1, r.place) for r in runs.first_seen().collect()}
    assert seen == {(h, min(n for n in range(5) if n * 3 <= h < n * 3 + 5)) for h in range(17)}
    names = runs.runs()
    runs.drop()
    assert not any(spark.catalog.tableExists(name) for name in names)


def test_runs_leave_the_catalog_after_a_fault(spark, monkeypatch):
    def fails(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(line_dedup.LineRuns, "first_seen", fails)
    with pytest.raises(RuntimeError, match="lost"):
        line_dedup.dedup_lines(cases.frame(spark))
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


def test_line_dedup_of_nothing(spark):
    assert line_dedup.dedup_lines(cases.empty(spark)).count() == 0


# --- exact dedup ---------------------------------------------------------------------------------


@pytest.mark.parametrize("keep,fan,runs", [("largest", 8, None), ("smallest", 2, 16), ("largest", 3, 1)])
def test_exact_groups(spark, keep, fan, runs):
    rows = cases.rows()
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[text or ""].append(doc_id)
    best = {}
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        best[text] = (max if keep == "largest" else min)(known) if known else None
    got = exact_dedup.exact_groups(cases.frame(spark), keep, fan, runs).collect()
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    expected = Counter((d, best[t or ""], len(groups[t or ""]), digest(t or "")) for d, t, *_ in rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == expected
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter({digest(t): 1 for t in groups})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_groups_of_nothing(spark):
    assert exact_dedup.exact_groups(cases.empty(spark)).count() == 0


# --- mixing --------------------------------------------------------------------------------------


def targets_by_hand(sizes):
    """Shares by weight, the excess over the cap shared again until there is none."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target = dict.fromkeys(order, 0.0)
    open_, left = set(order), float(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > 3 * sizes[s] + 1e-9}
        if not over:
            target.update({s: left * weight[s] / total for s in open_})
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def test_mix(spark):
    rows = cases.rows()
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for _, text, _, source, _ in rows:
        sizes[source] += words(text)
    target = targets_by_hand(sizes)
    df = cases.frame(spark)
    got = mixing.mix(df, carry=True).select("*", "row.source").collect()
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((d, words(t)) for d, t, *_ in rows)
    taken = Counter()
    for r in got:
        taken[r.source] += r.taken
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 3 * r["size"]
        assert sum(d.words for d in r.draws or ()) == r.taken
        assert [d["pass"] for d in r.draws or ()] == list(range(1, len(r.draws or ()) + 1))
    for source, t in target.items():
        assert abs(taken[source] - t) <= 0.5 + 1e-6
    again = mixing.mix(df.repartition(5)).collect()
    assert Counter((r.doc_id, r.taken, str(r.draws)) for r in again) == Counter((r.doc_id, r.taken, str(r.draws)) for r in got)


def test_splitting_tree_is_exact_and_random(spark):
    rows = [("=a", 1, b) for b in range(37)] + [("=b", 1, b) for b in range(90)] + [("=b", 2, b) for b in range(3)]
    units = spark.createDataFrame(rows, "source_key string, pass long, block long")
    got = mixing._split(units, 3, seed=1).collect()
    assert sorted((r.source_key, r["pass"], r.block) for r in got) == sorted(rows)
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    other = Counter(r.shard for r in mixing._split(units, 3, seed=2).collect() if r.source_key == "=a")
    assert other != Counter(r.shard for r in got if r.source_key == "=a")


def test_splitting_tree_by_hand(spark):
    """Level by level: the units of a node in the order of their chance, the first half to the left."""
    rows = [(f"={s}", p, b) for s in "abc" for b in range(40) for p in range(1, 1 + len(s) + b % 3)]
    nodes = {0: rows}
    for level in range(3):
        halves = {}
        for node, units in nodes.items():
            chance = lambda u: hashlib.md5(f"9:{level}:{u[0]}:{u[1]}:{u[2]}".encode()).hexdigest()
            ordered = sorted(units, key=chance)
            half = (len(units) + 1) // 2
            halves[2 * node], halves[2 * node + 1] = ordered[:half], ordered[half:]
        nodes = halves
    units = spark.createDataFrame(rows, "source_key string, pass long, block long")
    got = {(r.source_key, r["pass"], r.block): r.shard for r in mixing._split(units, 3, seed=9).collect()}
    assert got == {unit: node for node, units in nodes.items() for unit in units}


def test_mix_of_many_sources(spark):
    rows = [(i, "w " * (1 + i % 7), None, f"host{i % 5000:04d}", 0) for i in range(10_000)]
    got = mixing.mix(spark.createDataFrame(rows, cases.SCHEMA)).collect()
    sizes, taken = Counter(), Counter()
    for r, source in ((r, f"host{r.doc_id % 5000:04d}") for r in got):
        sizes[source] += r["size"]
        taken[source] += r.taken
    target = targets_by_hand(sizes)
    assert len(got) == 10_000 and all(abs(taken[s] - target[s]) <= 0.5 + 1e-6 for s in sizes)


def test_tree_decides_what_is_taken(spark, monkeypatch):
    """A shard's units that are lost on the way are words that are not taken."""
    whole = {r.doc_id: r for r in mixing.mix(cases.frame(spark)).collect() if r.doc_id is not None}
    split = mixing._split
    monkeypatch.setattr(mixing, "_split", lambda *a: split(*a).where("shard <> 3"))
    lost = 0
    for r in mixing.mix(cases.frame(spark)).select("doc_id", "taken").collect():
        if r.doc_id is not None:
            in_three = sum(d.words for d in whole[r.doc_id].draws or () if d.shard == 3)
            assert r.taken == whole[r.doc_id].taken - in_three
            lost += in_three
    assert lost > 0


def test_mix_of_nothing(spark):
    assert mixing.mix(cases.empty(spark)).count() == 0
    wordless = cases.frame(spark, [(1, None, None, None, None), (2, " ", None, "a", 1)])
    assert {(r.taken, r.target, r.draws) for r in mixing.mix(wordless).collect()} == {(0, 0.0, None)}


# --- URL filters ---------------------------------------------------------------------------------

URLS = [
    None, "", "no scheme", "://", "http://", "http://EXAMPLE.com", "http://example.com/", "http://example.com?x=/en/",
    "http://example.com/en/", "https://a.B.example.com/en/x?y#z", "ftp://www.example.com/en/", "http://xexample.com/en/",
    "http://www.example.com/En/", "http://net/es/", "http://x.net/fr/1", "http://x.net/frx", "http://a..com/x",
    "http://example.com:80/en/", "http://.com/", "http://com/", "x://com.net/es/#/fr/", "http://ÉX.com/é", "a://b://c.com/",
    "http://" + "a." * 5000 + "com/" + "p" * 5000,
]


def judged_by_hand(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    raw = re.match(r"[^/?#]*", rest)[0]
    host, path = lowered(raw), re.match(r"[^?#]*", rest[len(raw):])[0]
    fits = [
        (len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, None, url_filter.DEFAULT_VERDICT))
    return host, path, best[1], best[2]


@pytest.mark.parametrize("rules", [url_filter.RULES, [("block", "b.example.com", "/e"), ("allow", "com", ""), ("block", "c.com", "/")]])
def test_urls(spark, rules):
    data = [(i, url, "h", "r") for i, url in enumerate(URLS)] + [(5, URLS[5], "h", "r"), (None, URLS[8], "h", "r")]
    pages = spark.createDataFrame(data, "page_id long, url string, host string, rule string")
    got = url_filter.judge_urls(pages, rules).collect()
    expected = Counter((d[0], *judged_by_hand(d[1], rules)) for d in data)
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got) == expected


def test_urls_of_nothing(spark):
    assert url_filter.judge_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0
