"""Document fingerprints by I-Match over randomised lexicon subsets.

The lexicon keeps the terms within a band of inverse document frequency, counted over all documents. A term is the
64-bit hash of a word. Frequent terms (more than one in ``LISTED`` of all) are at most ``LISTED`` and go to the tasks
as a list; the others are joined to the lexicon in Spark, so that neither grows with the corpus.

From the lexicon random subsets are drawn once for all documents: ``SUBSETS`` at each density 1/2, 1/4, 1/8 and so on.
A document has one hash for each subset: that of the terms it shares with the subset, distinct and sorted, and one for
the whole lexicon. Two documents are compared at the densest subsets of which some are empty in both, where a subset
holds about two of their terms. Whether two subset hashes are equal depends on the share of common terms and on
nothing else; likeness is the estimate of that share.
"""

from __future__ import annotations

import functools
import hashlib
import math
import zlib
from collections.abc import Collection, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm.common import shuffle_partitions, stored

#: Band of the inverse document frequency, as a share of its largest value log(number of documents).
BAND = (0.15, 0.95)
#: Subsets of each density.
SUBSETS = 24
#: Subsets of a density that must be empty in both of two texts to compare them there.
EMPTY = 3
#: Terms with more than one in this many of all occurrences are listed; so there are fewer of them than this.
LISTED = 1 << 20
#: Terms that are mixed at once, of one text or of several.
PIECE = 1 << 14
#: Terms of several texts that wait to be counted, and values of a batch that are unpacked at once.
COUNTED, ITEMS = 1 << 19, 1 << 7
#: Place of rows without doc_id: after all others.
LAST = -(1 << 63)

#: Words are runs of letters, digits, _ and any character beyond ASCII; all other bytes become spaces.
_TO_WORDS = bytes(c if c >= 128 or chr(c).isalnum() or c == ord("_") else 32 for c in range(256))
_IN_WORDS = bytes(c != 32 for c in _TO_WORDS)
_POWERS = np.uint64(1) << np.arange(64, dtype=np.uint64)
# Odd multipliers, one a subset, from a fixed seed.
_MULTIPLIERS = np.random.default_rng(42).integers(1, 1 << 63, SUBSETS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _distinct(values: np.ndarray) -> np.ndarray:
    """Sorted and without repeats; ``values`` are sorted in place."""
    values.sort()
    return values[np.concatenate([values[:1] == values[:1], values[1:] != values[:-1]])]


def _words(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(_TO_WORDS).split()


def _hashed(words: Collection[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)).view(np.int64)


def terms(text: str) -> np.ndarray:
    """The distinct 64-bit hashes of a text's words, sorted."""
    return _distinct(_hashed(set(_words(text))))


def _items(column: pa.Array) -> Iterator:
    """The values of a column, a few in memory at a time."""
    for at in range(0, len(column), ITEMS):
        yield from column.slice(at, ITEMS).to_pylist()


def _counted(term: np.ndarray, n: np.ndarray, found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of sorted terms, one more for each time that a term is found."""
    more, times = np.unique(np.concatenate(found), return_counts=True)
    both, place = np.unique(np.concatenate([term, more]), return_inverse=True)
    counts = np.zeros(len(both), np.int64)
    counts[place[: len(term)]] = n
    counts[place[len(term) :]] += times
    return both, counts


def _count_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial document frequencies of a batch."""
    for batch in batches:
        term, n = np.empty(0, np.int64), np.empty(0, np.int64)
        found, size = [], 0
        for text in _items(batch.column(0)):
            found.append(terms(text or ""))
            size += len(found[-1])
            if size > COUNTED:
                term, n = _counted(term, n, found)
                found, size = [], 0
        if found:
            term, n = _counted(term, n, found)
        yield pa.RecordBatch.from_arrays([pa.array(term, pa.int64()), pa.array(n, pa.int64())], names=["term", "n"])


@dataclass
class Lexicon:
    """Frequent terms (sorted) with whether they lie in the band, and the other terms of the band as a table."""

    listed: np.ndarray
    inside: np.ndarray
    rare: DataFrame

    @classmethod
    def of(cls, texts: DataFrame, band: tuple[float, float] = BAND, listed: int = LISTED) -> Lexicon:
        """From a column of texts, all of them. Fewer than ``listed`` terms come to the driver."""
        total = texts.count()
        highest = np.log(max(total, 2))
        # idf = log(total / n) lies in the band
        most, least = float(total * np.exp(-band[0] * highest)), float(total * np.exp(-band[1] * highest))
        counted = texts.mapInArrow(_count_documents, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
        counted = stored(counted.where(F.col("n") >= least), "terms")
        bound = (counted.agg(F.sum("n").alias("n")).first()["n"] or 0) / listed
        within = F.col("n") <= most
        frequent = counted.where(F.col("n") > bound).select("term", within.alias("inside")).sort("term").toArrow()
        term, inside = (frequent.column(c).to_numpy() for c in ("term", "inside"))
        return cls(term, inside.astype(bool), counted.where((F.col("n") <= bound) & within).select("term"))

    def split(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of sorted terms those that are listed and in the band, and those that are not listed."""
        return _split(self.listed, self.inside, own)


def _member(values: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each value is in a sorted array, and its place there."""
    if not len(among):
        return np.zeros(len(values), bool), np.zeros(len(values), np.int64)
    at = np.minimum(np.searchsorted(among, values), len(among) - 1)
    return among[at] == values, at


def _split(listed: np.ndarray, inside: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hit, at = _member(own, listed)
    return own[hit][inside[at[hit]]], own[~hit]


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(32))
    values *= np.uint64(0x9E3779B97F4A7C15)
    return values


def _draws(kept: np.ndarray) -> np.ndarray:
    """Draws (subset, term): a subset of density ``2 ** -level`` holds the terms with ``level`` leading zero bits."""
    return _mixed((kept ^ (kept >> np.uint64(29))) * _MULTIPLIERS[:, None])


def _hashes(group: np.ndarray, term: np.ndarray, groups: int) -> list[str]:
    """Hash of the sorted terms of each group, in which rows are in order; empty where there is none.

    It is a polynomial of the terms, the place among them being the power.
    """
    sizes = np.bincount(group, minlength=groups)
    upto = np.cumsum(sizes)
    place = np.arange(len(group)) - (upto - sizes)[group]
    parts = _mixed(term + np.uint64(1)) * _mixed(2 * place.astype(np.uint64) + np.uint64(1))
    ends = np.concatenate([np.zeros(1, np.uint64), np.cumsum(parts)])[upto]
    sums = ends - np.concatenate([np.zeros(1, np.uint64), ends[:-1]])
    return [f"{h:012x}" if n else "" for h, n in zip((_mixed(sums) >> np.uint64(16)).tolist(), sizes.tolist())]


def fingerprints(texts: list[tuple[np.ndarray, np.ndarray]]) -> list[str]:
    """``0:hash;level:hash,...;level:hash,...`` of each text's terms and of those in the lexicon, both sorted.

    Level 0 is the whole lexicon. The first level of subsets is the densest with ``EMPTY`` empty ones: at a denser
    one no text can be compared with this. After the last all are empty. A text without lexicon terms has ``-:`` and
    the hash of its terms.
    """
    out = [f"-:{zlib.crc32(own.tobytes()):08x}" if not len(kept) else "" for own, kept in texts]
    some = [kept.view(np.uint64) for _, kept in texts if len(kept)]
    if not some:
        return out
    terms_of_all = np.concatenate(some)
    text = np.repeat(np.arange(len(some)), [len(kept) for kept in some])
    pieces = [(terms_of_all[at : at + PIECE], text[at : at + PIECE]) for at in range(0, len(text), PIECE)]
    once = _draws(terms_of_all) if len(pieces) == 1 else None
    smallest = np.full((SUBSETS, len(some)), np.uint64(0xFFFFFFFFFFFFFFFF))
    for piece, of in pieces:
        starts = np.concatenate([[0], np.flatnonzero(of[1:] != of[:-1]) + 1])
        least = np.minimum.reduceat(_draws(piece) if once is None else once, starts, axis=1)
        smallest[:, of[starts]] = np.minimum(smallest[:, of[starts]], least)
    smallest.sort(axis=0)
    first, last = (
        np.array([64 - m.bit_length() for m in row.tolist()]) + more for row, more in ((smallest[-EMPTY], 1), (smallest[0], 0))
    )
    lot = _POWERS[64 - first]
    # The few draws that any of a text's levels chooses, by subset and term, once for each of these levels.
    chosen = []
    for piece, of in pieces:
        drawn = _draws(piece) if once is None else once
        subset, at = np.nonzero(drawn < lot[of])
        chosen.append((subset, of[at], piece[at], drawn[subset, at]))
    subset, of, term, drawn = chosen[0] if len(chosen) == 1 else (np.concatenate(c) for c in zip(*chosen))
    levels = np.maximum(last - first + 1, 0)
    before = np.cumsum(levels) - levels
    times = 65 - np.searchsorted(_POWERS, drawn, "right") - first[of]
    row = np.repeat(np.arange(len(term)), times)
    level = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
    group = (before[of[row]] + level) * SUBSETS + subset[row]
    order = np.argsort(group, kind="stable")
    hashes = _hashes(group[order], term[row[order]], int(levels.sum()) * SUBSETS)
    rows = [",".join(hashes[at : at + SUBSETS]) for at in range(0, len(hashes), SUBSETS)]
    printed = (
        ";".join([
            f"0:{xxhash.xxh64_intdigest(kept.tobytes()) >> 16:012x}",
            *[f"{start + i}:{each}" for i, each in enumerate(rows[at : at + n])],
        ])
        for kept, start, at, n in zip(some, first.tolist(), before.tolist(), levels.tolist())
    )
    return [p or next(printed) for p in out]


def fingerprint(own: np.ndarray, kept: np.ndarray) -> str:
    """``fingerprints`` of one text."""
    return fingerprints([(own, kept)])[0]


def likeness(a: str, b: str) -> float:
    """Estimated share of common lexicon terms: 1 for equal fingerprints, 0 where no subset hash is equal.

    A subset of density p is equal in both texts, empty or not, if it holds none of the d terms that only one of them
    has, and empty in both if it holds none of all n: the shares of such subsets are about exp(-p d) and exp(-p n),
    so their logarithms give d / n. The densest subsets with enough empty ones and the next are counted.
    """
    if a == b:
        return 1.0
    if a[0] == "-" or b[0] == "-":
        return 0.0
    own, other = (p.split(";")[1:] for p in (a, b))
    if not own or not other:
        return 0.0
    starts = [int(levels[0].split(":")[0]) for levels in (own, other)]  # one level follows the other

    def pairs_at(level: int) -> list[tuple[str, str]]:
        rows = (
            levels[level - start].split(":")[1].split(",") if level - start < len(levels) else [""] * SUBSETS
            for levels, start in zip((own, other), starts)
        )
        return list(zip(*rows))

    level = max(starts)
    while (pairs := pairs_at(level)).count(("", "")) < EMPTY:
        level += 1
    apart = union = 0.0
    for pairs in (pairs, pairs_at(level + 1)):
        apart += math.log(sum(x == y for x, y in pairs) / SUBSETS)
        union += math.log(pairs.count(("", "")) / SUBSETS)
    return min(max(1.0 - apart / union, 0.0), 1.0) if union else 0.0


# --- each document with the next -----------------------------------------------------------------

_OUT = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
])
_OUT_DDL = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def edited(text: str, following: str) -> str:
    """The last third of a text replaced by as much of the beginning of the following one."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def _edges(text: str, following: str) -> str:
    """What the edited text has around its two cuts, from space to space: all its other words are in one of the texts."""
    third = len(text) // 3
    head, piece = text[: len(text) - third], following[:third]
    start, *end = piece.split(" ", 1)
    return " ".join([head.rsplit(" ", 1)[-1] + start, *[e.rsplit(" ", 1)[-1] for e in end]])


def _count(text: str) -> int:
    """How many words a text has; lower case doesn't change that."""
    at = np.frombuffer(text.encode("utf-8", "replace").translate(_IN_WORDS), np.int8)
    return int(np.count_nonzero(at[1:] > at[:-1]) + at[:1].sum())


def _untouched(text: str, following: str) -> tuple[int, int, int]:
    """Of the words of a text how many begin the edited text, and which of the following one's are whole in it.

    These are all but those of ``_edges``.
    """
    third = len(text) // 3
    head, piece = text[: len(text) - third], following[:third]
    first, last = piece.find(" ") + 1, piece.rfind(" ") + 1
    before = _count(piece[:first])
    return _count(head[: head.rfind(" ") + 1]), before, before + _count(piece[first:last])


def _unlisted(listed: np.ndarray, inside: np.ndarray):
    """(bucket, term): the terms that the list leaves open, of each bucket's texts and of their edited texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, open_terms = None, np.empty(0, np.int64)
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            found: list[np.ndarray] = []
            at: list[int] = []
            for bucket, text in zip(batch.column("bucket").to_pylist(), _items(batch.column("text"))):
                text = _unpacked(text, unpacker)
                texts = [text] if before is None or before[0] != bucket else [text, _edges(before[1], text)]
                for each in texts:
                    rest = _split(listed, inside, terms(each))[1]
                    if len(rest):
                        found.append(rest)
                        at.append(bucket)
                before = (bucket, text)
            # A batch's terms once, and not again those of the batch before it.
            for bucket in sorted(set(at)):
                now = np.unique(np.concatenate([f for f, b in zip(found, at) if b == bucket]))
                new = now[~_member(now, open_terms)[0]] if bucket == at[0] else now
                open_terms = now
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(new), bucket), pa.int32()), pa.array(new, pa.int64())], names=["bucket", "term"]
                )

    return run


def _compared(listed: np.ndarray, inside: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rare = None, np.empty(0, np.int64)  # the lexicon's other terms in this bucket; its first row brings them

        def lexical(own: np.ndarray) -> np.ndarray:
            known, rest = _split(listed, inside, own)
            rest = rest[_member(rest, rare)[0]]
            return np.sort(np.concatenate([known, rest])) if len(rest) else known

        def read(text: str) -> tuple:
            """A text's terms and those in the lexicon, and the term of each word with whether it is in the lexicon."""
            each = _hashed(_words(text))
            own = _distinct(each.copy())
            kept = lexical(own)
            return (own, kept), each, _member(each, kept)[0]

        def read_edited(text: str, each, within, following: str, next_each, next_within) -> tuple:
            """``read(edited(text, following))[0]`` from what was read of the two texts."""
            head, begin, end = _untouched(text, following)
            edges = terms(_edges(text, following))
            parts = [each[:head], next_each[begin:end]]
            kept = _distinct(np.concatenate([parts[0][within[:head]], parts[1][next_within[begin:end]], lexical(edges)]))
            return kept if len(kept) else _distinct(np.concatenate([*parts, edges])), kept

        unpacker = zstandard.ZstdDecompressor()
        before = None  # bucket, doc_id, text and what was read of it, of the row that waits for the next one
        for batch in batches:
            rows, pairs, size = [], [], 0
            columns = (batch.column(n) for n in ("bucket", "visit", "doc_id", "text", "rare"))
            for bucket, visit, doc_id, text, more in zip(*columns):
                bucket, visit, doc_id, text = bucket.as_py(), visit.as_py(), doc_id.as_py(), text.as_py()
                text = _unpacked(text, unpacker)
                if bucket != at:
                    at, rare = bucket, np.empty(0, np.int64)
                if more.is_valid:
                    rare = np.sort(more.values.to_numpy())
                if visit and before is None:
                    continue  # a repeated row that starts the next bucket
                own = read(text)
                if before is not None and before[0] == bucket:
                    changed = edited(before[2], text)
                    digest = hashlib.sha256(changed.encode("utf-8", "replace")).hexdigest()
                    rows.append((before[1], len(before[2]), digest))
                    pairs.append((before[3][0], read_edited(before[2], *before[3][1:], text, *own[1:]), own[0]))
                    size += sum(len(kept) for _, kept in pairs[-1])
                    if size > PIECE // 2:
                        yield _likened(rows, pairs)
                        rows, pairs, size = [], [], 0
                before = None if visit else (bucket, doc_id, text, own)
            if rows:
                yield _likened(rows, pairs)

    return run


def _likened(rows: list[tuple], pairs: list[tuple]) -> pa.RecordBatch:
    """``rows`` with fingerprints and likeness of ``pairs``: what was read of a text, its edited text and the next one."""
    # Of rows in order one's next text is the following one's own.
    own, after, following = zip(*pairs)
    chained = all(a is b for a, b in zip(own[1:], following))
    printed = fingerprints([*own, *after, *(following[-1:] if chained else following)])
    own, after = printed[: len(rows)], printed[len(rows) : 2 * len(rows)]
    following = [*own[1:], printed[-1]] if chained else printed[2 * len(rows) :]
    near = [list(map(likeness, own, other)) for other in (after, following)]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip((*zip(*rows), own, after, *near), _OUT)], schema=_OUT
    )


_packer = functools.cache(lambda: zstandard.ZstdCompressor(level=3))


def _packed(text: str | None) -> bytes:
    """A text compressed, since whole texts are most of the shuffle. Null is empty.

    A UDF by row: Arrow's batches would hold the texts of up to 10,000 rows, several times in the JVM and in Python.
    """
    return _packer().compress((text or "").encode("utf-8", "replace"))


def _unpacked(text: bytes, unpacker: zstandard.ZstdDecompressor) -> str:
    return unpacker.decompress(text).decode("utf-8")


_IN_ORDER = ["bucket", "visit", "place", "tie"]
_RISING = [True, True, False, False]


def _below(place: Column, bounds: np.ndarray) -> Column:
    """How many of the sorted ``bounds`` lie below ``place``, which isn't null: first whole runs of them, then inside one."""
    step = math.isqrt(len(bounds)) + 1
    runs = [bounds[at : at + step] for at in range(0, len(bounds) + 1, step)]

    def count(values: Column) -> Column:
        return F.size(F.filter(values, lambda bound: bound < place))

    run = count(F.lit(bounds[step - 1 :: step]))
    return run * step + count(F.get(F.array(*map(F.lit, runs)), run))


def _in_buckets(docs: DataFrame) -> DataFrame:
    """(bucket, visit, head, doc_id, packed text, place, tie), a bucket in one task; ``_IN_ORDER`` sorts it.

    Then rows follow by descending doc_id, ``head`` is a bucket's first and the last is the row that comes next. A bucket is a range of ids. The first row of a bucket visits the bucket before it, and the first of all the
    last; so every task sees the following row of each of its own without a global sort. Only the ids at the
    bounds come to the driver, one for each bucket.
    """
    spark = docs.sparkSession
    buckets = shuffle_partitions(spark)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("place"),
        F.xxhash64("text").alias("tie"),
    )
    shares = [i / buckets for i in range(1, buckets)] or [0.5]
    found = rows.agg(F.percentile_approx("place", shares, 10_000).alias("q")).first()["q"]
    bounds = np.unique(np.asarray(found or [0], np.int64))
    numbered = rows.withColumn("bucket", len(bounds) - _below(F.col("place"), bounds))
    heads = sorted(
        (row.bucket, row.head.place, row.head.tie)
        for row in numbered.groupBy("bucket").agg(F.max(F.struct("place", "tie")).alias("head")).collect()
    )
    to = [heads[i - 1][0] for i in range(len(heads))]
    # From Arrow: rows of a list would pass through Python workers, which then stay beside those of the texts.
    visits = spark.createDataFrame(pa.Table.from_pylist(
        [{"bucket": bucket, "place": place, "tie": tie, "to": into} for (bucket, place, tie), into in zip(heads, to)],
        pa.schema([("bucket", pa.int32()), ("place", pa.int64()), ("tie", pa.int64()), ("to", pa.int32())]),
    ))
    own = F.struct("bucket", F.lit(False).alias("visit"))
    other = F.when(F.col("to").isNotNull(), F.struct(F.col("to").alias("bucket"), F.lit(True).alias("visit")))
    return (
        numbered.withColumn("text", F.udf(_packed, "binary", useArrow=False)("text"))
        .join(F.broadcast(visits), ["bucket", "place", "tie"], "left")
        .select("doc_id", "text", "place", "tie", "to", F.explode(F.array_compact(F.array(own, other))).alias("at"))
        .select("at.bucket", "at.visit", (F.col("to").isNotNull() & ~F.col("at.visit")).alias("head"),
                "doc_id", "text", "place", "tie")
        .repartition(buckets, "bucket")
    )


def compare_fingerprints(docs: DataFrame, lexicon: Lexicon | None = None) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next), a row for each.

    The next document is that with the next smaller doc_id, and the first after the last; a single document is
    its own next. Rows without doc_id come last, rows with one doc_id in the order of a hash of their texts.
    Null texts are empty. The lexicon is counted over ``docs`` if none is given. Columns other than doc_id and
    text are ignored. An empty table gives an empty one.
    """
    lexicon = lexicon or Lexicon.of(docs.select("text"))
    rows = _in_buckets(docs.select("doc_id", "text"))
    # Both reads of ``rows`` share its shuffle. A bucket's first row brings the lexicon's unlisted terms of the bucket.
    opened = rows.sortWithinPartitions(_IN_ORDER, ascending=_RISING).mapInArrow(
        _unlisted(lexicon.listed, lexicon.inside), "bucket int, term long"
    )
    found = opened.join(lexicon.rare, "term").groupBy("bucket").agg(F.collect_set("term").alias("rare"))
    first_rare = F.when(F.col("head"), F.col("rare")).alias("rare")
    return (
        rows.join(found, "bucket", "left")
        .select(*_IN_ORDER, "doc_id", "text", first_rare)
        .sortWithinPartitions(_IN_ORDER, ascending=_RISING)
        .select("bucket", "visit", "doc_id", "text", "rare")
        .mapInArrow(_compared(lexicon.listed, lexicon.inside), _OUT_DDL)
    )


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
