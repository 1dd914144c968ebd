"""Packing documents into sequences of fixed length: cutting stock by column generation.

Every document is tokenized once. It is cut into whole sequences, a head of a multiple of ``UNIT`` ids and a tail
of fewer than ``UNIT``. The lengths of heads and tails are counted; these histograms have at most a row for each
length, whatever the number of documents, and are all that the driver sees. There a linear program chooses
patterns (how many pieces of each length fill one sequence) and cuts (a head of one length becomes two shorter
ones, at a small price). Knapsack dynamic programming finds the pattern that improves the program most, until
none does. Patterns are rounded down and what remains is filled up piece by piece.

Pieces of one length are ranked across the whole table; the plan gives each rank its sequence and offset, so
placing a piece is arithmetic on its rank. A head keeps the checksum of each unit: where the plan cuts it, the
parts' checksums are combined from them and the document isn't tokenized again.
"""

from __future__ import annotations

import re
import sys
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm.common import ranked, stored

CAPACITY = 4096
#: Heads are multiples of so many ids.
UNIT = 64
#: Id at the end of each document.
END_ID = 2
#: Price of one cut, in sequences: as much as 8 ids of padding.
CUT_PRICE = 8 / CAPACITY
#: A task keeps the ids of so many distinct words.
CACHED_WORDS = 600_000
_LITTLE = sys.byteorder == "little" and array("I").itemsize == 4


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: Words of these characters only are split and lower-cased here, by the tokenizer file's own rules; any other
#: word goes through the whole tokenizer.
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for letters from 256 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in kept]
    letter = {byte: chr(byte) for byte in kept} | {byte: chr(256 + n) for n, byte in enumerate(others)}
    return {ord(c): "".join(letter[byte] for byte in c.encode()) for c in map(chr, range(0xC0, 0x100))}


class WordIds(dict):
    """Ids of a word as little-endian bytes. Words end at ASCII white space, which the tokenizer drops too."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.encode, self.pieces = tokenizer.encode, tokenizer.model.tokenize
        self.letters = _byte_letters()

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if len(word) <= 64 and "<|" not in text and _PLAIN.fullmatch(text):
            text = text.lower()
            parts = [text] if text.isascii() and text.isalpha() else _PARTS.findall(text)
            ids = [piece.id for part in parts for piece in self.pieces(part.translate(self.letters))]
        else:
            ids = self.encode(text, add_special_tokens=False).ids
        out = array("I", ids).tobytes() if _LITTLE else np.asarray(ids, "<u4").tobytes()
        if len(word) <= 64:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = out
        return out

    def of(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.encode("utf-8", "replace").split()))


# --- cutting -------------------------------------------------------------------------------------

_PIECES = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("unit_crcs", pa.binary()),
])
_PIECES_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, unit_crcs binary"


def _cut(ids: bytes) -> Iterator[tuple[int, int, int, bytes | None]]:
    """(start, length, crc, unit crcs) of whole sequences, the head and the tail."""
    n = len(ids) // 4
    start = 0
    while start < n:
        length = min(n - start, CAPACITY)
        if UNIT < length < CAPACITY:
            length -= length % UNIT
        part = ids[4 * start : 4 * (start + length)]
        units = None
        if UNIT <= length < CAPACITY:
            units = np.asarray(
                [zlib.crc32(part[i : i + 4 * UNIT]) for i in range(0, len(part), 4 * UNIT)], "<u4"
            ).tobytes()
        yield start, length, zlib.crc32(part), units
        start += length


def _tokenized(path: str):
    end = np.asarray([END_ID], "<u4").tobytes()

    def run(batches):
        words = WordIds(path)
        for batch in batches:
            columns: list[list] = [[] for _ in _PIECES]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = words.of(text.as_py() or "") + end
                for start, length, crc, units in _cut(ids):
                    for column, value in zip(columns, (doc_id, start, length, crc, len(ids) // 4, units)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PIECES)], schema=_PIECES)

    return run


# --- the linear program --------------------------------------------------------------------------


def _best_pattern(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Knapsack: the multiset of sizes within the capacity that is worth most."""
    good = np.flatnonzero(values > 1e-12)
    sizes_, values_ = sizes[good], values[good]
    best = np.zeros(capacity + 1)
    chosen = np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        n = bisect_right(sizes_, c)
        if n:
            worth = best[c - sizes_[:n]] + values_[:n]
            k = int(worth.argmax())
            if worth[k] > best[c] + 1e-12:
                best[c], chosen[c] = worth[k], k
    pattern, c = np.zeros(len(sizes)), capacity
    while c > 0:
        if chosen[c] < 0:
            c -= 1
        else:
            pattern[good[chosen[c]]] += 1
            c -= sizes_[chosen[c]]
    return float(best[capacity]), pattern


def column_generation(
    sizes: np.ndarray, counts: np.ndarray, capacity: int, cut_price: float | None
) -> tuple[list[tuple[np.ndarray, float]], list[tuple[int, int, float]]]:
    """Fewest sequences that hold ``counts`` pieces of ``sizes`` (rising): patterns and cuts with their amounts.

    Revised simplex on one row a size. A pattern column has its pieces; a cut column (size a + b to a and b,
    all three in ``sizes``) covers one piece and asks for two. Counts are raised a little and unevenly, against
    cycling; the caller rounds down and settles the rest.
    """
    m = len(sizes)
    demand = counts + 1e-3 * (1 + np.arange(m) / m)
    fit = capacity // sizes
    columns = [np.where(np.arange(m) == k, fit[k], 0.0) for k in range(m)]
    prices = np.ones(m)
    cuts: list[tuple[int, int] | None] = [None] * m
    inverse = np.diag(1.0 / fit)
    place = {int(s): k for k, s in enumerate(sizes)}
    splits = [
        (k, place[int(a)], place[int(sizes[k] - a)])
        for k in range(m) for a in sizes[:k]
        if cut_price is not None and int(sizes[k] - a) in place and a <= sizes[k] - a
    ]
    split = np.asarray(splits).reshape(-1, 3)
    for turn in range(100 * m):
        dual = prices @ inverse
        worth, pattern = _best_pattern(sizes, dual, capacity)
        gain, entering, price, cut = worth - 1, pattern, 1.0, None
        if len(split):
            gains = dual[split[:, 0]] - dual[split[:, 1]] - dual[split[:, 2]] - cut_price
            s = int(gains.argmax())
            if gains[s] > max(gain, 0):
                k, a, b = splits[s]
                gain, price, cut = gains[s], cut_price, (k, a)
                entering = np.zeros(m)
                entering[k] += 1
                entering[a] -= 1
                entering[b] -= 1
        if gain <= 1e-9:
            break
        direction, amounts = inverse @ entering, inverse @ demand
        usable = direction > 1e-9
        if not usable.any():
            break
        leaving = int(np.where(usable, np.maximum(amounts, 0) / np.where(usable, direction, 1), np.inf).argmin())
        columns[leaving], prices[leaving], cuts[leaving] = entering, price, cut
        if turn % 50 == 49:
            inverse = np.linalg.inv(np.asarray(columns).T)
        else:
            row = inverse[leaving] / direction[leaving]
            inverse = inverse - np.outer(direction, row)
            inverse[leaving] = row
    amounts = np.maximum(inverse @ demand, 0)
    patterns = [(c, x) for c, x, cut in zip(columns, amounts, cuts) if cut is None]
    return patterns, [(cut[0], cut[1], x) for x, cut in zip(amounts, cuts) if cut is not None]


# --- the plan ------------------------------------------------------------------------------------


@dataclass
class Plan:
    """Where the piece of a length and rank goes. Ranks of one length are covered without gaps."""

    sequences: int = 0
    #: length: first rank, pieces in a sequence, first sequence, offset of the first piece
    slots: dict[int, list[tuple[int, int, int, int]]] = field(default_factory=dict)
    #: length: first rank, last rank + 1, length of the first part, its first rank, the second part's first rank
    cuts: dict[int, list[tuple[int, int, int, int, int]]] = field(default_factory=dict)

    def place(self, length: int, rank: int, start: int = 0) -> Iterator[tuple[int, int, int, int]]:
        """(start, length, sequence, offset) of the parts of a piece."""
        for first, end, part, rank_a, rank_b in self.cuts.get(length, ()):
            if first <= rank < end:
                yield from self.place(part, rank_a + rank - first, start)
                yield from self.place(length - part, rank_b + rank - first, start + part)
                return
        slots = self.slots[length]
        first, each, sequence, offset = slots[bisect_right(slots, (rank, 1 << 62)) - 1]
        nth, slot = divmod(rank - first, each)
        yield start, length, sequence + nth, offset + slot * length


class _Planner:
    """Gives out the ranks of each length in rising order: to cuts, then to patterns, then one by one."""

    def __init__(self, histogram: dict[int, int]):
        self.plan = Plan()
        self.made = {length: int(n) for length, n in histogram.items()}
        self.used = dict.fromkeys(self.made, 0)

    def left(self, length: int) -> int:
        return self.made.get(length, 0) - self.used.get(length, 0)

    def cut(self, length: int, part: int, n: int) -> None:
        """Cuts the next ``n`` pieces of a length; the parts get ranks after all others of their lengths."""
        first = self.used[length]
        ranks = []
        for size in (part, length - part):
            ranks.append(self.made.setdefault(size, 0))
            self.used.setdefault(size, 0)
            self.made[size] += n
        self.plan.cuts.setdefault(length, []).append((first, first + n, part, *ranks))
        self.used[length] += n

    def put(self, length: int, each: int, sequences: int, offset: int) -> None:
        """The next pieces of a length: ``each`` of them from ``offset`` in each of the next sequences."""
        self.plan.slots.setdefault(length, []).append((self.used[length], each, self.plan.sequences, offset))
        self.used[length] += each * sequences

    def repeat(self, pattern: dict[int, int], times: int) -> None:
        times = min([times, *(self.left(length) // each for length, each in pattern.items())])
        if times > 0:
            offset = 0
            for length, each in pattern.items():
                self.put(length, each, times, offset)
                offset += each * length
            self.plan.sequences += times

    def fill_up(self) -> None:
        """Places what is left: heads are cut where a sequence ends, tails fill the gaps."""
        filled = 0

        def close() -> None:
            nonlocal filled
            self.plan.sequences += 1
            filled = 0

        for length in range(CAPACITY - UNIT, 0, -UNIT):
            while self.left(length):
                space = CAPACITY - filled
                if length > space:
                    self.cut(length, space, 1)
                    self.put(space, 1, 1, filled)
                    filled = CAPACITY
                else:
                    self.put(length, 1, 1, filled)
                    filled += length
                if filled == CAPACITY:
                    close()
        for length in range(UNIT - 1, 0, -1):
            while n := self.left(length):
                if length > CAPACITY - filled:
                    close()
                n = min(n, (CAPACITY - filled) // length)
                self.put(length, n, 1, filled)
                filled += n * length
        if filled:
            close()


def plan_packing(histogram: dict[int, int]) -> Plan:
    """Places for all pieces of a histogram {length: number} with lengths as ``_cut`` makes them."""
    planner = _Planner(histogram)
    if CAPACITY in histogram:
        planner.repeat({CAPACITY: 1}, planner.left(CAPACITY))
    solved: list[tuple[dict[int, int], float]] = []
    heads = np.arange(1, CAPACITY // UNIT)
    counts = np.asarray([planner.left(int(size) * UNIT) for size in heads], float)
    if counts.any():
        patterns, cuts = column_generation(heads, counts, CAPACITY // UNIT, CUT_PRICE)
        # Longer heads first, since their parts may be cut again.
        for k, a, amount in sorted(cuts, reverse=True):
            length = int(heads[k]) * UNIT
            if n := min(int(amount + 1e-6), planner.left(length)):
                planner.cut(length, int(heads[a]) * UNIT, n)
        solved += [({int(heads[k]) * UNIT: int(p[k]) for k in np.flatnonzero(p)}, x) for p, x in patterns]
    tails = np.asarray([length for length in range(1, UNIT) if planner.left(length)], int)
    if len(tails):
        counts = np.asarray([planner.left(int(length)) for length in tails], float)
        patterns, _ = column_generation(tails, counts, CAPACITY, None)
        solved += [({int(tails[k]): int(p[k]) for k in np.flatnonzero(p)}, x) for p, x in patterns]
    for pattern, amount in solved:
        planner.repeat(pattern, int(amount + 1e-6))
    planner.fill_up()
    return planner.plan


# --- the job -------------------------------------------------------------------------------------

_PLACED = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
])
_PLACED_DDL = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)
_ZEROS = bytes(4 * UNIT)


def _joined_crc(units: np.ndarray) -> int:
    """CRC-32 of consecutive units, from theirs: a CRC is an affine function of its start value."""
    crc = int(units[0])
    for unit in units[1:]:
        crc = zlib.crc32(_ZEROS, crc) ^ zlib.crc32(_ZEROS) ^ int(unit)
    return crc


def _placed(plan: Plan):
    def run(batches):
        for batch in batches:
            columns: list[list] = [[] for _ in _PLACED]
            for row in zip(*(batch.column(n).to_pylist() for n in (*_PIECES.names, "rank"))):
                doc_id, start, length, crc, tokens, units, rank = row
                for at, size, sequence, offset in plan.place(length, rank):
                    if size != length:
                        own = np.frombuffer(units, "<u4")[at // UNIT : (at + size) // UNIT]
                        crc = _joined_crc(own)
                    for column, value in zip(columns, (doc_id, start + at, size, crc, tokens, sequence, offset)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PLACED)], schema=_PLACED)

    return run


def pack(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), a row for each piece.

    A document is the ids of its text by the tokenizer at ``path`` (default: the public 49k vocabulary) and the
    end id; a null or empty text has the end id only. Rows with equal ids, or none, are documents of their own.
    Columns other than doc_id and text are ignored. An empty table gives an empty one.
    """
    pieces = stored(
        docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_tokenized(path or tokenizer_path()), _PIECES_DDL),
        "pieces",
    )
    histogram = {row.length: row.n for row in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = plan_packing(histogram)
    buckets = max(1, round(max(histogram.values(), default=1) ** 0.5))
    spread = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)))
    places = ranked(spread, ["length"], "bucket", [F.col("doc_id"), F.col("start"), F.col("ids_crc32")], "rank")
    return places.select(*_PIECES.names, "rank").mapInArrow(_placed(plan), _PLACED_DDL)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
