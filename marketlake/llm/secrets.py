"""Secret scans: fixed patterns, and character Markov models that tell random strings from identifiers.

Two first-order Markov models over the characters of tokens are trained on the whole corpus, with the fixed
patterns as labels: what they find is the sample of secrets, every other token the sample of ordinary words and
identifiers. Spark counts the character pairs of both classes; the counts have one row for each class and pair
of characters at most, whatever the corpus. A token, or what of it lies outside the fixed spans, is added where the
log-likelihood ratio, summed over its characters, outweighs how rare secrets are among the labelled tokens by far.
Nothing else decides: the sum grows with the length, so a short or plain token needs the more telling characters.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the contract: kinds in order, their patterns and least lengths.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ASSIGN_LEAST = 6
# A run of at least so many is the same as a longest run that has them.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_HEX_LEAST = 24
KINDS = ("assign", "access", "hex")
_WORDS = (b"passw", b"secret", b"token", b"api")

#: Characters of tokens; all others end one.
_ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_N = len(_ALPHABET) + 1
#: Weight of what pairs fall back on, in characters.
SMOOTHING = 50.0
#: How many times as likely as an ordinary token a secret must be, by the models and the labelled tokens' numbers.
ODDS = 1_000.0
#: Which part of the labelled secrets' mean ratio a token needs for each pair of its characters.
LEAST_OF_MEAN = 0.5
_CODE = np.zeros(256, np.uint8)
_CODE[list(_ALPHABET)] = np.arange(1, _N)
#: Translate every byte that can be in a hexadecimal run to 0 and all others to 1.
_TO_HEX = bytes(c not in b"0123456789abcdef" for c in range(256))

Span = tuple[int, int, str]


def _may_have(data: bytes, least: int, table: bytes) -> bool:
    """Whether a run of the table's characters is long enough; far cheaper than a pattern."""
    return b"\0" * least in data.translate(table)


def base_spans(text: str) -> list[tuple[Span, tuple[int, int]]]:
    """Spans of the fixed patterns by start, then kind, each with the place of the secret itself."""
    found = []
    folded = text.encode("utf-8", "replace").lower()
    if any(word in folded for word in _WORDS):
        for m in _ASSIGN.finditer(text):
            if len(m[2]) >= _ASSIGN_LEAST:
                found.append(((m.start(), m.end(), "assign"), m.span(2)))
    if "AKIA" in text:
        found += [((m.start(), m.end(), "access"), m.span()) for m in _ACCESS.finditer(text)]
    if _may_have(folded, _HEX_LEAST, _TO_HEX):
        found += [((m.start(), m.end(), "hex"), m.span()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0][0], KINDS.index(x[0][2])))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def _pairs(codes: np.ndarray) -> np.ndarray:
    """Counts of character pairs; 0 is the edge of a token."""
    return np.bincount(codes[:-1].astype(np.int32) * _N + codes[1:], minlength=_N * _N)


def _count_pairs(batches):
    """Partial counts of a task: one row for each class and pair that occurs."""
    totals = np.zeros((2, _N * _N), np.int64)
    for batch in batches:
        for value in batch.column(0):
            text = value.as_py()
            if not text:
                continue
            all_codes = _CODE[np.frombuffer(b" " + text.encode("utf-8", "replace") + b" ", np.uint8)]
            counts = _pairs(all_codes)
            for _, (start, end) in base_spans(text):
                own = _pairs(_CODE[np.frombuffer(f" {text[start:end]} ".encode(), np.uint8)])
                totals[1] += own
                counts = counts - own
            totals[0] += np.maximum(counts, 0)
    label, pair = np.nonzero(totals)
    yield pa.RecordBatch.from_arrays(
        [pa.array(label, pa.int32()), pa.array(pair, pa.int32()), pa.array(totals[label, pair], pa.int64())],
        names=["label", "pair", "n"],
    )


@dataclass
class MarkovModel:
    """Log-likelihood ratio of character pairs, secret against ordinary, and the sum that a secret reaches.

    The least sum has a part for each token and one for each of its pairs: characters that neither class has shown
    say a little for a secret each, and a long token of them must not add up to one.
    """

    ratio: np.ndarray
    least: float
    least_each: float = 0.0

    def enough(self, sums: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return sums >= np.maximum(self.least, self.least_each * (lengths + 1))

    @classmethod
    def train(cls, texts: DataFrame, odds: float = ODDS) -> MarkovModel:
        """From a column of texts; their fixed patterns are the labels.

        The least sum is where a secret is ``odds`` times as likely as an ordinary token, given how many there are of
        either in the sample, and not under ``LEAST_OF_MEAN`` of the mean ratio that labelled secrets have for a pair.

        Pairs that were seen seldom fall back on single characters: for secrets on any, as random strings have
        them, for ordinary tokens on those that they are made of. So texts without any secret will do, or none.
        """
        counted = texts.mapInArrow(_count_pairs, "label int, pair int, n long").groupBy("label", "pair").sum("n")
        counts = np.zeros((2, _N * _N))
        for label, pair, n in counted.collect():
            counts[label, pair] = n
        counts = counts.reshape(2, _N, _N)
        counts[:, 0, 0] = 0
        tokens = counts[:, 0, 1:].sum(axis=1)  # every one begins at an edge
        least = np.log((tokens[0] + 1) / (tokens[1] + 1)) + np.log(odds)
        ordinary = counts[0].sum(axis=0) + 1
        backoff = np.stack([ordinary / ordinary.sum(), np.full(_N, 1 / _N)])
        totals = counts.sum(axis=2, keepdims=True)
        logs = np.log((counts + SMOOTHING * backoff[:, None, :]) / (totals + SMOOTHING))
        ratio = logs[1] - logs[0]
        mean = float((counts[1] * ratio).sum() / max(counts[1].sum(), 1))
        return cls(ratio, float(least), LEAST_OF_MEAN * mean)

    def runs(self, data: bytes | bytearray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and summed ratios of all tokens of a text's bytes, in order; an edge on either side counts."""
        codes = np.zeros(len(data) + 2, np.uint8)
        codes[1:-1] = _CODE[np.frombuffer(data, np.uint8)]
        inside = codes > 0
        starts = np.flatnonzero(inside[1:] & ~inside[:-1])
        ends = np.flatnonzero(~inside[1:] & inside[:-1])
        upto = np.concatenate([[0.0], np.cumsum(self.ratio[codes[:-1], codes[1:]])])
        return starts, ends, upto[ends + 1] - upto[starts]


def added_spans(text: str, base: list[Span], model: MarkovModel) -> list[Span]:
    """Tokens, or their parts outside the fixed spans, that the models take for secrets."""
    data = bytearray(text.encode("utf-8", "replace"))
    plain = len(data) == len(text)
    for start, end, _ in base:
        if not plain:
            start, end = (len(text[:at].encode("utf-8", "replace")) for at in (start, end))
        data[start:end] = b" " * (end - start)
    starts, ends, sums = model.runs(data)
    found = []
    for i in np.flatnonzero(model.enough(sums, ends - starts)):
        start, end = int(starts[i]), int(ends[i])
        if not plain:
            # Bytes to code points: those of a character but its first are 10xxxxxx.
            start, end = (int(np.count_nonzero((np.frombuffer(data[:at], np.uint8) & 0xC0) != 0x80)) for at in (start, end))
        found.append((start, end, "markov"))
    return found


_FOUND = pa.schema([
    ("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
    ("base_spans", pa.string()), ("spans", pa.string()),
])
_FOUND_DDL = "doc_id long, n_assign long, n_access long, n_hex long, base_spans string, spans string"


def _scanner(model: MarkovModel):
    def run(batches):
        for batch in batches:
            rows = []
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = value.as_py() or ""
                base = [span for span, _ in base_spans(text)]
                spans = sorted(base + added_spans(text, base, model), key=lambda s: s[0])
                n = [sum(s[2] == kind for s in base) for kind in KINDS]
                rows.append((doc_id, *n, joined(base), joined(spans)))
            columns = list(zip(*rows)) or [()] * len(_FOUND)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FOUND)], schema=_FOUND)

    return run


def find_secrets(docs: DataFrame, model: MarkovModel | None = None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_spans, spans), a row for each row of ``docs``.

    Spans are ``kind:start:end`` in code points, by start and then kind, joined by commas. ``spans`` has the
    base spans and the model's (kind ``markov``), which never overlap a base span. ``model`` is trained on
    ``docs`` if none is given. Null and empty texts have no spans; very long ones are scanned whole. Repeated rows get
    the same result each. An empty table gives an empty one. Columns other than doc_id and text are ignored.
    """
    model = model or MarkovModel.train(docs.select("text"))
    return docs.select(docs.doc_id.cast("long").alias("doc_id"), "text").mapInArrow(_scanner(model), _FOUND_DDL)


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans"
    )
