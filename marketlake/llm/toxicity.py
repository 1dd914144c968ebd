"""Toxicity: a factorization machine over hashed terms.

A text is its set of hashed words and word beginnings. Besides a weight each term has a few factors, and the product of two terms'
factors is the weight of the pair: an insult together with the mention of a group can score high where neither
does alone. Spark turns a bounded sample of labelled texts into sets of terms; the machine is trained on those
and goes to the tasks, which score whole texts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Labelled texts to learn from, of either class: all, or about so many where there are more.
TRAIN_ROWS = 6_000
SLOT_BITS = 18
#: Lengths of the beginnings of words that are terms too.
STEMS = (3, 4, 5, 6, 7)
FACTORS = 8
#: A term must occur in so many of the texts learned from.
LEAST_TEXTS = 5
#: And its shares in the two classes must lie so many standard errors apart, or those of it together with another term.
LEAST_APART, LEAST_APART_IN_PAIRS = 4.0, 7.0
#: Terms that pairs are looked for among: those that vary most over the texts learned from.
PAIR_TERMS = 2_048
LINEAR_EPOCHS, EPOCHS, BATCH, RATE = 15, 10, 128, 0.2
#: L1 price of weights, in texts: what so many texts say alone is taken for chance. That of factors is the one of these
#: with which the other texts explain a held-back share of them best.
WEIGHT_PRICE, FACTOR_PRICES = 1.0, (0.05, 0.2, 1.0)
HELD_BACK = 5

_WORD = re.compile(r"\w+")


@lru_cache(maxsize=200_000)
def _word_slots(word: str) -> tuple[int, ...]:
    """Slots of a word and of its beginnings, so that an unknown form of a known stem counts."""
    mask = (1 << SLOT_BITS) - 1
    parts = [word, *(f"^{word[:n]}" for n in STEMS if len(word) > n)]
    return tuple(zlib.crc32(part.encode("utf-8", "replace")) & mask for part in parts)


def terms(text: str | None) -> np.ndarray:
    """The distinct slots of a text's words and their beginnings, in order."""
    words = set(_WORD.findall((text or "").lower()))
    return np.unique(np.fromiter(chain.from_iterable(map(_word_slots, words)), np.int64))


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive groups of rows, some of them empty."""
    total = np.zeros((len(values) + 1, *values.shape[1:]))
    np.cumsum(values, axis=0, out=total[1:])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def _telling(texts: Sequence[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """The slots that differ between the classes by more than chance, alone or in how they meet another one.

    A long text has thousands of terms that say nothing; even small weights of theirs would add up.
    """
    slots = 1 << SLOT_BITS
    n = np.asarray([(labels == label).sum() for label in (0, 1)], float)
    seen = [
        np.bincount(np.concatenate([np.zeros(0, np.int64), *(t for t, y in zip(texts, labels) if y == label)]), minlength=slots)
        for label in (0, 1)
    ]
    both = (seen[0] + seen[1]) / max(n.sum(), 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        apart = np.abs(seen[1] / n[1] - seen[0] / n[0]) / np.sqrt(both * (1 - both) * (1 / n[0] + 1 / n[1]))
    enough = seen[0] + seen[1] >= LEAST_TEXTS
    alone = np.flatnonzero(enough & (np.nan_to_num(apart) >= LEAST_APART))
    return np.union1d(alone, _telling_in_pairs(texts, labels, np.flatnonzero(enough), both))


def _telling_in_pairs(
    texts: Sequence[np.ndarray], labels: np.ndarray, slots: np.ndarray, share: np.ndarray
) -> np.ndarray:
    """Those slots whose covariance with another slot differs between the classes by more than chance."""
    slots = np.sort(slots[np.argsort(-share[slots] * (1 - share[slots]), kind="stable")[:PAIR_TERMS]])
    n = [int((labels == label).sum()) for label in (0, 1)]
    if len(slots) < 2 or min(n) < 2:
        return slots[:0]
    place = np.full(1 << SLOT_BITS, -1, np.int32)
    place[slots] = np.arange(len(slots))
    covariance, error = [], np.zeros((len(slots), len(slots)), np.float32)
    for label in (0, 1):
        x = np.zeros((n[label], len(slots)), np.float32)
        for row, t in zip(x, (t for t, y in zip(texts, labels) if y == label)):
            at = place[t]
            row[at[at >= 0]] = 1
        x -= x.mean(axis=0)
        covariance.append(x.T @ x / n[label])
        x *= x
        error += (x.T @ x / n[label] - covariance[-1] ** 2) / n[label]
    # A pair seen a few times only has no error worth the name: one text more or less of each class.
    apart = np.abs(covariance[1] - covariance[0]) / np.sqrt(error + 1 / n[0] ** 2 + 1 / n[1] ** 2)
    np.fill_diagonal(apart, 0)
    return slots[(apart >= LEAST_APART_IN_PAIRS).any(axis=1)]


@dataclass
class FactorizationMachine:
    place: np.ndarray  # of each slot among the known terms, or -1
    weights: np.ndarray
    factors: np.ndarray
    bias: float

    @classmethod
    def fit(
        cls, texts: Sequence[np.ndarray], labels: Sequence[int], prior_shift: float = 0.0, seed: int = 42,
        factor_price: float | None = None,
    ):
        """Logistic loss, Adagrad. ``prior_shift`` is added to the bias, for samples that favour one class.

        The price of factors is chosen on every ``HELD_BACK``-th text where none is given.
        """
        labels = np.asarray(labels, float)
        if factor_price is None:
            factor_price = cls._price(texts, labels, seed)
        known = _telling(texts, labels)
        place = np.full(1 << SLOT_BITS, -1, np.int32)
        place[known] = np.arange(len(known))
        rng = np.random.default_rng(seed)
        model = cls(place, np.zeros(len(known)), rng.normal(0, 0.05, (len(known), FACTORS)), 0.0)
        if not len(texts):
            return model
        share = (labels.sum() + 0.5) / (len(labels) + 1)
        model.bias = float(np.log(share / (1 - share)))
        own = [place[t][place[t] >= 0] for t in texts]
        grown = [np.full(a.shape, 1e-3) for a in (model.weights, model.factors)]
        bias_grown = 1e-3
        # Weights first: factors are there for what single terms don't explain.
        for epoch in range(LINEAR_EPOCHS + EPOCHS):
            pairwise = epoch >= LINEAR_EPOCHS
            order = rng.permutation(len(own))
            for at in range(0, len(order), BATCH):
                rows = order[at : at + BATCH]
                sizes = np.asarray([len(own[r]) for r in rows])
                terms_ = np.concatenate([own[r] for r in rows])
                factors = model.factors[terms_] * pairwise
                sums = _sums(factors, sizes)
                error = _logistic(model._raw(terms_, factors, sums, sizes)) - labels[rows]
                spread = np.repeat(error, sizes)
                used, inverse = np.unique(terms_, return_inverse=True)
                slope = np.bincount(inverse, spread, len(used))
                pull = spread[:, None] * (np.repeat(sums, sizes, axis=0) - factors)
                bend = np.stack([np.bincount(inverse, pull[:, f], len(used)) for f in range(FACTORS)], axis=1)
                for values, history, gradient, price in (
                    (model.weights, grown[0], slope, WEIGHT_PRICE), (model.factors, grown[1], bend, factor_price)
                )[: 1 + pairwise]:
                    history[used] += gradient**2
                    values[used] -= RATE * gradient / np.sqrt(history[used])
                    # Soft thresholding of all terms: only what many texts speak for stays above 0.
                    least = RATE * price * len(rows) / len(own) / np.sqrt(history)
                    values[:] = np.sign(values) * np.maximum(np.abs(values) - least, 0)
                bias_grown += error.sum() ** 2
                model.bias -= RATE * error.sum() / np.sqrt(bias_grown)
        model.bias += prior_shift
        return model

    @classmethod
    def _price(cls, texts: Sequence[np.ndarray], labels: np.ndarray, seed: int) -> float:
        back = np.arange(len(texts)) % HELD_BACK == 0
        held = [t for t, is_back in zip(texts, back) if is_back]
        others = [t for t, is_back in zip(texts, back) if not is_back]
        losses = []
        for price in FACTOR_PRICES:
            score = np.clip(cls.fit(others, labels[~back], seed=seed, factor_price=price).score(held), 1e-6, 1 - 1e-6)
            losses.append(-(labels[back] * np.log(score) + (1 - labels[back]) * np.log(1 - score)).sum())
        return FACTOR_PRICES[int(np.argmin(losses))]

    def _raw(self, terms_: np.ndarray, factors: np.ndarray, sums: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        linear = _sums(self.weights[terms_], sizes)
        pairs = 0.5 * (sums**2 - _sums(factors**2, sizes)).sum(axis=1)
        return self.bias + linear + pairs

    def score(self, texts: Sequence[np.ndarray]) -> np.ndarray:
        """Probabilities of label 1 of sets of terms."""
        own = [self.place[t][self.place[t] >= 0] for t in texts]
        sizes = np.asarray([len(x) for x in own], np.int64)
        terms_ = np.concatenate([np.zeros(0, np.int32), *own])
        factors = self.factors[terms_]
        return _logistic(self._raw(terms_, factors, _sums(factors, sizes), sizes))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> FactorizationMachine:
    """From texts (doc_id, text) and labels (doc_id, toxic); a document labelled both ways is toxic.

    Of either class all labelled documents are used, or where there are more than ``rows``, those whose hash of
    the doc_id is small, about ``rows``. The labels chosen are few enough to be broadcast to the texts.
    """
    labels = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {int(row.toxic): row.n for row in labels.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    shares = {label: min(1.0, rows / n) for label, n in sizes.items()}
    chance = F.pmod(F.xxhash64(F.lit("train"), F.col("doc_id")), F.lit(1_000_000)) / 1_000_000
    kept = F.lit(False)
    for label, share in shares.items():
        kept = kept | ((F.col("toxic") == label) & (chance < share))
    chosen = F.broadcast(labels.where(kept))
    to_terms = F.arrow_udf(_terms_of_batches, "array<int>")
    found = (
        docs.select("doc_id", "text").join(chosen, "doc_id")
        .select("doc_id", to_terms("text").alias("terms"), F.col("toxic").cast("int").alias("toxic"))
        .orderBy("doc_id", F.xxhash64("terms")).toArrow()
    )
    shift = float(np.log(shares.get(0, 1.0) / shares.get(1, 1.0)))
    texts = [np.asarray(value.as_py(), np.int64) for value in found.column("terms")]
    return FactorizationMachine.fit(texts, found.column("toxic").to_pylist(), shift)


def _terms_of_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([terms(value.as_py()).tolist() for value in batch], pa.list_(pa.int32()))


def rate(docs: DataFrame, model: FactorizationMachine) -> DataFrame:
    """Adds ``score`` (0 to 1) to every row, replacing a column of that name. Only ``text`` is looked at.

    A null, empty or wordless text, or one of unknown words only, has the score of an average text. Repeated
    rows get the same result each.
    """

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = np.zeros(len(batch))
            for at in range(0, len(batch), 500):
                part = [terms(value.as_py()) for value in batch.slice(at, 500)]
                out[at : at + len(part)] = model.score(part)
            yield pa.array(out)

    rest = [F.col(f"`{c}`") for c in docs.columns if c != "score"]
    return docs.select(*rest, F.arrow_udf(score, "double")("text").alias("score"))


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train(docs, labels.where(~held_out()))
    return rate(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
