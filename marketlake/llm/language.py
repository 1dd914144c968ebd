"""Language identification: multinomial naive Bayes over hashed character n-grams.

Spark counts the hashed n-grams of a bounded sample of labelled texts; there is one count for each language and
slot at most. The matrix of log-probabilities goes to the tasks, which score batches of texts with numpy: all
n-grams of a batch are hashed at once, their rows of the matrix are looked up, and summed text by text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Answer for a text that is null or has no letter.
UNDETERMINED = "und"
#: Labelled texts to learn from, of each language: all, or about so many where there are more.
TRAIN_ROWS = 20_000
SLOT_BITS = 15
ORDERS = (1, 2, 3)
#: Added to every count.
SMOOTHING = 0.5
#: The score is the posterior of so many n-grams at most; those of a long text are far from independent.
EVIDENCE = 200
#: Code points that are hashed at once.
PIECE = 1 << 18
#: Texts of the sample whose n-grams one task counts, about.
TRAIN_TASK_ROWS = 2_000

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _slots(codes: np.ndarray) -> Iterator[np.ndarray]:
    """For each order the slots of the n-grams that start at each code point."""
    codes = codes.astype(np.uint64)
    for order in ORDERS:
        mixed = np.full(max(0, len(codes) - order + 1), order, np.uint64)
        for i in range(order):
            mixed = (mixed ^ codes[i : len(codes) - order + 1 + i]) * _MIX
            mixed ^= mixed >> np.uint64(29)
        yield ((mixed * _MIX) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), "<u4")


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _count_slots(languages: Sequence[str]):
    def run(batches):
        counts = np.zeros((len(languages), 1 << SLOT_BITS), np.int64)
        number = {language: n for n, language in enumerate(languages)}
        for batch in batches:
            for language, value in zip(batch.column("lang").to_pylist(), batch.column("text")):
                codes = _codes(value.as_py())
                for at in range(0, len(codes), PIECE):
                    for slots in _slots(codes[at : at + PIECE + max(ORDERS) - 1]):
                        counts[number[language]] += np.bincount(slots, minlength=1 << SLOT_BITS)
        language, slot = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(language, pa.int32()), pa.array(slot, pa.int32()), pa.array(counts[language, slot], pa.int64())],
            names=["language", "slot", "n"],
        )

    return run


@dataclass
class LanguageModel:
    languages: list[str]
    logs: np.ndarray  # slot, language
    prior: np.ndarray

    @classmethod
    def train(cls, labelled: DataFrame, rows: int = TRAIN_ROWS) -> LanguageModel:
        """From columns doc_id, text and lang; rows where text or lang is null don't count.

        Of a language with more than ``rows`` rows, those whose hash of the doc_id is small are taken, about ``rows``;
        of one with fewer, all. Rows without a doc_id are drawn by their texts.
        """
        labelled = labelled.select("doc_id", "text", "lang").where("text is not null and lang is not null")
        sizes = {row.lang: row.n for row in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
        languages, total = sorted(sizes), sum(sizes.values())
        key = [F.col("doc_id"), F.when(F.col("doc_id").isNull(), F.col("text"))]
        chance = F.pmod(F.xxhash64(F.lit("train"), *key), F.lit(1_000_000))
        large = {language: int(1_000_000 * rows / n) for language, n in sizes.items() if n > rows}
        kept = ~F.col("lang").isin(list(large))
        for language, share in large.items():
            kept = kept | ((F.col("lang") == language) & (chance < share))
        sample = labelled.where(kept) if large else labelled
        tasks = 1 + sum(min(n, rows) for n in sizes.values()) // TRAIN_TASK_ROWS
        counted = (
            sample.select("lang", "text").repartition(tasks)
            .mapInArrow(_count_slots(languages), "language int, slot int, n long")
            .groupBy("language", "slot").agg(F.sum("n").alias("n"))
        )
        counts = np.full((1 << SLOT_BITS, len(languages)), SMOOTHING)
        for language, slot, n in counted.collect():
            counts[slot, language] += n
        logs = np.log(counts / counts.sum(axis=0))
        return cls(languages, logs, np.log(np.asarray([sizes[x] for x in languages], float) / max(total, 1)))

    def predict(self, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray]:
        """Languages and scores; ties go to the language that sorts first."""
        names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        if not self.languages:
            return names, scores
        waiting: list[tuple[int, np.ndarray]] = []
        held = 0

        def flush() -> None:
            nonlocal held
            if waiting:
                for (place, _), sums, n in zip(waiting, *self._sums([codes for _, codes in waiting])):
                    names[place], scores[place] = self._decide(sums, n)
            waiting.clear()
            held = 0

        for place, text in enumerate(texts):
            if has_letter(text):
                codes = _codes(text)
                waiting.append((place, codes))
                held += len(codes)
                if held >= PIECE:
                    flush()
        flush()
        return names, scores

    def _sums(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihoods and numbers of n-grams of some texts; a very long one is taken in pieces."""
        sums, numbers = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), np.int64)
        joined = np.concatenate(texts)
        edges = np.cumsum([0, *map(len, texts)])
        overlap = max(ORDERS) - 1
        for at in range(0, len(joined), PIECE):
            end = min(len(joined), at + PIECE)
            for order, slots in zip(ORDERS, _slots(joined[at : end + overlap])):
                start = np.arange(at, at + len(slots))
                text = np.searchsorted(edges, start, "right") - 1
                inside = (start + order <= edges[text + 1]) & (start < end)
                slots, text = slots[inside], text[inside]
                if len(slots):
                    first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
                    sums[text[first]] += np.add.reduceat(self.logs[slots], first)
                    numbers += np.bincount(text, minlength=len(texts))
        return sums, numbers

    def _decide(self, sums: np.ndarray, n: int) -> tuple[str, float]:
        likely = sums + self.prior
        best = int(likely.argmax())
        # Only the score is tempered: scaled as a whole, the sums keep their order.
        odds = np.exp((likely - likely[best]) * min(1.0, EVIDENCE / max(n, 1)))
        return self.languages[best], float(odds[best] / odds.sum())


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """Adds ``lang_pred`` and ``score`` (0 to 1) to every row, replacing columns of these names.

    Only ``text`` is looked at. Null texts, texts without a letter, and all texts if the model has learned no
    language are ``und`` with score 0. The language is the one with the largest sum of log-probabilities over all
    n-grams, however long the text is; a very long one is summed in pieces. Repeated rows get the same result each.
    An empty table gives an empty one.
    """

    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            names, scores = model.predict(batch.to_pylist())
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores)], ["lang_pred", "score"])

    predict = F.arrow_udf(predict, "lang_pred string, score double")
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")]
    return docs.select(*rest, predict("text").alias("__p")).select(*rest, "__p.lang_pred", "__p.score")


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = LanguageModel.train(docs.where(~held_out()))
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score"
    )
