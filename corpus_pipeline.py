"""A corpus from raw documents to packed sequences: five stages, each on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm.common import field, stored, whole_row
from marketlake.llm.language import UNDETERMINED, LanguageModel, identify
from marketlake.llm.line_dedup import dedup_lines
from marketlake.llm.mixing import mix
from marketlake.llm.near_copies import near_copies
from marketlake.llm.packing import pack
from marketlake.llm.simhash import keep_one

#: Documents whose language is less likely than this are rejected.
LEAST_SCORE = 0.5
#: Near copies share 0.8 of their five-word shingles, which is checked. The search sees 4 x 64 SimHash bits: at 0.8 they
#: differ in 39 bits on average, and of such pairs 3 in a million differ in over 2 bits in each of the 16 blocks.
NEAR = {"words": 5, "prints": 4, "each": 4, "reach": 2, "bits_apart": 72, "shard_rows": 32_768}


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: no text, no letter, or no language that is likely enough.

    The model learns from the documents' own ``lang``. Without any label every document stays that has a letter.
    """
    model = LanguageModel.train(docs)
    rated = identify(docs.select("text", whole_row(docs)), model)
    if not model.languages:
        return rated.where(F.col("text").rlike(r"\p{L}")).select(*[field(c) for c in docs.columns])
    fits = (F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= LEAST_SCORE)
    return rated.where(fits).select(*[field(c) for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with the lines left that no document before it has; n_chars follows the text."""
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    rows = dedup_lines(docs, carry=True)
    return rows.select(*[new[c].alias(c) if c in new else field(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest doc_id. Texts without words are one group."""
    return keep_one(docs, near_copies(docs, **NEAR))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it. A last pass that takes under half of its words is left out.

    Rows are written by shard, and inside a shard in the order of its shuffle: files in order of their names are
    the shards one after the other, each in as many files as it is large.
    """
    drawn = mix(docs, carry=True)
    passes = F.filter("draws", lambda d: 2 * d["words"] >= F.col("size"))
    taken = stored(drawn.select("row", F.explode(passes).alias("draw")), "draws")
    place = [F.col("draw.shard"), F.col("draw.shuffle_key")]
    return taken.repartitionByRange(*place).sortWithinPartitions(*place).select(*[field(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences. A document that the mix repeats has its pieces as often."""
    return pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: SQL can't express the language model, SimHash and the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
