"""Small tables with everything that is awkward: nulls, empty and very long texts, ties, repeats, extra columns."""

from __future__ import annotations

import random

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omikron pi rho sigma tau".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside.
CLASHING = "row int, size string, score string, key string, place string, shard string, bucket string, rank string"


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n))


def texts(seed: int = 7, n: int = 40) -> list[str | None]:
    rng = random.Random(seed)
    lines = [sentence(rng, 8) for _ in range(6)]
    out: list[str | None] = []
    for i in range(n):
        body = [sentence(rng, rng.randint(1, 30)) for _ in range(rng.randint(1, 5))]
        body.insert(rng.randint(0, len(body)), rng.choice(lines))
        out.append("\n".join(body))
    out += out[:5] + [out[0]] * 12  # copies
    out += [x.replace("alpha", "omega", 1) for x in out[5:9]]  # near copies
    out += [None, None, "", "", " \t", "\n\n", "\n".join(lines), f"  {lines[0].upper()}\t\r", lines[0] + "\u2028"]
    out += ["Éa Straße ÀÉ \u212a\u0130 \u03a3", "x" * 5000, sentence(rng, 6000), "a", "\ud7ff\U0001f600 \x0b\x0c end"]
    return out


def rows(seed: int = 7) -> list[tuple]:
    """(doc_id, text, lang, source, n_chars); ids are not in order, two rows are repeated, two ids are null."""
    rng = random.Random(seed)
    all_texts = texts(seed)
    ids = rng.sample(range(1000), len(all_texts))
    sources = ["a", "b", "B", "ä", None, "a", "a"]
    out = [
        (doc_id, text, rng.choice(["en", "de", None]), rng.choice(sources), None if text is None else len(text))
        for doc_id, text in zip(ids, all_texts)
    ]
    return out + out[3:5] + [(None, "no id here at all", None, None, 17), (None, "no id here at all", None, None, 17)]


def frame(spark, data=None, clashing: bool = True):
    """The rows as a table, with extra columns whose names operators use themselves."""
    df = spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(3)
    if clashing:
        for name, kind in (part.split() for part in CLASHING.split(", ")):
            df = df.selectExpr("*", f"cast(7 as {kind}) as {name}")
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
