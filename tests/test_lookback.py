"""Chunked windows equal whole-series windows, whatever the density of the chunks."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketlake.operators.lookback import CHUNK, RowChunks, over_chunks, with_lookback


def _series(seed: int) -> pd.DataFrame:
    rng = random.Random(seed)
    rows = []
    for key in ("hot", "cold", "single"):
        n = {"hot": 400, "cold": 30, "single": 1}[key]
        position = 0
        for _ in range(n):
            # Dense runs and long gaps: chunks of many rows, of one row, and empty ones.
            position += rng.choice([1, 1, 1, 1, 2, 7, 150])
            rows.append((key, position, round(rng.uniform(1, 100), 2)))
    return pd.DataFrame(rows, columns=["k", "t", "x"])


@pytest.mark.parametrize("seed,width", [(1, 10), (2, 1), (3, 64), (4, 1000), (5, None), (6, None)])
def test_chunked_equals_whole(spark, seed, width):
    pdf = _series(seed)
    df = spark.createDataFrame(pdf)

    def compute(frame, window):
        first = frame.withColumns(
            {"mean": F.avg("x").over(window(5)), "n": F.count("x").over(window(5)), "lag": F.lag("x").over(window())}
        )
        return first.withColumn("mean_of_mean", F.avg("mean").over(window(4)))

    # Chunks of a handful of rows, shorter than the windows' reach, or of a width in time.
    chunk = RowChunks(3 + seed) if width is None else F.floor(F.col("t") / width)
    actual = over_chunks(df, ["k"], ["t"], chunk, 7, compute).orderBy("k", "t").toPandas()
    whole = over_chunks(df, ["k"], ["t"], None, 7, compute).orderBy("k", "t").toPandas()
    pd.testing.assert_frame_equal(actual, whole)

    grouped = pdf.sort_values(["k", "t"]).groupby("k")["x"]
    expected = grouped.transform(lambda s: s.rolling(5, min_periods=1).mean())
    assert actual["mean"].tolist() == pytest.approx(expected.tolist())
    assert len(actual) == len(pdf)


def test_one_shuffle_of_the_input(spark):
    """The input is scanned and shuffled once although tails and windows both read it."""
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("k"), "id", F.rand(1).alias("x"))
    out = over_chunks(
        df, ["k"], ["id"], F.floor(F.col("id") / 500), 3,
        lambda f, w: f.withColumn("m", F.avg("x").over(w(4))),
    )
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert plan.count("Range (") == 1
    assert plan.count("ReusedExchange") == 1


def test_rows_may_hold_maps(spark):
    df = spark.range(50).select(F.lit("k").alias("k"), "id", F.create_map(F.lit("a"), F.col("id")).alias("m"))
    out = over_chunks(
        df, ["k"], ["id"], F.floor(F.col("id") / 10), 2, lambda f, w: f.withColumn("p", F.lag("m", 2).over(w()))
    )
    assert [r.p["a"] for r in out.orderBy("id").collect()[2:]] == list(range(48))


def test_chunks_of_rows_hold_no_hot_second(spark):
    """One series and one second, or no time at all, have most rows; no chunk holds much more than it may."""
    most = 250
    hot = spark.range(6_000).select(
        F.lit("hot").alias("k"), F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.lit(7)).cast("long").alias("t"), "id"
    )
    rest = spark.range(6_000, 7_000).select((F.col("id") % 50).cast("string").alias("k"), F.col("id").alias("t"), "id")
    df = hot.unionByName(rest).withColumn("x", F.pmod(F.xxhash64("id"), F.lit(1000)).cast("double"))
    sizes = with_lookback(df, ["k"], ["t", "id"], RowChunks(most), 4, ["x"]).groupBy("k", CHUNK).count()
    assert sizes.agg(F.max("count")).first()[0] <= 2 * most

    def compute(frame, window):
        return frame.withColumn("mean", F.avg("x").over(window(5))).withColumn("lag", F.lag("x", 4).over(window()))

    cut = over_chunks(df, ["k"], ["t", "id"], RowChunks(most), 4, compute, ["x"]).orderBy("k", "t", "id").toPandas()
    whole = over_chunks(df, ["k"], ["t", "id"], None, 4, compute).orderBy("k", "t", "id").toPandas()
    pd.testing.assert_frame_equal(cut[whole.columns], whole)


def test_chunks_are_drawn_once(spark, tmp_path):
    """Of more rows than a range sample takes, tails and windows see the same chunks, in a stream's batches too."""
    path = str(tmp_path / "in")
    spark.range(60_000).select(
        (F.col("id") % 3).cast("string").alias("k"), F.xxhash64("id").alias("t"), "id", F.rand(1).alias("x"), F.lit("y").alias("y")
    ).coalesce(1).write.parquet(path)
    df = spark.read.parquet(path)

    def compute(frame, window):
        return frame.withColumn("n", F.count("x").over(window(5))).withColumn("lag", F.lag("x", 4).over(window()))

    whole = over_chunks(df, ["k"], ["t", "id"], None, 4, compute)
    folder = str(tmp_path / "chunks")
    for chunks in (RowChunks(700), RowChunks(700, store=True), RowChunks(900, folder=folder), RowChunks(500, folder=folder)):
        cut = over_chunks(df, ["k"], ["t", "id"], chunks, 4, compute, ["x"]).select(*whole.columns)
        assert cut.exceptAll(whole).count() == 0 and cut.count() == 60_000


def test_stored_input_is_evaluated_once(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(500).selectExpr("'k' as k", "id", "cast(id as double) as x", "'{\"a\":1}' as js").write.parquet(path)
    df = spark.read.parquet(path).withColumn("parsed", F.from_json("js", "a int"))
    out = over_chunks(
        df, ["k"], ["id"], RowChunks(100, store=True), 3, lambda f, w: f.withColumn("m", F.avg("x").over(w(4))), ["x"]
    )
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan and path not in plan
