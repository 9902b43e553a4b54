"""Ranks, newest rows and row numbers where one value or one key holds most
of the rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from donorlake.operators import aggregates as agg, dedup, normalize, ranks
from donorlake.operators.dedup import asc, desc


@pytest.mark.parametrize("kind", ["spread", "ties", "one", "skewed"])
def test_values_at_ranks(spark, kind):
    rng = np.random.default_rng(3)
    x = {"spread": rng.normal(size=5000), "ties": rng.integers(0, 5, 5000), "one": np.ones(50),
         "skewed": np.concatenate([np.zeros(3000), rng.lognormal(0, 4, 500)])}[kind].astype(float)
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)] * 7, "x double").repartition(5)
    at = [0, 1, len(x) // 4, len(x) // 2, len(x) // 2 + 1, len(x) - 2, len(x) - 1]
    assert ranks.values_at_ranks(df, F.col("x"), at, len(x)) == [float(np.sort(x)[r]) for r in at]
    q = normalize.exact_quantiles(df, F.col("x"), [0.0, 0.25, 0.5, 0.9, 1.0])
    assert np.allclose(q, np.quantile(x, [0.0, 0.25, 0.5, 0.9, 1.0]))


def test_brackets_widen_when_the_sketch_misses(spark, monkeypatch):
    x = np.random.default_rng(1).normal(size=4000)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    monkeypatch.setattr(ranks, "ACCURACY", (1_000_000, 1_000_000))
    real = ranks._look
    tried = []

    def look(values, wanted, n, accuracy, margin):
        tried.append(margin)
        return real(values, wanted, n, 20, margin)  # a sketch far worse than assumed

    monkeypatch.setattr(ranks, "_look", look)
    at = [100, 1999, 3333]
    assert ranks.values_at_ranks(df, F.col("x"), at, len(x)) == [float(np.sort(x)[r]) for r in at]
    assert len(tried) > 1


@pytest.mark.parametrize("n", [0, 1, 40, 100, 333, 500, 520])
def test_newest_rows_with_one_moment_in_most_rows(spark, n):
    rng = random.Random(n)
    rows = [(f"k{rng.randint(0, 300):03d}", None if i % 13 == 0 else 1_700_000_000 + (0 if i % 3 else rng.randint(-5, 5)))
            for i in range(500)]
    df = (spark.createDataFrame(rows, "id string, s long").select("id", F.timestamp_seconds("s").alias("ts"), "s")).repartition(4)
    kept, over = agg.keep_newest(df, "ts", n, "id")
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))[:n]
    assert sorted(((r["id"], r["s"]) for r in kept.collect()), key=repr) == sorted(want, key=repr)
    assert over.first()[0] == max(0, 500 - n)


@pytest.mark.parametrize("hot_rows", [10_000, 50])
def test_row_numbers_of_a_hot_key_and_step(spark, hot_rows):
    rng = random.Random(5)
    rows = [("hot" if i % 3 else f"k{rng.randint(0, 20)}", None if i % 17 == 0 else f"2024-01-{1 + (i % 7 == 0):02d}",
             rng.randint(0, 50), "same" if i % 2 else str(i)) for i in range(1500)]
    df = spark.createDataFrame(rows, "k string, day string, v int, note string").withColumn("day", F.to_date("day")).repartition(6)
    got = dedup.row_number_by(df, ["k"], [desc("day"), asc("v")], "rn", hot_rows=hot_rows)
    got.createOrReplaceTempView("got")
    df.createOrReplaceTempView("given")
    want = spark.sql("""SELECT *, row_number() OVER (PARTITION BY k ORDER BY day DESC NULLS LAST, v ASC NULLS LAST,
                        day NULLS FIRST, v NULLS FIRST, note NULLS FIRST) AS rn FROM given""")
    key = lambda d: sorted(((r["k"], str(r["day"]), r["v"], r["note"], r["rn"]) for r in d.collect()), key=repr)
    assert key(got) == key(want)


def test_no_block_of_a_hot_step_is_large(spark, monkeypatch):
    """A third of the rows are one key with one day, another third are equal
    in every column."""
    sizes = []
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit("a")).when(F.col("id") % 3 == 1, F.lit("b")).otherwise(F.col("id").cast("string")).alias("k"),
        F.lit("2024-01-01").cast("date").alias("day"), F.when(F.col("id") % 3 == 1, F.lit(0)).otherwise(F.col("id")).alias("v")).repartition(8)
    scratch = dedup.scratch_path
    paths = []
    monkeypatch.setattr(dedup, "scratch_path", lambda s, n: paths.append((n, scratch(s, n))) or paths[-1][1])
    got = dedup.row_number_by(df, ["k"], [asc("day")], "rn", hot_rows=500)
    blocks = spark.read.parquet(dict(paths)["blocks"]).groupBy("_block").count()
    sizes = sorted(r["count"] for r in blocks.collect())
    assert sum(sizes) == 6000 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    for k in "ab":
        assert sorted(r["rn"] for r in got.filter(F.col("k") == k).collect()) == list(range(1, 3001))
