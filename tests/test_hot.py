"""Heavy hitters and salted joins."""

import collections
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from donorlake.operators import hot, joins


def skewed(spark, n=6000):
    rng = random.Random(1)
    keys = [None if i % 50 == 0 else "big" if i % 3 == 0 else "mid" if i % 10 == 1 else f"k{rng.randint(0, 2000)}" for i in range(n)]
    return keys, spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, i int").repartition(6)


def test_every_heavy_key_is_found(spark):
    keys, df = skewed(spark)
    found = hot.hot_keys(df, "k", 0.02)
    n = collections.Counter(k for k in keys if k)
    assert {k for k, c in n.items() if c >= 0.02 * sum(n.values())} <= {k for k, _ in found} <= {"big", "mid"}
    assert dict(found)["big"] > dict(found)["mid"] >= 2


def test_counters_stay_bounded_and_err_on_the_low_side():
    rng = random.Random(2)
    items = ["a"] * 500 + [f"x{rng.randint(0, 5000)}" for _ in range(3000)]
    rng.shuffle(items)
    held = pd.Series(dtype="int64")
    for at in range(0, len(items), 100):
        batch = pd.Series(items[at : at + 100]).value_counts()
        held = hot._trim(held.add(batch, fill_value=0).astype("int64"), 20)
        assert len(held) <= 20
    assert 500 - len(items) / 20 <= held["a"] <= 500


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_the_plain_one(spark, how):
    _, df = skewed(spark)
    dim = spark.createDataFrame([("big", "B"), ("big", "B2"), ("mid", "M"), ("k7", "S"), ("none", "N"), (None, "0")], "k string, name string")
    got = hot.skewed_join(df, dim, "k", how, 0.02).select("k", "i", "name")
    want = df.join(dim, "k", how).select("k", "i", "name")
    rows = lambda x: sorted(map(tuple, x.collect()), key=repr)
    assert rows(got) == rows(want)


def test_a_hot_key_is_spread_over_tasks_without_aqe(spark):
    _, df = skewed(spark, 9000)
    dim = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v")).unionByName(
        spark.createDataFrame([("big", 1), ("mid", 2)], "k string, v long"))
    keep = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        load = lambda x: sorted(r["count"] for r in x.groupBy(F.spark_partition_id().alias("p")).count().collect())
        plain, salted = load(df.join(dim, "k", "left")), load(hot.skewed_join(df, dim, "k"))
    finally:
        for c, v in keep.items():
            spark.conf.set(c, v)
    assert plain[-1] > 2.5 * 9000 / 8 and salted[-1] < 1.7 * 9000 / 8


def test_bounded_dimensions_are_counted_first(spark):
    _, df = skewed(spark, 100)
    dim = spark.createDataFrame([("big", 1), ("mid", 2)], "k string, v int")
    few = joins.enrich(df, dim, "k", bounded=2)._jdf.queryExecution().optimizedPlan().toString()
    many = joins.enrich(df, dim, "k", bounded=1)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in few and "strategy=broadcast" not in many
