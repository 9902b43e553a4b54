"""Joins on keys that a large share of the rows has (JN1, JN5, JN12).

A heavy-hitter sketch names the hot keys in one pass: every task keeps at most
``COUNTERS`` counters of the Misra-Gries kind (a key that no counter is free
for takes one off all of them), and sketches are merged by adding counters. A
key with more than 1 / COUNTERS of a task's rows is never missed there, and a
count is too small by at most rows / COUNTERS. Rows of a hot key get a salt
and its dimension rows are repeated once for each salt; all other rows join as
they are. It is one equi join on (key, salt), so a hot key is spread over
tasks without AQE, and only hot dimension rows are repeated.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COUNTERS = 1000
#: Salts of rows without a key.
SALTS = 32


def _trim(counts: pd.Series, k: int) -> pd.Series:
    """Misra-Gries step over merged counters: at most ``k`` stay, all less by
    the largest counter that goes."""
    if len(counts) <= k:
        return counts
    counts = counts.sort_values(ascending=False, kind="stable")
    return (counts.iloc[:k] - counts.iloc[k]).loc[lambda x: x > 0]


def hot_keys(df: DataFrame, key: str, share: float, counters: int = COUNTERS) -> list[tuple[str, int]]:
    """(key as text, salts) of the keys with at least ``share`` of the rows:
    at most 1 / share of them. Each gets a salt for every ``share`` / 2 of the
    rows that it has."""
    if share * counters < 4:
        raise ValueError(f"{counters} counters cannot tell a share of {share}")

    def sketch(batches):
        held = pd.Series(dtype="int64")
        n = 0
        for pdf in batches:
            n += len(pdf)
            held = _trim(held.add(pdf["k"].value_counts(), fill_value=0).astype("int64"), counters)
        yield pd.DataFrame({"k": [*held.index, None], "n": [*held.to_numpy(), n]})

    rows = (df.select(F.col(key).cast("string").alias("k")).filter("k IS NOT NULL")
            .mapInPandas(sketch, "k string, n long").groupBy("k").agg(F.sum("n").alias("n")))
    total = rows.filter("k IS NULL").first()
    if total is None or not total["n"]:
        return []
    # a counter may be short by rows / counters
    least = total["n"] * (share - 1 / counters)
    found = rows.filter(F.col("k").isNotNull() & (F.col("n") >= least)).collect()  # at most 1 / (share - 1 / counters)
    return sorted((r["k"], max(2, int(2 * r["n"] / (share * total["n"])) + 1)) for r in found)


def share_of(df: DataFrame) -> float:
    """A key is hot if it has more than half of a partition's fair load, but
    no share below 4 / COUNTERS is looked for."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(0.5 / n, 4 / COUNTERS)


def skewed_join(df: DataFrame, dim: DataFrame, on: str, how: str = "left", share: float | None = None) -> DataFrame:
    """Equi join of ``df`` with ``dim`` (columns other than ``on`` must
    differ), ``how`` inner or left. Rows with a NULL key find nothing and are
    spread by their salt."""
    if how not in ("left", "inner"):
        raise ValueError(f"how is 'left' or 'inner', not {how!r}")
    share = share_of(df) if share is None else share
    hot = hot_keys(df, on, share)
    table = df.sparkSession.createDataFrame(hot, "_hot string, _salts int")
    # the list is bounded by the share
    salts = F.broadcast(table)
    # salts come from the row itself, so a task that runs again deals alike
    spread = F.pmod(F.xxhash64(*df.columns), F.coalesce(F.col("_salts"), F.lit(1))).cast("int")
    left = (df.join(salts, F.col(on).cast("string") == F.col("_hot"), "left")
            .withColumn("_salt", F.when(F.col(on).isNull(), F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)).cast("int")).otherwise(spread))
            .drop("_hot", "_salts"))
    right = (dim.join(salts, F.col(on).cast("string") == F.col("_hot"), "left")
             .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
             .drop("_hot", "_salts"))
    return left.join(right, [on, "_salt"], how).drop("_salt")


def enrich_hot(df: DataFrame, dim: DataFrame, on: str, cols: Sequence[str] | None = None, how: str = "left",
               share: float | None = None) -> DataFrame:
    """JN1 / JN2 where ids may be hot."""
    right = dim if cols is None else dim.select(on, *cols)
    return skewed_join(df, right, on, how, share).select(*df.columns, *[c for c in right.columns if c != on])
