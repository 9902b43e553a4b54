"""Exact values at ranks in two scans (NRM5, TOP1, SYN3).

One pass builds a mergeable quantile sketch (``percentile_approx``) and reads
from it a bracket around every wanted rank; one exact pass counts the rows
below, between and inside the brackets, the latter by value. The values at the
ranks follow from running sums inside a bracket, whose size is a fixed share of
the rows (4 / accuracy). Nothing is sorted as a whole. A rank that its bracket
turns out not to hold (the sketch's error is bounded, not its luck) widens all
brackets and repeats the exact pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bounds of the sketch's accuracy: its rank error is rows / accuracy.
ACCURACY = (10_000, 1_000_000)
#: Rows a bracket should hold where the accuracy allows it.
BRACKET_ROWS = 10_000


def values_at_ranks(df: DataFrame, x: Column, ranks: Sequence[int], n: int) -> list[float]:
    """The values at ``ranks`` (0 is the smallest) of the ``n`` non-NULL
    values of ``x``, a number that a double holds exactly."""
    wanted = sorted(set(ranks))
    if not wanted:
        return []
    values = df.select(x.cast("double").alias("x")).filter("x IS NOT NULL")
    accuracy = min(max(n // BRACKET_ROWS, ACCURACY[0]), ACCURACY[1])
    margin, found = 2.0 / accuracy, None
    while found is None:
        found = _look(values, wanted, n, accuracy, margin)
        margin *= 8
    return [found[r] for r in ranks]


def _look(values: DataFrame, ranks: list[int], n: int, accuracy: int, margin: float) -> dict[int, float] | None:
    ends = [(max(r / n - margin, 0.0), min((r + 1) / n + margin, 1.0)) for r in ranks]
    sketch = values.agg(F.percentile_approx("x", [s for e in ends for s in e], accuracy).alias("q"),
                        F.min("x").alias("a"), F.max("x").alias("b")).first()
    q = sketch["q"]
    spans = [(sketch["a"] if lo == 0 else q[2 * i], sketch["b"] if hi == 1 else q[2 * i + 1])
             for i, (lo, hi) in enumerate(ends)]
    merged: list[list[float]] = []  # brackets that touch become one
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    # even segments lie between brackets and are one group each, odd ones are
    # brackets and are counted by value
    segment = F.lit(0)
    for a, b in merged:
        segment = segment + F.when(F.col("x") >= a, 1).otherwise(0) + F.when(F.col("x") > b, 1).otherwise(0)
    counts = (values.withColumn("seg", segment).withColumn("v", F.when(F.col("seg") % 2 == 1, F.col("x")))
              .groupBy("seg", "v").agg(F.count("*").alias("n")))
    # the running sum inside a bracket: a bounded share of the rows' values
    upto = Window.partitionBy("seg").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.withColumn("upto", F.sum("n").over(upto)).persist()
    try:
        total = {r["seg"]: r["n"] for r in counts.groupBy("seg").agg(F.sum("n").alias("n")).collect()}
        out, hits = {}, []
        for r in ranks:
            before = 0
            for seg in sorted(total):
                if r < before + total[seg]:
                    if seg % 2 == 0:
                        return None  # between brackets
                    hits.append((r, seg, r - before))
                    break
                before += total[seg]
        pick = [F.min_by("v", F.when((F.col("seg") == seg) & (F.col("upto") > at), F.col("upto"))).alias(f"r{r}")
                for r, seg, at in hits]
        row = counts.agg(*pick).first()
        for r, _, _ in hits:
            out[r] = row[f"r{r}"]
        return out
    finally:
        counts.unpersist()
