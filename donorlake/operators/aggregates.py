"""Grouping operators (AGG6-AGG11, AGG13), sets (SET1-SET3), top-k
(TOP1-TOP4) and column padding (PRJ4)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from donorlake.operators.dedup import By, asc, best_per_key, desc, row_number_by
from donorlake.operators.ranks import values_at_ranks

# --- aggregations -----------------------------------------------------------


def sum_contributions(df: DataFrame, keys: Sequence[str], amount: str = "amount",
                      out: str = "amount") -> DataFrame:
    """AGG6: total amount per contributor/committee group."""
    return df.groupBy(*keys).agg(F.sum(amount).alias(out))


def latest(df: DataFrame, keys: Sequence[str], ts: str, out: str | None = None) -> DataFrame:
    """AGG7: latest date per group."""
    return df.groupBy(*keys).agg(F.max(ts).alias(out or ts))


def collapse(df: DataFrame, keys: Sequence[str], fns: Mapping[str, str]) -> DataFrame:
    """AGG8: collapse duplicates keeping MIN/MAX of each column."""
    aggs = [getattr(F, fn)(c).alias(c) for c, fn in fns.items()]
    return df.groupBy(*keys).agg(*aggs)


def mode_by(df: DataFrame, keys: Sequence[str], col: str, out: str | None = None) -> DataFrame:
    """AGG9: most frequent non-NULL value per group, lowest value on ties.

    Two plain aggregations: count per (key, value), then the best value per
    key; both combine map-side, so a hot key never lands in one buffer."""
    keys = list(keys)
    counts = (df.where(F.col(col).isNotNull())
                .groupBy(*keys, col).agg(F.count(F.lit(1)).alias("_cnt")))
    best = best_per_key(counts, keys, [asc(-F.col("_cnt")), asc(col)])
    return best.select(*keys, F.col(col).alias(out or col))


def distinct_on(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AGG10: GROUP BY used as DISTINCT."""
    return df.select(*cols).distinct()


def distinct_rows(df: DataFrame) -> DataFrame:
    """AGG11: SELECT DISTINCT *."""
    return df.distinct()


def row_count(df: DataFrame) -> int:
    """AGG13."""
    return df.count()


# --- sets ---------------------------------------------------------------------


def pad_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """PRJ4: add typed NULL columns and order columns like ``schema``."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])


def union_all(dfs: Sequence[DataFrame], allow_missing: bool = True) -> DataFrame:
    """SET1: UNION ALL by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)


def union_distinct(dfs: Sequence[DataFrame]) -> DataFrame:
    """SET2: UNION (distinct rows)."""
    return union_all(dfs).distinct()


def union_sources(registry: Mapping[str, DataFrame], schema: T.StructType,
                  with_candidate: Sequence[str] = (),
                  candidate_cols: Sequence[str] = ("candidate_id", "candidate_name")) -> DataFrame:
    """SET3: master union over a registry of sources. Sources listed in
    ``with_candidate`` keep their candidate columns; the others are padded
    with typed NULLs. Every source appears once (a source listed in both
    branches would be unioned twice)."""
    parts = []
    for name, df in registry.items():
        if name not in with_candidate:
            df = df.drop(*[c for c in candidate_cols if c in df.columns])
        parts.append(pad_columns(df, schema))
    return union_all(parts)


# --- top-k --------------------------------------------------------------------


def newest_cut(df: DataFrame, ts: str, n: int) -> tuple[Column, Column, int]:
    """TOP1 / SYN3: where the newest ``n`` rows end: a filter of the rows that
    are newer than the n-th, one of those that have its very value, and how many
    of the latter are among the ``n``. A NULL ``ts`` is oldest.

    The value of the n-th row is found in two scans (``ranks``)."""
    if n <= 0:
        return F.lit(False), F.lit(False), 0
    dtype = df.schema[ts].dataType
    when = F.col(ts)
    as_number = (F.unix_micros(when.cast("timestamp")) if isinstance(dtype, (T.TimestampType, T.TimestampNTZType))
                 else F.unix_date(when) if isinstance(dtype, T.DateType) else when.cast("double"))
    total, filled = df.agg(F.count(F.lit(1)), F.count(ts)).first()
    if total <= n:
        return F.lit(True), F.lit(False), 0
    if filled >= n:
        cut = values_at_ranks(df, as_number, [filled - n], filled)[0]
        x = as_number.cast("double")
        newer, tied = F.coalesce(x > cut, F.lit(False)), F.coalesce(x == cut, F.lit(False))
    else:
        newer, tied = when.isNotNull(), when.isNull()
    return newer, tied, n - df.filter(newer).count()


def tied_newest(df: DataFrame, tied: Column, left: int, ts: str, key: str) -> DataFrame:
    """The rows of the n-th value with ``_in``, true for the first ``left`` by
    ``key``, then by all columns: only they are numbered, in blocks where they
    are many."""
    return row_number_by(df.filter(tied), [ts], [asc(key)], "_at").withColumn("_in", F.col("_at") <= left).drop("_at")


def newest_first(df: DataFrame, ts: str, key: str, n: int) -> DataFrame:
    """TOP1 / SYN3: ``df`` with ``_in``, true for the newest ``n`` rows (ties
    by ``key``, then by all columns; a NULL ``ts`` is oldest). Newer rows are in
    and older ones out by a filter. No task orders the rows of a day."""
    newer, tied, left = newest_cut(df, ts, n)
    if n <= 0 or not left:
        return df.withColumn("_in", newer)
    return df.filter(~tied).withColumn("_in", newer).unionByName(tied_newest(df, tied, left, ts, key))


def keep_newest(df: DataFrame, ts: str, n: int, key: str) -> tuple[DataFrame, DataFrame]:
    """TOP1: the newest ``n`` rows, and a one-row frame with the number of the
    others. ``df`` is read several times: pass a stored table."""
    return newest_first(df, ts, key, n).filter("_in").drop("_in"), overflow_count(df, n)


def overflow_count(df: DataFrame, n: int) -> DataFrame:
    """TOP1: how many rows are past the newest ``n``."""
    return df.agg(F.greatest(F.count(F.lit(1)) - F.lit(n), F.lit(0)).alias("overflow_count"))


def ranked(df: DataFrame, by: Sequence[str | Column], descending: bool = True) -> DataFrame:
    """TOP2: report order (a sort of a small, aggregated report)."""
    cols = [F.col(b) if isinstance(b, str) else b for b in by]
    return df.orderBy(*[c.desc() if descending else c.asc() for c in cols])


def extremes(df: DataFrame, col: str) -> DataFrame:
    """TOP4: the row holding the minimum and the row holding the maximum of
    ``col`` (ties broken by the remaining columns), tagged ``which``."""
    rest = [c for c in df.columns if c != col]
    lo = best_per_key(df.withColumn("_g", F.lit(0)), ["_g"], [asc(col)] + [asc(c) for c in rest])
    hi = best_per_key(df.withColumn("_g", F.lit(0)), ["_g"], [desc(col)])
    return (lo.drop("_g").withColumn("which", F.lit("min"))
              .unionByName(hi.drop("_g").withColumn("which", F.lit("max"))))


__all__ = [
    "By", "asc", "desc", "sum_contributions", "latest", "collapse", "mode_by", "distinct_on",
    "distinct_rows", "row_count", "pad_columns", "union_all", "union_distinct", "union_sources",
    "keep_newest", "newest_cut", "newest_first", "tied_newest", "overflow_count", "ranked", "extremes",
]
