"""Joins used by the conforming and master jobs (JN1-JN14).

Broadcast policy: a side is broadcast explicitly only when its size is
bounded by construction (a fixed code list, the nation table). Every other
dimension (committees, candidates, zip reference) grows with the data, so
the join is left to AQE: it broadcasts at runtime only when the measured
shuffle size is under ``spark.sql.autoBroadcastJoinThreshold`` and keeps a
sort-merge join otherwise; skewed partitions are split by
``spark.sql.adaptive.skewJoin``.

Semi/anti joins and key matching first reduce the other side to its
distinct keys; the distinct is aggregated map-side, so a hot key costs one
row per task instead of a third of the table in the shuffle. Lookups of ids
that may be hot (JN5, JN12, ``hot.enrich_hot``) find them with a sketch and salt
them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from donorlake.operators.dedup import By, best_per_key
from donorlake.operators.hot import enrich_hot, skewed_join


def _on(on) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def enrich(df: DataFrame, dim: DataFrame, on, cols: Sequence[str] | None = None,
           how: str = "left", bounded: int | None = None) -> DataFrame:
    """JN1 / JN14: left equi join to a dimension. ``bounded`` is the number of
    rows up to which the dimension is broadcast: its rows are counted, and one
    that has more is joined like any other."""
    keys = _on(on)
    right = dim if cols is None else dim.select(*keys, *cols)
    if bounded is not None and right.limit(bounded + 1).count() <= bounded:
        right = F.broadcast(right)
    return df.join(right, keys, how)


def join_required(df: DataFrame, other: DataFrame, on, cols=None) -> DataFrame:
    """JN2 / JN11: inner join (a left join whose right key must be present
    is an inner join)."""
    return enrich(df, other, on, cols, how="inner")


def enrich_on(df: DataFrame, dim: DataFrame, left_expr: Column, right_col: str,
              cols: Sequence[str], how: str = "left") -> DataFrame:
    """JN3: join on a computed key (``'FEC_' || id``). The key is derived
    as a column first so the join stays an equi (hash-partitioned) join."""
    tmp = f"_k_{right_col}"
    right = dim.select(F.col(right_col).alias(tmp), *cols)
    return df.withColumn(tmp, left_expr).join(right, tmp, how).drop(tmp)


def enrich_where(df: DataFrame, dim: DataFrame, on, pred: Column, cols=None) -> DataFrame:
    """JN4: constant predicate on the right side is applied before the join
    (a post-filter would turn the left join into an inner one)."""
    return enrich(df, dim.filter(pred), on, cols)


def enrich_via_link(df: DataFrame, link: DataFrame, dim: DataFrame, df_key: str,
                    link_left: str, link_right: str, dim_key: str,
                    cols: Sequence[str], order: Sequence[By], link_cols: Sequence[str] = ()) -> DataFrame:
    """JN5: entity → bridge → entity, then one row per original row, with
    ``link_cols`` of the bridge. Hot ids on either side of it are salted."""
    l2 = link.select(F.col(link_left).alias("_ll"), F.col(link_right).alias("_lr"), *link_cols)
    d2 = dim.select(F.col(dim_key).alias("_lr"), *cols)
    out = skewed_join(df.withColumn("_ll", F.col(df_key)), l2, "_ll")
    out = skewed_join(out, d2, "_lr").drop("_ll", "_lr")
    return best_per_key(out, list(df.columns), order)


def full_merge(a: DataFrame, b: DataFrame, key: str, prefer: str = "a") -> DataFrame:
    """JN6: full outer join; the key and shared columns are coalesced with
    the preferred side first."""
    shared = [c for c in a.columns if c in b.columns and c != key]
    first, second = ("a", "b") if prefer == "a" else ("b", "a")
    j = a.alias("a").join(b.alias("b"), F.col(f"a.{key}") == F.col(f"b.{key}"), "full")
    sel = [F.coalesce(F.col(f"{first}.{key}"), F.col(f"{second}.{key}")).alias(key)]
    sel += [F.coalesce(F.col(f"{first}.{c}"), F.col(f"{second}.{c}")).alias(c) for c in shared]
    sel += [F.col(f"a.{c}") for c in a.columns if c not in shared and c != key]
    sel += [F.col(f"b.{c}") for c in b.columns if c not in shared and c != key]
    return j.select(*sel)


def distinct_keys(df: DataFrame, on) -> DataFrame:
    keys = _on(on)
    cond = F.col(keys[0]).isNotNull()
    for k in keys[1:]:
        cond = cond & F.col(k).isNotNull()
    return df.select(*keys).where(cond).distinct()


def only_with(df: DataFrame, other: DataFrame, on) -> DataFrame:
    """JN7: EXISTS → left semi join against the other side's distinct keys."""
    return df.join(distinct_keys(other, on), _on(on), "left_semi")


def without(df: DataFrame, other: DataFrame, on) -> DataFrame:
    """JN8 / JN9: NOT EXISTS / LEFT JOIN … IS NULL → left anti join."""
    return df.join(distinct_keys(other, on), _on(on), "left_anti")


def lookup_first(df: DataFrame, dim: DataFrame, on, value: str, order: Sequence[By]) -> DataFrame:
    """JN10: correlated scalar ``(SELECT value … WHERE name = x LIMIT 1)``:
    one row per name by a stable order, then a left join."""
    keys = _on(on)
    one = best_per_key(dim, keys, order).select(*keys, value)
    return df.join(one, keys, "left")


def resolve_id(df: DataFrame, key: str, dims: Sequence[tuple[DataFrame, str, str]],
               out_col: str) -> DataFrame:
    """JN12: look an id up in several dimensions (e.g. committee, then
    candidate) and keep the first hit. ``dims`` = (df, key col, value col).
    Hot ids are salted."""
    out = df
    hits = []
    for i, (d, k, v) in enumerate(dims):
        alias = f"_hit{i}"
        right = best_per_key(d.select(F.col(k).alias(key), F.col(v).alias(alias)), [key])
        out = enrich_hot(out, right, key)
        hits.append(F.col(alias))
    return out.withColumn(out_col, F.coalesce(*hits)).drop(*[f"_hit{i}" for i in range(len(dims))])


def match_keys(truth: DataFrame, df: DataFrame, key: str, flag: str = "matched") -> DataFrame:
    """JN13: flag truth rows whose key occurs in ``df``. The other side is
    reduced to distinct keys first, so the join cannot fan out."""
    keys = distinct_keys(df, key).withColumn(flag, F.lit(True))
    return truth.join(keys, key, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
