"""Conforming projections (PRJ1-PRJ9, FN20).

A source adapter is a ``Spec``: output column → Column expression over the
landing table. ``conform`` applies one spec, ``conform_all`` loops a list
of (landing DataFrame, spec) pairs and unions the results by name, which
is what a templated model over a table list does.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from donorlake.operators.aggregates import pad_columns, union_all


@dataclass(frozen=True)
class Spec:
    """Declarative adapter: output column → expression (str = column name)."""

    columns: Mapping[str, str | Column]
    where: Column | None = None

    def exprs(self) -> list[Column]:
        return [(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in self.columns.items()]


def conform(df: DataFrame, spec: Spec, schema: T.StructType | None = None) -> DataFrame:
    """PRJ1/PRJ2/PRJ3: project a landing table to the conformed shape."""
    if spec.where is not None:
        df = df.filter(spec.where)
    out = df.select(*spec.exprs())
    return pad_columns(out, schema) if schema is not None else out


def conform_all(items: Sequence[tuple[DataFrame, Spec]], schema: T.StructType | None = None) -> DataFrame:
    """PRJ9: one projection per (table, spec), unioned by name."""
    return union_all([conform(df, spec, schema) for df, spec in items])


def realign(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """PRJ8: fix a landing table whose columns are shifted (``city`` holds
    the state, …). ``mapping`` = true name → column that holds it; other
    columns are kept."""
    moved = set(mapping.values())
    keep = [F.col(c) for c in df.columns if c not in moved and c not in mapping]
    return df.select(*keep, *[F.col(src).alias(dst) for dst, src in mapping.items()])


def extract_required(df: DataFrame, col: str, regex: str, outputs: Mapping[str, int],
                     keep_flag: str | None = None) -> DataFrame:
    """FN20: a set-returning regex match in a select list drops rows that do
    not match. Reproduced with an explicit filter; with ``keep_flag`` the
    rows are kept and flagged instead."""
    c = F.col(col)
    hit = c.rlike(regex)
    extracted = {name: F.when(hit, F.regexp_extract(c, regex, g)) for name, g in outputs.items()}
    out = df.withColumns(extracted)
    if keep_flag:
        return out.withColumn(keep_flag, F.coalesce(hit, F.lit(False)))
    return out.filter(hit)
