"""Row filters (FIL1-FIL10, ROW6).

All are plain predicates so Catalyst pushes them into the Parquet scan
where the column is a stored one (``PushedFilters`` in the plan).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from donorlake.functions._util import as_col


def present(c, trim: bool = True) -> Column:
    c = as_col(c)
    return c.isNotNull() & ((F.trim(c) if trim else c) != "")


def require_present(df: DataFrame, cols: Sequence[str], trim: bool = True) -> DataFrame:
    """FIL1: every column not NULL and not blank."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & present(c, trim)
    return df.filter(cond)


def require_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


def where_matches(df: DataFrame, patterns: Mapping[str, str]) -> DataFrame:
    """FIL2: regex guard before parsing."""
    cond = F.lit(True)
    for c, rx in patterns.items():
        cond = cond & as_col(c).rlike(rx)
    return df.filter(cond)


def where_between(df: DataFrame, col, lo=None, hi=None, inclusive: bool = False) -> DataFrame:
    """FIL3: range guard; bounds are exclusive unless ``inclusive``."""
    c = as_col(col)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & ((c >= lo) if inclusive else (c > lo))
    if hi is not None:
        cond = cond & ((c <= hi) if inclusive else (c < hi))
    return df.filter(cond)


INT32_MIN, INT32_MAX = -2147483648, 2147483647


def int32_safe_expr(c: Column) -> Column:
    """-2^31 < c < 2^31-1 as one comparison on c (exact decimal arithmetic),
    FALSE for NULL: an expensive parsed column is evaluated once."""
    half, bound = F.lit(Decimal("0.5")), F.lit(Decimal("2147483647.5"))
    return F.coalesce(F.abs(c + half) < bound, F.lit(False))


def int32_safe(df: DataFrame, col) -> DataFrame:
    """FIL3 as the master model uses it: value fits a 32-bit int (bounds
    exclusive)."""
    return df.filter(int32_safe_expr(as_col(col)))


def since(df: DataFrame, ts_col, floor: str) -> DataFrame:
    """FIL4: date floor (the master build uses 2015-01-01)."""
    return df.filter(as_col(ts_col) >= F.lit(floor).cast("timestamp"))


def where_in(df: DataFrame, values: Mapping[str, Iterable]) -> DataFrame:
    """FIL5: equality / IN list per column."""
    cond = F.lit(True)
    for c, vals in values.items():
        vals = list(vals)
        cond = cond & (as_col(c) == vals[0] if len(vals) == 1 else as_col(c).isin(vals))
    return df.filter(cond)


def where_like(df: DataFrame, col, pattern: str, ignore_case: bool = False) -> DataFrame:
    """FIL6: LIKE / ILIKE."""
    c = as_col(col)
    return df.filter(c.ilike(pattern) if ignore_case else c.like(pattern))


def drop_amendments(df: DataFrame, col, keep_values: Sequence[str | None] = ("N", "", "0", None)) -> DataFrame:
    """FIL7: keep original filings (amendment flag in ``keep_values``;
    ``None`` in the list keeps NULL flags)."""
    c = as_col(col)
    vals = [v for v in keep_values if v is not None]
    cond = c.isin(vals) if vals else F.lit(False)
    if None in keep_values:
        cond = cond | c.isNull()
    return df.filter(cond)


def exclude_keys(df: DataFrame, key: str, bad_keys: Sequence[str]) -> DataFrame:
    """FIL8: drop known test/aggregate keys. The list is a literal of fixed
    size, so it is an IN predicate (pushed to the scan), not a join."""
    return df.filter(~F.col(key).isin(list(bad_keys)) | F.col(key).isNull())


def where_length(df: DataFrame, col, n: int) -> DataFrame:
    """FIL9."""
    return df.filter(F.length(as_col(col)) == n)


def high_water(df: DataFrame, col: str, default=None):
    """AGG12: global MAX as a driver scalar (one value; the aggregation is
    partial per task)."""
    v = df.agg(F.max(col).alias("m")).first()["m"]
    return default if v is None else v


def after_high_water(df: DataFrame, target: DataFrame | None, col: str, default, inclusive=True) -> DataFrame:
    """FIL10: keep rows at or after the target's high-water mark. The mark
    becomes a literal, so a partition column is pruned at planning."""
    mark = default if target is None else high_water(target, col, default)
    c = F.col(col)
    return df.filter(c >= F.lit(mark) if inclusive else c > F.lit(mark))


def drop_header_rows(df: DataFrame, headers: Mapping[str, str]) -> DataFrame:
    """ROW6: drop rows that repeat the header text (a leaked header line)."""
    cond = F.lit(True)
    for c, lit in headers.items():
        cond = cond & (~F.col(c).eqNullSafe(F.lit(lit)))
    return df.filter(cond)
