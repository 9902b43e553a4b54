"""Data-quality suites and reports (QC1-QC6, AGG1-AGG5).

A suite is a list of rules over one table. All row-level rules (not_null,
accepted_values, has_prefix) are evaluated in a single aggregation pass;
each ``unique`` rule needs its own grouping. The result is a small
DataFrame ``(rule, column, violations)``; nothing row-level reaches the
driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from donorlake.operators.joins import match_keys


@dataclass(frozen=True)
class Rule:
    kind: str  # not_null | unique | accepted_values | has_prefix
    column: str
    values: tuple = field(default_factory=tuple)

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.column}"


def not_null(c: str) -> Rule:
    """QC1."""
    return Rule("not_null", c)


def unique(c: str) -> Rule:
    """QC2."""
    return Rule("unique", c)


def accepted(c: str, values: Sequence[str]) -> Rule:
    """QC3."""
    return Rule("accepted_values", c, tuple(values))


def has_prefix(c: str, prefix: str) -> Rule:
    """QC4: non-NULL values must start with ``prefix``. The source test used
    LIKE, where ``_`` in a prefix is a wildcard; ``startswith`` is literal."""
    return Rule("has_prefix", c, (prefix,))


def _row_rule_expr(r: Rule) -> Column:
    c = F.col(r.column)
    if r.kind == "not_null":
        # failing rows: value is NULL
        return F.count_if(c.isNull())
    if r.kind == "has_prefix":
        return F.count_if(c.isNotNull() & ~c.startswith(r.values[0]))
    raise ValueError(r.kind)


def run_suite(df: DataFrame, rules: Sequence[Rule], materialize: bool = True) -> DataFrame:
    """QC5: violations per rule as a DataFrame (rule, column, violations).

    Row rules share one aggregation; ``unique`` and ``accepted_values`` count
    values and take a grouping each, of the values that can violate them
    only. With ``materialize`` (an input that is computed, not stored) the
    rules' columns are checkpointed once for all passes."""
    spark = df.sparkSession
    df = df.select(*dict.fromkeys(r.column for r in rules)) if rules else df
    row_rules = [r for r in rules if r.kind in ("not_null", "has_prefix")]
    value_rules = [r for r in rules if r not in row_rules]
    if materialize and bool(row_rules) + len(value_rules) > 1:
        from donorlake.session import checkpoint_root

        checkpoint_root(spark)
        df = df.checkpoint(eager=True)
    parts: list[DataFrame] = []
    if row_rules:
        wide = df.agg(*[_row_rule_expr(r).cast("long").alias(f"r{i}") for i, r in enumerate(row_rules)])
        stack = ", ".join(
            f"'{r.kind}', '{r.column}', r{i}" for i, r in enumerate(row_rules)
        )
        parts.append(wide.selectExpr(f"stack({len(row_rules)}, {stack}) AS (rule, column, violations)"))
    for r in value_rules:
        c = F.col(r.column)
        if r.kind == "unique":
            bad = df.where(c.isNotNull()).groupBy(r.column).count().where(F.col("count") > 1)
        elif r.kind == "accepted_values":
            # failing *values*: distinct non-NULL values outside the list
            bad = df.where(~c.isin(list(r.values))).select(r.column).distinct()
        else:
            raise ValueError(r.kind)
        parts.append(bad.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(r.kind).alias("rule"), F.lit(r.column).alias("column"), "violations"))
    if not parts:
        return spark.createDataFrame([], "rule string, column string, violations long")
    return reduce(DataFrame.unionByName, parts)


def failed(suite_result: DataFrame) -> DataFrame:
    return suite_result.where(F.col("violations") > 0)


class QualityError(AssertionError):
    pass


def assert_empty(df: DataFrame, what: str = "table") -> None:
    """QC6: the table must be empty (``isEmpty`` stops at the first row)."""
    if not df.isEmpty():
        raise QualityError(f"{what} is not empty")


def assert_at_most(df: DataFrame, n: int, what: str = "table") -> int:
    """QC6: the table holds at most n rows; returns the count."""
    c = df.count()
    if c > n:
        raise QualityError(f"{what} has {c} rows, limit {n}")
    return c


def parse_failures(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Count values a parse step could not read: raw present but parsed NULL.
    ``pairs`` = {label: (raw column, parsed column)}."""
    return df.agg(*[
        F.count_if(F.col(raw).isNotNull() & (F.trim(F.col(raw)) != "") & F.col(parsed).isNull()).alias(label)
        for label, (raw, parsed) in pairs.items()
    ])


# --- reports (AGG1-AGG5) --------------------------------------------------------


def source_report(contribs: DataFrame) -> DataFrame:
    """AGG1: rows per source, largest first."""
    return (contribs.groupBy("source").agg(F.count(F.lit(1)).alias("n_contributions"))
            .orderBy(F.col("n_contributions").desc()))


def _pct(num: Column, den: Column) -> Column:
    return F.round(F.try_divide(num.cast("double") * 100, F.nullif(den, F.lit(0)).cast("double")), 2)


def match_rate(truth: DataFrame, contribs: DataFrame, key: str = "name_concat") -> DataFrame:
    """AGG2: per state, distinct truth keys, distinct matched keys, rate."""
    m = match_keys(truth.select("state", key), contribs, key)
    total = F.count_distinct(F.col(key))
    matched = F.count_distinct(F.when(F.col("matched"), F.col(key)))
    return m.groupBy("state").agg(
        total.alias("total_ground_truth"),
        matched.alias("matched_count"),
        _pct(matched, total).alias("match_rate_percent"),
    )


def match_rate_unique(truth: DataFrame, contribs: DataFrame, key: str = "name_concat") -> DataFrame:
    """AGG3: distinct (state, key) people, then sum of 0/1 matches."""
    people = truth.select("state", key).distinct()
    m = match_keys(people, contribs, key).withColumn("m", F.col("matched").cast("long"))
    return m.groupBy("state").agg(
        F.count(F.lit(1)).alias("total_unique_people"),
        F.sum("m").alias("matched_unique_people"),
        _pct(F.sum("m"), F.count(F.lit(1))).alias("match_rate_percent"),
    )


def overall_rate(rates: DataFrame) -> DataFrame:
    """AGG4: Σmatched / Σtotal · 100 across states, 0 when there is none."""
    tot = F.sum("total_ground_truth")
    hit = F.sum("matched_count")
    return rates.agg(
        tot.alias("total_ground_truth"),
        hit.alias("total_matched"),
        F.coalesce(_pct(hit, tot), F.lit(0.0)).alias("overall_rate"),
    )


# Confidence bands of the match-rate report (percent).
BANDS = [(80, "high"), (50, "medium"), (30, "low")]


def confidence_band(rate: Column) -> Column:
    """AGG5: ≥80 high, 50-79 medium, 30-49 low, else very_low."""
    out = F.lit("very_low")
    for lo, name in reversed(BANDS):
        out = F.when(rate >= lo, F.lit(name)).otherwise(out)
    return out
