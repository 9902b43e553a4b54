"""Keep-one-row-per-key and row numbering (WIN1-WIN9).

The source models write these as ``ROW_NUMBER() OVER (PARTITION BY key
ORDER BY …) = 1``. A window puts every row of a key into one task, so one
hot key (a constant id, a default committee) becomes one straggler that
sorts a third of the table. Here "best row per key" is an aggregation:
``max_by(struct(row), struct(order…, tiebreak…))`` per key. Aggregations
combine map-side, so a hot key is reduced to one row per input partition
before the shuffle.

Every order is made total by appending all remaining columns, so the kept
row does not depend on partitioning or task timing (the source's unordered
ROW_NUMBER is arbitrary).

Row *numbering* (WIN6, WIN7) keeps every row. ``row_number_by`` numbers rows
inside (key, step of the leading order column), e.g. key and day, and adds
the rows of the key's earlier steps from a small table of counts. Rows cross
the network once, and a hot key spreads over its steps.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from donorlake.session import scratch_path


@dataclass(frozen=True)
class By:
    """One ordering key. ``desc`` picks the largest first; NULLs are never
    preferred unless ``nulls_first``."""

    expr: str | Column
    desc: bool = False
    nulls_first: bool = False

    @property
    def col(self) -> Column:
        return self.expr if isinstance(self.expr, Column) else F.col(self.expr)


def asc(expr, nulls_first=False) -> By:
    return By(expr, False, nulls_first)


def desc(expr, nulls_first=False) -> By:
    return By(expr, True, nulls_first)


_ORDERABLE_SKIP = (T.MapType, T.VariantType) if hasattr(T, "VariantType") else (T.MapType,)


def _tiebreak_cols(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    ex = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if f.name not in ex and not isinstance(f.dataType, _ORDERABLE_SKIP)
    ]


def _flip(c: Column, dtype: T.DataType) -> Column | None:
    """An expression whose ascending order is c's descending order, or
    None when the type has no such cheap inverse (strings)."""
    if isinstance(dtype, T.BooleanType):
        return ~c
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return -c.cast("long")
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        return -c
    if isinstance(dtype, T.DateType):
        return -F.unix_date(c)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return -F.unix_micros(c.cast("timestamp"))
    return None


def _encode(df: DataFrame, order: Sequence[By], use_max: bool) -> list[Column] | None:
    fields: list[Column] = []
    for i, b in enumerate(order):
        c = b.col
        value = c
        if b.desc != use_max:
            dtype = df.select(c.alias("_t")).schema["_t"].dataType
            value = _flip(c, dtype)
            if value is None:
                return None
        # null flag decides NULL placement independent of the value order:
        # under max the preferred flag must compare larger, under min smaller
        prefer_null = b.nulls_first
        flag = c.isNull() if (use_max == prefer_null) else c.isNotNull()
        fields += [flag.alias(f"_n{i}"), value.alias(f"_v{i}")]
    return fields


def newest_order(df: DataFrame, newest: str) -> list[Column]:
    """Columns whose least value is the newest row's; a NULL comes last."""
    return _encode(df, [desc(newest)], False)


def best_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[By] = (),
    rank_col: str | None = None,
) -> DataFrame:
    """Keep the first row per key under ``order`` (then all columns)."""
    keys = list(keys)
    order = list(order)
    use_max = bool(order) and order[0].desc
    encoded = _encode(df, order, use_max)
    if encoded is None:
        return _best_per_key_passes(df, keys, order, rank_col)
    # one struct: the order, then every other column, which breaks ties and
    # is the kept row; columns without an order ride along behind
    tie = _tiebreak_cols(df, keys)
    rest = [c for c in df.columns if c not in keys and c not in tie]
    whole = F.struct(*encoded, *[F.col(c).alias(f"_t{i}") for i, c in enumerate(tie)])
    if rest:
        pick = F.max_by if use_max else F.min_by
        best = pick(F.struct(whole.alias("_w"), *rest), whole)
    else:
        best = F.struct((F.max if use_max else F.min)(whole).alias("_w"))
    out = df.groupBy(*keys).agg(best.alias("_best")).select(
        *keys, *[F.col(f"_best._w._t{i}").alias(c) for i, c in enumerate(tie)],
        *[F.col(f"_best.{c}") for c in rest]).select(*df.columns)
    if rank_col:
        out = out.withColumn(rank_col, F.lit(1).cast("long"))
    return out


def _best_per_key_passes(df, keys, order, rank_col):
    """Orders a single struct cannot express (a string key against the
    leading direction): one pass per order key keeps the rows holding the
    key's preferred value (an aggregation per key, joined back), then the
    total tiebreak picks one row. Every pass combines map-side, so hot keys
    stay safe; it costs one extra shuffle per order key."""
    cur = df
    kk = [f"_pk{i}" for i in range(len(keys))]
    for b in order:
        cand = cur.withColumn("_cmp", b.col)
        pick = F.max("_cmp") if b.desc else F.min("_cmp")  # ignore NULLs
        best = cand.groupBy(*keys).agg(pick.alias("_best"), F.count_if(F.col("_cmp").isNull()).alias("_nulls"))
        best = best.select(*[F.col(k).alias(a) for k, a in zip(keys, kk)], "_best", "_nulls")
        cond = None
        for k, a in zip(keys, kk):
            e = F.col(k).eqNullSafe(F.col(a))
            cond = e if cond is None else cond & e
        j = cand.join(best, cond, "inner")
        if b.nulls_first:
            keep = F.when(F.col("_nulls") > 0, F.col("_cmp").isNull()).otherwise(F.col("_cmp") == F.col("_best"))
        else:
            keep = F.col("_cmp").eqNullSafe(F.col("_best"))
        cur = j.filter(keep).drop("_cmp", "_best", "_nulls", *kk)
    return best_per_key(cur.select(*df.columns), keys, (), rank_col)


def _sort_exprs(df: DataFrame, keys: Sequence[str], order: Sequence[By]) -> list[Column]:
    exprs = []
    for b in order:
        c = b.col
        if b.desc:
            exprs.append(c.desc_nulls_first() if b.nulls_first else c.desc_nulls_last())
        else:
            exprs.append(c.asc_nulls_first() if b.nulls_first else c.asc_nulls_last())
    exprs += [F.col(c).asc_nulls_first() for c in _tiebreak_cols(df, keys)]
    return exprs


# --- named forms used by the conforming jobs -------------------------------


def first_per_key(df, keys, order: Sequence[By] = (), rank_col=None) -> DataFrame:
    """WIN1 / WIN9: one row per key; with no order the tiebreak on all
    columns makes the choice repeatable."""
    return best_per_key(df, keys, order, rank_col)


def latest_per_key(df, keys, by, rank_col=None) -> DataFrame:
    """WIN2: newest row per key (NULL dates never win)."""
    bys = [by] if isinstance(by, (str, Column)) else list(by)
    return best_per_key(df, keys, [desc(b) for b in bys], rank_col)


def earliest_per_key(df, keys, by, rank_col=None) -> DataFrame:
    """WIN3."""
    bys = [by] if isinstance(by, (str, Column)) else list(by)
    return best_per_key(df, keys, [asc(b) for b in bys], rank_col)


def preferred_per_key(df, keys, rank_exprs: Sequence[By], rank_col=None) -> DataFrame:
    """WIN4: e.g. rows with a candidate first (``desc(candidate_id)`` puts
    NULL last), then a CASE rank of the designation."""
    return best_per_key(df, keys, rank_exprs, rank_col)


def top_contribution(df, keys=("committee_id", "name", "zip_code"), amount="amount") -> DataFrame:
    """WIN5: the largest contribution per (committee, name, zip)."""
    return best_per_key(df, list(keys), [desc(amount)])


def dedup_two_level(dfs: Sequence[DataFrame], key: str, order: Sequence[By]) -> DataFrame:
    """WIN8: dedup inside every source table, then across tables."""
    firsts = [best_per_key(d, [key], order) for d in dfs]
    out = firsts[0]
    for d in firsts[1:]:
        out = out.unionByName(d)
    return best_per_key(out, [key], order)


#: Rows of one (key, step) that a task orders; more are numbered in blocks.
HOT_ROWS = 1_000_000
#: Rows of a table that may be broadcast, counted before it is.
BROADCAST_ROWS = 100_000


def step_of(df: DataFrame, c: Column) -> Column:
    """A coarse value that grows with ``c``: the day of a timestamp, else
    ``c`` itself."""
    dtype = df.select(c.alias("_t")).schema["_t"].dataType
    return c.cast("date") if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)) else c


def row_number_by(
    df: DataFrame,
    partition_cols: Sequence[str],
    order: Sequence[By],
    out_col: str = "row_num",
    hot_rows: int | None = None,
) -> DataFrame:
    """WIN6/WIN7: exact ``row_number() over (partition by … order by …)`` for
    every row, all remaining columns breaking ties.

    1. count rows by (partition cols, step), where the step is a coarse form
       of the leading order column: combined map-side, a small table;
    2. running sum of those counts over a key's steps: the rows before each;
    3. number the rows inside (partition cols, step) and add that offset.

    A step with more than ``hot_rows`` rows (one key with one day, or a key
    whose order starts with a column of few values) is numbered in blocks: its
    rows are dealt by ranges of the whole order, which Spark samples inside
    these steps alone, blocks are counted, and a row's number is the rows
    before its block plus its place in it. A block has about half of
    ``hot_rows`` rows, whatever the keys; rows that are equal in every column
    are dealt by where they were read. All other rows are shuffled once, by
    (partition cols, step), which the join with the counts needs too."""
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    parts = list(partition_cols)
    tie = _tiebreak_cols(df, parts)
    lead = order[0] if order else By(tie[0], nulls_first=True) if tie else By(F.lit(0))
    keys = [f"_k{i}" for i in range(len(parts))]
    named = df.withColumns({**{k: F.col(c) for k, c in zip(keys, parts)}, "_step": step_of(df, lead.col)})
    step = F.col("_step")
    direction = ((step.desc_nulls_first() if lead.nulls_first else step.desc_nulls_last()) if lead.desc
                 else (step.asc_nulls_first() if lead.nulls_first else step.asc_nulls_last()))
    counts = named.groupBy(*keys, "_step").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy(direction).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*keys, "_step", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # written: which steps are hot is asked before the rows are dealt
    path = scratch_path(df.sparkSession, "steps")
    counts.write.parquet(path)
    counts = df.sparkSession.read.schema(counts.schema).parquet(path)
    hot = counts.filter(F.col("_n") > hot_rows)
    n_hot, hot_total = hot.agg(F.count("*"), F.sum("_n")).first()
    within = _sort_exprs(df, parts, order)

    def matched(rows: DataFrame, other: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
        cond = [F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}")) for k in on]
        return rows.alias("r").join(other.alias("s"), cond, how)

    cold = named
    if n_hot:
        few = F.broadcast(hot) if n_hot <= BROADCAST_ROWS else hot
        cold = matched(named, few.select(*keys, "_step"), [*keys, "_step"], "left_anti")
    inside = Window.partitionBy(*keys, "_step").orderBy(*within)
    numbered = cold.withColumn("_pos", F.row_number().over(inside))
    out = matched(numbered, counts.filter(F.col("_n") <= hot_rows), [*keys, "_step"]).select(
        *[F.col(f"r.{c}") for c in df.columns], (F.col("r._pos") + F.col("s._before")).cast("long").alias(out_col))
    if not n_hot:
        return out
    n_blocks = max(2, -(-2 * hot_total // hot_rows))
    rows = matched(named, few, [*keys, "_step"]).select("r.*", "s._before").withColumn("_read", F.monotonically_increasing_id())
    whole = [*[F.col(k).asc_nulls_first() for k in keys], step.asc_nulls_first(), *within, F.col("_read").asc()]
    # the high bits of the id are the block, the low ones the place in it;
    # written, since blocks are sampled
    dealt = (rows.repartitionByRange(n_blocks, *whole).sortWithinPartitions(*whole)
             .withColumn("_at", F.monotonically_increasing_id()).withColumn("_block", F.shiftright("_at", 33)))
    path = scratch_path(df.sparkSession, "blocks")
    dealt.write.parquet(path)
    dealt = df.sparkSession.read.schema(dealt.schema).parquet(path)
    blocks = dealt.groupBy(*keys, "_step", "_block").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy(*keys, "_step").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_skip", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    if n_hot + n_blocks <= BROADCAST_ROWS:  # one row a step, and one more where a block ends
        blocks = F.broadcast(blocks)
    place = F.col("r._before") + F.col("s._skip") + F.col("r._at") - F.col("s._first") + 1
    return out.unionByName(matched(dealt, blocks, [*keys, "_step", "_block"]).select(
        *[F.col(f"r.{c}") for c in df.columns], place.cast("long").alias(out_col)))


def sequence_id(df, partition_cols, order: Sequence[By], out_col="sub_id") -> DataFrame:
    """WIN6: sequence number inside a partition, by date with a full
    tiebreak (never ``monotonically_increasing_id`` alone, which depends
    on the physical layout)."""
    return row_number_by(df, partition_cols, order, out_col)


def number_duplicates(df, keys, order: Sequence[By] = (), out_col="dup_num") -> DataFrame:
    """WIN7: keep all rows and number duplicates of a key 1, 2, 3…"""
    return row_number_by(df, keys, order, out_col)
