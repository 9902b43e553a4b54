"""Campaign-finance views over the driver tables.

The driver ships TPC-H-like tables, not filings, so each source is a view
that renders a filing-like, all-text landing table from them, and a
conforming job that parses it back with the column functions:

* source A (state filings): orders ⋈ customer ⋈ nation ⋈ region.
  Names arrive ``LAST, FIRST``; amounts as ``$123.45`` or ``($123.45)``
  for pending orders; dates as ``M/D/YYYY``.
* source B (itemised schedule): lineitem ⋈ part. Amounts with a trailing
  minus for returned lines; dates ``YYYYMMDD``; committee = supplier.
* source C (online receipts): events. Amounts plain, ISO timestamps, JSON
  ``props``.

Committees come from customer segments (A), suppliers ⋈ nation (B) and
event types (C); candidates from order priorities (A). The ground truth
sample is one row per customer.

Every view reads whole tables. Nation/region are the only dimensions
broadcast explicitly (fixed size, 25 and 5 rows); part and supplier grow
with the data and are left to AQE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from donorlake import functions as fn
from donorlake.operators import aggregates as agg
from donorlake.operators import dedup, filters, joins
from donorlake.session import spread, table_path

# Master-build date floor. The reference build uses 2015-01-01; the driver
# tables date orders 1995-2001, so queries pass a floor inside that span.
REFERENCE_DATE_FLOOR = "2015-01-01"
DEMO_DATE_FLOOR = "1997-01-01"

# Fixed value lists (designation codes and the maps onto them).
DESIGNATION_CODES = ["A", "B", "D", "J", "P", "U"]
SEGMENT_DESIGNATION = {
    "AUTOMOBILE": "A",
    "BUILDING": "B",
    "FURNITURE": "D",
    "HOUSEHOLD": "J",
    "MACHINERY": "P",
}
NATION_DESIGNATION = {"0": "A", "1": "B", "2": "D", "3": "J", "4": "P"}

CONTRIB_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("source_id", T.StringType()),
    T.StructField("committee_id", T.StringType()),
    T.StructField("candidate_id", T.StringType()),
    T.StructField("candidate_name", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("zip_code", T.StringType()),
    T.StructField("employer", T.StringType()),
    T.StructField("occupation", T.StringType()),
    T.StructField("amount", T.DecimalType(38, 2)),
    T.StructField("contribution_datetime", T.TimestampType()),
])

COMMITTEE_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("committee_id", T.StringType()),
    T.StructField("candidate_id", T.StringType()),
    T.StructField("candidate_name", T.StringType()),
    T.StructField("committee_designation", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("address1", T.StringType()),
    T.StructField("address2", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("zip_code", T.StringType()),
    T.StructField("affiliation", T.StringType()),
    T.StructField("district", T.StringType()),
])

CANDIDATE_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("candidate_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("affiliation", T.StringType()),
])


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as it is now (nothing is kept between calls)."""
    return spread(spark.read.parquet(table_path(sf_dir, name)))


def _money_text(c: Column) -> Column:
    return c.cast("decimal(12,2)").cast("string")


def _zip_text(c: Column) -> Column:
    return fn.pad_left(c, 5)


# --- landing (all text) -----------------------------------------------------


def landing_a(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders")
    c = read(spark, d, "customer")
    n = read(spark, d, "nation")
    r = read(spark, d, "region")
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")
    money = _money_text(F.col("o_totalprice"))
    return (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("o_orderkey").cast("string").alias("filing_id"),
            F.col("c_mktsegment").alias("committee_name"),
            F.concat(
                F.split_part("c_name", F.lit("#"), F.lit(2)),
                F.lit(", "),
                F.split_part("c_name", F.lit("#"), F.lit(1)),
            ).alias("contributor_name"),
            F.col("r_name").alias("city"),
            F.col("n_name").alias("state"),
            _zip_text(F.col("c_custkey")).alias("zip"),
            F.col("c_mktsegment").alias("employer"),
            F.col("o_orderpriority").alias("occupation"),
            F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("($"), money, F.lit(")")))
            .otherwise(F.concat(F.lit("$"), money))
            .alias("amount"),
            F.date_format("o_orderdate", "M/d/yyyy").alias("contribution_date"),
            F.col("o_orderpriority").alias("candidate_code"),
            F.col("o_orderstatus").alias("status"),
        )
    )


def landing_b(spark: SparkSession, d: str) -> DataFrame:
    li = read(spark, d, "lineitem")
    p = read(spark, d, "part")
    money = _money_text(F.col("l_extendedprice"))
    return li.join(p, li.l_partkey == p.p_partkey, "left").select(
        F.concat_ws("_", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("line_id"),
        F.col("l_suppkey").cast("string").alias("supplier_key"),
        F.col("p_name").alias("contributor_name"),
        _zip_text(F.col("l_partkey")).alias("zip"),
        F.col("p_brand").alias("employer"),
        F.col("p_type").alias("occupation"),
        F.when(F.col("l_returnflag") == "R", F.concat(money, F.lit("-"))).otherwise(money).alias("amount"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("ship_date"),
        F.col("l_returnflag").alias("return_flag"),
    )


def landing_c(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events")
    return e.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("event_type"),
        F.concat(F.lit("User "), F.col("user_id").cast("string")).alias("contributor_name"),
        _zip_text(F.col("user_id")).alias("zip"),
        _money_text(F.col("value")).alias("amount"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("received_at"),
        F.col("props"),
    )


# --- conformed contributions (PRJ1) -------------------------------------------


def conformed_a(spark: SparkSession, d: str) -> DataFrame:
    la = landing_a(spark, d)
    return la.select(
        F.lit("A").alias("source"),
        F.concat(F.lit("A_"), F.col("filing_id")).alias("source_id"),
        fn.committee_id("A_", F.col("committee_name")).alias("committee_id"),
        F.concat(F.lit("A_"), F.left("candidate_code", F.lit(1))).alias("candidate_id"),
        F.expr("substring(candidate_code, 3)").alias("candidate_name"),
        fn.flip_name("contributor_name").alias("name"),
        F.col("city"),
        F.col("state"),
        F.col("zip").alias("zip_code"),
        F.col("employer"),
        F.col("occupation"),
        fn.clean_amount("amount").alias("amount"),
        fn.parse_flexible_date("contribution_date").alias("contribution_datetime"),
    )


def conformed_b(spark: SparkSession, d: str) -> DataFrame:
    lb = landing_b(spark, d)
    return lb.select(
        F.lit("B").alias("source"),
        F.concat(F.lit("B_"), F.col("line_id")).alias("source_id"),
        F.concat(F.lit("B_"), F.col("supplier_key")).alias("committee_id"),
        F.lit(None).cast("string").alias("candidate_id"),
        F.lit(None).cast("string").alias("candidate_name"),
        F.col("contributor_name").alias("name"),
        F.lit(None).cast("string").alias("city"),
        F.lit(None).cast("string").alias("state"),
        F.col("zip").alias("zip_code"),
        F.col("employer"),
        F.col("occupation"),
        fn.signed_amount("amount").alias("amount"),
        fn.parse_ts("ship_date", fn.dates.YYYYMMDD).alias("contribution_datetime"),
    )


def conformed_c(spark: SparkSession, d: str) -> DataFrame:
    lc = landing_c(spark, d)
    return lc.select(
        F.lit("C").alias("source"),
        F.concat(F.lit("C_"), F.col("event_id")).alias("source_id"),
        F.concat(F.lit("C_"), F.col("event_type")).alias("committee_id"),
        F.lit(None).cast("string").alias("candidate_id"),
        F.lit(None).cast("string").alias("candidate_name"),
        F.col("contributor_name").alias("name"),
        F.lit(None).cast("string").alias("city"),
        F.lit(None).cast("string").alias("state"),
        F.col("zip").alias("zip_code"),
        F.col("event_type").alias("employer"),
        F.lit(None).cast("string").alias("occupation"),
        fn.to_amount("amount").alias("amount"),
        fn.parse_flexible_date("received_at").alias("contribution_datetime"),
    )


def contributions(spark: SparkSession, d: str) -> DataFrame:
    """All conformed contributions (SET1)."""
    return agg.union_all([conformed_a(spark, d), conformed_b(spark, d), conformed_c(spark, d)])


# --- committees / candidates (PRJ2, PRJ3, PRJ5) -------------------------------


def committees_a(spark: SparkSession, d: str) -> DataFrame:
    seg = read(spark, d, "customer").select("c_mktsegment").distinct()
    return agg.pad_columns(seg.select(
        F.lit("A").alias("source"),
        fn.committee_id("A_", F.col("c_mktsegment")).alias("committee_id"),
        fn.map_codes("c_mktsegment", SEGMENT_DESIGNATION, "U").alias("committee_designation"),
        F.col("c_mktsegment").alias("name"),
    ), COMMITTEE_SCHEMA)


def committees_b(spark: SparkSession, d: str) -> DataFrame:
    s = read(spark, d, "supplier")
    n = read(spark, d, "nation").select("n_nationkey", "n_name")
    return agg.pad_columns(
        s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey, "left").select(
            F.lit("B").alias("source"),
            F.concat(F.lit("B_"), F.col("s_suppkey").cast("string")).alias("committee_id"),
            fn.map_codes((F.col("s_nationkey") % 6).cast("string"), NATION_DESIGNATION, "U")
            .alias("committee_designation"),
            F.col("s_name").alias("name"),
            F.col("n_name").alias("state"),
            F.col("n_name").alias("affiliation"),
            F.col("s_nationkey").cast("string").alias("district"),
        ),
        COMMITTEE_SCHEMA,
    )


def committees_c(spark: SparkSession, d: str) -> DataFrame:
    et = read(spark, d, "events").select("event_type").distinct()
    return agg.pad_columns(et.select(
        F.lit("C").alias("source"),
        F.concat(F.lit("C_"), F.col("event_type")).alias("committee_id"),
        F.lit("U").alias("committee_designation"),
        F.upper("event_type").alias("name"),
    ), COMMITTEE_SCHEMA)


def candidates_a(spark: SparkSession, d: str) -> DataFrame:
    pr = read(spark, d, "orders").select("o_orderpriority").distinct()
    return agg.pad_columns(pr.select(
        F.lit("A").alias("source"),
        F.concat(F.lit("A_"), F.left("o_orderpriority", F.lit(1))).alias("candidate_id"),
        F.expr("substring(o_orderpriority, 3)").alias("name"),
    ), CANDIDATE_SCHEMA)


# --- masters (SET3, WIN1, JN1, JN7) -------------------------------------------

MASTER_COMMITTEE_COLS = [
    "source", "committee_id", "candidate_id", "committee_designation", "name", "affiliation", "district",
]


def committee_master_unfiltered(spark: SparkSession, d: str) -> DataFrame:
    """Union of conformed committees, not-NULL guards, one row per id."""
    union = agg.union_all([committees_a(spark, d), committees_b(spark, d), committees_c(spark, d)])
    union = filters.require_not_null(union.select(*MASTER_COMMITTEE_COLS), ["source", "committee_id", "name"])
    return dedup.first_per_key(union, ["committee_id"], rank_col="row_num")


MASTER_CONTRIB_COLS = [
    "source", "committee_id", "source_id", "name_concat", "employer", "occupation", "amount",
    "contribution_datetime", "committee_name", "candidate_id", "candidate_name", "candidate_office",
]


def master_rows(df: DataFrame, floor: str) -> DataFrame:
    """Master-model guards and projection (FIL1, FIL3, FIL4, PRJ10, FN27)."""
    # Catalyst pushes these guards below the conforming projection and
    # inlines the parse expressions; each guard on a parsed column is one
    # null-safe comparison (NULL fails it) so every parse runs once here.
    df = df.filter(
        F.coalesce(F.col("contribution_datetime") >= F.lit(floor).cast("timestamp"), F.lit(False))
        & filters.int32_safe_expr(F.col("amount"))
    )
    df = filters.require_not_null(df, ["source", "source_id", "committee_id", "name", "zip_code"])
    df = df.filter((F.col("name") != "") & (F.col("zip_code") != ""))
    return df.select(
        "source",
        "source_id",
        "committee_id",
        "candidate_id",
        "candidate_name",
        fn.name_concat("name", "zip_code").alias("name_concat"),
        fn.cut("employer", 20).alias("employer"),
        fn.cut("occupation", 20).alias("occupation"),
        fn.to_int_rounded("amount").alias("amount"),
        F.to_date("contribution_datetime").alias("contribution_datetime"),
    )


def contributions_master(spark: SparkSession, d: str, floor: str = DEMO_DATE_FLOOR,
                         conformed: DataFrame | None = None,
                         committees: DataFrame | None = None) -> DataFrame:
    """Master contributions: union → guards → dedup by source_id → committee
    name. A's rows keep their candidate columns; B and C are padded."""
    registry = {
        "A": conformed_a(spark, d),
        "B": conformed_b(spark, d),
        "C": conformed_c(spark, d),
    } if conformed is None else {"all": conformed}
    union = agg.union_sources(registry, CONTRIB_SCHEMA, with_candidate=("A", "all"))
    rows = master_rows(union, floor)
    one = dedup.first_per_key(rows, ["source_id"])
    cm = (committees if committees is not None else committee_master_unfiltered(spark, d)) \
        .select("committee_id", F.col("name").alias("committee_name"))
    out = joins.enrich(one, cm, "committee_id")
    return out.withColumn("candidate_office", F.lit(None).cast("string")).select(*MASTER_CONTRIB_COLS)


def committee_master(spark: SparkSession, d: str, contribs: DataFrame | None = None) -> DataFrame:
    """Committees that occur in the contributions master (JN7). Built in
    three steps (committees → contributions → semi join) instead of the
    source's cycle through the previous build."""
    cm = committee_master_unfiltered(spark, d)
    contribs = contribs if contribs is not None else contributions_master(spark, d)
    return joins.only_with(cm, contribs, "committee_id")


def candidate_master(spark: SparkSession, d: str) -> DataFrame:
    return agg.union_all([candidates_a(spark, d)])


def ground_truth(spark: SparkSession, d: str) -> DataFrame:
    """Hand-gathered sample stand-in: one row per customer, identity key
    ``UPPER(fname|lname|zip5)`` generated like the stored column."""
    c = read(spark, d, "customer")
    n = read(spark, d, "nation").select("n_nationkey", "n_name")
    gt = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left").select(
        F.col("n_name").alias("state"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("fname"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("lname"),
        _zip_text(F.col("c_custkey")).alias("zip"),
        F.col("c_acctbal").cast("decimal(38,2)").alias("amount"),
    )
    return gt.withColumn("name_concat", fn.name_concat_parts("fname", "lname", "zip"))
