"""Registered queries: conforming, masters, joins, windows, sets, top-k and
the match-rate reports (PRJ1-4, SET1-3, JN1-14, WIN1-9, AGG1-13, TOP1-4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from donorlake.operators import aggregates as agg
from donorlake.operators import dedup, filters, joins
from donorlake.operators.dedup import asc, desc
from donorlake.operators import quality
from donorlake.plans import domain as dm
from donorlake.plans.registry import register
from donorlake.session import scratch_path
from donorlake.plans.sqlviews import CONTRIB_COLS, COMMITTEE_COLS, order_all, with_views


# --- masters and reports ------------------------------------------------------------


@register("agg1_source_report", with_views(
    "SELECT source, count(*) AS n_contributions FROM master GROUP BY source ORDER BY n_contributions DESC",
    "master"))
def agg1_source_report(spark, d) -> DataFrame:
    """Flagship: contributions by source after cleaning and dedup."""
    return quality.source_report(dm.contributions_master(spark, d))


@register("set3_master_contributions", with_views("SELECT * FROM master", "master"))
def set3_master_contributions(spark, d):
    return dm.contributions_master(spark, d)


@register("jn7_committee_master", with_views("SELECT * FROM committee_master", "committee_master"))
def jn7_committee_master(spark, d):
    return dm.committee_master(spark, d)


@register("prj3_candidate_master", with_views("SELECT * FROM candidates_all", "candidates_all"))
def prj3_candidate_master(spark, d):
    return dm.candidate_master(spark, d)


def _rate_sql(total: str, matched: str) -> str:
    """Distinct people of a state, those among them that occur in the
    master, and the percentage."""
    return f"""
SELECT p.state, p.n AS {total}, coalesce(h.n, 0) AS {matched},
       CASE WHEN p.n > 0 THEN round(100::DOUBLE * coalesce(h.n, 0) / p.n, 2) END AS match_rate_percent
FROM (SELECT state, count(DISTINCT name_concat) AS n FROM ground_truth GROUP BY state) p
LEFT JOIN (SELECT state, count(DISTINCT name_concat) AS n FROM ground_truth
           WHERE name_concat IN (SELECT name_concat FROM master) GROUP BY state) h
  ON h.state IS NOT DISTINCT FROM p.state"""


_RATE_SQL = _rate_sql("total_ground_truth", "matched_count")


@register("agg2_match_rate_by_state", with_views(_RATE_SQL, "ground_truth", "master"))
def agg2_match_rate_by_state(spark, d):
    return quality.match_rate(dm.ground_truth(spark, d), dm.contributions_master(spark, d))


@register("agg3_match_rate_unique", with_views(
    _rate_sql("total_unique_people", "matched_unique_people"), "ground_truth", "master"))
def agg3_match_rate_unique(spark, d):
    return quality.match_rate_unique(dm.ground_truth(spark, d), dm.contributions_master(spark, d))


@register("agg4_overall_rate", with_views("""
SELECT sum(total_ground_truth) AS total_ground_truth, sum(matched_count) AS total_matched,
       coalesce(round(CAST(sum(matched_count) AS DOUBLE) * 100 / CAST(nullif(sum(total_ground_truth), 0) AS DOUBLE), 2), 0.0) AS overall_rate
FROM rates""", "ground_truth", "master", extra={"rates": _RATE_SQL}))
def agg4_overall_rate(spark, d):
    return quality.overall_rate(agg2_match_rate_by_state(spark, d))


@register("agg5_confidence_band", with_views("""
SELECT state, match_rate_percent,
       CASE WHEN match_rate_percent >= 80 THEN 'high'
            WHEN match_rate_percent >= 50 THEN 'medium'
            WHEN match_rate_percent >= 30 THEN 'low'
            ELSE 'very_low' END AS confidence
FROM rates""", "ground_truth", "master", extra={"rates": _RATE_SQL}))
def agg5_confidence_band(spark, d):
    r = agg2_match_rate_by_state(spark, d)
    return r.select("state", "match_rate_percent",
                    quality.confidence_band(F.col("match_rate_percent")).alias("confidence"))


@register("top2_ranked", with_views(_RATE_SQL + " ORDER BY match_rate_percent DESC, state",
                                    "ground_truth", "master"))
def top2_ranked(spark, d):
    return agg.ranked(agg2_match_rate_by_state(spark, d), ["match_rate_percent"])


@register("jn13_match_keys", with_views("""
SELECT gt.state, gt.name_concat, (ic.name_concat IS NOT NULL) AS matched
FROM ground_truth gt LEFT JOIN (SELECT DISTINCT name_concat FROM master) ic ON gt.name_concat = ic.name_concat""",
    "ground_truth", "master"))
def jn13_match_keys(spark, d):
    gt = dm.ground_truth(spark, d).select("state", "name_concat")
    return joins.match_keys(gt, dm.contributions_master(spark, d), "name_concat")


# --- conforming and sets -----------------------------------------------------------


@register("prj1_conform_contributions", with_views("SELECT * FROM conformed_a", "conformed_a"))
def prj1_conform_contributions(spark, d):
    return dm.conformed_a(spark, d)


@register("set1_union_all", with_views("SELECT * FROM contributions", "contributions"))
def set1_union_all(spark, d):
    return dm.contributions(spark, d)


@register("prj2_conform_committees", with_views("SELECT * FROM committees_all", "committees_all"))
def prj2_conform_committees(spark, d):
    return agg.union_all([dm.committees_a(spark, d), dm.committees_b(spark, d), dm.committees_c(spark, d)]) \
        .select(*COMMITTEE_COLS)


@register("prj4_pad_columns", """
SELECT 'C' AS source, 'C_' || event_type AS committee_id, CAST(NULL AS VARCHAR) AS candidate_id,
       CAST(NULL AS VARCHAR) AS candidate_name, 'U' AS committee_designation, upper(event_type) AS name,
       CAST(NULL AS VARCHAR) AS address1, CAST(NULL AS VARCHAR) AS address2, CAST(NULL AS VARCHAR) AS city,
       CAST(NULL AS VARCHAR) AS state, CAST(NULL AS VARCHAR) AS zip_code, CAST(NULL AS VARCHAR) AS affiliation,
       CAST(NULL AS VARCHAR) AS district
FROM (SELECT DISTINCT event_type FROM events)""")
def prj4_pad_columns(spark, d):
    return dm.committees_c(spark, d)


@register("set2_union_distinct", with_views("""
SELECT committee_id FROM contributions UNION SELECT committee_id FROM committees_all""",
    "contributions", "committees_all"))
def set2_union_distinct(spark, d):
    return agg.union_distinct([
        dm.contributions(spark, d).select("committee_id"),
        prj2_conform_committees(spark, d).select("committee_id"),
    ])


# --- joins ------------------------------------------------------------------------


@register("jn1_enrich", with_views("""
SELECT a.source_id, a.committee_id, cu.name AS committee_name, cu.committee_designation
FROM conformed_a a LEFT JOIN committee_unfiltered cu ON a.committee_id = cu.committee_id""",
    "conformed_a", "committee_unfiltered"))
def jn1_enrich(spark, d):
    cu = dm.committee_master_unfiltered(spark, d).select(
        "committee_id", F.col("name").alias("committee_name"), "committee_designation")
    return joins.enrich(dm.conformed_a(spark, d).select("source_id", "committee_id"), cu, "committee_id")


@register("jn1_enrich_hot", with_views("""
SELECT a.source_id, a.committee_id, cu.name AS committee_name, cu.committee_designation
FROM contributions a LEFT JOIN committee_unfiltered cu ON a.committee_id = cu.committee_id""",
    "contributions", "committee_unfiltered"))
def jn1_enrich_hot(spark, d):
    """All sources: a few segment ids hold all of source A."""
    cu = dm.committee_master_unfiltered(spark, d).select(
        "committee_id", F.col("name").alias("committee_name"), "committee_designation")
    return joins.enrich_hot(dm.contributions(spark, d).select("source_id", "committee_id"), cu, "committee_id")


@register("jn2_join_required", with_views("""
SELECT b.source_id, c.name AS committee_name, c.affiliation
FROM conformed_b b JOIN committees_all c ON b.committee_id = c.committee_id""",
    "conformed_b", "committees_all"))
def jn2_join_required(spark, d):
    cb = dm.committees_b(spark, d).select("committee_id", F.col("name").alias("committee_name"), "affiliation")
    return joins.join_required(dm.conformed_b(spark, d).select("source_id", "committee_id"), cb,
                               "committee_id").drop("committee_id")


@register("jn3_enrich_on", with_views("""
SELECT l.l_orderkey, l.l_linenumber, c.name AS committee_name
FROM lineitem l LEFT JOIN committees_all c ON 'B_' || CAST(l.l_suppkey AS VARCHAR) = c.committee_id""",
    "committees_all"))
def jn3_enrich_on(spark, d):
    li = dm.read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    cb = dm.committees_b(spark, d).withColumnRenamed("name", "committee_name")
    return joins.enrich_on(li, cb, F.concat(F.lit("B_"), F.col("l_suppkey").cast("string")),
                           "committee_id", ["committee_name"]).drop("l_suppkey")


@register("jn4_enrich_where", with_views("""
SELECT b.source_id, c.name AS committee_name
FROM conformed_b b LEFT JOIN (SELECT * FROM committees_all WHERE committee_designation = 'A') c
  ON b.committee_id = c.committee_id""", "conformed_b", "committees_all"))
def jn4_enrich_where(spark, d):
    cb = dm.committees_b(spark, d).withColumnRenamed("name", "committee_name")
    out = joins.enrich_where(dm.conformed_b(spark, d).select("source_id", "committee_id"), cb,
                             "committee_id", F.col("committee_designation") == "A", ["committee_name"])
    return out.drop("committee_id")


@register("jn5_enrich_via_link", """
SELECT s.s_suppkey, s.s_name, min(p.p_name) AS part_name
FROM supplier s LEFT JOIN lineitem l ON s.s_suppkey = l.l_suppkey LEFT JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY s.s_suppkey, s.s_name""")
def jn5_enrich_via_link(spark, d):
    s = dm.read(spark, d, "supplier").select("s_suppkey", "s_name")
    li = dm.read(spark, d, "lineitem")
    p = dm.read(spark, d, "part").withColumnRenamed("p_name", "part_name")
    # reduce the bridge to distinct pairs first: a supplier's many lines
    # collapse map-side before the join
    link = li.select("l_suppkey", "l_partkey").distinct()
    return joins.enrich_via_link(s, link, p, "s_suppkey", "l_suppkey", "l_partkey", "p_partkey",
                                 ["part_name"], [asc("part_name")])


@register("jn6_full_merge", with_views("""
SELECT coalesce(a.committee_id, b.committee_id) AS committee_id, a.name, b.n_rows
FROM (SELECT committee_id, name FROM committees_all WHERE source = 'B') a
FULL JOIN (SELECT committee_id, count(*) AS n_rows FROM contributions WHERE source IN ('B', 'C') GROUP BY committee_id) b
  ON a.committee_id = b.committee_id""", "committees_all", "contributions"))
def jn6_full_merge(spark, d):
    a = dm.committees_b(spark, d).select("committee_id", "name")
    c = dm.contributions(spark, d).filter(F.col("source").isin("B", "C"))
    b = c.groupBy("committee_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return joins.full_merge(a, b, "committee_id")


@register("jn6_full_merge_one_side", with_views("""
SELECT m.committee_id, m.name, m.n_rows, c.candidate_id IS NOT NULL AS has_candidate, c.n_filings
FROM (SELECT coalesce(a.committee_id, b.committee_id) AS committee_id, a.name, b.n_rows, b.committee_id AS right_id
      FROM (SELECT committee_id, name FROM committees_all WHERE source = 'A') a
      FULL JOIN (SELECT committee_id, count(*) AS n_rows FROM contributions WHERE amount < 0 GROUP BY committee_id) b
        ON a.committee_id = b.committee_id) m
LEFT JOIN (SELECT committee_id, min(candidate_id) AS candidate_id, count(*) AS n_filings FROM conformed_a
           GROUP BY committee_id) c ON m.right_id = c.committee_id""", "committees_all", "contributions", "conformed_a"))
def jn6_full_merge_one_side(spark, d):
    """A full outer merge, then a left join on the key of one side only: rows
    that only the other side brought find nothing."""
    a = dm.committees_a(spark, d).select("committee_id", "name")
    b = (dm.contributions(spark, d).filter("amount < 0").groupBy("committee_id")
         .agg(F.count(F.lit(1)).alias("n_rows")).withColumn("right_id", F.col("committee_id")))
    c = dm.conformed_a(spark, d).groupBy("committee_id").agg(
        F.min("candidate_id").alias("candidate_id"), F.count(F.lit(1)).alias("n_filings"))
    merged = joins.full_merge(a, b, "committee_id")
    out = joins.enrich(merged, c.withColumnRenamed("committee_id", "right_id"), "right_id")
    return out.select("committee_id", "name", "n_rows", F.col("candidate_id").isNotNull().alias("has_candidate"),
                      "n_filings")


@register("jn8_without", with_views("""
SELECT * FROM committees_all c
WHERE NOT EXISTS (SELECT 1 FROM contributions x WHERE x.committee_id = c.committee_id)""",
    "committees_all", "contributions"))
def jn8_without(spark, d):
    return joins.without(prj2_conform_committees(spark, d), dm.contributions(spark, d), "committee_id")


@register("jn9_without_target", with_views("""
SELECT c.* FROM contributions c LEFT JOIN (SELECT DISTINCT source_id AS held FROM master) m ON m.held = c.source_id
WHERE m.held IS NULL""", "contributions", "master"))
def jn9_without_target(spark, d):
    return joins.without(dm.contributions(spark, d), dm.contributions_master(spark, d), "source_id")


@register("jn10_lookup_first", with_views("""
SELECT a.filing_id, a.committee_name, f.c_name AS first_customer
FROM landing_a a LEFT JOIN (
  SELECT c_mktsegment, c_name FROM (
    SELECT c_mktsegment, c_name, row_number() OVER (PARTITION BY c_mktsegment
           ORDER BY c_custkey ASC NULLS LAST, c_custkey, c_name, c_nationkey, c_acctbal) AS rn
    FROM customer) WHERE rn = 1) f
ON a.committee_name = f.c_mktsegment""", "landing_a"))
def jn10_lookup_first(spark, d):
    la = dm.landing_a(spark, d).select("filing_id", "committee_name")
    cust = dm.read(spark, d, "customer").withColumnRenamed("c_mktsegment", "committee_name") \
        .withColumnRenamed("c_name", "first_customer")
    return joins.lookup_first(la, cust, "committee_name", "first_customer", [asc("c_custkey")])


@register("jn11_join_required", with_views("""
SELECT a.source_id, a.candidate_id, c.name AS candidate
FROM conformed_a a JOIN candidates_all c ON a.candidate_id = c.candidate_id""", "conformed_a", "candidates_all"))
def jn11_join_required(spark, d):
    ca = dm.candidate_master(spark, d).select("candidate_id", F.col("name").alias("candidate"))
    return joins.join_required(dm.conformed_a(spark, d).select("source_id", "candidate_id"), ca, "candidate_id")


@register("jn12_resolve_id", with_views("""
SELECT i.id, coalesce(cm.name, ca.name) AS resolved_name
FROM (SELECT DISTINCT committee_id AS id FROM conformed_a UNION SELECT DISTINCT candidate_id FROM conformed_a) i
LEFT JOIN committee_unfiltered cm ON i.id = cm.committee_id
LEFT JOIN candidates_all ca ON i.id = ca.candidate_id""", "conformed_a", "committee_unfiltered", "candidates_all"))
def jn12_resolve_id(spark, d):
    a = dm.conformed_a(spark, d)
    ids = agg.union_distinct([a.select(F.col("committee_id").alias("id")), a.select(F.col("candidate_id").alias("id"))])
    return joins.resolve_id(ids, "id", [
        (dm.committee_master_unfiltered(spark, d), "committee_id", "name"),
        (dm.candidate_master(spark, d), "candidate_id", "name"),
    ], "resolved_name")


@register("jn14_zip_city", with_views("""
SELECT a.source_id, z.city AS expected_city
FROM conformed_a a LEFT JOIN (SELECT DISTINCT state, zip AS zip_code, city FROM landing_a) z
  ON a.state = z.state AND a.zip_code = z.zip_code""", "conformed_a", "landing_a"))
def jn14_zip_city(spark, d):
    zips = dm.landing_a(spark, d).select("state", F.col("zip").alias("zip_code"), F.col("city").alias("expected_city")).distinct()
    return joins.enrich(dm.conformed_a(spark, d).select("source_id", "state", "zip_code"), zips,
                        ["state", "zip_code"]).select("source_id", "expected_city")


# --- aggregations ------------------------------------------------------------------


@register("agg6_sum_contributions", with_views("""
SELECT committee_id, name, zip_code, sum(amount) AS amount FROM conformed_b GROUP BY committee_id, name, zip_code""",
    "conformed_b"))
def agg6_sum_contributions(spark, d):
    return agg.sum_contributions(dm.conformed_b(spark, d), ["committee_id", "name", "zip_code"])


@register("agg7_latest", with_views("""
SELECT committee_id, max(contribution_datetime) AS latest_datetime FROM contributions GROUP BY committee_id""",
    "contributions"))
def agg7_latest(spark, d):
    return agg.latest(dm.contributions(spark, d), ["committee_id"], "contribution_datetime", "latest_datetime")


@register("agg8_collapse", with_views("""
SELECT committee_id, min(name) AS name, max(zip_code) AS zip_code, min(contribution_datetime) AS contribution_datetime
FROM contributions GROUP BY committee_id""", "contributions"))
def agg8_collapse(spark, d):
    return agg.collapse(dm.contributions(spark, d), ["committee_id"],
                        {"name": "min", "zip_code": "max", "contribution_datetime": "min"})


@register("agg9_mode_by", with_views("""
SELECT committee_id, employer FROM (
  SELECT committee_id, employer, row_number() OVER (PARTITION BY committee_id ORDER BY cnt DESC, employer ASC) AS rn
  FROM (SELECT committee_id, employer, count(*) AS cnt FROM conformed_b WHERE employer IS NOT NULL
        GROUP BY committee_id, employer)) WHERE rn = 1""", "conformed_b"))
def agg9_mode_by(spark, d):
    return agg.mode_by(dm.conformed_b(spark, d), ["committee_id"], "employer")


@register("agg10_distinct_on", with_views(
    "SELECT DISTINCT committee_id, employer FROM conformed_b", "conformed_b"))
def agg10_distinct_on(spark, d):
    return agg.distinct_on(dm.conformed_b(spark, d), ["committee_id", "employer"])


def duplicates(spark, d) -> DataFrame:
    """Source A plus a re-filed copy of the BUILDING committee's rows with a
    changed amount and date: the same ``source_id`` twice (SURVEY §7.2)."""
    a = dm.conformed_a(spark, d)
    again = a.filter(F.col("employer") == "BUILDING").withColumn(
        "amount", (F.col("amount") * 2).cast("decimal(38,2)")
    ).withColumn("contribution_datetime", F.col("contribution_datetime") + F.expr("INTERVAL 30 DAYS"))
    return a.unionByName(again)


_DUPS_SQL = """
SELECT * FROM conformed_a UNION ALL
SELECT source, source_id, committee_id, candidate_id, candidate_name, name, city, state, zip_code, employer,
       occupation, CAST(amount * 2 AS DECIMAL(38,2)) AS amount, contribution_datetime + INTERVAL 30 DAY
FROM conformed_a WHERE employer = 'BUILDING'"""


def _dups_sql(body: str, *more: str) -> str:
    return with_views(body, "conformed_a", *more, extra={"dups": _DUPS_SQL})


@register("agg11_distinct_rows", _dups_sql("SELECT DISTINCT * FROM dups"))
def agg11_distinct_rows(spark, d):
    return agg.distinct_rows(duplicates(spark, d))


@register("agg12_high_water", with_views(
    "SELECT coalesce(max(ship_date), '20150101') AS high_water FROM landing_b", "landing_b"))
def agg12_high_water(spark, d):
    mark = filters.high_water(dm.landing_b(spark, d), "ship_date", "20150101")
    return spark.createDataFrame([(mark,)], "high_water string")


@register("agg13_row_count", with_views("""
SELECT 'A' AS source, count(*) AS n_rows FROM conformed_a UNION ALL
SELECT 'B', count(*) FROM conformed_b UNION ALL SELECT 'C', count(*) FROM conformed_c""",
    "conformed_a", "conformed_b", "conformed_c"))
def agg13_row_count(spark, d):
    tables = {"A": dm.conformed_a, "B": dm.conformed_b, "C": dm.conformed_c}
    return spark.createDataFrame([(k, agg.row_count(f(spark, d))) for k, f in tables.items()],
                                 "source string, n_rows long")


# --- windows (one row per key / numbering) --------------------------------------

def _cols_except(*keys):
    return [c for c in CONTRIB_COLS if c not in keys]


@register("win1_first_per_key", _dups_sql(f"""
SELECT {', '.join(CONTRIB_COLS)} FROM (SELECT *, row_number() OVER (PARTITION BY source_id
  ORDER BY {order_all(_cols_except('source_id'))}) AS rn FROM dups) WHERE rn = 1"""))
def win1_first_per_key(spark, d):
    return dedup.first_per_key(duplicates(spark, d), ["source_id"])


@register("win2_latest_per_key", _dups_sql(f"""
SELECT {', '.join(CONTRIB_COLS)} FROM (SELECT *, row_number() OVER (PARTITION BY committee_id
  ORDER BY contribution_datetime DESC NULLS LAST, {order_all(_cols_except('committee_id'), desc=True)}) AS rn
  FROM dups) WHERE rn = 1"""))
def win2_latest_per_key(spark, d):
    return dedup.latest_per_key(duplicates(spark, d), ["committee_id"], "contribution_datetime")


@register("win3_earliest_per_key", with_views(f"""
SELECT {', '.join(CONTRIB_COLS)} FROM (SELECT *, row_number() OVER (PARTITION BY name, zip_code
  ORDER BY contribution_datetime ASC NULLS LAST, {order_all(_cols_except('name', 'zip_code'))}) AS rn
  FROM conformed_b) WHERE rn = 1""", "conformed_b"))
def win3_earliest_per_key(spark, d):
    return dedup.earliest_per_key(dm.conformed_b(spark, d), ["name", "zip_code"], "contribution_datetime")


def _committees_with_candidates(spark, d):
    base = prj2_conform_committees(spark, d)
    extra = dm.committees_b(spark, d).select(*COMMITTEE_COLS).withColumn(
        "candidate_id", F.concat(F.lit("CAND_"), F.col("district"))
    ).withColumn("committee_designation", F.lit(None).cast("string"))
    return base.unionByName(extra)


_CWC_SQL = """
SELECT * FROM committees_all UNION ALL
SELECT source, committee_id, 'CAND_' || district AS candidate_id, CAST(NULL AS VARCHAR) AS committee_designation,
       name, affiliation, district
FROM committees_all WHERE source = 'B'"""


@register("win4_preferred_per_key", with_views(f"""
SELECT {', '.join(COMMITTEE_COLS)} FROM (SELECT *, row_number() OVER (PARTITION BY committee_id
  ORDER BY candidate_id DESC NULLS LAST,
           CASE WHEN committee_designation IS NULL THEN 1 ELSE 0 END ASC NULLS LAST,
           {order_all([c for c in COMMITTEE_COLS if c != 'committee_id'], desc=True)}) AS rn
  FROM cwc) WHERE rn = 1""", "committees_all", extra={"cwc": _CWC_SQL}))
def win4_preferred_per_key(spark, d):
    rank = F.when(F.col("committee_designation").isNull(), 1).otherwise(0)
    return dedup.preferred_per_key(_committees_with_candidates(spark, d), ["committee_id"],
                                   [desc("candidate_id"), asc(rank)])


@register("win5_top_contribution", with_views(f"""
SELECT {', '.join(CONTRIB_COLS)} FROM (SELECT *, row_number() OVER (PARTITION BY committee_id, name, zip_code
  ORDER BY amount DESC NULLS LAST, {order_all(_cols_except('committee_id', 'name', 'zip_code'), desc=True)}) AS rn
  FROM conformed_b) WHERE rn = 1""", "conformed_b"))
def win5_top_contribution(spark, d):
    return dedup.top_contribution(dm.conformed_b(spark, d))


@register("win6_sequence_id", with_views(f"""
SELECT source_id, 'B_' || partition_date || '/' || CAST(row_number() OVER (PARTITION BY partition_date
  ORDER BY contribution_datetime ASC NULLS LAST, {order_all(CONTRIB_COLS)}) AS VARCHAR) AS sequence_source_id
FROM (SELECT *, strftime(contribution_datetime, '%Y%m%d') AS partition_date FROM conformed_b)""", "conformed_b"))
def win6_sequence_id(spark, d):
    b = dm.conformed_b(spark, d).withColumn("partition_date", F.date_format("contribution_datetime", "yyyyMMdd"))
    n = dedup.sequence_id(b, ["partition_date"], [asc("contribution_datetime")])
    return n.select("source_id", F.concat(F.lit("B_"), F.col("partition_date"), F.lit("/"),
                                          F.col("sub_id").cast("string")).alias("sequence_source_id"))


@register("win7_number_duplicates", _dups_sql(f"""
SELECT {', '.join(CONTRIB_COLS)}, row_number() OVER (PARTITION BY source_id
  ORDER BY {order_all(_cols_except('source_id'))}) AS dup_num FROM dups"""))
def win7_number_duplicates(spark, d):
    return dedup.number_duplicates(duplicates(spark, d), ["source_id"])


@register("win8_dedup_two_level", with_views(f"""
SELECT {', '.join(COMMITTEE_COLS)} FROM (SELECT *, row_number() OVER (PARTITION BY committee_id
  ORDER BY candidate_id DESC NULLS LAST, {order_all([c for c in COMMITTEE_COLS if c != 'committee_id'], desc=True)}) AS rn
  FROM cwc) WHERE rn = 1""", "committees_all", extra={"cwc": _CWC_SQL}))
def win8_dedup_two_level(spark, d):
    base = prj2_conform_committees(spark, d)
    extra = _committees_with_candidates(spark, d).filter(F.col("candidate_id").isNotNull())
    return dedup.dedup_two_level([base, extra], "committee_id", [desc("candidate_id")])


@register("win9_first_by_name", with_views(f"""
SELECT {', '.join(CONTRIB_COLS)} FROM (SELECT *, row_number() OVER (PARTITION BY committee_id
  ORDER BY name ASC NULLS LAST, {order_all(_cols_except('committee_id'))}) AS rn FROM conformed_b) WHERE rn = 1""",
    "conformed_b"))
def win9_first_by_name(spark, d):
    return dedup.first_per_key(dm.conformed_b(spark, d), ["committee_id"], [asc("name")])


# --- top-k -----------------------------------------------------------------------

KEEP_NEWEST_N = 1000


@register("top1_keep_newest", with_views(
    f"SELECT * FROM master ORDER BY contribution_datetime DESC NULLS LAST, source_id ASC NULLS LAST "
    f"LIMIT {KEEP_NEWEST_N}", "master"))
def top1_keep_newest(spark, d):
    path = scratch_path(spark, "top1")  # the master is built once and read by each pass
    dm.contributions_master(spark, d).write.parquet(path)
    return agg.keep_newest(spark.read.parquet(path), "contribution_datetime", KEEP_NEWEST_N, "source_id")[0]


@register("top1_overflow_count", with_views(
    f"SELECT greatest(count(*) - {KEEP_NEWEST_N}, 0) AS overflow_count FROM master", "master"))
def top1_overflow_count(spark, d):
    return agg.overflow_count(dm.contributions_master(spark, d), KEEP_NEWEST_N)


@register("top4_extremes", with_views(f"""
(SELECT *, 'min' AS which FROM conformed_a ORDER BY amount ASC NULLS LAST, {order_all(CONTRIB_COLS)} LIMIT 1)
UNION ALL
(SELECT *, 'max' AS which FROM conformed_a ORDER BY amount DESC NULLS LAST, {order_all(CONTRIB_COLS, desc=True)} LIMIT 1)""",
    "conformed_a"))
def top4_extremes(spark, d):
    return agg.extremes(dm.conformed_a(spark, d), "amount")
