"""Registered queries for the data-quality suites (QC1-QC6) over the
master tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from donorlake.operators import quality as qc
from donorlake.plans import domain as dm
from donorlake.plans.registry import register
from donorlake.plans.sqlviews import with_views

_NOT_NULL = ["source", "committee_id", "source_id", "name_concat", "amount", "committee_name", "candidate_id"]


@register("qc1_not_null", with_views(" UNION ALL ".join(
    f"SELECT 'not_null' AS rule, '{c}' AS column, count_if({c} IS NULL) AS violations FROM master"
    for c in _NOT_NULL), "master"))
def qc1_not_null(spark, d):
    return qc.run_suite(dm.contributions_master(spark, d), [qc.not_null(c) for c in _NOT_NULL])


@register("qc2_unique", with_views("""
SELECT 'unique' AS rule, 'source_id' AS column, count(*) AS violations FROM
  (SELECT source_id FROM master WHERE source_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
UNION ALL
SELECT 'unique', 'name_concat', count(*) FROM
  (SELECT name_concat FROM master WHERE name_concat IS NOT NULL GROUP BY 1 HAVING count(*) > 1)""", "master"))
def qc2_unique(spark, d):
    return qc.run_suite(dm.contributions_master(spark, d), [qc.unique("source_id"), qc.unique("name_concat")])


@register("qc3_accepted_values", with_views("""
SELECT 'accepted_values' AS rule, 'source' AS column,
       count(DISTINCT CASE WHEN source NOT IN ('A', 'B') THEN source END) AS violations FROM master
UNION ALL
SELECT 'accepted_values', 'committee_designation',
       count(DISTINCT CASE WHEN committee_designation NOT IN ('A', 'B', 'D', 'J', 'P', 'U')
                           THEN committee_designation END) FROM committee_master""", "master", "committee_master"))
def qc3_accepted_values(spark, d):
    m = dm.contributions_master(spark, d)
    a = qc.run_suite(m, [qc.accepted("source", ["A", "B"])])
    b = qc.run_suite(dm.committee_master(spark, d, m), [qc.accepted("committee_designation", dm.DESIGNATION_CODES)])
    return a.unionByName(b)


@register("qc4_has_prefix", with_views("""
SELECT 'has_prefix' AS rule, 'source_id' AS column,
       count_if(source_id IS NOT NULL AND NOT starts_with(source_id, 'A_')) AS violations FROM master
UNION ALL
SELECT 'has_prefix', 'committee_id', count_if(committee_id IS NOT NULL AND NOT starts_with(committee_id, source || '_'))
FROM master""", "master"))
def qc4_has_prefix(spark, d):
    m = dm.contributions_master(spark, d)
    a = qc.run_suite(m, [qc.has_prefix("source_id", "A_")])
    # per-source prefix: one suite per source value, summed
    b = m.agg(F.count_if(F.col("committee_id").isNotNull()
                         & ~F.col("committee_id").startswith(F.concat(F.col("source"), F.lit("_"))))
              .cast("long").alias("violations")).select(
        F.lit("has_prefix").alias("rule"), F.lit("committee_id").alias("column"), "violations")
    return a.unionByName(b)


_SUITE = [qc.not_null("source_id"), qc.not_null("committee_name"), qc.unique("source_id"),
          qc.accepted("source", ["A", "B", "C"]), qc.has_prefix("committee_id", "B_")]


@register("qc5_run_suite", with_views("""
SELECT 'not_null' AS rule, 'source_id' AS column, count_if(source_id IS NULL) AS violations FROM master
UNION ALL SELECT 'not_null', 'committee_name', count_if(committee_name IS NULL) FROM master
UNION ALL SELECT 'accepted_values', 'source', count(DISTINCT CASE WHEN source NOT IN ('A', 'B', 'C') THEN source END)
  FROM master
UNION ALL SELECT 'has_prefix', 'committee_id', count_if(committee_id IS NOT NULL AND NOT starts_with(committee_id, 'B_'))
  FROM master
UNION ALL SELECT 'unique', 'source_id', count(*) FROM
  (SELECT source_id FROM master WHERE source_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)""", "master"))
def qc5_run_suite(spark, d):
    return qc.run_suite(dm.contributions_master(spark, d), _SUITE)


@register("qc5_parse_failures", with_views("""
SELECT count_if(amount_text IS NOT NULL AND trim(amount_text) <> '' AND amount IS NULL) AS amount_unreadable
FROM (SELECT amount_text, TRY_CAST(CASE WHEN regexp_matches(amount_text, '^\\(.*\\)$')
        THEN '-' || regexp_replace(amount_text, '[$,()]', '', 'g') ELSE regexp_replace(amount_text, '[$,]', '', 'g')
        END AS DECIMAL(38,2)) AS amount
      FROM (SELECT CASE WHEN occupation = '5-LOW' THEN 'n/a' WHEN occupation = '1-URGENT'
                        THEN replace(amount, '.', ',') || '.00' ELSE amount END AS amount_text FROM landing_a))""",
    "landing_a"))
def qc5_parse_failures(spark, d):
    from donorlake.plans.q_functions import fn1_clean_amount

    return qc.parse_failures(fn1_clean_amount(spark, d), {"amount_unreadable": ("amount_text", "amount")})


QC6_LIMIT = 1_000_000


@register("qc6_guards", with_views(f"""
SELECT 'master_rows_at_most' AS check_name, count(*) AS value, count(*) <= {QC6_LIMIT} AS ok FROM master
UNION ALL
SELECT 'quarantine_empty', count(*), count(*) = 0 FROM master WHERE source_id IS NULL""", "master"))
def qc6_guards(spark, d):
    """QC6 as data: each guard's measured value and whether it holds."""
    m = dm.contributions_master(spark, d).select("source_id")

    def holds(guard, *args):
        try:
            guard(*args)
        except qc.QualityError:
            return False
        return True

    lost = m.filter(F.col("source_id").isNull())
    return spark.createDataFrame([
        ("master_rows_at_most", m.count(), holds(qc.assert_at_most, m, QC6_LIMIT)),
        ("quarantine_empty", lost.count(), holds(qc.assert_empty, lost)),
    ], "check_name string, value long, ok boolean")
