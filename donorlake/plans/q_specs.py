"""Whole conforming jobs, each a ``Spec`` with its guards and its load, in
the order the steps run. Inputs are the rendered landing tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from donorlake import functions as fn
from donorlake.operators import aggregates, dedup, filters, joins, projections, tables
from donorlake.operators.dedup import asc
from donorlake.operators.projections import Spec
from donorlake.plans import domain as dm
from donorlake.plans.registry import register
from donorlake.plans.sqlviews import clean_amount, flex_date, flip_name, pad_left, with_views
from donorlake.session import scratch_path

LOADED = dt.datetime(2025, 1, 1, 8, 0, 0)
FLOOR, SPLIT = "1996-01-01", "1999-01-01"

FEDERAL_COLS = ["source", "source_id", "committee_id", "candidate_id", "candidate_name", "name", "city", "state",
                "zip_code", "employer", "occupation", "amount", "contribution_datetime", "insert_datetime"]


def federal_spec() -> Spec:
    """The 14 conformed columns of federal receipts; an earmarked receipt
    belongs to the committee its memo names."""
    return Spec({
        "source": F.lit("federal"),
        "source_id": F.concat(F.lit("federal_"), F.col("filing_id")),
        "committee_id": fn.earmark_committee("memo", F.concat(F.lit("filer_"), F.col("committee_name"))),
        "candidate_id": F.lit(None).cast("string"),
        "candidate_name": F.lit(None).cast("string"),
        "name": fn.flip_name("contributor_name"),
        "city": "city", "state": "state",
        "zip_code": fn.zip5("zip", "00000"),
        "employer": fn.cut("employer", 20), "occupation": fn.cut("occupation", 20),
        "amount": fn.clean_amount("amount"),
        "contribution_datetime": fn.parse_flexible_date("contribution_date"),
        "insert_datetime": F.lit(LOADED).cast("timestamp"),
    })


def federal_receipts(spark, d):
    """Landing rows with a memo: every fulfilled filing was earmarked."""
    la = dm.landing_a(spark, d)
    return la.withColumn("memo", F.when(
        F.col("status") == "F", F.concat(F.lit("EARMARKED THROUGH C"), fn.pad_left("filing_id", 8))))


def federal_guarded(spark, d):
    raw = filters.require_present(federal_receipts(spark, d), ["filing_id", "contributor_name", "zip"])
    raw = filters.where_matches(raw, {"contribution_date": "^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"})
    rows = projections.conform(raw, federal_spec())
    return filters.since(filters.where_between(rows, "amount", -2147483648, 2147483647), "contribution_datetime", FLOOR)


@register("spec1_federal_contributions", with_views(f"""
SELECT *, row_number() OVER (PARTITION BY committee_id ORDER BY contribution_datetime, {', '.join(
    f'{c} NULLS FIRST' for c in FEDERAL_COLS if c != 'committee_id')}) AS sub_id
FROM (
  SELECT 'federal' AS source, 'federal_' || filing_id AS source_id,
         CASE WHEN status = 'F' THEN left('C' || {pad_left('filing_id', 8)}, 9) ELSE 'filer_' || committee_name END AS committee_id,
         CAST(NULL AS VARCHAR) AS candidate_id, CAST(NULL AS VARCHAR) AS candidate_name,
         {flip_name('contributor_name')} AS name, city, state, left(zip, 5) AS zip_code,
         left(employer, 20) AS employer, left(occupation, 20) AS occupation,
         {clean_amount('amount')} AS amount, {flex_date('contribution_date')} AS contribution_datetime,
         TIMESTAMP '{LOADED}' AS insert_datetime
  FROM landing_a)
WHERE contribution_datetime >= TIMESTAMP '{FLOOR}' AND amount IS NOT NULL AND length(trim(name)) > 0""", "landing_a"))
def spec1_federal_contributions(spark, d):
    """High-water load in two runs and a rerun, then the sequence number of
    each receipt of a committee."""
    path = scratch_path(spark, "federal")
    rows = federal_guarded(spark, d)
    before = rows.filter(F.col("contribution_datetime") < F.lit(SPLIT).cast("timestamp"))
    tables.merge_replace(before, path, "source_id", high_water="contribution_datetime")
    tables.merge_replace(rows, path, "source_id", high_water="contribution_datetime")
    loaded = tables.merge_replace(rows, path, "source_id", high_water="contribution_datetime")
    return dedup.sequence_id(loaded.select(*FEDERAL_COLS), ["committee_id"], [asc("contribution_datetime")])


# --- committees with a link table to their candidates ---------------------------

# Committee types of the landing table and their designations.
COMMITTEE_TYPES = {"Candidate": "P", "Political Party": "U", "Political Action": "U", "Limited Activity Committee": "U",
                   "Ballot Initiative": "U", "Independent Expenditure": "U"}


def _type_of(n):
    names = F.array(*[F.lit(t) for t in COMMITTEE_TYPES], F.lit("Other"))
    return F.element_at(names, (n % 7 + 1).cast("int"))


def linked_landing(spark, d):
    """(committees, links, candidates): suppliers, who bought from them, and
    customers. A committee has many links, some to unknown candidates."""
    s, c = dm.read(spark, d, "supplier"), dm.read(spark, d, "customer")
    nation = dm.read(spark, d, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("city"))
    committees = s.join(F.broadcast(nation), "s_nationkey").select(
        F.col("s_suppkey").cast("string").alias("ID"), F.col("s_name").alias("Name"),
        _type_of(F.col("s_suppkey")).alias("TypeOfCommittee"), F.col("city").alias("City"))
    sold = dm.read(spark, d, "lineitem").filter("l_returnflag = 'R'").select("l_orderkey", "l_suppkey")
    links = sold.join(dm.read(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).filter("l_suppkey % 3 <> 0").select(
        F.col("l_suppkey").cast("string").alias("CommitteeID"), F.col("o_custkey").cast("string").alias("CandidateID")).distinct()
    candidates = c.filter("c_custkey % 4 <> 0").select(
        F.col("c_custkey").cast("string").alias("CandidateID"), F.col("c_mktsegment").alias("FirstName"), F.col("c_name").alias("LastName"))
    return committees, links, candidates


@register("spec2_linked_committees", f"""
SELECT 'IL' AS source, 'IL_' || id AS committee_id,
       CASE type WHEN 'Candidate' THEN 'P' {" ".join(f"WHEN '{t}' THEN 'U'" for t in list(COMMITTEE_TYPES)[1:])} END AS committee_designation,
       name, city, 'IL_' || candidate AS candidate_id,
       CASE WHEN candidate IS NOT NULL THEN concat_ws(' ', first_name, last_name) END AS candidate_name
FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY last_name NULLS LAST, first_name NULLS LAST, candidate NULLS FIRST) AS rn
  FROM (
    SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, n_name AS city,
           ['{"', '".join(COMMITTEE_TYPES)}', 'Other'][s_suppkey % 7 + 1] AS type, l.o_custkey,
           CAST(l.o_custkey AS VARCHAR) AS candidate, c_mktsegment AS first_name, c_name AS last_name
    FROM supplier JOIN nation ON n_nationkey = s_nationkey
    LEFT JOIN (SELECT DISTINCT l_suppkey, o_custkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey
               WHERE l_returnflag = 'R' AND l_suppkey % 3 <> 0) l ON l.l_suppkey = s_suppkey
    LEFT JOIN customer ON c_custkey = l.o_custkey AND c_custkey % 4 <> 0))
WHERE rn = 1""")
def spec2_linked_committees(spark, d):
    """Committees through a link table to the first of their candidates by
    name; a link to a candidate that is not on file counts last."""
    committees, links, candidates = linked_landing(spark, d)
    linked = joins.enrich_via_link(
        committees, links.withColumn("_candidate", F.col("CandidateID")), candidates, "ID", "CommitteeID", "CandidateID",
        "CandidateID", ["FirstName", "LastName"], [asc("LastName"), asc("FirstName")], link_cols=["_candidate"])
    return projections.conform(linked, Spec({
        "source": F.lit("IL"),
        "committee_id": F.concat(F.lit("IL_"), F.col("ID")),
        "committee_designation": fn.map_codes("TypeOfCommittee", COMMITTEE_TYPES),
        "name": "Name", "city": "City",
        "candidate_id": F.concat(F.lit("IL_"), F.col("_candidate")),
        "candidate_name": F.when(F.col("_candidate").isNotNull(), F.concat_ws(" ", "FirstName", "LastName")),
    }))


# --- committees merged from a register and from what filings name ---------------

@register("spec3_merged_committees", """
WITH reg AS (SELECT s_suppkey AS id, max(s_name) AS name, max(CASE WHEN s_suppkey % 6 = 0 THEN 'S' END) AS designation
             FROM supplier WHERE s_suppkey % 2 = 0 GROUP BY s_suppkey),
seen AS (SELECT id, max(name) AS name FROM (
  SELECT l_suppkey AS id, 'payee ' || CAST(l_suppkey AS VARCHAR) AS name FROM lineitem WHERE l_returnflag = 'R' AND l_suppkey % 3 = 0
  UNION SELECT l_suppkey, 'filer ' || CAST(l_suppkey AS VARCHAR) FROM lineitem WHERE l_returnflag = 'A' AND l_suppkey % 3 <> 1) GROUP BY id),
cand AS (SELECT s_suppkey AS id, s_name AS person FROM supplier WHERE s_suppkey % 5 = 0)
SELECT 'VT' AS source, 'VT_' || CAST(coalesce(reg.id, seen.id) AS VARCHAR) AS committee_id,
       max(CASE WHEN cand.id IS NOT NULL THEN 'A' ELSE coalesce(designation, 'U') END) AS committee_designation,
       coalesce(max(reg.name), max(seen.name)) AS name, max('VT_' || CAST(cand.id AS VARCHAR)) AS candidate_id,
       max(person) AS candidate_name
FROM reg FULL JOIN seen ON reg.id = seen.id LEFT JOIN cand ON cand.id = seen.id GROUP BY 2""")
def spec3_merged_committees(spark, d):
    """A register merged with the names that receipts and payments give; the
    candidate is looked up by the filings' side alone, so a committee that
    only the register has stays without one. One row a committee."""
    s, li = dm.read(spark, d, "supplier"), dm.read(spark, d, "lineitem")
    ident = F.col("s_suppkey").alias("id")
    register_ = aggregates.collapse(
        s.filter("s_suppkey % 2 = 0").select(ident, F.col("s_name").alias("name"),
                                             F.when(F.col("s_suppkey") % 6 == 0, F.lit("S")).alias("designation")),
        ["id"], {"name": "max", "designation": "max"})

    def named(rows, word):
        return rows.select(F.col("l_suppkey").alias("id"), F.concat(F.lit(word), F.col("l_suppkey").cast("string")).alias("name"))

    seen = aggregates.union_distinct([named(li.filter("l_returnflag = 'R' AND l_suppkey % 3 = 0"), "payee "),
                                      named(li.filter("l_returnflag = 'A' AND l_suppkey % 3 <> 1"), "filer ")])
    seen = aggregates.collapse(seen, ["id"], {"name": "max"}).withColumn("seen_id", F.col("id"))
    candidates = s.filter("s_suppkey % 5 = 0").select(F.col("s_suppkey").alias("seen_id"), F.col("s_name").alias("person"))
    merged = joins.enrich(joins.full_merge(register_, seen, "id"), candidates, "seen_id")
    has = F.col("person").isNotNull()
    rows = projections.conform(merged, Spec({
        "source": F.lit("VT"),
        "committee_id": F.concat(F.lit("VT_"), F.col("id").cast("string")),
        "committee_designation": F.when(has, F.lit("A")).otherwise(F.coalesce("designation", F.lit("U"))),
        "name": "name",
        "candidate_id": F.when(has, F.concat(F.lit("VT_"), F.col("seen_id").cast("string"))),
        "candidate_name": "person",
    }))
    return aggregates.collapse(rows, ["source", "committee_id"], {
        c: "max" for c in ("committee_designation", "name", "candidate_id", "candidate_name")}).select(rows.columns)
