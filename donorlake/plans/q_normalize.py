"""Registered queries for profiling and geographic normalisation
(NRM1-NRM15) over a contributor-geography view derived from customer ⋈
nation: state codes written as codes, lower case or full names; zips with
+4 suffixes, lost leading zeros and placeholders; cities abbreviated,
misspelt by one letter or left as placeholders. The zip reference (state,
zip → city) is derived from the same tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from donorlake import functions as fn
from donorlake.operators import normalize as nz
from donorlake.plans import domain as dm
from donorlake.plans.registry import register
from donorlake.plans.sqlviews import pad_left, with_views

# Fixed values for the rendered geography: canonical city names assigned to
# nations (by nation key modulo the list length) and street names.
CITIES = [
    "SAINT LOUIS", "MOUNT PLEASANT", "FORT WORTH", "NORTH CHARLESTON", "SPRINGFIELD", "GREENVILLE",
    "COLUMBIA", "FRANKLIN", "CLINTON", "GEORGETOWN", "SALEM", "MADISON", "WEST COLUMBIA", "FAIRVIEW",
    "SAINT PAUL", "LEXINGTON", "ARLINGTON", "AUBURN", "BRISTOL", "DOVER", "JACKSON", "MILTON",
    "NEWPORT", "OXFORD", "WINCHESTER",
]
STREETS = ["Main Street", "oak avenue.", "Pine Rd", "Elm Court", "north Lake Drive", "Hill Ln"]
STATE_CODES = sorted(nz.US_STATES)


def _pick(values, idx):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def geo_raw(spark, d) -> DataFrame:
    c = dm.read(spark, d, "customer")
    k = F.col("c_custkey")
    n = F.col("c_nationkey")
    code = _pick(STATE_CODES, n % len(STATE_CODES))
    full = _pick([nz.US_STATES[s] for s in STATE_CODES], n % len(STATE_CODES))
    canon = _pick(CITIES, n % len(CITIES))
    zip5 = fn.pad_left(n * 1000 + k % 7, 5)
    abbreviated = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(
        canon, "^SAINT ", "ST "), "^MOUNT ", "MT "), "^FORT ", "FT "), "^NORTH ", "N ")
    return c.select(
        k.alias("id"),
        F.concat(k.cast("string"), F.lit(" "), _pick(STREETS, k % len(STREETS))).alias("address_raw"),
        (F.when(k % 6 == 0, F.lower(code)).when(k % 6 == 1, F.lower(full))
         .when(k % 6 == 2, F.concat(F.lit(" "), code, F.lit(" "))).when(k % 6 == 3, F.lit("ZZ"))
         .otherwise(code)).alias("state_raw"),
        (F.when(k % 7 == 0, F.concat(F.lower(canon), F.lit(".")))
         .when(k % 7 == 1, abbreviated)
         .when(k % 7 == 2, F.concat(F.left(canon, F.lit(1)), F.substr(canon, F.lit(3))))
         .when(k % 7 == 3, F.lit("unknown"))
         .when(k % 7 == 4, F.regexp_replace(canon, " ", ",  "))
         .otherwise(canon)).alias("city_raw"),
        (F.when(k % 5 == 0, F.lit("00000")).when(k % 5 == 1, F.concat(zip5, F.lit("-1234")))
         .when(k % 5 == 2, zip5.cast("int").cast("string")).otherwise(zip5)).alias("zip_raw"),
        F.col("c_acctbal").alias("amount"),
    )


def zip_reference(spark, d) -> DataFrame:
    c = dm.read(spark, d, "customer")
    n = F.col("c_nationkey")
    return c.select(
        _pick(STATE_CODES, n % len(STATE_CODES)).alias("state"),
        fn.pad_left(n * 1000 + F.col("c_custkey") % 7, 5).alias("zip"),
        _pick(CITIES, n % len(CITIES)).alias("city"),
    ).distinct()


def geo_norm(spark, d) -> DataFrame:
    """Per-row normalisers only (NRM8-NRM11): no shuffle."""
    g = geo_raw(spark, d)
    g = nz.normal_address(g, "address_raw")
    g = nz.normal_zip(g, "zip_raw")
    g = nz.normal_state(g, "state_raw")
    return nz.normal_city(g, "city_raw")


def geo_refined(spark, d) -> DataFrame:
    """Full chain (NRM8-NRM13) on a checkpointed vocabulary, joined back once."""
    return nz.normalize_places(geo_raw(spark, d), zip_reference(spark, d))


geo_swapped = geo_refined


# --- SQL spelling of the same view and normalisers ------------------------------


def _arr(values):
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _case_map(x, m, default):
    return "CASE " + x + " " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in m.items()) + f" ELSE {default} END"


def _squash(x):
    return f"trim(regexp_replace(upper(regexp_replace({x}, '[^A-Za-z0-9 ]', ' ', 'g')), '\\s+', ' ', 'g'))"


def _map_tokens(x, m):
    return f"array_to_string(list_transform(string_split({x}, ' '), lambda t: {_case_map('t', m, 't')}), ' ')"


_CODE = f"{_arr(STATE_CODES)}[(c_nationkey % {len(STATE_CODES)}) + 1]"
_FULL = f"{_arr([nz.US_STATES[s] for s in STATE_CODES])}[(c_nationkey % {len(STATE_CODES)}) + 1]"
_CANON = f"{_arr(CITIES)}[(c_nationkey % {len(CITIES)}) + 1]"
_ZIP5 = pad_left("(c_nationkey * 1000 + c_custkey % 7)", 5)

GEO_RAW_SQL = f"""
SELECT c_custkey AS id,
  CAST(c_custkey AS VARCHAR) || ' ' || {_arr(STREETS)}[(c_custkey % {len(STREETS)}) + 1] AS address_raw,
  CASE WHEN c_custkey % 6 = 0 THEN lower({_CODE}) WHEN c_custkey % 6 = 1 THEN lower({_FULL})
       WHEN c_custkey % 6 = 2 THEN ' ' || {_CODE} || ' ' WHEN c_custkey % 6 = 3 THEN 'ZZ' ELSE {_CODE} END AS state_raw,
  CASE WHEN c_custkey % 7 = 0 THEN lower({_CANON}) || '.'
       WHEN c_custkey % 7 = 1 THEN regexp_replace(regexp_replace(regexp_replace(regexp_replace({_CANON},
            '^SAINT ', 'ST '), '^MOUNT ', 'MT '), '^FORT ', 'FT '), '^NORTH ', 'N ')
       WHEN c_custkey % 7 = 2 THEN left({_CANON}, 1) || substr({_CANON}, 3)
       WHEN c_custkey % 7 = 3 THEN 'unknown'
       WHEN c_custkey % 7 = 4 THEN replace({_CANON}, ' ', ',  ')
       ELSE {_CANON} END AS city_raw,
  CASE WHEN c_custkey % 5 = 0 THEN '00000' WHEN c_custkey % 5 = 1 THEN {_ZIP5} || '-1234'
       WHEN c_custkey % 5 = 2 THEN CAST(CAST({_ZIP5} AS INTEGER) AS VARCHAR) ELSE {_ZIP5} END AS zip_raw,
  c_acctbal AS amount
FROM customer"""

ZIPREF_SQL = f"SELECT DISTINCT {_CODE} AS state, {_ZIP5} AS zip, {_CANON} AS city FROM customer"

_DIGITS = "regexp_replace(zip_raw, '[^0-9]', '', 'g')"
_ZIPN = f"CASE WHEN length({_DIGITS}) > 0 THEN lpad(left({_DIGITS}, 5), 5, '0') END"
_STATE_S = "regexp_replace(trim(regexp_replace(upper(state_raw), '[^A-Z ]', '', 'g')), '\\s+', ' ', 'g')"
_STATE_CODE = f"coalesce({_case_map(_STATE_S, {v: k for k, v in nz.US_STATES.items()}, 'NULL')}, {_STATE_S})"
_CITY_S = f"nullif({_map_tokens(_squash('city_raw'), nz.CITY_ABBREVIATIONS)}, '')"
_INVALID = ", ".join(f"'{v}'" for v in nz.INVALID_CITIES)
_PLACEHOLDERS = ", ".join(f"'{v}'" for v in nz.PLACEHOLDER_ZIPS)
_CODES = ", ".join(f"'{v}'" for v in nz.US_STATES)

GEO_NORM_SQL = f"""
SELECT *,
  nullif({_map_tokens(_squash('address_raw'), nz.STREET_ABBREVIATIONS)}, '') AS address_norm,
  CASE WHEN ({_ZIPN}) NOT IN ({_PLACEHOLDERS}) THEN {_ZIPN} END AS zip_norm,
  CASE WHEN ({_STATE_CODE}) IN ({_CODES}) THEN {_STATE_CODE} END AS state_norm,
  CASE WHEN ({_CITY_S}) NOT IN ({_INVALID}) THEN {_CITY_S} END AS city_norm
FROM geo_raw"""


def _is_abbrev(a, f):
    return (f"(length({a}) < length({f}) AND left({a}, 1) = left({f}, 1) AND regexp_matches({f}, '^' || "
            f"array_to_string(string_split(regexp_replace({a}, '[^A-Z]', '', 'g'), ''), '.*')))")


GEO_SWAP_SQL = f"""
SELECT g.*, CASE WHEN e.expect IS NOT NULL AND coalesce({_is_abbrev('g.city_norm', 'e.expect')}
                   OR levenshtein(g.city_norm, e.expect) = 1, false) THEN e.expect ELSE g.city_norm END AS city_swap
FROM geo_norm g LEFT JOIN (SELECT state, zip, min(city) AS expect FROM zipref GROUP BY state, zip) e
  ON g.state_norm = e.state AND g.zip_norm = e.zip"""


def _key_text(x):
    folds, bases = nz.KEY_FOLDS
    return (f"trim(regexp_replace(regexp_replace(translate({x}, '{folds}', '{bases}'), "
            r"'[^\p{L}\p{N} ]', ' ', 'g'), ' +', ' ', 'g'))")


def _fp(x):
    return f"array_to_string(list_sort(list_distinct(string_split({_key_text(x)}, ' '))), ' ')"


def _gram(x):
    return f"array_to_string(list_sort(list_distinct(string_split(replace({_key_text(x)}, ' ', ''), ''))), '')"


_NEAR = (f"levenshtein({_key_text('c.v')}, {_key_text('w.best')}) <= least({nz.MAX_EDITS}, length(w.best) // {nz.EDITS_EVERY})")


def _merge_sql(src_view, col, key_sql, out, weight="1", near=False):
    """Each value's most common spelling among those with the same key;
    values with an empty key, or too far from it, stay."""
    return f"""
SELECT s.*, coalesce(b.best, s.{col}) AS {out} FROM {src_view} s LEFT JOIN (
  SELECT c.v, w.best
  FROM (SELECT {col} AS v, {key_sql(col)} AS k FROM {src_view} WHERE {col} IS NOT NULL GROUP BY {col}) c
  JOIN (SELECT k, arg_min(v, (-n, v)) AS best
        FROM (SELECT {col} AS v, sum({weight}) AS n, {key_sql(col)} AS k FROM {src_view}
              WHERE {col} IS NOT NULL GROUP BY {col}) WHERE k <> '' GROUP BY k) w
    ON c.k = w.k{" AND " + _NEAR if near else ""}) b ON s.{col} = b.v"""


GEO_R1_SQL = _merge_sql("geo_swap", "city_swap", _fp, "r1")
GEO_R2_SQL = _merge_sql("geo_r1", "r1", _gram, "r2", near=True)
GEO_REFINE_SQL = """
SELECT g.* EXCLUDE (r1, r2),
  CASE WHEN z.city IS NOT NULL AND g.r2 <> g.city_swap AND NOT regexp_matches(g.city_swap, '^(NORTH|SOUTH|EAST|WEST)')
       THEN g.r2 ELSE g.city_swap END AS city_refine
FROM geo_r2 g LEFT JOIN (SELECT DISTINCT city, state, zip FROM zipref) z
  ON g.r2 = z.city AND g.state_norm = z.state AND g.zip_norm = z.zip"""


def geo_sql(body: str, upto: str = "geo_norm") -> str:
    chain = {"geo_raw": GEO_RAW_SQL, "zipref": ZIPREF_SQL, "geo_norm": GEO_NORM_SQL, "geo_swap": GEO_SWAP_SQL,
             "geo_r1": GEO_R1_SQL, "geo_r2": GEO_R2_SQL, "geo_refine": GEO_REFINE_SQL}
    names = list(chain)
    extra = {n: chain[n] for n in names[: names.index(upto) + 1]}
    return with_views(body, extra=extra)


# --- queries -----------------------------------------------------------------------


@register("nrm8_normal_address", geo_sql("SELECT id, address_norm FROM geo_norm"))
def nrm8_normal_address(spark, d):
    return geo_norm(spark, d).select("id", "address_norm")


@register("nrm9_normal_zip", geo_sql("SELECT id, zip_norm FROM geo_norm"))
def nrm9_normal_zip(spark, d):
    return geo_norm(spark, d).select("id", "zip_norm")


@register("nrm10_normal_state", geo_sql("SELECT id, state_norm FROM geo_norm"))
def nrm10_normal_state(spark, d):
    return geo_norm(spark, d).select("id", "state_norm")


@register("nrm11_normal_city", geo_sql("SELECT id, city_norm FROM geo_norm"))
def nrm11_normal_city(spark, d):
    return geo_norm(spark, d).select("id", "city_norm")


@register("nrm12_swap_city", geo_sql("SELECT id, city_swap FROM geo_swap", "geo_swap"))
def nrm12_swap_city(spark, d):
    return geo_swapped(spark, d).select("id", "city_swap")


@register("nrm13_refine_city", geo_sql("SELECT id, city_refine FROM geo_refine", "geo_refine"))
def nrm13_refine_city(spark, d):
    return geo_refined(spark, d).select("id", "city_refine")


_NORM_COLS = ["address_norm", "zip_norm", "state_norm", "city_norm"]


@register("nrm1_null_profile", geo_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS column, count_if({c} IS NULL) AS n_null, "
    f"round(CAST(count_if({c} IS NULL) AS DOUBLE) / count(*), 6) AS p_null FROM geo_norm" for c in _NORM_COLS)))
def nrm1_null_profile(spark, d):
    return nz.null_profile(geo_norm(spark, d), _NORM_COLS)


@register("nrm2_flag_missing", geo_sql(
    "SELECT id, (city_norm IS NULL OR state_norm IS NULL OR zip_norm IS NULL) AS na_flag FROM geo_norm"))
def nrm2_flag_missing(spark, d):
    return nz.flag_missing(geo_norm(spark, d), ["city_norm", "state_norm", "zip_norm"]).select("id", "na_flag")


_DUP_A_SQL = """SELECT * FROM landing_a UNION ALL
SELECT filing_id || 'b', committee_name, contributor_name, city, state, zip, employer, occupation, amount,
       contribution_date, candidate_code, status FROM landing_a WHERE status = 'P'"""


@register("nrm3_flag_duplicates", with_views("""
SELECT filing_id, count(*) OVER (PARTITION BY committee_name, contributor_name, city, state, zip, employer, occupation,
                                 amount, contribution_date, candidate_code, status) > 1 AS dupe_flag FROM dup_a""",
    "landing_a", extra={"dup_a": _DUP_A_SQL}))
def nrm3_flag_duplicates(spark, d):
    la = dm.landing_a(spark, d)
    dup = la.unionByName(la.filter(F.col("status") == "P").withColumn("filing_id", F.concat("filing_id", F.lit("b"))))
    return nz.flag_duplicates(dup, ["filing_id"]).select("filing_id", "dupe_flag")


_RAW_COLS = ["address_raw", "state_raw", "city_raw", "zip_raw"]


@register("nrm4_distinct_profile", geo_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS column, count(DISTINCT {c}) AS n_distinct, "
    f"round(CAST(count(DISTINCT {c}) AS DOUBLE) / count(*), 6) AS p_distinct FROM geo_raw" for c in _RAW_COLS),
    "geo_raw"))
def nrm4_distinct_profile(spark, d):
    return nz.distinct_profile(geo_raw(spark, d), _RAW_COLS)


@register("nrm5_amount_summary", """
SELECT round(min(c_acctbal), 6) AS min, round(quantile_cont(c_acctbal, 0.25), 6) AS q25,
       round(quantile_cont(c_acctbal, 0.5), 6) AS median, round(quantile_cont(c_acctbal, 0.75), 6) AS q75,
       round(avg(c_acctbal), 6) AS mean, round(max(c_acctbal), 6) AS max,
       round(CAST(count_if(c_acctbal <= 0) AS DOUBLE) / count(c_acctbal), 6) AS p_nonpositive
FROM customer""")
def nrm5_amount_summary(spark, d):
    return nz.amount_summary(dm.read(spark, d, "customer"), "c_acctbal", digits=6)


@register("nrm6_date_profile", """
SELECT year(o_orderdate) AS year, count(*) AS n_rows,
       count_if(o_orderdate < TIMESTAMP '1996-01-01' OR o_orderdate > TIMESTAMP '2000-12-31') AS n_out_of_range,
       min(o_orderdate) AS first, max(o_orderdate) AS last
FROM orders GROUP BY 1""")
def nrm6_date_profile(spark, d):
    return nz.date_profile(dm.read(spark, d, "orders"), "o_orderdate", "1996-01-01", "2000-12-31")


@register("nrm7_tidy_text", with_views("""
SELECT filing_id, nullif(trim(name_raw), '') AS contributor_name,
       try_strptime(nullif(trim(date_raw), ''), '%m/%d/%Y') AS contribution_date
FROM (SELECT filing_id, CASE WHEN status = 'O' THEN '   ' ELSE '  ' || contributor_name END AS name_raw,
             contribution_date || ' ' AS date_raw FROM landing_a)""", "landing_a"))
def nrm7_tidy_text(spark, d):
    la = dm.landing_a(spark, d).select(
        "filing_id",
        F.when(F.col("status") == "O", F.lit("   ")).otherwise(F.concat(F.lit("  "), "contributor_name"))
        .alias("contributor_name"),
        F.concat(F.col("contribution_date"), F.lit(" ")).alias("contribution_date"))
    return nz.tidy_text(la, {"contribution_date": "M/d/yyyy"})


@register("nrm14_progress_table", geo_sql(" UNION ALL ".join(
    f"""SELECT '{s}' AS stage,
  round(CAST(count_if(x IS NOT NULL AND ok) AS DOUBLE) / nullif(count_if(x IS NOT NULL), 0), 6) AS prop_in,
  count(DISTINCT x) AS n_distinct, round(CAST(count_if(x IS NULL) AS DOUBLE) / count(*), 6) AS prop_na,
  count_if(x IS NOT NULL AND ok IS NULL) AS n_out, count(DISTINCT CASE WHEN x IS NOT NULL AND ok IS NULL THEN x END) AS n_diff
FROM (SELECT g.{s} AS x, v.ok FROM geo_refine g LEFT JOIN (SELECT DISTINCT city, true AS ok FROM zipref) v
      ON g.{s} = v.city)""" for s in ["city_raw", "city_norm", "city_swap", "city_refine"]), "geo_refine"))
def nrm14_progress_table(spark, d):
    valid = zip_reference(spark, d).select("city")
    return nz.progress_table(geo_refined(spark, d), ["city_raw", "city_norm", "city_swap", "city_refine"], valid)


@register("nrm15_changes", geo_sql("""
SELECT state_raw, state_norm, count(*) AS n FROM geo_norm WHERE state_raw IS DISTINCT FROM state_norm
GROUP BY state_raw, state_norm"""))
def nrm15_changes(spark, d):
    return nz.changes(geo_norm(spark, d), "state_raw", "state_norm")


_WORDS_SQL = """SELECT word, count(*) AS n FROM (
  SELECT unnest(string_split_regex(text, '\\s+')) AS word FROM documents) WHERE length(word) > 0 GROUP BY word"""


@register("nrm13_cluster_document_words", with_views(
    "SELECT word, n, word_refine FROM words_r2",
    extra={"words": _WORDS_SQL,
           "words_r1": _merge_sql("words", "word", _fp, "r1", "n"),
           "words_r2": _merge_sql("words_r1", "r1", _gram, "word_refine", "n", near=True)}))
def nrm13_cluster_document_words(spark, d):
    """Spelling clusters over every token of every document (whole texts):
    one aggregation to the weighted word vocabulary, then key-collision and
    1-gram merges on the vocabulary."""
    docs = dm.read(spark, d, "documents")
    words = docs.select(F.explode(F.split("text", r"\s+")).alias("word")).filter(F.length("word") > 0)
    vocab = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return nz.cluster_merge(vocab, "word", "word_refine", weight="n").select("word", "n", "word_refine")
