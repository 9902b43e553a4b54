"""Registered queries for the column functions, filters and projections
(FN1-FN28, FIL1-FIL10, PRJ5-PRJ10, ROW7). Each renders messy text from a
whole driver table the way a landing file would hold it, and parses it
back with the function under test."""

from __future__ import annotations

from pyspark.sql import functions as F

from donorlake import functions as fn
from donorlake.functions import dates as dts
from donorlake.operators import addresses, filters, projections
from donorlake.operators.projections import Spec
from donorlake.plans import domain as dm
from donorlake.plans import sqlviews as sv
from donorlake.plans.registry import register
from donorlake.plans.sqlviews import pad_left, with_views

E = F.expr


def _messy_amount_a():
    # '5-LOW' orders carry unreadable text, '1-URGENT' ones a stray comma
    return (F.when(F.col("occupation") == "5-LOW", F.lit("n/a"))
             .when(F.col("occupation") == "1-URGENT",
                   F.concat(F.regexp_replace("amount", r"\.", ","), F.lit(".00")))
             .otherwise(F.col("amount")))


_MESSY_A_SQL = ("CASE WHEN occupation = '5-LOW' THEN 'n/a' WHEN occupation = '1-URGENT' "
                "THEN replace(amount, '.', ',') || '.00' ELSE amount END")


@register("fn1_clean_amount", with_views(
    f"SELECT filing_id, amount_text, {sv.clean_amount('amount_text')} AS amount "
    f"FROM (SELECT filing_id, {_MESSY_A_SQL} AS amount_text FROM landing_a)", "landing_a"))
def fn1_clean_amount(spark, d):
    la = dm.landing_a(spark, d).select("filing_id", _messy_amount_a().alias("amount_text"))
    return la.withColumn("amount", fn.clean_amount("amount_text"))


@register("fn2_signed_amount", with_views(
    f"SELECT line_id, amount AS amount_text, {sv.signed_amount('amount')} AS amount FROM landing_b", "landing_b"))
def fn2_signed_amount(spark, d):
    lb = dm.landing_b(spark, d)
    return lb.select("line_id", F.col("amount").alias("amount_text"), fn.signed_amount("amount").alias("amount"))


@register("fn3_digits_amount", with_views(
    "SELECT line_id, TRY_CAST(regexp_replace(amount, '[^0-9.]', '', 'g') AS DECIMAL(38,2)) AS amount FROM landing_b",
    "landing_b"))
def fn3_digits_amount(spark, d):
    return dm.landing_b(spark, d).select("line_id", fn.digits_amount("amount").alias("amount"))


@register("fn4_parse_flexible_date", with_views(f"""
SELECT id, date_text, {sv.flex_date('date_text')} AS parsed FROM (
  SELECT 'A_' || filing_id AS id, contribution_date AS date_text FROM landing_a
  UNION ALL SELECT 'B_' || line_id, ship_date FROM landing_b
  UNION ALL SELECT 'C_' || event_id, received_at FROM landing_c
  UNION ALL SELECT 'O_' || CAST(o_orderkey AS VARCHAR), strftime(o_orderdate, '%Y-%-m-%-d') FROM orders)""",
    "landing_a", "landing_b", "landing_c"))
def fn4_parse_flexible_date(spark, d):
    texts = (
        dm.landing_a(spark, d).select(F.concat(F.lit("A_"), "filing_id").alias("id"),
                                      F.col("contribution_date").alias("date_text"))
        .unionByName(dm.landing_b(spark, d).select(F.concat(F.lit("B_"), "line_id").alias("id"),
                                                    F.col("ship_date").alias("date_text")))
        .unionByName(dm.landing_c(spark, d).select(F.concat(F.lit("C_"), "event_id").alias("id"),
                                                    F.col("received_at").alias("date_text")))
        .unionByName(dm.read(spark, d, "orders").select(
            F.concat(F.lit("O_"), F.col("o_orderkey").cast("string")).alias("id"),
            F.date_format("o_orderdate", "yyyy-M-d").alias("date_text")))
    )
    return texts.withColumn("parsed", fn.parse_flexible_date("date_text"))


def _odd_dates(spark, d):
    """Month/day/year text with shifted days (many impossible dates) and a
    leap-day text per order."""
    o = dm.read(spark, d, "orders")
    shifted = F.concat_ws("/", F.month("o_orderdate").cast("string"),
                          (F.dayofmonth("o_orderdate") + (F.col("o_orderkey") % 4) * 9).cast("string"),
                          F.year("o_orderdate").cast("string"))
    leap = F.concat(F.lit("2/29/"), F.year("o_orderdate").cast("string"))
    return o.select("o_orderkey", shifted.alias("date_text"), leap.alias("leap_text"))


_ODD_SQL = """SELECT o_orderkey,
  CAST(month(o_orderdate) AS VARCHAR) || '/' || CAST(day(o_orderdate) + (o_orderkey % 4) * 9 AS VARCHAR) || '/'
    || CAST(year(o_orderdate) AS VARCHAR) AS date_text,
  '2/29/' || CAST(year(o_orderdate) AS VARCHAR) AS leap_text FROM orders"""

_MDY_RE = "'^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$'"


def _safe_sql(x):
    return f"CASE WHEN regexp_matches({x}, {_MDY_RE}) THEN try_strptime({x}, '%m/%d/%Y') END"


@register("fn5_safe_parse_date", with_views(
    f"SELECT o_orderkey, date_text, {_safe_sql('date_text')} AS safe_date, {_safe_sql('leap_text')} AS leap_date "
    f"FROM odd", extra={"odd": _ODD_SQL}))
def fn5_safe_parse_date(spark, d):
    o = _odd_dates(spark, d)
    return o.select("o_orderkey", "date_text", fn.safe_parse_date("date_text").alias("safe_date"),
                    fn.safe_parse_date("leap_text").alias("leap_date"))


@register("row7_repair_date", with_views(
    f"SELECT o_orderkey, CASE WHEN regexp_matches(trim(date_text), {_MDY_RE}) AND "
    f"try_strptime(trim(date_text), '%m/%d/%Y') IS NOT NULL THEN trim(date_text) ELSE '01/01/2020' END AS repaired "
    f"FROM odd", extra={"odd": _ODD_SQL}))
def row7_repair_date(spark, d):
    return _odd_dates(spark, d).select("o_orderkey", fn.repair_date("date_text", 2020).alias("repaired"))


@register("fn6_parse_ts", """
SELECT event_id,
  try_strptime(strftime(ts, '%Y%m%d'), '%Y%m%d') AS from_yyyymmdd,
  try_strptime(strftime(ts, '%-m/%-d/%Y %-I:%M:%S %p'), '%m/%d/%Y %I:%M:%S %p') AS from_ampm,
  try_strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS from_iso_space,
  try_strptime(strftime(ts, '%-d-%b') || '-' || CAST(year(ts) AS VARCHAR), '%d-%b-%Y') AS from_day_month
FROM events""")
def fn6_parse_ts(spark, d):
    e = dm.read(spark, d, "events")
    return e.select(
        "event_id",
        fn.parse_ts(F.date_format("ts", "yyyyMMdd"), dts.YYYYMMDD).alias("from_yyyymmdd"),
        fn.parse_ts(F.date_format("ts", "M/d/yyyy h:mm:ss a"), dts.MDY_AMPM).alias("from_ampm"),
        fn.parse_ts(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), dts.YMD_HMS).alias("from_iso_space"),
        fn.parse_day_month(F.date_format("ts", "d-MMM"), F.year("ts")).alias("from_day_month"),
    )


@register("fn7_excel_serial", """
SELECT o_orderkey, CAST(DATE '1900-01-01' + CAST(serial AS INTEGER) AS TIMESTAMP) AS serial_date
FROM (SELECT o_orderkey, CAST(date_diff('day', DATE '1900-01-01', CAST(o_orderdate AS DATE)) AS VARCHAR) AS serial
      FROM orders)""")
def fn7_excel_serial(spark, d):
    o = dm.read(spark, d, "orders").select(
        "o_orderkey", F.datediff(F.col("o_orderdate"), F.lit("1900-01-01").cast("date")).cast("string").alias("serial"))
    return o.select("o_orderkey", fn.excel_serial("serial").alias("serial_date"))


@register("fn8_date_or_year", f"""
SELECT o_orderkey, coalesce({_safe_sql('date_text')}, CAST(make_date(CAST(year_text AS INTEGER), 1, 1) AS TIMESTAMP))
       AS contribution_datetime
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN '' ELSE strftime(o_orderdate, '%-m/%-d/%Y') END AS date_text,
             CAST(year(o_orderdate) AS VARCHAR) AS year_text FROM orders)""")
def fn8_date_or_year(spark, d):
    o = dm.read(spark, d, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "O", F.lit("")).otherwise(F.date_format("o_orderdate", "M/d/yyyy"))
        .alias("date_text"),
        F.year("o_orderdate").cast("string").alias("year_text"))
    return o.select("o_orderkey", fn.date_or_year(fn.safe_parse_date("date_text"), "year_text")
                    .alias("contribution_datetime"))


@register("fn9_to_ts", """
SELECT event_id, TRY_CAST(trim(t) AS TIMESTAMP) AS ts FROM (
  SELECT event_id, CASE WHEN event_type = 'error' THEN 'not a date' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS t
  FROM events)""")
def fn9_to_ts(spark, d):
    e = dm.read(spark, d, "events")
    t = F.when(F.col("event_type") == "error", F.lit("not a date")).otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return e.select("event_id", fn.to_ts(t).alias("ts"))


@register("fn10_year_month", with_views("""
SELECT year(contribution_datetime) AS year, month(contribution_datetime) AS month, count(*) AS n_rows
FROM contributions GROUP BY 1, 2""", "contributions"))
def fn10_year_month(spark, d):
    c = dm.contributions(spark, d)
    return c.groupBy(fn.year_of("contribution_datetime").alias("year"),
                     fn.month_of("contribution_datetime").alias("month")).agg(F.count(F.lit(1)).alias("n_rows"))


@register("fn11_surrogate_key", with_views(
    f"SELECT source_id, {sv.surrogate('source_id', 'city', 'zip_code', 'amount')} AS row_key FROM conformed_b",
    "conformed_b"))
def fn11_surrogate_key(spark, d):
    b = dm.conformed_b(spark, d)
    return b.select("source_id", fn.surrogate_key("source_id", "city", "zip_code", "amount").alias("row_key"))


@register("fn12_committee_id", with_views(
    f"SELECT DISTINCT committee_name, 'A_' || {sv.surrogate('committee_name')} AS committee_id FROM landing_a",
    "landing_a"))
def fn12_committee_id(spark, d):
    la = dm.landing_a(spark, d)
    return la.select("committee_name", fn.committee_id("A_", F.col("committee_name")).alias("committee_id")).distinct()


def _part_name_text():
    return F.when(F.col("p_size") < 5, F.col("p_name")).otherwise(F.concat(
        F.split_part("p_name", F.lit(" "), F.lit(2)), F.lit(", "), F.split_part("p_name", F.lit(" "), F.lit(1)),
        F.when(F.col("p_size") > 25, F.lit(", JR")).otherwise(F.lit(""))))


_PART_NAME_SQL = ("CASE WHEN p_size < 5 THEN p_name ELSE split_part(p_name, ' ', 2) || ', ' || "
                  "split_part(p_name, ' ', 1) || CASE WHEN p_size > 25 THEN ', JR' ELSE '' END END")


@register("fn13_flip_name", f"""
SELECT p_partkey, name_text, {sv.flip_name('name_text')} AS name
FROM (SELECT p_partkey, {_PART_NAME_SQL} AS name_text FROM part)""")
def fn13_flip_name(spark, d):
    p = dm.read(spark, d, "part").select("p_partkey", _part_name_text().alias("name_text"))
    return p.withColumn("name", fn.flip_name("name_text"))


@register("fn14_join_name", """
SELECT p_partkey,
  trim(concat_ws(' ', nullif(f, ''), nullif(m, ''), nullif(l, ''))) AS skip_blank,
  concat_ws(' ', f, m, l) AS ws,
  coalesce(f, '') || ' ' || coalesce(m, '') || ' ' || coalesce(l, '') AS concat_nulls,
  f || ' ' || m || ' ' || l AS strict
FROM (SELECT p_partkey, split_part(p_name, ' ', 1) AS f,
             CASE p_size % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE p_brand END AS m,
             CASE WHEN p_size > 45 THEN NULL ELSE split_part(p_name, ' ', 2) END AS l FROM part)""")
def fn14_join_name(spark, d):
    p = dm.read(spark, d, "part").select(
        "p_partkey",
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("f"),
        F.when(F.col("p_size") % 3 == 0, F.lit(None)).when(F.col("p_size") % 3 == 1, F.lit(""))
        .otherwise(F.col("p_brand")).alias("m"),
        F.when(F.col("p_size") > 45, F.lit(None)).otherwise(F.split_part("p_name", F.lit(" "), F.lit(2))).alias("l"),
    )
    return p.select("p_partkey", *[fn.join_name("f", "m", "l", mode=m).alias(a) for m, a in
                                   [("skip_blank", "skip_blank"), ("ws", "ws"), ("concat", "concat_nulls"),
                                    ("strict", "strict")]])


_TITLE_TEXT_SQL = "p_name || ' o''' || lower(p_type) || '-' || p_brand"


@register("fn15_title", f"SELECT p_partkey, {sv.title('t')} AS title FROM (SELECT p_partkey, {_TITLE_TEXT_SQL} AS t FROM part)")
def fn15_title(spark, d):
    p = dm.read(spark, d, "part")
    t = F.concat(F.col("p_name"), F.lit(" o'"), F.lower("p_type"), F.lit("-"), F.col("p_brand"))
    return p.select("p_partkey", fn.title(t).alias("title"))


@register("fn16_text_builtins", """
SELECT p_partkey,
  nullif(trim(CASE WHEN p_size % 7 = 0 THEN '  ' ELSE p_type END), '') AS type_or_null,
  replace(p_name, ' ', '_') AS replaced, translate(p_brand, '#', '-') AS translated,
  length(p_name) AS name_length, left(p_name, 3) AS name_left, substring(p_name, 2, 4) AS name_sub,
  strpos(p_name, 'r') AS r_position, reverse(p_name) AS reversed
FROM part""")
def fn16_text_builtins(spark, d):
    p = dm.read(spark, d, "part")
    return p.select(
        "p_partkey",
        fn.blank_to_null(F.when(F.col("p_size") % 7 == 0, F.lit("  ")).otherwise(F.col("p_type"))).alias("type_or_null"),
        F.replace("p_name", F.lit(" "), F.lit("_")).alias("replaced"),
        F.translate("p_brand", "#", "-").alias("translated"),
        F.length("p_name").alias("name_length"),
        F.left("p_name", F.lit(3)).alias("name_left"),
        F.substring("p_name", 2, 4).alias("name_sub"),
        F.locate("r", F.col("p_name")).alias("r_position"),
        F.reverse("p_name").alias("reversed"),
    )


@register("fn17_split_part", """
SELECT p_partkey, split_part(p_name, ' ', 1) AS part1, split_part(p_name, ' ', 2) AS part2,
       split_part(p_name, ' ', -1) AS part_last, split_part(p_name, ' ', 5) AS part5 FROM part""")
def fn17_split_part(spark, d):
    p = dm.read(spark, d, "part")
    return p.select("p_partkey", fn.part("p_name", " ", 1).alias("part1"), fn.part("p_name", " ", 2).alias("part2"),
                    fn.part("p_name", " ", -1).alias("part_last"), fn.part("p_name", " ", 5).alias("part5"))


@register("fn18_last_part", with_views(
    "SELECT filing_id, split_part(contributor_name, ',', -1) AS last_part FROM landing_a", "landing_a"))
def fn18_last_part(spark, d):
    return dm.landing_a(spark, d).select("filing_id", fn.last_part("contributor_name", ",").alias("last_part"))


def _memo():
    return F.when(F.col("o_orderstatus") == "F", F.concat(
        F.lit("EARMARKED THROUGH C"), fn.pad_left(F.col("o_custkey"), 8),
        F.lit(" AND C"), fn.pad_left(F.col("o_orderkey"), 8))).otherwise(F.lit("none"))


_MEMO_SQL = (f"CASE WHEN o_orderstatus = 'F' THEN 'EARMARKED THROUGH C' || {pad_left('o_custkey', 8)} "
             f"|| ' AND C' || {pad_left('o_orderkey', 8)} ELSE 'none' END")


@register("fn19_first_match", f"""
SELECT o_orderkey,
  CASE WHEN regexp_matches(memo, 'C[0-9]{{8}}') THEN regexp_extract(memo, 'C[0-9]{{8}}', 0) END AS first_id,
  CASE WHEN regexp_matches(memo, 'AND (C[0-9]{{8}})') THEN regexp_extract(memo, 'AND (C[0-9]{{8}})', 1) END AS second_id
FROM (SELECT o_orderkey, {_MEMO_SQL} AS memo FROM orders)""")
def fn19_first_match(spark, d):
    o = dm.read(spark, d, "orders").select("o_orderkey", _memo().alias("memo"))
    return o.select("o_orderkey", fn.first_match("memo", r"C[0-9]{8}").alias("first_id"),
                    fn.first_match("memo", r"AND (C[0-9]{8})", 1).alias("second_id"))


@register("fn20_extract_required", f"""
SELECT o_orderkey, regexp_extract(memo, 'THROUGH (C[0-9]{{8}})', 1) AS conduit_id
FROM (SELECT o_orderkey, {_MEMO_SQL} AS memo FROM orders) WHERE regexp_matches(memo, 'THROUGH (C[0-9]{{8}})')""")
def fn20_extract_required(spark, d):
    o = dm.read(spark, d, "orders").select("o_orderkey", _memo().alias("memo"))
    return projections.extract_required(o, "memo", r"THROUGH (C[0-9]{8})", {"conduit_id": 1}).drop("memo")


@register("fn21_replace_first", """
SELECT p_partkey, regexp_replace(t, ' ', '_') AS first_space, regexp_replace(t, ' ', '_', 'g') AS all_spaces,
       regexp_replace(t, '[aeiou]', '*') AS first_vowel
FROM (SELECT p_partkey, p_name || ' ' || p_type || ' ' || p_brand AS t FROM part)""")
def fn21_replace_first(spark, d):
    p = dm.read(spark, d, "part")
    t = F.concat_ws(" ", "p_name", "p_type", "p_brand")
    return p.select("p_partkey", fn.replace_first(t, " ", "_").alias("first_space"),
                    fn.replace_all(t, " ", "_").alias("all_spaces"),
                    fn.replace_first(t, "[aeiou]", "*").alias("first_vowel"))


def _addresses(spark, d):
    """Every customer's address in four layouts; each fifth names no place."""
    c = dm.read(spark, d, "customer")
    st = F.concat(E("chr(65 + c_nationkey % 26)"), E("chr(65 + (c_nationkey * 7) % 26)"))
    zp = F.concat(fn.pad_left(F.col("c_custkey"), 5),
                  F.when(F.col("c_custkey") % 2 == 0, F.lit("-1234")).otherwise(F.lit("")))
    town = F.concat(F.lit("Town"), F.col("c_nationkey").cast("string"))
    street = F.concat(F.col("c_custkey").cast("string"), F.lit(" Main St"))
    lost = lambda a: F.when(F.col("c_custkey") % 5 == 0, F.lit("no place here")).otherwise(a)
    return c.select(
        "c_custkey", lost(F.concat(town, F.lit(", "), st, F.lit(" "), zp)).alias("a1"),
        lost(F.concat(street, F.lit(", "), town, F.lit(", "), st, F.lit(" "), zp)).alias("a2"),
        lost(F.concat(street, F.lit(", "), town, F.lit(", "), st)).alias("a3"),
        lost(F.concat(street, F.lit(","), town, F.lit(","), st, F.lit(","), zp)).alias("a4"))


# Written from the fields that the addresses are rendered from, not by parsing.
_ADDR_SQL = f"""SELECT c_custkey, c_custkey % 5 <> 0 AS placed, length({pad_left('c_custkey', 5)}) = 5 AS zipped,
  'Town' || CAST(c_nationkey AS VARCHAR) AS town, CAST(c_custkey AS VARCHAR) || ' Main St' AS street,
  chr(65 + c_nationkey % 26) || chr(65 + (c_nationkey * 7) % 26) AS st,
  {pad_left('c_custkey', 5)} || CASE WHEN c_custkey % 2 = 0 THEN '-1234' ELSE '' END AS zp FROM customer"""


@register("fn22_parse_address", f"""
SELECT c_custkey,
  CASE WHEN placed AND zipped THEN town END AS city1, CASE WHEN placed AND zipped THEN st END AS state1,
  CASE WHEN placed AND zipped THEN zp END AS zip1,
  CASE WHEN placed AND zipped THEN street END AS street2, CASE WHEN placed AND zipped THEN town END AS city2,
  CASE WHEN placed AND zipped THEN st END AS state2, CASE WHEN placed AND zipped THEN zp END AS zip2,
  CASE WHEN placed THEN street END AS street3, CASE WHEN placed THEN town END AS city3,
  CASE WHEN placed THEN st END AS state3,
  CASE WHEN placed AND zipped THEN street END AS street4, CASE WHEN placed AND zipped THEN town END AS city4,
  CASE WHEN placed AND zipped THEN st END AS state4, CASE WHEN placed AND zipped THEN zp END AS zip4
FROM ({_ADDR_SQL})""")
def fn22_parse_address(spark, d):
    p = {k: fn.parse_address(f"a{k}") for k in (1, 2, 3, 4)}
    return _addresses(spark, d).select(
        "c_custkey", p[1].city.alias("city1"), p[1].state.alias("state1"), p[1].zip_code.alias("zip1"),
        *(p[k][f].alias(f"{n}{k}") for k in (2, 4)
          for f, n in (("street", "street"), ("city", "city"), ("state", "state"), ("zip_code", "zip"))),
        p[3].street.alias("street3"), p[3].city.alias("city3"), p[3].state.alias("state3"))


@register("fn22_place_addresses", """
SELECT c_custkey, CAST(c_custkey AS VARCHAR) || ' N Main St' || CASE WHEN c_custkey % 7 = 0 THEN ' Nowhere' ELSE '' END AS street,
       CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN 'New Town' ELSE 'Town' END
         || CAST(c_nationkey AS VARCHAR) AS city,
       'OR' AS state, CAST(10000 + c_nationkey AS VARCHAR) AS zip_code FROM customer""")
def fn22_place_addresses(spark, d):
    """Street, city, state and zip in one run of words; both ``Town3`` and
    ``New Town3`` are cities of the zip, and the longer one wins."""
    c = dm.read(spark, d, "customer")
    zip5 = (F.lit(10000) + F.col("c_nationkey")).cast("string")
    town = F.concat(F.lit("Town"), F.col("c_nationkey").cast("string"))
    cities = c.select(zip5.alias("zip_code"), F.explode(F.array(F.upper(town), F.concat(F.lit("New "), town))).alias("city"))
    end = (F.when(F.col("c_custkey") % 7 == 0, F.lit("Nowhere"))
           .when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("New "), town)).otherwise(town))
    a = c.select("c_custkey", F.concat_ws(" ", F.col("c_custkey").cast("string"), F.lit("N Main St"), end, F.lit("OR"), zip5).alias("a"))
    return addresses.place_addresses(a, "a", cities).drop("a")


@register("fn23_zip5", f"""
SELECT c_custkey, left(nullif(trim(t), ''), 5) AS zip5, coalesce(left(nullif(trim(t), ''), 5), '00000') AS zip5_default
FROM (SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN '  ' ELSE {pad_left('c_custkey', 5)} || '-'
      || {pad_left('c_nationkey', 4)} END AS t FROM customer)""")
def fn23_zip5(spark, d):
    c = dm.read(spark, d, "customer")
    t = F.when(F.col("c_custkey") % 10 == 0, F.lit("  ")).otherwise(F.concat(
        fn.pad_left(F.col("c_custkey"), 5), F.lit("-"), fn.pad_left(F.col("c_nationkey"), 4)))
    return c.select("c_custkey", fn.zip5(t).alias("zip5"), fn.zip5(t, "00000").alias("zip5_default"))


@register("fn24_earmark_committee", f"""
SELECT o_orderkey, coalesce(CASE WHEN regexp_matches(memo, 'C[0-9]{{8}}') THEN regexp_extract(memo, 'C[0-9]{{8}}', 0) END,
                            filer) AS committee_id
FROM (SELECT o_orderkey, {_MEMO_SQL} AS memo, 'F' || {pad_left('o_custkey', 8)} AS filer FROM orders)""")
def fn24_earmark_committee(spark, d):
    o = dm.read(spark, d, "orders")
    filer = F.concat(F.lit("F"), fn.pad_left(F.col("o_custkey"), 8))
    return o.select("o_orderkey", fn.earmark_committee(_memo(), filer).alias("committee_id"))


@register("fn25_split_pair", with_views("""
SELECT filing_id, trim(split_part(t, '/', 1)) AS employer, trim(split_part(t, '/', 2)) AS occupation
FROM (SELECT filing_id, employer || ' / ' || occupation AS t FROM landing_a)""", "landing_a"))
def fn25_split_pair(spark, d):
    la = dm.landing_a(spark, d).select("filing_id", F.concat_ws(" / ", "employer", "occupation").alias("t"))
    emp, occ = fn.split_pair("t", "/")
    return la.select("filing_id", emp.alias("employer"), occ.alias("occupation"))


@register("fn26_strip_parens", """
SELECT p_partkey, trim(regexp_replace(p_name || ' (' || p_brand || ')', '\\s*\\([^)]*\\)', '', 'g')) AS stripped,
       regexp_replace(p_brand, '[^A-Za-z ]', '', 'g') AS letters FROM part""")
def fn26_strip_parens(spark, d):
    p = dm.read(spark, d, "part")
    return p.select("p_partkey", fn.strip_parens(F.concat(F.col("p_name"), F.lit(" ("), F.col("p_brand"), F.lit(")")))
                    .alias("stripped"), fn.letters_only("p_brand").alias("letters"))


@register("fn27_int_and_cut", with_views(
    "SELECT source_id, CAST(round(amount) AS INTEGER) AS amount_int, left(occupation, 5) AS occupation_cut "
    "FROM conformed_b", "conformed_b"))
def fn27_int_and_cut(spark, d):
    b = dm.conformed_b(spark, d)
    return b.select("source_id", fn.to_int_rounded("amount").alias("amount_int"),
                    fn.cut("occupation", 5).alias("occupation_cut"))


@register("fn28_add_components", """
SELECT l_orderkey, l_linenumber,
  CAST(CAST(l_extendedprice AS DECIMAL(38,2)) + coalesce(TRY_CAST(nullif(trim(tax), '') AS DECIMAL(38,2)), 0)
       + coalesce(TRY_CAST(nullif(trim(disc), '') AS DECIMAL(38,2)), 0) AS DECIMAL(38,2)) AS total
FROM (SELECT l_orderkey, l_linenumber, l_extendedprice,
        CASE WHEN l_tax = 0 THEN '' ELSE CAST(CAST(l_tax * 100 AS DECIMAL(12,2)) AS VARCHAR) END AS tax,
        CASE WHEN l_discount = 0 THEN '' ELSE CAST(CAST(l_discount * 100 AS DECIMAL(12,2)) AS VARCHAR) END AS disc
      FROM lineitem)""")
def fn28_add_components(spark, d):
    li = dm.read(spark, d, "lineitem")

    def comp(c):
        return F.when(F.col(c) == 0, F.lit("")).otherwise((F.col(c) * 100).cast("decimal(12,2)").cast("string"))

    return li.select("l_orderkey", "l_linenumber",
                     fn.add_components(F.col("l_extendedprice").cast("decimal(38,2)"), comp("l_tax"), comp("l_discount"))
                     .alias("total"))


# --- projections ----------------------------------------------------------------


@register("prj5_map_codes", with_views(
    "SELECT committee_designation, count(*) AS n_committees FROM committees_all GROUP BY 1", "committees_all"))
def prj5_map_codes(spark, d):
    from donorlake.plans.q_masters import prj2_conform_committees

    return prj2_conform_committees(spark, d).groupBy("committee_designation").agg(
        F.count(F.lit(1)).alias("n_committees"))


@register("prj6_key_if", with_views(
    "SELECT filing_id, CASE WHEN status <> 'P' THEN 'KEY_' || filing_id END AS filing_key FROM landing_a", "landing_a"))
def prj6_key_if(spark, d):
    la = dm.landing_a(spark, d)
    return la.select("filing_id", fn.key_if(F.col("status") != "P", "KEY_", "filing_id").alias("filing_key"))


@register("prj7_first_present", with_views("""
SELECT source_id, coalesce(nullif(trim(city), ''), nullif(trim(state), ''), nullif(trim(zip_code), '')) AS place
FROM contributions""", "contributions"))
def prj7_first_present(spark, d):
    c = dm.contributions(spark, d)
    return c.select("source_id", fn.first_present("city", "state", "zip_code").alias("place"))


@register("prj8_realign", with_views("SELECT filing_id, city, state, zip FROM landing_a", "landing_a"))
def prj8_realign(spark, d):
    # a landing file whose city/state/zip columns arrived rotated by one
    shifted = dm.landing_a(spark, d).select(
        "filing_id", F.col("state").alias("city"), F.col("zip").alias("state"), F.col("city").alias("zip"))
    return projections.realign(shifted, {"city": "zip", "state": "city", "zip": "state"}) \
        .select("filing_id", "city", "state", "zip")


@register("prj9_generated_projection", with_views("""
SELECT 'A' AS source, filing_id AS source_ref, contributor_name AS name, amount AS amount_text FROM landing_a
UNION ALL SELECT 'B', line_id, contributor_name, amount FROM landing_b
UNION ALL SELECT 'C', event_id, contributor_name, amount FROM landing_c""", "landing_a", "landing_b", "landing_c"))
def prj9_generated_projection(spark, d):
    specs = [
        (dm.landing_a(spark, d), Spec({"source": F.lit("A"), "source_ref": "filing_id", "name": "contributor_name",
                                       "amount_text": "amount"})),
        (dm.landing_b(spark, d), Spec({"source": F.lit("B"), "source_ref": "line_id", "name": "contributor_name",
                                       "amount_text": "amount"})),
        (dm.landing_c(spark, d), Spec({"source": F.lit("C"), "source_ref": "event_id", "name": "contributor_name",
                                       "amount_text": "amount"})),
    ]
    return projections.conform_all(specs)


@register("prj10_name_concat", with_views(
    f"SELECT source_id, {sv.name_concat('name', 'zip_code')} AS name_concat FROM contributions", "contributions"))
def prj10_name_concat(spark, d):
    c = dm.contributions(spark, d)
    return c.select("source_id", fn.name_concat("name", "zip_code").alias("name_concat"))


# --- filters ----------------------------------------------------------------------


@register("fil1_require_present", with_views("""
SELECT source_id FROM contributions WHERE name IS NOT NULL AND trim(name) <> '' AND city IS NOT NULL
  AND trim(city) <> '' AND zip_code IS NOT NULL AND trim(zip_code) <> ''""", "contributions"))
def fil1_require_present(spark, d):
    return filters.require_present(dm.contributions(spark, d), ["name", "city", "zip_code"]).select("source_id")


@register("fil2_where_matches", with_views(f"""
SELECT id FROM (SELECT 'A_' || filing_id AS id, contribution_date AS t FROM landing_a
                UNION ALL SELECT 'B_' || line_id, ship_date FROM landing_b)
WHERE regexp_matches(t, {_MDY_RE})""", "landing_a", "landing_b"))
def fil2_where_matches(spark, d):
    t = dm.landing_a(spark, d).select(F.concat(F.lit("A_"), "filing_id").alias("id"), F.col("contribution_date").alias("t")) \
        .unionByName(dm.landing_b(spark, d).select(F.concat(F.lit("B_"), "line_id").alias("id"), F.col("ship_date").alias("t")))
    return filters.where_matches(t, {"t": dts.RE_MDY}).select("id")


@register("fil3_where_between", with_views(
    "SELECT source_id, amount FROM conformed_b WHERE amount > 0 AND amount < 50000", "conformed_b"))
def fil3_where_between(spark, d):
    return filters.where_between(dm.conformed_b(spark, d), "amount", 0, 50000).select("source_id", "amount")


@register("fil4_since", with_views(
    f"SELECT source_id FROM contributions WHERE contribution_datetime >= TIMESTAMP '{dm.DEMO_DATE_FLOOR}'",
    "contributions"))
def fil4_since(spark, d):
    return filters.since(dm.contributions(spark, d), "contribution_datetime", dm.DEMO_DATE_FLOOR).select("source_id")


@register("fil5_where_in", with_views(
    "SELECT filing_id FROM landing_a WHERE occupation IN ('1-URGENT', '2-HIGH') AND status = 'F'", "landing_a"))
def fil5_where_in(spark, d):
    return filters.where_in(dm.landing_a(spark, d), {"occupation": ["1-URGENT", "2-HIGH"], "status": ["F"]}) \
        .select("filing_id")


@register("fil6_where_like", with_views("""
SELECT committee_id FROM committees_all WHERE name ILIKE 'supplier#%5'
UNION ALL SELECT committee_id FROM committees_all WHERE name LIKE '%ING'""", "committees_all"))
def fil6_where_like(spark, d):
    from donorlake.plans.q_masters import prj2_conform_committees

    c = prj2_conform_committees(spark, d)
    return filters.where_like(c, "name", "supplier#%5", ignore_case=True).select("committee_id").unionByName(
        filters.where_like(c, "name", "%ING").select("committee_id"))


@register("fil7_drop_amendments", with_views("""
SELECT filing_id FROM (SELECT filing_id, CASE status WHEN 'F' THEN 'N' WHEN 'O' THEN '' ELSE 'Y' END AS amended
                       FROM landing_a) WHERE amended IN ('N', '') OR amended IS NULL""", "landing_a"))
def fil7_drop_amendments(spark, d):
    la = dm.landing_a(spark, d).withColumn(
        "amended", fn.map_codes("status", {"F": "N", "O": ""}, "Y"))
    return filters.drop_amendments(la, "amended").select("filing_id")


@register("fil8_exclude_keys", with_views(
    "SELECT source_id FROM conformed_c WHERE committee_id NOT IN ('C_error', 'C_signup') OR committee_id IS NULL",
    "conformed_c"))
def fil8_exclude_keys(spark, d):
    return filters.exclude_keys(dm.conformed_c(spark, d), "committee_id", ["C_error", "C_signup"]).select("source_id")


@register("fil9_where_length", with_views(
    "SELECT filing_id FROM landing_a WHERE length(contribution_date) = 10", "landing_a"))
def fil9_where_length(spark, d):
    return filters.where_length(dm.landing_a(spark, d), "contribution_date", 10).select("filing_id")


@register("fil10_after_high_water", with_views("""
SELECT line_id, ship_date FROM landing_b
WHERE ship_date >= (SELECT coalesce(max(ship_date), '20150101') FROM landing_b WHERE return_flag = 'A')""",
    "landing_b"))
def fil10_after_high_water(spark, d):
    lb = dm.landing_b(spark, d)
    target = lb.filter(F.col("return_flag") == "A")
    return filters.after_high_water(lb, target, "ship_date", "20150101").select("line_id", "ship_date")


@register("fn29_load_time", with_views(
    "SELECT source_id, true AS stamped FROM conformed_c", "conformed_c"))
def fn29_load_time(spark, d):
    """FN29: rows carry a load timestamp; the value itself is excluded from
    compared output (it is the run time), only its presence is checked."""
    c = dm.conformed_c(spark, d).withColumn("insert_datetime", fn.load_time())
    return c.select("source_id", F.col("insert_datetime").isNotNull().alias("stamped"))
