"""The domain views of ``plans.domain`` written as plain SQL (DuckDB
dialect) for the correctness oracle, plus SQL spellings of the column
functions. ``with_views(body, names)`` prefixes a query with the CTEs it
needs, in dependency order."""

from __future__ import annotations

from donorlake.functions.keys import SURROGATE_NULL_TOKEN
from donorlake.plans.domain import DEMO_DATE_FLOOR, NATION_DESIGNATION, SEGMENT_DESIGNATION

# --- column functions ---------------------------------------------------------


def clean_amount(x: str) -> str:
    money = "DECIMAL(38,2)"
    return (
        f"if(starts_with({x}, '(') AND ends_with({x}, ')'), -TRY_CAST(translate({x}, '$,()', '') AS {money}), "
        f"TRY_CAST(translate({x}, '$,', '') AS {money}))"
    )


def signed_amount(x: str) -> str:
    t = f"trim({x})"
    return (
        f"TRY_CAST(CASE WHEN {t} LIKE '%-' THEN '-' || regexp_replace({t}, '[,-]', '', 'g') "
        f"ELSE replace({t}, ',', '') END AS DECIMAL(38,2))"
    )


def flex_date(x: str) -> str:
    """The first layout that reads the text (rendered stamps have a fixed width)."""
    return (
        f"coalesce(try_strptime({x}, '%m/%d/%Y'), try_strptime({x}, '%Y-%m-%d'), "
        f"try_strptime(left({x}, 19), '%Y-%m-%dT%H:%M:%S'))"
    )


def surrogate(*cols: str) -> str:
    parts = " || '-' || ".join(f"coalesce(CAST({c} AS VARCHAR), '{SURROGATE_NULL_TOKEN}')" for c in cols)
    return f"md5({parts})"


def name_concat(name: str, zip_code: str) -> str:
    return (
        f"upper(split_part({name}, ' ', 1) || '|' || split_part({name}, ' ', -1) || '|' "
        f"|| left(coalesce({zip_code}, ''), 5))"
    )


def flip_name(x: str) -> str:
    return (
        f"CASE WHEN {x} IS NOT NULL AND {x} LIKE '%,%' "
        f"THEN trim(split_part({x}, ',', 2)) || ' ' || trim(split_part({x}, ',', 1)) ELSE {x} END"
    )


def case_map(x: str, mapping: dict, default: str | None) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    tail = f" ELSE '{default}'" if default is not None else ""
    return f"CASE {x} {whens}{tail} END"


def money_text(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(12,2)) AS VARCHAR)"


def pad_left(x: str, width: int) -> str:
    return f"repeat('0', greatest({width} - length(CAST({x} AS VARCHAR)), 0)::BIGINT) || CAST({x} AS VARCHAR)"


def zip_text(x: str) -> str:
    return pad_left(x, 5)


def title(x: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower({x}), ''), lambda ch, i: "
        f"CASE WHEN i = 1 OR NOT regexp_matches(substr({x}, i - 1, 1), '[\\p{{L}}\\p{{N}}]') "
        f"THEN upper(ch) ELSE ch END), '')"
    )


def order_all(cols: list[str], desc: bool = False) -> str:
    """The total tiebreak ``best_per_key`` appends: ascending NULLS FIRST
    under min, descending NULLS LAST under max."""
    d = "DESC NULLS LAST" if desc else "ASC NULLS FIRST"
    return ", ".join(f"{c} {d}" for c in cols)


# --- views ----------------------------------------------------------------------

CONTRIB_COLS = [
    "source", "source_id", "committee_id", "candidate_id", "candidate_name", "name", "city", "state",
    "zip_code", "employer", "occupation", "amount", "contribution_datetime",
]
MASTER_ROW_COLS = [
    "source", "source_id", "committee_id", "candidate_id", "candidate_name", "name_concat",
    "employer", "occupation", "amount", "contribution_datetime",
]
COMMITTEE_COLS = ["source", "committee_id", "candidate_id", "committee_designation", "name", "affiliation", "district"]

VIEWS: dict[str, tuple[str, list[str]]] = {}


def view(name: str, deps: list[str], sql: str) -> None:
    VIEWS[name] = (sql, deps)


view("landing_a", [], f"""
SELECT CAST(o.o_orderkey AS VARCHAR) AS filing_id,
       c.c_mktsegment AS committee_name,
       split_part(c.c_name, '#', 2) || ', ' || split_part(c.c_name, '#', 1) AS contributor_name,
       g.r_name AS city, g.n_name AS state,
       {zip_text('c.c_custkey')} AS zip,
       c.c_mktsegment AS employer, o.o_orderpriority AS occupation,
       CASE WHEN o.o_orderstatus = 'P' THEN '($' || {money_text('o.o_totalprice')} || ')'
            ELSE '$' || {money_text('o.o_totalprice')} END AS amount,
       strftime(o.o_orderdate, '%-m/%-d/%Y') AS contribution_date,
       o.o_orderpriority AS candidate_code,
       o.o_orderstatus AS status
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) g
  ON c.c_nationkey = g.n_nationkey""")

view("landing_b", [], f"""
SELECT CAST(l.l_orderkey AS VARCHAR) || '_' || CAST(l.l_linenumber AS VARCHAR) AS line_id,
       CAST(l.l_suppkey AS VARCHAR) AS supplier_key,
       p.p_name AS contributor_name,
       {zip_text('l.l_partkey')} AS zip,
       p.p_brand AS employer, p.p_type AS occupation,
       CASE WHEN l.l_returnflag = 'R' THEN {money_text('l.l_extendedprice')} || '-'
            ELSE {money_text('l.l_extendedprice')} END AS amount,
       strftime(l.l_shipdate, '%Y%m%d') AS ship_date,
       l.l_returnflag AS return_flag
FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey""")

view("landing_c", [], f"""
SELECT CAST(event_id AS VARCHAR) AS event_id, event_type,
       'User ' || CAST(user_id AS VARCHAR) AS contributor_name,
       {zip_text('user_id')} AS zip,
       {money_text('value')} AS amount,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS received_at,
       props
FROM events""")

view("conformed_a", ["landing_a"], f"""
SELECT 'A' AS source, 'A_' || filing_id AS source_id,
       'A_' || {surrogate('committee_name')} AS committee_id,
       'A_' || left(candidate_code, 1) AS candidate_id,
       substr(candidate_code, 3) AS candidate_name,
       {flip_name('contributor_name')} AS name,
       city, state, zip AS zip_code, employer, occupation,
       {clean_amount('amount')} AS amount,
       {flex_date('contribution_date')} AS contribution_datetime
FROM landing_a""")

view("conformed_b", ["landing_b"], f"""
SELECT 'B' AS source, 'B_' || line_id AS source_id, 'B_' || supplier_key AS committee_id,
       CAST(NULL AS VARCHAR) AS candidate_id, CAST(NULL AS VARCHAR) AS candidate_name,
       contributor_name AS name, CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS state,
       zip AS zip_code, employer, occupation,
       {signed_amount('amount')} AS amount,
       try_strptime(trim(ship_date), '%Y%m%d') AS contribution_datetime
FROM landing_b""")

view("conformed_c", ["landing_c"], f"""
SELECT 'C' AS source, 'C_' || event_id AS source_id, 'C_' || event_type AS committee_id,
       CAST(NULL AS VARCHAR) AS candidate_id, CAST(NULL AS VARCHAR) AS candidate_name,
       contributor_name AS name, CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS state,
       zip AS zip_code, event_type AS employer, CAST(NULL AS VARCHAR) AS occupation,
       TRY_CAST(amount AS DECIMAL(38,2)) AS amount,
       {flex_date('received_at')} AS contribution_datetime
FROM landing_c""")

view("contributions", ["conformed_a", "conformed_b", "conformed_c"],
     "SELECT * FROM conformed_a UNION ALL SELECT * FROM conformed_b UNION ALL SELECT * FROM conformed_c")

view("committees_all", [], f"""
SELECT 'A' AS source, 'A_' || {surrogate('c_mktsegment')} AS committee_id, CAST(NULL AS VARCHAR) AS candidate_id,
       {case_map('c_mktsegment', SEGMENT_DESIGNATION, 'U')} AS committee_designation,
       c_mktsegment AS name, CAST(NULL AS VARCHAR) AS affiliation, CAST(NULL AS VARCHAR) AS district
FROM (SELECT DISTINCT c_mktsegment FROM customer)
UNION ALL
SELECT 'B', 'B_' || CAST(s_suppkey AS VARCHAR), CAST(NULL AS VARCHAR),
       {case_map('CAST(s_nationkey % 6 AS VARCHAR)', NATION_DESIGNATION, 'U')},
       s_name, n_name, CAST(s_nationkey AS VARCHAR)
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
UNION ALL
SELECT 'C', 'C_' || event_type, CAST(NULL AS VARCHAR), 'U', upper(event_type), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR)
FROM (SELECT DISTINCT event_type FROM events)""")

view("committee_unfiltered", ["committees_all"], f"""
SELECT source, committee_id, candidate_id, committee_designation, name, affiliation, district,
       CAST(1 AS BIGINT) AS row_num
FROM (SELECT *, row_number() OVER (PARTITION BY committee_id ORDER BY
        {order_all([c for c in COMMITTEE_COLS if c != 'committee_id'])}) AS rn
      FROM committees_all
      WHERE source IS NOT NULL AND committee_id IS NOT NULL AND name IS NOT NULL)
WHERE rn = 1""")

view("candidates_all", [], """
SELECT 'A' AS source, 'A_' || left(o_orderpriority, 1) AS candidate_id,
       substr(o_orderpriority, 3) AS name, CAST(NULL AS VARCHAR) AS affiliation
FROM (SELECT DISTINCT o_orderpriority FROM orders)""")


def master_rows_sql(src: str, floor: str = DEMO_DATE_FLOOR) -> str:
    return f"""
SELECT source, source_id, committee_id, candidate_id, candidate_name,
       {name_concat('name', 'zip_code')} AS name_concat,
       left(employer, 20) AS employer, left(occupation, 20) AS occupation,
       CAST(round(amount) AS INTEGER) AS amount,
       CAST(contribution_datetime AS DATE) AS contribution_datetime
FROM {src}
WHERE contribution_datetime >= TIMESTAMP '{floor}'
  AND (source || source_id || committee_id) IS NOT NULL
  AND least(length(name), length(zip_code)) > 0 AND length(name) IS NOT NULL AND length(zip_code) IS NOT NULL
  AND abs(amount + 0.5) < 2147483647.5"""


view("master_rows", ["contributions"], master_rows_sql("contributions"))

view("master", ["master_rows", "committee_unfiltered"], f"""
SELECT m.source, m.committee_id, m.source_id, m.name_concat, m.employer, m.occupation, m.amount,
       m.contribution_datetime, cm.name AS committee_name, m.candidate_id, m.candidate_name,
       CAST(NULL AS VARCHAR) AS candidate_office
FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY
        {order_all([c for c in MASTER_ROW_COLS if c != 'source_id'])}) AS rn FROM master_rows) WHERE rn = 1) m
LEFT JOIN committee_unfiltered cm ON m.committee_id = cm.committee_id""")

view("committee_master", ["committee_unfiltered", "master"], """
SELECT * FROM committee_unfiltered cu
WHERE EXISTS (SELECT 1 FROM master m WHERE m.committee_id = cu.committee_id)""")

view("ground_truth", [], f"""
SELECT n_name AS state, split_part(c_name, '#', 1) AS fname, split_part(c_name, '#', 2) AS lname,
       {zip_text('c_custkey')} AS zip, CAST(c_acctbal AS DECIMAL(38,2)) AS amount,
       upper(split_part(c_name, '#', 1) || '|' || split_part(c_name, '#', 2) || '|' || left(coalesce({zip_text('c_custkey')}, ''), 5)) AS name_concat
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")


def _resolve(names: list[str], seen: list[str]) -> None:
    for n in names:
        if n in seen:
            continue
        _resolve(VIEWS[n][1], seen)
        if n not in seen:
            seen.append(n)


def with_views(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """``WITH <needed views> <body>``; ``extra`` adds query-local CTEs
    (evaluated after the shared ones, in insertion order)."""
    order: list[str] = []
    _resolve(list(names), order)
    ctes = [f"{n} AS ({VIEWS[n][0]}\n)" for n in order]
    ctes += [f"{n} AS ({s}\n)" for n, s in (extra or {}).items()]
    return ("WITH " + ",\n".join(ctes) + "\n" + body) if ctes else body
