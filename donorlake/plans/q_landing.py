"""Registered queries for landing scans and row hygiene (SRC1-SRC12,
ROW1-ROW6, ROW8). Each writes a landing file set derived from a whole
driver table into a fresh folder under the shared checkpoint root and
scans it back with the loader under test."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from donorlake.plans import domain as dm
from donorlake.plans.registry import register
from donorlake.plans.sqlviews import with_views
from donorlake.session import scratch_path
from donorlake.sources import filelog, filings
from donorlake.sources import fixtures as fx
from donorlake.sources import landing as ld

A_COLS = ["filing_id", "committee_name", "contributor_name", "city", "state", "zip", "employer", "occupation",
          "amount", "contribution_date", "candidate_code", "status"]
B_COLS = ["line_id", "supplier_key", "contributor_name", "zip", "employer", "occupation", "amount", "ship_date",
          "return_flag"]
C_COLS = ["event_id", "event_type", "contributor_name", "zip", "amount", "received_at", "props"]


def _csv(df: DataFrame, path: str, sep: str = ",", header: bool = True, mode: str = "overwrite") -> str:
    (df.write.mode(mode).option("sep", sep).option("header", str(header).lower())
     .option("escape", '"').csv(path))
    return path


@register("src1_delimited_scan", with_views("SELECT * FROM landing_a", "landing_a"))
def src1_delimited_scan(spark, d):
    path = _csv(dm.landing_a(spark, d), scratch_path(spark, "src1"), sep="|")
    df = ld.delimited_scan(spark, path, A_COLS, sep="|", quote=None, escape=None)
    good, _ = ld.split_valid(df)
    return good


@register("src1_multiline_scan", with_views("""
SELECT * REPLACE (CASE WHEN status = 'F' THEN employer || chr(10) || 'c/o "' || contributor_name || '"' ELSE employer END
                  AS employer) FROM landing_a""", "landing_a"))
def src1_multiline_scan(spark, d):
    """Quoted fields with line breaks, commas and quotes, over many splits."""
    la = dm.landing_a(spark, d)
    name = F.concat(F.col("employer"), F.lit('\nc/o "'), F.col("contributor_name"), F.lit('"'))
    la = la.withColumn("employer", F.when(F.col("status") == "F", name).otherwise(F.col("employer")))
    path = _csv(la, scratch_path(spark, "src1m"))
    return ld.split_valid(ld.multiline_scan(spark, path, A_COLS, glob="*.csv", split_bytes=256 << 10))[0]


@register("src2_scan_years", with_views(
    "SELECT *, substr(ship_date, 1, 4) AS year FROM landing_b", "landing_b"))
def src2_scan_years(spark, d):
    root = scratch_path(spark, "src2")
    lb = dm.landing_b(spark, d)
    lb.withColumn("y", F.substring("ship_date", 1, 4)).write.partitionBy("y").option("header", "true") \
        .option("escape", '"').csv(root)
    # the folders that were written, and one year without a file, which is skipped
    paths = {y: f"{root}/y={y}" for y in [*ld.listed_values(spark, root, "y"), "0000"]}
    df = ld.scan_years(spark, paths, B_COLS)
    return ld.split_valid(df)[0]


@register("src3_scan_mixed_delimiters", with_views("SELECT * FROM landing_c", "landing_c"))
def src3_scan_mixed_delimiters(spark, d):
    root = scratch_path(spark, "src3")
    lc = dm.landing_c(spark, d)
    _csv(lc.filter(F.col("event_type").isin("click", "view")), root, sep="\t")
    _csv(lc.filter(~F.col("event_type").isin("click", "view")), root, sep=",", mode="append")
    return ld.split_valid(ld.scan_mixed_delimiters(spark, root, C_COLS))[0]


def _a_bucket():
    return F.floor(F.col("filing_id").cast("long") / 500)


@register("src4_archive_scan", with_views("SELECT * FROM landing_a", "landing_a"))
def src4_archive_scan(spark, d):
    """Archives are written as files and scanned; names hold quoted commas."""
    la = dm.landing_a(spark, d)
    groups = fx.bucketed_lines(la, _a_bucket(), F.to_csv(F.struct(*A_COLS)), F.col("filing_id").cast("long"))
    folder = fx.write_binary(fx.zip_archives(groups, ",".join(A_COLS)), scratch_path(spark, "src4"))
    records = ld.archive_scan(spark, folder, mode="first_csv")
    return ld.split_records(records, A_COLS)[0]


@register("src4_archive_members", with_views("SELECT * FROM landing_a", "landing_a"))
def src4_archive_members(spark, d):
    """Every csv member of every archive, the members dealt over the tasks."""
    la = dm.landing_a(spark, d)
    groups = fx.bucketed_lines(la, _a_bucket(), F.to_csv(F.struct(*A_COLS)), F.col("filing_id").cast("long"))
    folder = fx.write_binary(fx.zip_archives(groups, ",".join(A_COLS), nested_every=0), scratch_path(spark, "src4m"))
    records = ld.archive_scan(spark, folder, member_pattern=r"\.csv$", split_bytes=16 << 10)
    return ld.split_records(records, A_COLS)[0]


@register("src4_archive_quarantine", with_views(
    "SELECT count(*) FILTER (WHERE status <> 'P') AS good, count(*) FILTER (WHERE status = 'P') AS bad FROM landing_a",
    "landing_a"))
def src4_archive_quarantine(spark, d):
    """Records that lack a field are set aside, and counted, not padded."""
    la = dm.landing_a(spark, d)
    line = F.when(F.col("status") == "P", F.to_csv(F.struct(*A_COLS[:-1]))).otherwise(F.to_csv(F.struct(*A_COLS)))
    groups = fx.bucketed_lines(la, _a_bucket(), line, F.col("filing_id").cast("long"))
    folder = fx.write_binary(fx.zip_archives(groups, ",".join(A_COLS)), scratch_path(spark, "src4q"))
    good, bad = ld.split_records(ld.archive_scan(spark, folder, mode="first_csv"), A_COLS)
    return good.agg(F.count("*").alias("good")).crossJoin(bad.agg(F.count("*").alias("bad")))


@register("src5_workbook_scan", with_views(
    "SELECT line_id, supplier_key, contributor_name, zip, employer, occupation, amount, "
    "substr(ship_date, 1, 4) || '-' || substr(ship_date, 5, 2) || '-' || substr(ship_date, 7, 2) AS ship_date, "
    "return_flag FROM landing_b", "landing_b"))
def src5_workbook_scan(spark, d):
    lb = dm.landing_b(spark, d)
    bucket = F.floor(F.split_part("line_id", F.lit("_"), F.lit(1)).cast("long") / 250)
    order = F.struct(F.split_part("line_id", F.lit("_"), F.lit(1)).cast("long"),
                     F.split_part("line_id", F.lit("_"), F.lit(2)).cast("long"))
    groups = fx.bucketed_lines(lb, bucket, F.array(*B_COLS), order)
    books = fx.workbooks(groups, B_COLS, date_cols=["ship_date"])  # dates land as ISO text
    return ld.workbook_scan(spark, fx.write_binary(books, scratch_path(spark, "src5")), B_COLS)


def _event_envelopes(spark, d, quoted: bool):
    e = dm.read(spark, d, "events").select(
        "event_id", "event_type", F.get_json_object("props", "$.k").cast("long").alias("k"))
    row = F.struct("event_id", "event_type", "k")
    g = e.groupBy(F.floor(F.col("event_id") / 100).alias("bucket")).agg(
        F.array_sort(F.collect_list(row)).alias("rows"))
    if quoted:
        body = F.to_json(F.struct(F.to_json(F.struct(F.col("rows").alias("Table"))).alias("d")))
    else:
        body = F.to_json(F.struct(F.struct(F.col("rows").alias("items")).alias("data")))
    return g.select("bucket", body.alias("body"))


_EVENTS_K_SQL = ("SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, "
                 "CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) AS VARCHAR) AS k FROM events")


@register("src6_json_envelope_scan", _EVENTS_K_SQL)
def src6_json_envelope_scan(spark, d):
    env = _event_envelopes(spark, d, quoted=True)
    return ld.json_envelope_scan(env, "body", ["event_id", "event_type", "k"], path="$.d").drop("bucket")


@register("src6_json_quarantine", """
SELECT count(DISTINCT event_id // 100) FILTER (WHERE (event_id // 100) % 3 <> 0) AS readable,
       count(DISTINCT event_id // 100) FILTER (WHERE (event_id // 100) % 3 = 0) AS unreadable FROM events""")
def src6_json_quarantine(spark, d):
    """Every third envelope is cut off: it is set aside, the others are read."""
    env = _event_envelopes(spark, d, quoted=True)
    env = env.withColumn("body", F.when(F.col("bucket") % 3 == 0, F.expr("left(body, length(body) - 8)"))
                         .otherwise(F.col("body")))
    rows, bad = ld.json_envelope_split(env, "body", ["event_id"], path="$.d")
    return rows.agg(F.count_distinct("bucket").alias("readable")).crossJoin(bad.agg(F.count("*").alias("unreadable")))


@register("src6_json_items_scan", _EVENTS_K_SQL)
def src6_json_items_scan(spark, d):
    env = _event_envelopes(spark, d, quoted=False)
    return ld.json_envelope_scan(env, "body", ["event_id", "event_type", "k"], path="$.data.items",
                                 quoted=False).drop("bucket")


@register("src6_json_entity_scan", "SELECT s_name AS name, CAST(s_nationkey AS VARCHAR) AS nation FROM supplier")
def src6_json_entity_scan(spark, d):
    s = dm.read(spark, d, "supplier")
    ent = F.struct(F.to_json(F.struct(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")))
                   .alias("entityDTO"))
    g = s.groupBy(F.floor(F.col("s_suppkey") / 50).alias("b")).agg(F.collect_list(ent).alias("aaData"))
    body = g.select(F.to_json(F.struct("aaData")).alias("body"))
    return ld.nested_entity_scan(body, "body", "$.aaData", "entityDTO", ["name", "nation"])


@register("src7_html_list_rows", """
SELECT page_id, CAST(i - 1 AS BIGINT) AS row_idx, l[i] AS cell
FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1) AS l FROM pages),
     LATERAL (SELECT unnest(generate_series(1, len(l))) AS i)""")
def src7_html_list_rows(spark, d):
    rows = ld.extract_html_rows(dm.read(spark, d, "pages"), container_tag="ul", row_tag="li",
                                cell_tags=("a",), min_cells=1, skip_header=False)
    return rows.select("page_id", "row_idx", F.element_at("cells", 1).alias("cell"))


@register("src7_html_table_rows", """
SELECT CAST(c_custkey // 100 AS BIGINT) AS page_id,
       CAST(row_number() OVER (PARTITION BY c_custkey // 100 ORDER BY c_custkey) - 1 AS BIGINT) AS row_idx,
       c_name AS name, CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS balance, c_mktsegment AS segment
FROM customer""")
def src7_html_table_rows(spark, d):
    c = dm.read(spark, d, "customer")
    tr = F.concat(F.lit("<tr><td> "), F.col("c_name"), F.lit(" </td><td>"),
                  F.col("c_acctbal").cast("decimal(12,2)").cast("string"), F.lit("</td><td>"),
                  F.col("c_mktsegment"), F.lit("</td></tr>"))
    g = fx.bucketed_lines(c, F.floor(F.col("c_custkey") / 100), tr, F.col("c_custkey"))
    html = F.concat(F.lit('<html><body><table class="grid" id="contribs"><tr><th>Name</th><th>Balance</th>'
                          '<th>Segment</th></tr>'), F.array_join("lines", ""),
                    F.lit('<tr><td colspan="3">1 2 3 Next</td></tr></table></body></html>'))
    pages = g.select(F.col("bucket").alias("page_id"), html.alias("html"))
    rows = ld.extract_html_rows(pages, "table", {"id": "contribs"}, min_cells=2)
    return rows.select("page_id", "row_idx", F.element_at("cells", 1).alias("name"),
                       F.element_at("cells", 2).alias("balance"), F.element_at("cells", 3).alias("segment"))


_LINK_PAGES_SQL = """
SELECT page_id, html FROM pages
UNION ALL
SELECT 1000000 + o_orderkey // 100 AS page_id,
       string_agg('<li><a class="dl" href="/filings/' || strftime(o_orderdate, '%Y_%m_%d') || '/'
                  || CAST(o_orderkey AS VARCHAR) || '.csv">get</a><a href=''/about/' || o_orderstatus
                  || '.html''>about</a></li>', '') AS html
FROM orders GROUP BY 1"""


@register("src8_extract_links", f"""
SELECT page_id, 'https://filings.example.org' || href AS link FROM (
  SELECT page_id, unnest(regexp_extract_all(html, '{ld.HREF_RE.replace("'", "''")}', 1)) AS href FROM link_pages)
WHERE regexp_matches(replace(string_split(href, '/')[-2], '_', ''), '^[0-9]+$')""".replace(
    "FROM link_pages", f"FROM ({_LINK_PAGES_SQL})"))
def src8_extract_links(spark, d):
    o = dm.read(spark, d, "orders")
    li = F.concat(F.lit('<li><a class="dl" href="/filings/'), F.date_format("o_orderdate", "yyyy_MM_dd"),
                  F.lit("/"), F.col("o_orderkey").cast("string"),
                  F.lit(".csv\">get</a><a href='/about/"), F.col("o_orderstatus"), F.lit(".html'>about</a></li>"))
    g = fx.bucketed_lines(o, F.floor(F.col("o_orderkey") / 100), li, F.col("o_orderkey"))
    derived = g.select((F.lit(1000000) + F.col("bucket")).alias("page_id"), F.array_join("lines", "").alias("html"))
    pages = dm.read(spark, d, "pages").select("page_id", "html").unionByName(derived)
    return ld.extract_links(pages, "https://filings.example.org")


ITEM_COLS = ["form_type", "order_ref", "line_ref", "committee_ref", "amount", "item_date"]


@register("src9_itemization_scan", """
SELECT 'sa11ai' AS form_type, CAST(l_orderkey AS VARCHAR) AS order_ref, CAST(l_linenumber AS VARCHAR) AS line_ref,
       CAST(l_suppkey AS VARCHAR) AS committee_ref, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS amount,
       strftime(l_shipdate, '%Y%m%d') AS item_date
FROM lineitem WHERE l_returnflag = 'N'""")
def src9_itemization_scan(spark, d):
    li = dm.read(spark, d, "lineitem")
    form = (F.when(F.col("l_returnflag") == "R", F.lit("SA3L"))
            .when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "O"), F.lit(""))
            .when(F.col("l_returnflag") == "A", F.lit("SB21B")).otherwise(F.lit("sa11ai")))
    line = F.concat_ws("|", form, F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
                       F.col("l_suppkey").cast("string"), F.col("l_extendedprice").cast("decimal(12,2)").cast("string"),
                       F.date_format("l_shipdate", "yyyyMMdd"))
    path = scratch_path(spark, "src9")
    li.select(line.alias("value")).write.text(path)
    return ld.itemization_scan(spark.read.text(path), ITEM_COLS)


@register("src10_route_by_filename", with_views("""
SELECT 'orders_filing' AS table_key, count(*) AS n_rows FROM landing_a UNION ALL
SELECT 'line_items', count(*) FROM landing_b UNION ALL SELECT 'web_events', count(*) FROM landing_c""",
    "landing_a", "landing_b", "landing_c"))
def src10_route_by_filename(spark, d):
    root = scratch_path(spark, "src10")
    _csv(dm.landing_a(spark, d), f"{root}/orders_filing", sep="|")
    _csv(dm.landing_b(spark, d), f"{root}/line_items", sep="|")
    _csv(dm.landing_c(spark, d), f"{root}/web_events", sep="|")
    _csv(dm.read(spark, d, "region"), f"{root}/misc", sep="|")  # matches no key: skipped
    schemas = {"orders_filing": A_COLS, "line_items": B_COLS, "web_events": C_COLS}
    files = ld.list_files(spark, root, "*.csv")
    # keys sit in the folder names below the fresh scratch root
    routes = ld.route_by_filename(files, schemas)
    parts = []
    for key, cols in schemas.items():
        paths = routes.get(key, [])
        df = ld.split_valid(ld.delimited_scan(spark, paths, cols, sep="|"))[0]
        parts.append(df.agg(F.lit(key).alias("table_key"), F.count(F.lit(1)).alias("n_rows")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _named_files(spark, d, folder: str):
    """Filings in files of 500 orders each (every fifth file has a short
    row), events in files of 500, and files that no table takes."""
    la, lc = dm.landing_a(spark, d), dm.landing_c(spark, d)
    order = F.col("filing_id").cast("long")
    cut = ((_a_bucket() % 5 == 0) & (order % 500 == F.lit(7)))
    line = F.when(cut, F.lit("cut,off")).otherwise(F.to_csv(F.struct(*A_COLS)))
    parts = [("orders_filing", A_COLS, fx.bucketed_lines(la, _a_bucket(), line, order)),
             ("web_events", C_COLS, fx.bucketed_lines(lc, F.floor(F.col("event_id").cast("long") / 500),
                                                      F.to_csv(F.struct(*C_COLS)), F.col("event_id").cast("long"))),
             ("misc", ["x"], fx.bucketed_lines(lc, F.floor(F.col("event_id").cast("long") / 5000), F.lit("x"),
                                               F.col("event_id").cast("long")))]
    for name, cols, groups in parts:
        text = F.concat(F.lit(",".join(cols) + "\n"), F.array_join("lines", "\n"), F.lit("\n"))
        files = groups.select(F.concat(F.lit(f"{name}_"), F.col("bucket").cast("string"), F.lit(".csv")).alias("path"),
                              F.encode(text, "UTF-8").alias("content"))
        fx.write_binary(files, folder)


@register("src10_load_report", with_views("""
SELECT * FROM (
WITH f AS (SELECT CAST(filing_id AS BIGINT) // 500 AS b, count(*) AS n,
                  count(*) FILTER (CAST(filing_id AS BIGINT) % 500 = 7) AS marked FROM landing_a GROUP BY 1),
g AS (SELECT *, CASE WHEN b % 5 = 0 THEN marked ELSE 0 END AS bad FROM f),
e AS (SELECT CAST(event_id AS BIGINT) AS i FROM landing_c),
first AS (
  SELECT 'orders_filing' AS "table", CASE WHEN bad > 0 THEN 'failed' ELSE 'loaded' END AS status, count(*) AS files,
         sum(n - bad)::BIGINT AS rows, sum(bad)::BIGINT AS bad_rows FROM g GROUP BY ALL
  UNION ALL SELECT 'web_events', 'loaded', count(DISTINCT i // 500), count(*), 0 FROM e
  UNION ALL SELECT NULL, 'skipped', count(DISTINCT i // 5000), 0, 0 FROM e)
SELECT 1 AS run, * FROM first
UNION ALL SELECT 2, "table", CASE status WHEN 'loaded' THEN 'skipped' ELSE status END, files,
                 CASE status WHEN 'failed' THEN rows ELSE 0 END, bad_rows FROM first)""", "landing_a", "landing_c"))
def src10_load_report(spark, d):
    """Loaded, skipped and failed files of a run and of the run after it."""
    folder, root = scratch_path(spark, "src10in"), scratch_path(spark, "src10log")
    _named_files(spark, d, folder)
    schemas = {"orders_filing": A_COLS, "web_events": C_COLS}
    first, second = (filelog.load_files(spark, folder, schemas, root) for _ in range(2))
    return first.select(F.lit(1).alias("run"), "*").unionByName(second.select(F.lit(2).alias("run"), "*"))


@register("src10_loaded_rows", with_views("""
SELECT a.* FROM landing_a a WHERE (CAST(filing_id AS BIGINT) // 500) % 5 <> 0 OR CAST(filing_id AS BIGINT) // 500 NOT IN (
  SELECT CAST(filing_id AS BIGINT) // 500 FROM landing_a WHERE CAST(filing_id AS BIGINT) % 500 = 7)""", "landing_a"))
def src10_loaded_rows(spark, d):
    """Rows of the files that were loaded: a bad file left none behind."""
    folder, root = scratch_path(spark, "src10in"), scratch_path(spark, "src10log")
    _named_files(spark, d, folder)
    filelog.load_files(spark, folder, {"orders_filing": A_COLS, "web_events": C_COLS}, root)
    return filelog.table(spark, root, "orders_filing", A_COLS).select(*A_COLS)


@register("src9_form_versions", """
SELECT strftime(DATE '2024-01-01' + CAST(l_orderkey // 250 % 28 AS INTEGER), '%Y-%m-%d') AS partition_date,
       CASE WHEN l_orderkey // 250 % 2 = 0 THEN 'SA11AI' ELSE 'sa17a' END AS form_type,
       CAST(l_suppkey AS VARCHAR) AS filer_committee_id_number,
       CASE WHEN l_orderkey // 250 % 2 = 0 THEN '' ELSE 'DOE, ' || CAST(l_partkey AS VARCHAR) END AS contributor_name,
       CASE WHEN l_orderkey // 250 % 2 = 0 THEN 'DOE' ELSE '' END AS contributor_last_name,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS contribution_amount,
       strftime(l_shipdate, '%Y%m%d') AS contribution_date
FROM lineitem WHERE l_returnflag <> 'R'""")
def src9_form_versions(spark, d):
    """Filings of two form versions, each with its separator, its positions
    and the date of its folder."""
    cols = ["form_type", "filer_committee_id_number", "contributor_name", "contributor_last_name",
            "contribution_amount", "contribution_date"]
    li = dm.read(spark, d, "lineitem").withColumn("bucket", F.floor(F.col("l_orderkey") / 250))
    values = {"filer_committee_id_number": F.col("l_suppkey").cast("string"),
              "contribution_amount": F.col("l_extendedprice").cast("decimal(12,2)").cast("string"),
              "contribution_date": F.date_format("l_shipdate", "yyyyMMdd"), "contributor_last_name": F.lit("DOE"),
              "contributor_name": F.concat(F.lit('"DOE, '), F.col("l_partkey").cast("string"), F.lit('"'))}
    old, new = filings.SCHEDULE_A[0], filings.SCHEDULE_A[-1]

    def body(layout, form, sep):
        own = {**values, "form_type": F.when(F.col("l_returnflag") == "R", F.lit("SB21B")).otherwise(F.lit(form))}
        return F.concat_ws(sep, *[own.get(c, F.lit("")) for c in layout.columns])

    even = F.col("bucket") % 2 == 0
    line = F.when(even, body(new, "SA11AI", filings.FIELD_SEPARATOR)).otherwise(body(old, "sa17a", ","))
    groups = fx.bucketed_lines(li, F.col("bucket"), line, F.struct("l_orderkey", "l_linenumber"))
    head = F.when(even, F.lit(filings.FIELD_SEPARATOR.join(["HDR", "FEC", "8.3"]))).otherwise(F.lit("HDR,FEC,5.3"))
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("bucket") % 28).cast("int")), "yyyy-MM-dd")
    files = groups.select(
        F.concat(F.lit("date="), day, F.lit("/filing_"), F.col("bucket").cast("string"), F.lit(".fec")).alias("path"),
        F.encode(F.concat(head, F.lit("\n"), F.array_join("lines", "\n"), F.lit("\n")), "UTF-8").alias("content"))
    folder = fx.write_binary(files, scratch_path(spark, "src9v"))
    return filings.itemizations(spark, folder, cols)[0]


@register("src11_map_headers", with_views(
    "SELECT filing_id, contributor_name AS name, zip, '' AS occupation_code FROM landing_a", "landing_a"))
def src11_map_headers(spark, d):
    path = scratch_path(spark, "src11")
    la = dm.landing_a(spark, d).select(F.col("filing_id").alias("Filing ID"),
                                       F.col("contributor_name").alias("CONTRIBUTOR"),
                                       F.col("zip").alias("Zip Code"))
    _csv(la, path, sep="|")
    raw = spark.read.option("header", "true").option("sep", "|").option("escape", '"').csv(path)
    return ld.map_headers(raw, {"filing_id": ["FilingId", "Filing ID"], "name": ["Name", "CONTRIBUTOR"],
                                "zip": ["zip", "Zip Code"], "occupation_code": ["OccupationCode", "JOB"]})


@register("src12_landing_scan", with_views("SELECT * FROM landing_c", "landing_c"))
def src12_landing_scan(spark, d):
    root = scratch_path(spark, "landing")
    dm.landing_c(spark, d).write.parquet(f"{root}/C/events")
    return ld.landing(spark, root, "C", "events")


# --- row hygiene ----------------------------------------------------------------------


def _ragged_b(spark, d) -> str:
    """landing_b as pipe lines; returned lines ('R') lose a field, adjusted
    ('A') gain one."""
    lb = dm.landing_b(spark, d)
    full = F.concat_ws("|", *B_COLS)
    line = (F.when(F.col("return_flag") == "R", F.concat_ws("|", *B_COLS[:-1]))
            .when(F.col("return_flag") == "A", F.concat(full, F.lit("|extra"))).otherwise(full))
    path = scratch_path(spark, "ragged")
    lb.select(line.alias("value")).write.text(path)
    return path


@register("row1_split_valid", with_views("SELECT * FROM landing_b WHERE return_flag = 'N'", "landing_b"))
def row1_split_valid(spark, d):
    df = ld.delimited_scan(spark, _ragged_b(spark, d), B_COLS, sep="|", quote=None, escape=None, header=False)
    return ld.split_valid(df)[0]


@register("row1_quarantine", with_views(
    "SELECT count(*) AS quarantined FROM landing_b WHERE return_flag <> 'N'", "landing_b"))
def row1_quarantine(spark, d):
    df = ld.delimited_scan(spark, _ragged_b(spark, d), B_COLS, sep="|", quote=None, escape=None, header=False)
    return ld.split_valid(df)[1].agg(F.count(F.lit(1)).alias("quarantined"))


@register("row2_clean_text", with_views("SELECT filing_id, contributor_name FROM landing_a", "landing_a"))
def row2_clean_text(spark, d):
    la = dm.landing_a(spark, d).select(
        "filing_id",
        F.when(F.col("status") == "O", F.concat(F.col("contributor_name"), F.lit("\u0000")))
        .otherwise(F.col("contributor_name")).alias("contributor_name"))
    return ld.clean_text(la, ["contributor_name"])


@register("row3_drop_blank_lines", "SELECT count(*) AS n_lines FROM events")
def row3_drop_blank_lines(spark, d):
    e = dm.read(spark, d, "events")
    lines = e.select(F.concat_ws("|", F.col("event_id").cast("string"), "event_type").alias("value")).unionByName(
        e.filter(F.col("event_type") == "view").select(F.lit("   ").alias("value")))
    path = scratch_path(spark, "row3")
    lines.write.text(path)
    return ld.drop_blank_lines(spark.read.text(path)).agg(F.count(F.lit(1)).alias("n_lines"))


@register("row4_fit_width", """
SELECT CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) AS line_id,
  CASE l_returnflag
    WHEN 'R' THEN CAST(l_suppkey AS VARCHAR) || '|' || CAST(l_partkey AS VARCHAR) || '|' || l_linestatus || '||'
    ELSE CAST(l_suppkey AS VARCHAR) || '|' || CAST(l_partkey AS VARCHAR) || '|' || l_linestatus || '|'
         || CAST(l_linenumber AS VARCHAR) || '|' || l_returnflag END AS fields
FROM lineitem""")
def row4_fit_width(spark, d):
    li = dm.read(spark, d, "lineitem")
    base = [F.year("l_shipdate").cast("string"), F.col("l_suppkey").cast("string"),
            F.col("l_partkey").cast("string"), F.concat(F.lit(" "), F.col("l_linestatus"))]
    more = [F.col("l_linenumber").cast("string"), F.col("l_returnflag"), F.lit("x"), F.lit("y")]
    arr = (F.when(F.col("l_returnflag") == "R", F.array(*base))
           .when(F.col("l_returnflag") == "A", F.array(*base, *more[:2]))
           .otherwise(F.array(*base, *more)))
    fitted = ld.fit_width(arr, 5, drop=1)
    line_id = F.concat_ws("_", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    return li.select(line_id.alias("line_id"), F.array_join(fitted, "|").alias("fields"))


@register("row5_with_load_columns", with_views(
    "SELECT line_id, '2024-01' AS partition_key, true AS has_file FROM landing_b", "landing_b"))
def row5_with_load_columns(spark, d):
    path = _csv(dm.landing_b(spark, d), scratch_path(spark, "row5"), sep="|")
    df = ld.split_valid(ld.delimited_scan(spark, path, B_COLS, sep="|"))[0]
    out = ld.with_load_columns(df, partition_key="2024-01")
    return out.select("line_id", "partition_key", F.col("file_name").startswith("part-").alias("has_file"))


@register("row6_drop_header_rows", with_views("SELECT * FROM landing_a", "landing_a"))
def row6_drop_header_rows(spark, d):
    from donorlake.operators.filters import drop_header_rows

    path = _csv(dm.landing_a(spark, d).repartition(4), scratch_path(spark, "row6"), sep="|")
    df = ld.split_valid(ld.delimited_scan(spark, path, A_COLS, sep="|", quote=None, escape=None,
                                          header=False))[0]
    return drop_header_rows(df, {"filing_id": "filing_id"})


@register("row8_normalize_json_row", """
SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN value > 10 THEN 'Yes' ELSE 'No' END AS "group",
       CASE WHEN event_type = 'view' THEN '' ELSE event_type END AS note
FROM events""")
def row8_normalize_json_row(spark, d):
    e = dm.read(spark, d, "events")
    js = F.to_json(F.struct("event_id", (F.col("value") > 10).alias("group"),
                            F.when(F.col("event_type") != "view", F.col("event_type")).alias("note")))
    m = F.from_json(js, "map<string,string>")
    rows = e.select(m.alias("m"))
    return rows.select(F.col("m")["event_id"].alias("event_id"),
                       ld.normalize_json_row(F.col("m")["group"]).alias("group"),
                       ld.normalize_json_row(F.col("m")["note"]).alias("note"))
