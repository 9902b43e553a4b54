"""Landing scans on real files: nested zip archives, workbooks, ragged
delimited text, leaked headers, HTML rows and links."""

import io
import os
import zipfile

from pyspark.sql import functions as F

from donorlake.sources import fixtures as fx
from donorlake.sources import landing as ld


def test_archive_scan_nested_first_csv(spark, tmp_dir):
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("readme.txt", "x")
        z.writestr("data.csv", "a,b\n1,2\n3,4\n")
    with zipfile.ZipFile(os.path.join(tmp_dir, "outer.zip"), "w") as z:
        z.writestr("notes.txt", "n")
        z.writestr("inner.zip", inner.getvalue())
    with zipfile.ZipFile(os.path.join(tmp_dir, "flat.zip"), "w") as z:
        z.writestr("dir/", "")
        z.writestr("dir/x.csv", "a,b\n5,6\n")
    records = ld.archive_scan(spark, tmp_dir, mode="first_csv")
    rows = ld.split_records(records, ["a", "b"])[0].collect()
    assert sorted((r.a, r.b) for r in rows) == [("1", "2"), ("3", "4"), ("5", "6")]
    # mode "all" reads every matching top-level member (no descent)
    every = ld.archive_scan(spark, tmp_dir, mode="all", member_pattern=r"\.(txt|csv)$")
    assert sorted(r.member for r in every.select("member").distinct().collect()) == ["dir/x.csv", "notes.txt"]


def test_archive_records_keep_quotes_and_set_bad_ones_aside(spark, tmp_dir):
    text = 'id,name,amount\n1,"DOE, JANE",5\n2,"two\nlines",6\n3,a\u0085b,7\n4,short\n\n5,x,8,long\n'
    with zipfile.ZipFile(os.path.join(tmp_dir, "a.zip"), "w") as z:
        z.writestr("a.csv", text)
    good, bad = ld.split_records(ld.archive_scan(spark, tmp_dir), ["id", "name", "amount"])
    assert sorted(tuple(r) for r in good.collect()) == [
        ("1", "DOE, JANE", "5"), ("2", "two\nlines", "6"), ("3", "a\u0085b", "7")]
    assert sorted(r.fields for r in bad.collect()) == [["4", "short"], ["5", "x", "8", "long"]]


def test_serials_round_to_the_nearest_second():
    import datetime as dt

    for s in range(0, 86_400, 7):
        t = dt.datetime(2024, 2, 3) + dt.timedelta(seconds=s)
        want = t.date().isoformat() if s == 0 else t.isoformat()
        assert ld._serial_to_iso(f"{45325 + s / 86_400:.10f}") == want
    assert ld._serial_to_iso("0.5") == "12:00:00"


def test_unreadable_envelopes_are_set_aside(spark):
    good = '{"d": "{\\"Table\\": [{\\"a\\": 1}]}"}'
    df = spark.createDataFrame([(1, good), (2, good[:-9]), (3, "<html>"), (4, '{"d": "{\\"Table\\": []}"}')],
                               "id int, body string")
    rows, bad = ld.json_envelope_split(df, "body", ["a"])
    assert [tuple(r) for r in rows.collect()] == [(1, "1")]
    assert sorted(r.id for r in bad.collect()) == [2, 3]


def test_workbook_roundtrip(spark, tmp_dir):
    groups = spark.createDataFrame([(0, [["a", "1"], ["b", ""]]), (1, [["c", "3"]])],
                                   "bucket long, lines array<array<string>>")
    fx.write_binary(fx.workbooks(groups, ["name", "amount"]), tmp_dir)
    df = ld.workbook_scan(spark, tmp_dir, ["name", "amount"])
    assert sorted(tuple(r) for r in df.collect()) == [("a", "1"), ("b", ""), ("c", "3")]


def test_quarantine_short_and_long_rows(spark, tmp_dir):
    p = os.path.join(tmp_dir, "f.csv")
    with open(p, "w") as fh:
        fh.write("col1,col2,col3,col4\nval1,val2,val3,val4\nbad,row\n\"q,1\",\"a \"\"b\"\"\",x,y\nlong,1,2,3,4\n\n")
    df = ld.delimited_scan(spark, p, ["col1", "col2", "col3", "col4"])
    good, bad = ld.split_valid(df)
    assert sorted(tuple(r) for r in good.collect()) == [("q,1", 'a "b"', "x", "y"), ("val1", "val2", "val3", "val4")]
    assert sorted(r.raw_line for r in bad.collect()) == ["bad,row", "long,1,2,3,4"]
    assert good.count() == 2 and bad.count() == 2


def test_clean_text_and_fit_width(spark):
    df = spark.createDataFrame([("a\u0000b",)], "x string")
    assert ld.clean_text(df).first()[0] == "ab"
    arr = spark.createDataFrame([(["2024", " a ", "b"],), (["2024", "a", "b", "c", "d"],)], "f array<string>")
    got = [r[0] for r in arr.select(ld.fit_width(F.col("f"), 3, drop=1)).collect()]
    assert got == [["a", "b", ""], ["a", "b", "c"]]


def test_json_envelope(spark):
    body = '{"d": "{\\"Table\\": [{\\"a\\": 1, \\"flag\\": true}, {\\"a\\": 2}]}"}'
    df = spark.createDataFrame([(body,)], "body string")
    rows = ld.json_envelope_scan(df, "body", ["a", "flag"]).collect()
    assert [(r.a, r.flag) for r in rows] == [("1", "true"), ("2", "")]
    out = df.select(ld.normalize_json_row(F.lit("true")), ld.normalize_json_row(F.lit(None).cast("string"))).first()
    assert tuple(out) == ("Yes", "")


def test_html_rows_and_links(spark):
    html = ('<table id="t"><tr><th>Name</th><th>Amt</th></tr><tr><td> Jane  Doe </td><td>5&amp;6</td></tr>'
            '<tr><td colspan="2">1 2 Next</td></tr></table>'
            '<a href="/files/2024_01/report.csv">r</a><a href="/about/x.html">a</a>')
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    rows = ld.extract_html_rows(pages, "table", {"id": "t"}, min_cells=2).collect()
    assert [r.cells for r in rows] == [["Jane Doe", "5&6"]]
    links = [r.link for r in ld.extract_links(pages, "https://x.org").collect()]
    assert links == ["https://x.org/files/2024_01/report.csv"]


def test_map_headers_and_routing(spark):
    df = spark.createDataFrame([("1", "Jane")], "`Filing ID` string, CONTRIBUTOR string")
    out = ld.map_headers(df, {"id": ["FilingId", "Filing ID"], "name": ["contributor"], "zip": ["Zip"]})
    assert tuple(out.first()) == ("1", "Jane", "")
    routes = ld.route_by_filename(["/a/orders_2024.csv", "/a/misc.csv"], {"orders": ["x"]})
    assert routes == {"orders": ["/a/orders_2024.csv"], None: ["/a/misc.csv"]}
    deep = "/data/line_items/run/orders_filing/part-0.csv"
    assert ld.route_by_filename([deep], {"line_items": ["x"], "orders": ["y"]}) == {"orders": [deep]}


def test_workbook_date_cells_land_as_iso(spark, tmp_dir):
    groups = spark.createDataFrame([(0, [["a", "20240203"], ["b", "2023-12-31"]])],
                                   "bucket long, lines array<array<string>>")
    fx.write_binary(fx.workbooks(groups, ["name", "day"], date_cols=["day"]), tmp_dir)
    df = ld.workbook_scan(spark, tmp_dir, ["name", "day"])
    assert sorted(tuple(r) for r in df.collect()) == [("a", "2024-02-03"), ("b", "2023-12-31")]


def test_plain_sheet_rows_equal_parsed_ones():
    """Rows cut out of the text are those of the XML parser, and one that is
    written otherwise sends the rest of its sheet there."""
    rows = [[f"{i}_{j} é > \"q\"" if j % 3 else "" for j in range(30)] for i in range(3000)]
    rows[2000][1] = "A & B <c> &amp;lt;"
    book = io.BytesIO(fx._xlsx([["h"] * 30, *rows]))
    with zipfile.ZipFile(book) as z, z.open("xl/worksheets/sheet1.xml") as f:
        plain = list(ld._plain_rows(f))
        assert len(plain) == 3001 and None not in plain
        got = list(ld._sheet_rows(z, 0))
    assert [n for n, _ in got] == list(range(1, 3002))
    assert [c for _, c in got][1:] == [[*r[:30]] for r in rows]
    odd = ('<row r="1"><c r="A1" t="b"><v>1</v></c><c r="C1" s="1"><v>45325.5</v></c><c r="D1" s="1"/></row><row r="2"/>'
           '<row r="4" spans="1:2"><c t="str" r="B4"><f>1+1</f><v>x</v></c><!-- c --><c r="A4"><v>7</v></c></row>')
    with zipfile.ZipFile(book) as z:
        names = {n: z.read(n) for n in z.namelist()}
    head, _, tail = names["xl/worksheets/sheet1.xml"].partition(b"<sheetData>")
    names["xl/worksheets/sheet1.xml"] = head + b"<sheetData>" + odd.encode() + b"</sheetData></worksheet>"
    again = io.BytesIO()
    with zipfile.ZipFile(again, "w") as z:
        for n, x in names.items():
            z.writestr(n, x)
    with zipfile.ZipFile(again) as z:
        assert list(ld._sheet_rows(z, 0)) == [(1, ["True", "", "2024-02-03T12:00:00", ""]), (2, []), (4, ["7", "x"])]


def test_files_are_rendered_a_few_at_a_time(spark, tmp_dir, monkeypatch):
    """A worker is never given all the groups of its task at once."""
    monkeypatch.setattr(fx, "FILES_AT_ONCE", 7)
    groups = spark.range(100).repartition(1).select(F.col("id").alias("bucket"), F.array(F.lit("x")).alias("lines"))

    def count(batches):
        for b in batches:
            assert b.num_rows <= 7
            yield b

    before = spark.conf.get(fx._BATCH)
    fx.write_binary(fx.zip_archives(groups.mapInArrow(count, groups.schema), "h"), tmp_dir)
    assert len(os.listdir(tmp_dir)) == 100 and spark.conf.get(fx._BATCH) == before
    assert ld.archive_scan(spark, tmp_dir, mode="first_csv").count() == 200
