"""Files as transactions, and filings by form version."""

import os

import pytest

from donorlake.sources import filelog, filings

COLS = ["id", "name"]
SCHEMAS = {"orders": COLS, "events": ["id", "kind", "n"]}


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", newline="") as f:
        f.write(text)


def report(df):
    return sorted(((r["table"], r["status"], r["files"], r["rows"], r["bad_rows"]) for r in df.collect()), key=repr)


def test_a_bad_file_fails_alone(spark, tmp_dir):
    src, root = f"{tmp_dir}/in", f"{tmp_dir}/out"
    put(src, "orders_1.csv", 'id,name\n1,"a\nb"\n2,c\n')
    put(src, "orders_2.csv", "id,name\n3,d\nshort\n4,e\n")
    put(src, "events_1.csv", "id,kind,n\n1,x,2\n")
    put(src, "readme.txt", "nothing\n")
    want = [("events", "loaded", 1, 1, 0), ("orders", "failed", 1, 2, 1), ("orders", "loaded", 1, 2, 0), (None, "skipped", 1, 0, 0)]
    assert report(filelog.load_files(spark, src, SCHEMAS, root)) == sorted(want, key=repr)
    rows = lambda: sorted((r["id"], r["name"]) for r in filelog.table(spark, root, "orders", COLS).collect())
    assert rows() == [("1", "a\nb"), ("2", "c")]
    # loaded files are left out, the mended one is taken
    put(src, "orders_2.csv", "id,name\n3,d\n4,e\n")
    again = report(filelog.load_files(spark, src, SCHEMAS, root))
    assert ("orders", "loaded", 1, 2, 0) in again and ("events", "skipped", 1, 0, 0) in again
    assert rows() == [("1", "a\nb"), ("2", "c"), ("3", "d"), ("4", "e")]
    name = next(r["file"] for r in filelog.log(spark, root).collect() if r["file"].endswith("orders_1.csv"))
    assert filelog.undo(spark, root, name) == 2 and rows() == [("3", "d"), ("4", "e")]
    filelog.load_files(spark, src, SCHEMAS, root)
    assert len(rows()) == 4


def test_bad_rows_within_the_limit_are_set_aside(spark, tmp_dir):
    put(f"{tmp_dir}/in", "orders.csv", "id,name\n1,a\nshort\n")
    filelog.load_files(spark, f"{tmp_dir}/in", SCHEMAS, f"{tmp_dir}/out", max_bad=1)
    assert filelog.table(spark, f"{tmp_dir}/out", "orders", COLS).count() == 1
    assert [r["raw_line"] for r in filelog.quarantine(spark, f"{tmp_dir}/out", "orders", COLS).collect()] == ["short"]


def test_a_run_that_stops_leaves_nothing(spark, tmp_dir, monkeypatch):
    src, root = f"{tmp_dir}/in", f"{tmp_dir}/out"
    put(src, "orders_1.csv", "id,name\n1,a\n")
    monkeypatch.setattr(filelog, "_LOG", "no such schema")
    with pytest.raises(Exception):
        filelog.load_files(spark, src, SCHEMAS, root)
    monkeypatch.undo()
    assert filelog.table(spark, root, "orders", COLS).count() == 0
    assert report(filelog.load_files(spark, src, SCHEMAS, root)) == [("orders", "loaded", 1, 1, 0)]


def line(version, **values):
    layout = next(x for x in filings.SCHEDULE_A if float(x.first) <= version <= float(x.last))
    return [values.get(c, "") for c in layout.columns]


def test_layouts_follow_the_form_version(spark, tmp_dir):
    sep = filings.FIELD_SEPARATOR
    cols = ["form_type", "contributor_name", "contributor_last_name", "contributor_city", "contribution_amount", "contributor_employer"]
    new = [["HDR", "FEC", "8.3", "x"],
           line(8.3, form_type="SA11AI", contributor_last_name='O"NEIL', contributor_city="SALEM", contribution_amount="5", contributor_employer="ACME"),
           line(8.3, form_type="SB21B", contribution_amount="9"), line(8.3, form_type="SA3L", contribution_amount="9")]
    put(f"{tmp_dir}/date=2024-02-03", "a.fec", "".join(sep.join(r) + "\n" for r in new))
    old = line(5.3, form_type="sa17a", contributor_name='"DOE, JANE"', contributor_city="BEND", contribution_amount="7", contributor_employer="ACME")
    put(f"{tmp_dir}/date=2003-01-01", "b.fec", "HDR,FEC,5.30,y\n" + ",".join(old) + "\n")
    mid = line(6.4, form_type="SA11AI", contributor_last_name="ROE", contribution_amount="8", contributor_employer="CO")
    put(tmp_dir, "c.fec", sep.join(["HDR", "FEC", "6.4"]) + "\n" + sep.join(mid) + "\n")
    put(tmp_dir, "d.fec", sep.join(["HDR", "FEC", "9.1"]) + "\n" + sep.join(new[1]) + "\n")
    put(tmp_dir, "none.fec", "")
    rows, unplaced = filings.itemizations(spark, tmp_dir, cols, split_bytes=40)
    assert sorted(map(tuple, rows.collect())) == [
        ("", "SA11AI", "", "ROE", "", "8", "CO"),
        ("2003-01-01", "sa17a", "DOE, JANE", "", "BEND", "7", "ACME"),
        ("2024-02-03", "SA11AI", "", 'O"NEIL', "SALEM", "5", "ACME")]
    assert [(r["version"], r["fields"][0]) for r in unplaced.collect()] == [("9.10", "SA11AI")]


def test_files_share_parts(spark, tmp_dir):
    """A table is written in as many parts as there are tasks, not one a
    file; failed and undone files are left out all the same."""
    src, root = f"{tmp_dir}/in", f"{tmp_dir}/out"
    for i in range(60):
        put(src, f"orders_{i}.csv", f"id,name\n{i},a\n" + ("short\n" if i % 20 == 0 else ""))
    filelog.load_files(spark, src, SCHEMAS, root)
    held = [os.path.join(p, f) for p, _, names in os.walk(f"{root}/data/orders") for f in names if f.endswith(".parquet")]
    assert len(held) < 30 and len({os.path.dirname(f) for f in held}) == 1
    ids = lambda: sorted(int(r["id"]) for r in filelog.table(spark, root, "orders", COLS).collect())
    good = [i for i in range(60) if i % 20]
    assert ids() == good
    stored = spark.read.parquet(*held)
    assert stored.count() == len(good)  # nothing of the bad files
    name = next(r["file"] for r in filelog.log(spark, root).collect() if r["file"].endswith("orders_7.csv"))
    assert filelog.undo(spark, root, name) == 1 and ids() == [i for i in good if i != 7]
    filelog.load_files(spark, src, SCHEMAS, root)
    assert ids() == good
