"""Streaming landing: each file once, ragged rows quarantined, re-runs
land nothing new."""

import datetime as dt
import os

from donorlake.operators import sync as syn
from donorlake.streaming import jobs


def test_land_stream_exactly_once_with_quarantine(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.csv"), "w") as fh:
        fh.write("id,name\n1,x\n2,y\nbad\n")
    args = dict(input_path=src, columns=["id", "name"], table_path=os.path.join(tmp_dir, "t"),
                checkpoint=os.path.join(tmp_dir, "ck"), quarantine_path=os.path.join(tmp_dir, "q"))
    jobs.land_stream(spark, **args)
    with open(os.path.join(src, "b.csv"), "w") as fh:
        fh.write("id,name\n3,z\n")
    jobs.land_stream(spark, **args)
    jobs.land_stream(spark, **args)  # nothing new
    rows = sorted((r.id, r.name) for r in spark.read.parquet(args["table_path"]).collect())
    assert rows == [("1", "x"), ("2", "y"), ("3", "z")]
    assert [r.raw_line for r in spark.read.parquet(args["quarantine_path"]).collect()] == ["bad"]


def test_sync_stream_keeps_rows_past_the_cap(spark, tmp_dir):
    src, root, ck = (os.path.join(tmp_dir, x) for x in ("in", "state", "ck"))
    rows = spark.createDataFrame(
        [(f"S_{i}", "S", i, dt.date(2024, 1, 1 + i)) for i in range(10)] + [("S_1", "S", 99, dt.date(2024, 2, 1))],
        "source_id string, source string, amount int, contribution_datetime date")
    rows.write.parquet(src)
    for hour in range(4):
        jobs.sync_stream(spark, src, rows.schema, root, ck, dt.datetime(2025, 1, 1, hour), max_rows=4)
    out = syn.serving(spark, root)
    assert out.count() == 10 and out.filter("amount = 99").count() == 1


def test_sync_stream_remembers_ids_without_reading_history(spark, tmp_dir):
    """Later epochs look at neither ledger nor serving: both are taken away.
    Rows of batches before the stream are left out."""
    import shutil

    src, root, ck = (os.path.join(tmp_dir, x) for x in ("in", "state", "ck"))
    schema = "source_id string, v int, contribution_datetime timestamp"
    day = lambda n: dt.datetime(2024, 1, n)
    frame = lambda rows: spark.createDataFrame(rows, schema)
    syn.sync(frame([("old", 0, day(1))]), root, "b0", day(1))
    frame([("old", 9, day(9)), ("a", 1, day(1)), ("a", 2, day(3)), ("a", None, None), ("b", 3, day(2)), (None, 4, day(1))]).write.parquet(src)
    args = (spark, src, frame([]).schema, root, ck)
    (r,) = jobs.sync_stream(*args, day(10))
    assert r.published_rows == 3
    served = sorted(x["v"] for x in syn.serving(spark, root).collect())
    assert served == [0, 2, 3, 4] and syn.ledger(spark, root).count() == 4
    shutil.rmtree(f"{root}/ledger/batch_id=epoch-000000")
    shutil.rmtree(f"{root}/serving/batch_id=epoch-000000")
    frame([("a", 5, day(20)), ("c", 6, day(1)), (None, 4, day(1)), (None, 7, day(1))]).write.mode("append").parquet(src)
    (r,) = jobs.sync_stream(*args, day(11))
    assert r.published_rows == 2
    assert sorted(x["v"] for x in syn.serving(spark, root).collect()) == [0, 6, 7]
    assert jobs.sync_stream(*args, day(12)) == []


def test_first_seen_keeps_its_state_without_python(spark, tmp_dir):
    """A key costs no Python call; ties of the newest go to the least row, and
    an id that comes again, even twice at once, is left out."""
    src, root, ck = (os.path.join(tmp_dir, x) for x in ("in", "state", "ck"))
    schema = "source_id string, v int, contribution_datetime date"
    frame = lambda rows: spark.createDataFrame(rows, schema)
    frame([("a", 5, dt.date(2024, 1, 2)), ("a", 4, dt.date(2024, 1, 2)), ("a", 1, None), ("b", 7, None)]).write.parquet(src)
    stream = spark.readStream.schema(schema).parquet(src)
    plan = jobs.first_seen(stream, "source_id", "contribution_datetime")._jdf.queryExecution().analyzed().toString()
    assert "Pandas" not in plan and "Aggregate" in plan
    args = (spark, src, frame([]).schema, root, ck)
    jobs.sync_stream(*args, dt.datetime(2025, 1, 1))
    frame([("a", 9, dt.date(2025, 1, 1)), ("a", 8, dt.date(2025, 1, 1)), ("c", 3, None)]).write.mode("append").parquet(src)
    jobs.sync_stream(*args, dt.datetime(2025, 1, 2))
    assert sorted(r["v"] for r in syn.serving(spark, root).collect()) == [3, 4, 7]
