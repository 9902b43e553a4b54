"""Quality suites with seeded violations; sync and table maintenance are
idempotent on re-run."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from donorlake.operators import quality as qc
from donorlake.operators import sync as syn
from donorlake.operators import tables


def test_suite_counts_seeded_violations(spark):
    df = spark.createDataFrame(
        [("A_1", "A"), ("A_1", "B"), (None, "Z"), ("X_9", "Z"), ("A_a", None)], "id string, src string")
    res = {(r.rule, r.column): r.violations for r in qc.run_suite(df, [
        qc.not_null("id"), qc.unique("id"), qc.accepted("src", ["A", "B"]), qc.has_prefix("id", "A_"),
    ]).collect()}
    assert res == {("not_null", "id"): 1, ("unique", "id"): 1, ("accepted_values", "src"): 1,
                   ("has_prefix", "id"): 1}


def test_guards_raise(spark):
    df = spark.range(3)
    with pytest.raises(qc.QualityError):
        qc.assert_empty(df)
    with pytest.raises(qc.QualityError):
        qc.assert_at_most(df, 2)
    assert qc.assert_at_most(df, 3) == 3


def _master(spark):
    return spark.createDataFrame(
        [(f"S_{i}", "S", i * 10, dt.date(2024, 1, 1 + i % 28)) for i in range(50)],
        "source_id string, source string, amount int, contribution_datetime date")


def test_sync_idempotent_and_capped(spark, tmp_dir):
    m = _master(spark)
    t1, t2 = dt.datetime(2025, 1, 1, 8), dt.datetime(2025, 1, 1, 22)
    r1 = syn.sync(m, tmp_dir, "b1", t1, max_rows=30)
    assert (r1.delta_rows, r1.overflow_rows, r1.published_rows) == (50, 20, 30)
    # the 30 newest are published, the rest come in the next run
    r2 = syn.sync(m, tmp_dir, "b2", t2, max_rows=30)
    assert (r2.delta_rows, r2.published_rows) == (20, 20)
    r3 = syn.sync(m, tmp_dir, "b3", t2, max_rows=30)
    assert r3.delta_rows == 0
    assert syn.serving(spark, tmp_dir).count() == 50
    led = syn.ledger(spark, tmp_dir)
    assert led.count() == 50 and led.filter(F.col("insert_time") == F.lit(t1)).count() == 30
    # a crash after publish and before the ledger write: re-publishing the
    # same batch replaces its partition
    syn.publish(m.limit(5), f"{tmp_dir}/serving", "b2")
    syn.publish(m.limit(5), f"{tmp_dir}/serving", "b2")
    assert syn.serving(spark, tmp_dir).filter("batch_id = 'b2'").count() == 5
    # running the batch again mends it
    r2 = syn.sync(m, tmp_dir, "b2", t2, max_rows=30)
    assert r2.published_rows == 20 and syn.serving(spark, tmp_dir).count() == 50


def test_sync_without_cap_takes_everything(spark, tmp_dir):
    m = _master(spark)
    assert syn.sync(m, tmp_dir, "b1", dt.datetime(2025, 1, 1)).published_rows == 50


def test_sync_reused_batch_id_keeps_rows(spark, tmp_dir):
    m = _master(spark)
    now = dt.datetime(2025, 1, 1)
    syn.sync(m.filter("amount < 20"), tmp_dir, "b1", now)
    report = syn.sync(m.filter("amount < 30"), tmp_dir, "b1", now)
    assert report.published_rows == 3 and syn.serving(spark, tmp_dir).count() == 3
    assert syn.ledger(spark, tmp_dir).count() == 3


def test_sync_overflow_waits_as_pending(spark, tmp_dir):
    """Rows past the cap are taken up even if they never come in again."""
    m = _master(spark)
    now = dt.datetime(2025, 1, 1)
    syn.sync(m, tmp_dir, "b1", now, max_rows=20)
    for b in ("b2", "b2", "b3"):
        syn.sync(m.limit(0), tmp_dir, b, now, max_rows=20)
    assert syn.serving(spark, tmp_dir).count() == 50 and syn.ledger(spark, tmp_dir).count() == 50
    with pytest.raises(syn.SyncError):
        syn.sync(m, f"{tmp_dir}/other", "b1", now, max_rows=10, max_overflow=5)


def test_merge_and_slices(spark, tmp_dir):
    t = f"{tmp_dir}/t"
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    tables.merge_replace(base, t, "k")
    upd = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    tables.merge_replace(upd, t, "k")
    assert sorted(tuple(r) for r in tables.merge_replace(upd, t, "k").collect()) == [(1, "a"), (2, "B"), (3, "c")]
    late = spark.createDataFrame([(3, "d"), (9, "z")], "k int, v string")
    got = tables.merge_replace(late, t, "k", high_water="v")  # 'c' is the mark: both are above
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a"), (2, "B"), (3, "d"), (9, "z")]
    got = tables.merge_replace(spark.createDataFrame([(1, "a2")], "k int, v string"), t, "k", high_water="v")
    assert (1, "a") in [tuple(r) for r in got.collect()]
    got = tables.append_new(spark.createDataFrame([(1, "x"), (5, "y")], "k int, v string"), t, "k")
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a"), (2, "B"), (3, "d"), (5, "y"), (9, "z")]
    p = f"{tmp_dir}/s"
    df = spark.createDataFrame([("2023", 1), ("2024", 2)], "y string, n int")
    tables.replace_slice(df, p, ["y"])
    tables.replace_slice(spark.createDataFrame([("2024", 9)], "y string, n int"), p, ["y"])
    assert sorted((str(r.y), r.n) for r in spark.read.parquet(p).collect()) == [("2023", 1), ("2024", 9)]
    tables.replace_slice(df.limit(0), p, ["y"], [{"y": "2023"}])
    assert [(str(r.y), r.n) for r in spark.read.parquet(p).collect()] == [("2024", 9)]


@pytest.mark.parametrize("cap", [None, 1, 3, 4])
def test_every_row_is_published_once_with_equal_and_missing_ids(spark, tmp_dir, cap):
    """Duplicates of an id, rows without one and equal rows: three full runs,
    a batch run twice and a run without a cap publish each row once."""
    import datetime as dt

    rows = [("a", 1, 10), ("a", 2, 20), ("b", 3, 30), (None, 4, 40), (None, 4, 40), (None, 5, 5), ("c", 6, None)]
    m = spark.createDataFrame(rows, "source_id string, v int, s int").select(
        "source_id", "v", F.timestamp_seconds("s").alias("contribution_datetime"))
    now = dt.datetime(2025, 1, 1)
    for batch in ("b1", "b2", "b2", "b3"):
        syn.sync(m, tmp_dir, batch, now, max_rows=cap)
    syn.sync(m, tmp_dir, "b4", now)
    assert sorted(r["v"] for r in syn.serving(spark, tmp_dir).collect()) == [1, 2, 3, 4, 4, 5, 6]
    assert syn.sync(m, tmp_dir, "b5", now).delta_rows == 0


def test_a_waiting_row_that_comes_in_changed_goes_out_changed(spark, tmp_dir):
    import datetime as dt

    def m(*rows):
        return spark.createDataFrame(list(rows), "source_id string, v int, s int").select(
            "source_id", "v", F.timestamp_seconds("s").alias("contribution_datetime"))

    now = dt.datetime(2025, 1, 1)
    syn.sync(m(("a", 1, 9), ("b", 1, 5), ("c", 1, 4)), tmp_dir, "b1", now, max_rows=1)
    syn.sync(m(("a", 2, 9), ("b", 2, 5)), tmp_dir, "b2", now)  # a is synced, b comes in anew, c waits
    assert sorted(r["v"] for r in syn.serving(spark, tmp_dir).collect()) == [1, 1, 2]
    assert syn.ledger(spark, tmp_dir).count() == 3


def test_a_cap_writes_only_the_rows_at_its_value(spark, tmp_dir):
    """The rows that the cap parts by their date alone are not written again."""
    import datetime as dt

    from donorlake.operators import sync as syn

    rows = spark.createDataFrame([(f"s{i:02d}", i, dt.date(2024, 1, 1 + i // 4)) for i in range(20)],
                                 "source_id string, amount int, contribution_datetime date")
    syn.sync(rows, tmp_dir, "b1", dt.datetime(2025, 1, 1), max_rows=6)
    assert sorted(r["amount"] for r in syn.serving(spark, tmp_dir).collect()) == [12, 13, 16, 17, 18, 19]
    assert sorted(r["amount"] for r in spark.read.parquet(f"{tmp_dir}/delta-capped/b1").collect()) == [12, 13, 14, 15]
    assert spark.read.parquet(f"{tmp_dir}/pending").count() == 14
