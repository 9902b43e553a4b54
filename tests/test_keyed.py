"""Keyed tables: high water, versions, keys that are NULL, deltas that read
and rewrite only what they must."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from donorlake.operators import keyed, tables


def frame(spark, rows):
    return spark.createDataFrame(rows, "id string, v int, day date")


def rows_of(df):
    return sorted(((r["id"], r["v"]) for r in df.collect()), key=repr)


def day(n):
    import datetime as dt

    return dt.date(2024, 1, n)


def test_late_rows_of_the_top_day_are_taken(spark, tmp_dir):
    p = f"{tmp_dir}/t"
    tables.merge_replace(frame(spark, [("a", 1, day(1)), ("b", 1, day(2))]), p, "id", "day")
    got = tables.merge_replace(frame(spark, [("b", 2, day(2)), ("c", 1, day(2)), ("e", 1, day(3)), ("z", 1, day(1)),
                                             ("n", 1, None)]), p, "id", "day")
    assert rows_of(got) == [("a", 1), ("b", 2), ("c", 1), ("e", 1), ("n", 1)]


def test_bucket_count_is_kept(spark, tmp_dir):
    p = f"{tmp_dir}/t"
    df = spark.range(50).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("v"), F.lit(None).cast("date").alias("day"))
    tables.merge_replace(df, p, "id", buckets=16)
    with pytest.raises(ValueError, match="16 buckets"):
        tables.merge_replace(df, p, "id", buckets=7)
    with pytest.raises(ValueError, match="key"):
        tables.merge_replace(df, p, "v")
    assert tables.merge_replace(df, p, "id").count() == 50


@pytest.mark.parametrize("load", ["merge_replace", "append_new"])
def test_rows_without_a_key_load_once(spark, tmp_dir, load):
    p = f"{tmp_dir}/t"
    rows = frame(spark, [("a", 1, None), (None, 2, None), (None, 3, day(1)), (None, 3, day(1))])
    for _ in range(3):
        got = getattr(tables, load)(rows, p, "id")
    assert rows_of(got) == sorted([("a", 1), (None, 2), (None, 3), (None, 3)], key=repr)
    got = getattr(tables, load)(frame(spark, [(None, 9, None)]), p, "id")
    assert got.count() == 5


def test_random_merges_equal_a_dictionary(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(keyed, "FILE_ROWS", 20)
    p, rng, want = f"{tmp_dir}/t", np.random.default_rng(0), {}
    for step in range(5):
        keys = rng.choice(120, 60 if step == 0 else 25, replace=False)
        batch = [(f"k{k}", int(step * 1000 + k), None) for k in keys]
        if step == 3:
            got = tables.append_new(frame(spark, batch), p, "id")
            want = {b[0]: b[1] for b in batch} | want
        else:
            got = tables.merge_replace(frame(spark, batch), p, "id")
            want |= {b[0]: b[1] for b in batch}
        assert rows_of(got) == sorted(want.items(), key=repr)
    n = keyed.vacuum(spark, p, keep=1)
    assert n > 0 and rows_of(keyed.keyed(spark, p)) == sorted(want.items(), key=repr)


def test_a_small_delta_rewrites_nothing(spark, tmp_dir):
    p = f"{tmp_dir}/t"
    base = spark.range(50_000).select(F.concat(F.lit("k"), "id").alias("id"), F.lit(1).alias("v"), F.lit(None).cast("date").alias("day"))
    tables.merge_replace(base, p, "id")
    before = {r["file"]: r["n"] for r in keyed.files_of(spark, p, 1).collect()}
    delta = base.filter(F.expr("cast(substr(id, 2) as int) % 1000 = 7")).withColumn("v", F.lit(2))
    got = tables.merge_replace(delta, p, "id")
    after = {r["file"]: (r["n"], r["deleted"]) for r in keyed.files_of(spark, p, 2).collect()}
    assert got.count() == 50_000 and got.filter("v = 2").count() == 50
    assert all(after[f][0] == n for f, n in before.items())  # every base file is still there as it was
    assert sum(d for _, d in after.values()) == 50 and sum(n for n, _ in after.values()) == 50_050


def test_filters_admit_every_key_and_few_others():
    rng = np.random.default_rng(2)
    own, other = rng.integers(-(2**63), 2**63 - 1, 5000), rng.integers(-(2**63), 2**63 - 1, 5000)
    bloom = keyed.bloom_of(own)
    assert keyed.may_hold(bloom, own).all() and keyed.may_hold(bloom, other).mean() < 0.06


def test_files_outside_the_delta_are_not_candidates(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(keyed, "FILE_ROWS", 100)
    p = f"{tmp_dir}/t"
    base = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("id"), F.lit(1).alias("v"), F.lit(None).cast("date").alias("day"))
    tables.merge_replace(base, p, "id")
    files = keyed.files_of(spark, p, 1)
    wanted = keyed._hashed(base.filter("id in ('k1', 'k2', 'k3')"), "id")
    assert files.count() >= 40 and len(keyed.candidates(files, wanted, keyed.BUCKETS)) <= 6
    unseen = keyed._hashed(base.filter("id = 'k1'").withColumn("id", F.lit("new")), "id")
    assert len(keyed.candidates(files, unseen, keyed.BUCKETS)) <= 1


def test_a_reader_sees_whole_versions_and_one_of_two_writers_fails(spark, tmp_dir, monkeypatch):
    p = f"{tmp_dir}/t"
    tables.merge_replace(frame(spark, [("a", 1, None)]), p, "id")
    monkeypatch.setattr(keyed, "_commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        tables.merge_replace(frame(spark, [("a", 2, None), ("b", 1, None)]), p, "id")
    assert rows_of(keyed.keyed(spark, p)) == [("a", 1)]
    monkeypatch.undo()
    commit = keyed._commit

    def late(spark_, path, v, *rest):
        commit(spark_, path, v, *rest)  # another writer was faster
        commit(spark_, path, v, *rest)

    monkeypatch.setattr(keyed, "_commit", late)
    with pytest.raises(keyed.MergeConflict):
        tables.merge_replace(frame(spark, [("c", 1, None)]), p, "id")


def test_replaced_slices_read_their_input_once(spark, tmp_dir):
    df = spark.range(100).select((F.rand() * 0 + F.col("id") % 2).cast("int").alias("part"), "id")
    path = f"{tmp_dir}/s"
    tables.replace_slice(df, path, ["part"], [{"part": 0}, {"part": 1}, {"part": 2}])
    assert spark.read.parquet(path).count() == 100
    tables.replace_slice(df.filter("part = 1"), path, ["part"], [{"part": 0}, {"part": 1}])
    assert spark.read.parquet(path).count() == 50


def test_an_append_deals_only_the_rows_that_stay(spark, tmp_dir, monkeypatch):
    from donorlake.operators import keyed as kd

    dealt = []
    write = kd._write_files
    monkeypatch.setattr(kd, "_write_files", lambda rows, folder, buckets: (dealt.append(rows.count()), write(rows, folder, buckets)))
    frame = lambda a, b: spark.range(a, b).selectExpr("cast(id as string) k", "id v")
    kd.append_new(frame(0, 100), tmp_dir, "k")
    kd.append_new(frame(0, 130), tmp_dir, "k")
    assert dealt == [100, 30] and kd.keyed(spark, tmp_dir).count() == 130


def test_an_append_leaves_no_copy_and_no_shuffle_files(spark, tmp_dir):
    import time

    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def shuffled():
        names = disk.getAllFiles().iterator()
        return {n for n in iter(lambda: names.next().getName() if names.hasNext() else None, None) if n.startswith("shuffle_")}

    before = shuffled()
    some = lambda a, b: spark.range(a, b).repartition(3).selectExpr("cast(id as string) k", "id v")
    tables.append_new(some(0, 100), tmp_dir, "k")
    tables.append_new(some(0, 130), tmp_dir, "k")
    until = time.time() + 10  # they go in the background
    while (left := shuffled() - before) and time.time() < until:
        time.sleep(0.1)
    assert not left
    assert spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_dir}/data").count() == 130


@pytest.mark.parametrize("stored", [False, True])
def test_an_append_deals_its_rows_share_by_share(spark, tmp_dir, monkeypatch, stored):
    monkeypatch.setattr(keyed, "FILE_ROWS", 100)
    dealt, write = [], keyed._write_files
    monkeypatch.setattr(keyed, "_write_files", lambda rows, *a: (dealt.append(rows.count()), write(rows, *a)))
    p = f"{tmp_dir}/t"
    old = spark.range(400).selectExpr("case when id < 390 then cast(id as string) end k", "id v")
    twice = "explode(array(id, id)) v"  # keys that repeat, and equal rows without a key
    spark.range(600).selectExpr("id", twice).selectExpr("case when v >= 10 then cast(380 + v as string) end k", "v + 380 v").write.parquet(f"{tmp_dir}/in")
    tables.append_new(old, p, "k")
    new = spark.read.parquet(f"{tmp_dir}/in")
    tables.append_new(new.filter("v < 0"), p, "k", stored=stored)  # nothing comes
    for _ in range(2):
        got = tables.append_new(new, p, "k", stored=stored)
    assert keyed.version(spark, p) == 4
    want = [(str(i), i) for i in range(390)] + [(None, i) for i in range(390, 400)]
    want += [(None, i) for i in range(380, 390) for _ in range(2)] + [(str(i), i) for i in range(390, 980) for _ in range(2)]
    assert rows_of(got.withColumnRenamed("k", "id")) == sorted(want, key=repr)
    assert len(dealt) == 2 + keyed.SHARES and sum(dealt[2:]) == 1200 and max(dealt[2:]) < 400  # the last append deals nothing
    assert spark.read.option("recursiveFileLookup", "true").parquet(f"{p}/data").count() == len(want)


def test_shares_cover_every_hash_once():
    for n in (1, 3, 8):
        got = keyed._shares(n)
        assert got[0][0] == -(2**63) and got[-1][1] == 2**63 - 1
        assert all(a[1] + 1 == b[0] for a, b in zip(got, got[1:]))


def test_a_few_hashes_first_find_the_same_files(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(keyed, "FILE_ROWS", 100)
    base = spark.range(1000).select(F.concat(F.lit("k"), "id").alias("id"), F.lit(1).alias("v"))
    tables.append_new(base, f"{tmp_dir}/t", "id")
    files = keyed.files_of(spark, f"{tmp_dir}/t", 1)
    for some in (base.filter("id in ('k1', 'k2', 'k3')"), base):
        hashes = keyed._keys(some, "id")
        found = keyed.candidates(files, hashes, keyed.BUCKETS, many=True)
        assert len(found) == len(set(found)) and set(found) == set(keyed.candidates(files, hashes, keyed.BUCKETS))
