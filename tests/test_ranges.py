"""Delimited files by byte range: line breaks in quotes at every split,
delimiters from the first line, and archives as a data source."""

import csv
import io
import os
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from donorlake.sources import archives, landing as ld, ranges


def awkward_rows(n, seed=0):
    rng = random.Random(seed)
    bits = ["a", "b,c", 'say ""x""', 'q"uote', "line\nbreak", "crlf\r\nin", "", ",", "\n", '"', "é北", "x" * 40]
    return [[str(i), "".join(rng.choice(bits) for _ in range(rng.randint(0, 4))), rng.choice(bits)] for i in range(n)]


def write_csv(path, rows, **how):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, **how)
        w.writerows([["id", "text", "more"], *rows])


@pytest.mark.parametrize("split", [1, 2, 3, 7, 64, 333, 10_000])
def test_each_record_is_in_one_range(tmp_dir, split):
    """The two passes over one file, without Spark, at any split."""
    rows = awkward_rows(120, seed=split)
    write_csv(f"{tmp_dir}/a.csv", rows, lineterminator=("\n", "\r\n")[split % 2])
    data = open(f"{tmp_dir}/a.csv", "rb").read()
    fs, path = ranges.filesystem(f"{tmp_dir}/a.csv")
    found = []
    with fs.open_input_file(path) as f:
        for a in range(0, len(data), split):
            b = min(a + split, len(data))
            begin = ranges.record_at(f, a, len(data), data[:a].count(b'"') % 2 == 1, 34)
            end = ranges.record_at(f, b, len(data), data[:b].count(b'"') % 2 == 1, 34)
            for block in ranges.records(f, begin, end, 34, step=max(split, 50)):
                found += [x.decode().rstrip("\r\n") for x in block]
    want = [tuple(x if x != "" else None for x in r) for r in rows]
    got = [tuple(x if x != "" else None for x in r) for r in ranges._parse(found, ",", '"')]
    assert got == [("id", "text", "more"), *want]


@pytest.mark.parametrize("split", [300, 5000, 1 << 20])
def test_multiline_equals_one_task_reader_at_any_split(spark, tmp_dir, split):
    rows = awkward_rows(200)
    write_csv(f"{tmp_dir}/a.csv", rows)
    write_csv(f"{tmp_dir}/b.csv", rows[:20], lineterminator="\n", quoting=csv.QUOTE_ALL)
    open(f"{tmp_dir}/empty.csv", "w").close()
    got, bad = ld.split_valid(ld.multiline_scan(spark, tmp_dir, ["id", "text", "more"], split_bytes=split))
    want = [tuple(x if x != "" else None for x in r) for r in rows] + [tuple(r) for r in rows[:20]]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert bad.count() == 0
    one_task = spark.read.schema("id string, text string, more string").csv(
        f"{tmp_dir}/b.csv", header=True, multiLine=True, escape='"')
    own = ld.multiline_scan(spark, f"{tmp_dir}/b.csv", ["id", "text", "more"], split_bytes=split).drop(ranges.CORRUPT)
    norm = lambda df: sorted(tuple((x or "").replace("\r\n", "\n") for x in r) for r in df.collect())
    assert norm(own) == norm(one_task)


def test_a_field_longer_than_many_splits(spark, tmp_dir):
    rows = [["1", "word,\n" * 5000, "x"], ["2", "y", "z"], ["3", "w\n" * 300, "end"]]
    write_csv(f"{tmp_dir}/a.csv", rows, quoting=csv.QUOTE_ALL)
    got = ld.split_valid(ld.multiline_scan(spark, tmp_dir, ["id", "text", "more"], split_bytes=4096))[0]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows))


def test_ragged_records_are_set_aside_whole(spark, tmp_dir):
    with open(f"{tmp_dir}/f.csv", "w") as f:
        f.write('id,text,more\n1,"two\nlines",x\nshort,"a\nb"\n\nlong,1,2,3\n4,"",\n')
    good, bad = ld.split_valid(ld.multiline_scan(spark, tmp_dir, ["id", "text", "more"], split_bytes=5))
    assert sorted(map(tuple, good.collect())) == [("1", "two\nlines", "x"), ("4", "", None)]
    assert sorted(r.raw_line for r in bad.collect()) == ["long,1,2,3", 'short,"a\nb"']


def test_a_file_is_read_by_several_tasks(spark, tmp_dir):
    write_csv(f"{tmp_dir}/a.csv", awkward_rows(3000))
    df = ld.multiline_scan(spark, tmp_dir, ["id", "text", "more"], split_bytes=4096)
    assert df.select(F.spark_partition_id().alias("p")).distinct().count() > 4


def test_delimiters_come_from_the_first_line(spark, tmp_dir):
    cols = ["id", "name"]
    for name, sep, rows in [("a.csv", ",", [["1", "x\ty"], ["2", "y"]]), ("b.csv", "\t", [["3", "p,q,r"]]),
                            ("c.TXT", "\t", [["4", "z"]]), ("d.csv", ",", [])]:
        with open(f"{tmp_dir}/{name}", "w") as f:
            f.write("\n".join(sep.join(r) for r in [cols, *rows]) + "\n")
    open(f"{tmp_dir}/none.csv", "w").close()
    good, bad = ld.split_valid(ld.scan_mixed_delimiters(spark, tmp_dir, cols, split_bytes=6))
    assert sorted(map(tuple, good.collect())) == [("1", "x\ty"), ("2", "y"), ("3", "p,q,r"), ("4", "z")]
    assert bad.count() == 0


def test_heads_are_bounded(tmp_dir, monkeypatch):
    with open(f"{tmp_dir}/long.csv", "wb") as f:
        f.write(b"x" * 1_000_000 + b"\n")
    assert len(ranges.first_line(f"{tmp_dir}/long.csv")) == ranges.HEAD_BYTES
    with open(f"{tmp_dir}/short.csv", "wb") as f:
        f.write(b"a,b\r\n1,2\n")
    assert ranges.first_line(f"{tmp_dir}/short.csv") == b"a,b"


def test_members_of_one_archive_run_in_several_tasks(spark, tmp_dir):
    with zipfile.ZipFile(f"{tmp_dir}/big.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for k in range(12):
            z.writestr(f"m{k:02d}.csv", "".join(f"{k},{i},{random.random()}\n" for i in range(2000)))
        z.writestr("skip.bin", b"\0" * 100)
    df = ld.archive_scan(spark, tmp_dir, split_bytes=30_000)
    assert df.rdd.getNumPartitions() > 4
    got = df.groupBy("member").agg(F.count("*").alias("n"), F.max("record_no").alias("last")).collect()
    assert sorted((r.member, r.n, r["last"]) for r in got) == [(f"m{k:02d}.csv", 2000, 2000) for k in range(12)]
    assert "binaryFile" not in df._jdf.queryExecution().toString()


@pytest.mark.parametrize("how", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED])
def test_inner_zips_are_read_in_place(spark, tmp_dir, how):
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("pad.txt", os.urandom(300_000).hex())
        z.writestr("data.csv", "a,b\n" + "1,2\n" * 7000)
    with zipfile.ZipFile(f"{tmp_dir}/outer.zip", "w", how) as z:
        z.writestr("notes.txt", "n")
        z.writestr("inner.zip", inner.getvalue())
    df = ld.archive_scan(spark, tmp_dir, mode="first_csv")
    assert df.count() == 7001 and df.first()["member"] == "inner.zip/data.csv"


def test_an_archive_without_csv_is_an_error(spark, tmp_dir):
    with zipfile.ZipFile(f"{tmp_dir}/x.zip", "w") as z:
        z.writestr("a.txt", "x")
    with pytest.raises(Exception, match="no csv member"):
        ld.archive_scan(spark, tmp_dir, mode="first_csv").collect()


def test_archives_past_two_gigabytes(tmp_dir):
    """A sparse file in front of the archive moves its members past 2 GB."""
    path = f"{tmp_dir}/far.zip"
    with open(path, "wb") as f:
        f.truncate((2 << 30) + 12345)
    with zipfile.ZipFile(path, "a") as z:
        z.writestr("far.csv", "a,b\n1,2\n")
    reader = archives._Reader({"path": path})
    (part,) = reader.partitions()
    (batch,) = reader.read(part)
    assert batch.column("fields").to_pylist() == [["a", "b"], ["1", "2"]]


def test_no_archives(spark, tmp_dir):
    assert ld.archive_scan(spark, tmp_dir).count() == 0


def test_many_archives_share_tasks(spark, tmp_dir, monkeypatch):
    units = [archives.Members(f"{i}.zip", None, 10) for i in range(1000)]
    packs = archives.packed(units, 50)
    assert len(packs) <= 51 and [u for p in packs for u in p.units] == units
    assert len(archives.packed(units, 50, 100)) > 100  # bytes ask for more
    assert archives.packed(units[:50], 50) == units[:50]
    for i in range(30):
        with zipfile.ZipFile(f"{tmp_dir}/{i}.zip", "w") as z:
            z.writestr("a.csv", f"h\n{i}\n")
    monkeypatch.setattr(archives.packed, "__defaults__", (4, archives.SPLIT_BYTES))
    for how in ("all", "first_csv"):
        reader = archives._Reader({"path": tmp_dir, "mode": how})
        parts = reader.partitions()
        assert len(parts) <= 5
        got = [f for p in parts for b in reader.read(p) for f in b.column("fields").to_pylist()]
        assert sorted(x[0] for x in got if x != ["h"]) == sorted(map(str, range(30)))
