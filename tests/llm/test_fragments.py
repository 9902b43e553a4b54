"""How shared fragments travel, and what is left on disk and in memory."""

import glob
import random
import time

import numpy as np

from donorlake.llm import bwt, fragments
from donorlake.llm.util import CLEANUP, freeing, materialise


def test_packed_rows_come_back():
    rows = [(-5, 7, b"abc", b""), (2**62, -1, b"", b"12345678"), (0, 0, b"\0" * 9, b"")]
    anchor, order, symbols, places = fragments.unpack_rows(fragments.pack_rows(rows))
    assert list(zip(anchor.tolist(), order.tolist(), symbols, places)) == rows


def test_a_batch_sends_a_block_one_row(spark, monkeypatch):
    """A passage that all documents share, in fragments that all differ: its
    windows go out in as many rows as there are blocks, not one by one."""
    monkeypatch.setattr(fragments, "HOT", 1)
    rng = random.Random(4)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = text(500)
    pairs = [(i, text(450) + passage + text(450)) for i in range(40)]
    docs = spark.createDataFrame(pairs, "doc_id long, text string").repartition(2)
    batches = fragments.stage(docs, bwt.SPEC)
    found = fragments.resolve(batches, fragments.census(batches, bwt.SPEC), bwt.SPEC, 16).filter("kind = 1").collect()
    sent = [fragments.unpack_rows(r["packed"]) for r in found]
    assert len(found) <= 16 * batches.count() and sum(len(x[0]) for x in sent) > 2000
    got = sorted(map(tuple, bwt.digest(bwt.suffix_dedup(docs)).collect()))
    assert got == sorted(bwt.brute_force(pairs))


def test_a_lineage_cut_leaves_no_shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*.data")}
    before, conf = files(), spark.conf.get(CLEANUP, None)
    rows = materialise(spark.range(50_000).selectExpr("id % 1000 AS k", "id").groupBy("k").sum("id"), "cut")
    for _ in range(100):
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before
    assert spark.conf.get(CLEANUP, None) == conf
    assert rows.count() == 1000 and np.isclose(rows.agg({"sum(id)": "sum"}).first()[0], 50_000 * 49_999 / 2)


def test_a_task_gives_its_memory_back():
    """Also what lies under an object that outlives the task."""
    resident = lambda: int(open("/proc/self/statm").read().split()[1]) * 4096
    left = []

    def run(batches):
        for _ in batches:
            held = [np.ones(12_000) for _ in range(2_000)]  # 192 MB in blocks of the C heap
            left.append(held[-1])
            yield resident()

    before = resident()
    assert all(x > before + (150 << 20) for x in freeing(run)([None]))
    assert resident() < before + (50 << 20)
