"""Registered queries at sf0.001 against their SQL, and the pipeline."""

import re
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parents[2]
sys.path.insert(0, str(ROOT / "tools"))

import corpus_pipeline  # noqa: E402
from check_oracle import TABLES, rows_of  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from donorlake.llm import queries as Q  # noqa: E402
from donorlake.llm import superminhash  # noqa: E402
from donorlake.llm.util import materialise, table  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in Q.QUERIES) == list(range(1, 14))
    assert set(Q.QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_query_matches_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(Q.ORACLE[name])
    assert rows_of(df.columns, rows) == rows_of([d[0] for d in res.description], res.fetchall())


def test_pipeline_stages(spark):
    """Every stage works on all that its predecessor kept, and decides."""
    docs = table(spark, SF, "documents")
    kept = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = materialise(stage(spark, docs, SF), name)
        assert docs.columns == before.columns
        kept.append(docs.count())
        ids = {r[0] for r in before.select("doc_id").collect()}
        assert {r[0] for r in docs.select("doc_id").collect()} <= ids
        if name == "near_dedup":
            sizes = superminhash.near_duplicates(docs, 5).filter("group_rows > 1").count()
            assert sizes == 0
        if name == "pii":
            assert docs.filter(F.col("text").rlike(r"[A-Za-z0-9]@[A-Za-z0-9-]+\.[a-z]")).count() == 0
            assert docs.filter("n_chars <> length(text)").count() == 0
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert out.count() == kept[-1] and out.filter("NOT round_trip").count() == 0
    assert kept[0] > kept[1] > kept[2] >= kept[3] == kept[4] > 0.5 * kept[0]
    assert out.filter("n_tokens <> size(ids)").count() == 0


def test_pipeline_runs_on_an_empty_table(spark):
    docs = table(spark, SF, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SF), f"none-{name}")
    assert docs.count() == 0


def test_pipeline_stages_on_awkward_rows(spark, docs):
    for name, stage in corpus_pipeline.STAGES[1:]:
        if name == "byte_bpe":
            continue
        got = stage(spark, docs, SF)
        assert got.columns == list(corpus_pipeline.COLUMNS) and got.count() > 0
    out = corpus_pipeline.tokenise(spark, docs, SF)
    assert out.count() == docs.count() and out.filter("NOT round_trip").count() == 0


def test_near_dedup_stage_on_repeated_ids(spark):
    """Of rows equal in id and text one stays; a kept id (null counts as one)
    keeps its other texts, also where they are copies of another id's."""
    one, two, three = (" ".join(f"{c}{i}" for i in range(30)) for c in "abc")
    rows = [(1, one), (1, one), (2, one), (3, two), (3, three), (4, three), (None, two), (None, None), (None, None), (5, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.deduplicate(spark, docs, "")
    assert got.columns == list(corpus_pipeline.COLUMNS)
    assert sorted(map(repr, got.select("doc_id", "text").collect())) == sorted(map(repr, (
        spark.createDataFrame([(1, one), (3, two), (3, three), (None, two), (None, None), (5, None)],
                              "doc_id long, text string").collect())))


def test_no_task_holds_two_python_workers(spark, docs, capsys, monkeypatch):
    """Links are written before they are joined to groups, and ids before they
    are decoded: two Python functions in one task are two workers a core."""
    joined, components = [], superminhash.components

    def seen(edges):
        edges.explain()
        joined.append(capsys.readouterr().out.count("MapInArrow"))
        return components(edges)

    monkeypatch.setattr(superminhash, "components", seen)
    corpus_pipeline.deduplicate(spark, docs, SF)
    assert joined and not any(joined)
    capsys.readouterr()
    corpus_pipeline.tokenise(spark, docs, SF).explain()
    assert capsys.readouterr().out.count("MapInArrow") == 1
