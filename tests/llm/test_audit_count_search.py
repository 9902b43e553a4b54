"""Source audit, token counts and lexical search against brute force, on the
awkward fixture, empty tables and the parts where scale is handled."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from donorlake.llm import divergence, fptree, tokencount


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ------------------------------------------------------------ source divergence

@pytest.fixture(scope="module")
def sourced():
    """(text, lang, source): punctuation around terms, hot source, nulls."""
    rng = random.Random(4)
    vocab = [f"{a}{b}" for a in ("Kauf", "ümlaut", "don't", "北京", "e-mail", "x1y") for b in "abcdef"] + ["42", "--", "."]
    rows = []
    for i in range(160):
        words = [rng.choice(vocab) + rng.choice(["", "", ",", ".", " "]) for _ in range(rng.randint(0, 40))]
        source = "hot" if i % 3 == 0 else rng.choice(["s1", "s2", "ß", None, ""])
        rows.append((rng.choice([" ", "\n", "\t\x0b"]).join(words), rng.choice(["en", "en", "de", None]), source))
    rows += [(None, "en", "silent"), ("", "en", "s1"), ("one two", "solo", "only"), ("-- 42", "fr", "a"), (None, "fr", "b")]
    rows += [rows[5]] * 3 + [("Word word WORD, word", "en", "s1")] * 2 + [("z" * 50_000, "de", "s2")]
    return rows


def frame(spark, rows):
    return (spark.createDataFrame(rows, "text string, lang string, source string")
            .withColumns({"g": F.lit(1), "term": F.lit("x"), "bucket": F.lit(2), "n": F.lit(3), "docs": F.lit(4)}))


@pytest.mark.parametrize("min_docs", [1, 8, 30])
def test_audit_matches_brute_force(spark, sourced, min_docs):
    got = divergence.digest(divergence.audit(frame(spark, sourced).repartition(5), min_docs, top_terms=6))
    assert as_rows(got) == sorted(divergence.brute_force(sourced, min_docs, top_terms=6), key=repr)


def test_audit_in_small_batches_and_blocks(spark, sourced, monkeypatch):
    monkeypatch.setattr(divergence, "SOURCE_BLOCK", 2)
    monkeypatch.setattr(divergence, "TERM_BLOCK", 5)
    rows = [(t, a, s) for t, a, s in sourced]
    got = divergence.digest(divergence.audit(frame(spark, rows).repartition(20), 3, top_terms=3))
    assert as_rows(got) == sorted(divergence.brute_force(rows, 3, top_terms=3), key=repr)


def test_terms_of_a_document_count_once_over_its_chunks(spark):
    rows = [("Word, word. WORD (word)", "en", "a"), ("word", "en", "b"), ("none", "en", "b")]
    got = {(r["source"], r["term"]): (r["docs"], r["n"]) for r in divergence.term_counts(frame(spark, rows)).collect()}
    assert got == {("a", "word"): (1, 4), ("b", "word"): (1, 1), ("b", "none"): (1, 1)}


def test_audit_of_nothing(spark):
    assert divergence.audit(frame(spark, []), 1).count() == 0
    # no term is in 30 documents: the sources are at distance 0
    got = as_rows(divergence.digest(divergence.audit(frame(spark, [("a b", "en", "x"), ("c", "en", "y")]))))
    assert got == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]


# ------------------------------------------------------------ token counts

@pytest.mark.parametrize("chunk, overlap", [(tokencount.CHUNK, tokencount.OVERLAP), (300, 40), (64, 20)])
def test_token_counts_equal_the_library(docs, pairs, chunk, overlap):
    got = tokencount.digest(tokencount.count_tokens(docs, chunk=chunk, overlap=overlap))
    assert as_rows(got) == sorted(tokencount.brute_force(pairs), key=repr)


def hard_texts(seed, n):
    rng = random.Random(seed)
    pieces = ["'re", "'", " ", "   ", "\n", "\t\n ", "abc", "Ü", "12", "9 9", "!?", "\u0085", "\x1c", "北京", " ",
              "<|endoftext|>", "<|endof", "text|>", "<|", "|>", "𝔘", "é", " a", " ..", "‍", "x" * 90, " " * 70]
    return [(i, "".join(rng.choice(pieces) for _ in range(rng.randint(0, 400)))) for i in range(n)]


@pytest.mark.parametrize("chunk, overlap", [(200, 30), (48, 18), (97, 97)])
def test_seams_on_hard_texts(spark, chunk, overlap):
    rows = hard_texts(chunk, 120)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = tokencount.digest(tokencount.count_tokens(df, chunk=chunk, overlap=overlap, limit=300))
    assert as_rows(got) == sorted(tokencount.brute_force(rows, limit=300), key=repr)


def test_special_strings_are_single_tokens_across_seams(spark):
    text = "<|endoftext|>" * 500
    got = tokencount.count_tokens(spark.createDataFrame([(1, text)], "doc_id long, text string"), chunk=100, overlap=40)
    assert got.first()["n_tokens"] == 500


def test_overlaps_widen_until_a_seam_has_an_edge(spark, monkeypatch):
    asked = []
    splice = tokencount.splice
    monkeypatch.setattr(tokencount, "splice", lambda *a: asked.append(a[2:]) or splice(*a))
    rows = [(1, "word " * 300), (2, "x" * 5000), (3, "a b " * 100 + " " * 900 + "c d " * 100)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = tokencount.digest(tokencount.count_tokens(df, chunk=200, overlap=30))
    assert as_rows(got) == sorted(tokencount.brute_force(rows), key=repr)
    assert asked == [(200, 30), (800, 120), (3200, 480), (12800, 1920)]


def test_token_counts_of_nothing(no_docs):
    assert tokencount.digest(tokencount.count_tokens(no_docs)).collect() == []


# ------------------------------------------------------------ lexical search

@pytest.mark.parametrize("tree_docs, leaf", [(fptree.TREE_DOCS, fptree.LEAF), (7, 2), (40, 1)])
def test_search_matches_brute_force(docs, pairs, items, tree_docs, leaf):
    got = fptree.digest(fptree.ranked_search(docs, items, tree_docs=tree_docs, leaf=leaf))
    assert as_rows(got) == sorted(fptree.brute_force(pairs, [tuple(r) for r in items.collect()]), key=repr)


def zipf_docs(n=600, seed=8):
    rng = np.random.default_rng(seed)
    return [(int(i), " ".join(f"t{k}" for k in np.minimum(rng.zipf(1.3, rng.integers(1, 60)), 500))) for i in range(n)]


@pytest.mark.parametrize("block_terms", [200_000, 12])
def test_search_in_blocks_with_ties(spark, block_terms):
    rows = zipf_docs() + [(5000 + i, "t1 t2 t3") for i in range(40)] + [(None, "t1 t2 t3"), (77, "t1 t2 t3"), (77, "t1 t2 t3")]
    asked = [(1, "T1 t2"), (2, "t9 t9 t400 t17"), (3, "t1 t2 t3"), (3, "unseen"), (None, "t4"), (5, None), (6, ""),
             (7, "t3"), (8, " ".join(f"t{i}" for i in range(1, 60)))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"n": F.lit(1), "score": F.lit(1), "rank": F.lit(2), "item_id": F.lit(9)}).repartition(3)
    items = spark.createDataFrame(asked, "item_id long, text string").withColumn("doc_id", F.lit(4))
    got = fptree.digest(fptree.ranked_search(df, items, block_terms=block_terms, tree_docs=100, leaf=4))
    assert as_rows(got) == sorted(fptree.brute_force(rows, asked), key=repr)


def test_bounds_hold_and_prune():
    """No document scores above a bound of any node over it, and whole
    subtrees are left out."""
    rng = np.random.default_rng(1)
    vectors = []
    for i in range(2000):
        ranks = np.unique(np.minimum(rng.zipf(1.4, 15), 60) - 1)
        vectors.append((i, int(rng.integers(76, 300)), ranks, rng.integers(1, 5, len(ranks))))
    tree = fptree.Tree(vectors, leaf=8)
    factor = np.arange(1, 61, dtype=np.int64) * 50
    score = {v[0]: int((factor[v[2]] * fptree.term_score(v[3], np.int64(v[1]))).sum()) for v in vectors}
    bound = tree.bounds(np.arange(60), factor)
    for k, node in enumerate(tree.nodes):
        assert bound[k] >= max(score[d] for d in tree.ids[node.lo : node.hi])
        if node.children:
            inner = [tree.nodes[c] for c in node.children]
            assert sorted((c.lo, c.hi) for c in inner)[0][0] == node.lo and sum(c.hi - c.lo for c in inner) == node.hi - node.lo
    ranks = np.array([40, 50, 59])
    dense = np.zeros(60, np.int64)
    dense[ranks] = factor[ranks]
    best = []
    scored = tree.search(ranks, dense, best, 5)
    want = sorted(((int((dense[v[2]] * fptree.term_score(v[3], np.int64(v[1]))).sum()), -v[0]) for v in vectors), reverse=True)
    assert sorted(best, reverse=True) == want[:5]
    assert scored < 1000


def test_search_of_nothing(spark, docs, no_docs, items):
    assert fptree.ranked_search(no_docs, items).collect() == []
    assert fptree.ranked_search(docs, items.limit(0)).collect() == []
    blank = spark.createDataFrame([(1, None), (2, "..")], "doc_id long, text string")
    assert fptree.ranked_search(blank, items).collect() == []
