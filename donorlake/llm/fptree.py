"""Ranked lexical search on document FP-trees.

Documents are reduced to *restricted* term vectors: the terms that some item
asks for, ordered from the most to the least frequent. Sorted vectors share
prefixes, and a tree over them (one for each ``TREE_DOCS`` documents of a
task) has a node for each shared path; a path with at most ``LEAF`` documents
ends in a leaf. Every node knows, for its whole subtree, the largest tf of
each term and the smallest length part ``m``. A term's score grows with tf and
falls with m, so these give an upper bound on any document below. Each item
walks each tree depth first, best child first, and leaves out a subtree whose
bound is below the score of its ``TOP``-th document so far (a bound equal to
it is walked: the doc_id may win the tie). Leaves are scored exactly.

Items are a query set. They are taken in blocks of at most ``BLOCK_TERMS``
distinct terms (an item with more is a block of its own); each block is one
broadcast, used by one pass over the documents that writes its vectors, and
freed before the next. Of each task only ``TOP`` documents an item leave it.

Scores are integers: w * ((10^9 tf) div (1000 tf + 12 m)) summed over an
item's terms, repeats included, with w = floor(1000 ln((2N + 2) / (2 df + 1)))
and m = 75 + (25 n N) div L.

Defined results: a null text has no terms and is neither found nor counted;
an item without known terms finds nothing; each row of the items is an item
of its own, also where an item_id is null or repeats; repeated documents are
ranked one by one; a null doc_id comes after all others of its score; other
columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from donorlake.llm.util import materialise, prepare, sliced, texts_of

TOP = 20
TREE_DOCS = 4096
LEAF = 32
BLOCK_TERMS = 200_000
SCALE = 1_000_000_000
_NULL_ID = 1 << 63  # after every doc_id

#: Every byte outside the term class becomes a space, A-Z becomes a-z.
TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)


def terms(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_part(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    return 75 + (25 * n * n_docs) // n_terms


def term_score(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (SCALE * tf) // (1000 * tf + 12 * m)


# ------------------------------------------------------------ items

@dataclass
class Block:
    """Items of one pass: their terms as places in ``vocab``."""

    vocab: dict[bytes, int]
    ids: list  # item_id of each item
    rows: list[int]  # number of each item over all blocks
    asked: list[tuple[np.ndarray, np.ndarray]]  # distinct terms, how often


def blocks_of(items: DataFrame, block_terms: int = BLOCK_TERMS) -> Iterator[Block]:
    """Blocks with at most ``block_terms`` distinct terms, read one by one."""
    block = Block({}, [], [], [])
    for i, row in enumerate(items.select("item_id", "text").toLocalIterator()):
        asked = Counter(terms((row["text"] or "").encode()))
        new = sum(t not in block.vocab for t in asked)
        if block.ids and len(block.vocab) + new > block_terms:
            yield block
            block = Block({}, [], [], [])
        at = [block.vocab.setdefault(t, len(block.vocab)) for t in asked]
        block.ids.append(row["item_id"])
        block.rows.append(i)
        block.asked.append((np.array(at, np.int64), np.array([*asked.values()], np.int64)))
    if block.vocab:
        yield block


# ------------------------------------------------------------ vectors

def _vectors(shared):
    def run(batches):
        get = shared.value.vocab.get
        for batch in sliced(batches, limit=4 << 20):
            n, at, tf = [], [], []
            for t in texts_of(batch):
                found = terms(t)
                counted = Counter(map(get, found))
                counted.pop(None, None)
                n.append(len(found))
                at.append([*counted])
                tf.append([*counted.values()])
            out = pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(n, pa.int64()),
                pa.array(at, pa.list_(pa.int32())), pa.array(tf, pa.list_(pa.int32()))],
                ["doc_id", "n", "terms", "tf"])
            yield out.filter(pa.array([x > 0 for x in n]))
    return run


# ------------------------------------------------------------ the tree

@dataclass
class Node:
    lo: int  # documents lo..hi of the sorted vectors
    hi: int
    children: list[int]


class Tree:
    """FP-tree over the restricted vectors of some documents. ``vectors``
    holds (doc_id, m, ranks, tf) with ranks ascending: rank 0 is the most
    frequent term."""

    def __init__(self, vectors: list[tuple], leaf: int = LEAF):
        vectors = sorted(vectors, key=lambda v: v[2].astype(">u4").tobytes())
        self.ids = [v[0] for v in vectors]
        self.m = np.array([v[1] for v in vectors], np.int64)
        self.ranks = [v[2] for v in vectors]
        self.begin = np.concatenate([[0], np.cumsum([len(r) for r in self.ranks])])
        self.flat = np.concatenate(self.ranks) if vectors else np.empty(0, np.int64)
        self.tf = np.concatenate([v[3] for v in vectors]) if vectors else self.flat
        self.nodes: list[Node] = []
        self._grow(leaf)
        self.m_min = np.array([self.m[x.lo : x.hi].min() for x in self.nodes], np.int64)
        self._maxima()

    def _grow(self, leaf: int) -> None:
        """Nodes in depth-first order; a path shared by all documents of a
        node takes no node of its own."""
        stack = [(0, len(self.ids), 0, -1)]
        while stack:
            lo, hi, depth, parent = stack.pop()
            if parent >= 0:
                self.nodes[parent].children.append(len(self.nodes))
            here = len(self.nodes)
            self.nodes.append(Node(lo, hi, []))
            while hi - lo > leaf:
                a, b = self.ranks[lo], self.ranks[hi - 1]
                if len(a) > depth and len(b) > depth and a[depth] == b[depth]:
                    depth += 1  # sorted: all between share it too
                    continue
                if max(len(a), len(b)) <= depth:
                    break  # equal vectors
                terms_here = [int(r[depth]) if len(r) > depth else -1 for r in self.ranks[lo:hi]]
                cut = [lo, *(np.flatnonzero(np.diff(terms_here)) + lo + 1), hi]
                stack += [(int(x), int(y), depth + 1, here) for x, y in zip(cut, cut[1:])]
                break

    def _maxima(self) -> None:
        """Largest tf of each term below each node, by term: ``post[r]`` to
        ``post[r + 1]`` are the nodes that have rank ``r``."""
        node, rank, tf = [], [], []
        for k, x in enumerate(self.nodes):
            a, b = self.begin[x.lo], self.begin[x.hi]
            r, f = self.flat[a:b], self.tf[a:b]
            order = np.argsort(r, kind="stable")
            r, f = r[order], f[order]
            first = np.flatnonzero(np.diff(r, prepend=-1))
            rank.append(r[first])
            tf.append(np.maximum.reduceat(f, first) if len(first) else f)
            node.append(np.full(len(first), k))
        rank, node, tf = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (rank, node, tf))
        order = np.argsort(rank, kind="stable")
        self.post_rank, self.post_node, self.post_tf = rank[order], node[order], tf[order]

    def bounds(self, ranks: np.ndarray, factor: np.ndarray) -> np.ndarray:
        """An upper bound of the score of any document below each node."""
        lo, hi = np.searchsorted(self.post_rank, ranks, "left"), np.searchsorted(self.post_rank, ranks, "right")
        n = hi - lo
        at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        node = self.post_node[at]
        out = np.zeros(len(self.nodes), np.int64)
        np.add.at(out, node, np.repeat(factor, n) * term_score(self.post_tf[at], self.m_min[node]))
        return out

    def search(self, ranks: np.ndarray, dense: np.ndarray, best: list[tuple], top: int) -> int:
        """Keep in the heap ``best`` the ``top`` best documents, as (score,
        -doc_id); the number of documents scored. ``dense`` has the factor of
        each rank."""
        bound = self.bounds(ranks, dense[ranks])
        scored = 0
        stack = [0] if self.nodes else []
        while stack:
            k = stack.pop()
            if bound[k] <= 0 or (len(best) == top and bound[k] < best[0][0]):
                continue
            x = self.nodes[k]
            if x.children:
                stack += sorted(x.children, key=bound.__getitem__)
                continue
            scored += x.hi - x.lo
            a, b = self.begin[x.lo], self.begin[x.hi]
            size = np.diff(self.begin[x.lo : x.hi + 1])
            doc = np.repeat(np.arange(x.hi - x.lo), size)
            part = dense[self.flat[a:b]] * term_score(self.tf[a:b], self.m[x.lo : x.hi][doc])
            score = np.zeros(x.hi - x.lo, np.int64)
            np.add.at(score, doc, part)
            least = best[0][0] if len(best) == top else 1
            for d in np.flatnonzero(score >= least).tolist():
                doc_id = self.ids[x.lo + d]
                entry = (int(score[d]), -(_NULL_ID if doc_id is None else doc_id))
                if len(best) < top:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return scored


# ------------------------------------------------------------ search

@dataclass
class Plan:
    """What a task needs to search: ranks and weights of the block's terms."""

    rank: np.ndarray  # place in the vocabulary -> rank by frequency
    queries: list[tuple[int, object, np.ndarray, np.ndarray]]  # row, item_id, ranks, factors
    n_docs: int
    n_terms: int


def plan_of(block: Block, df: dict[int, int], n_docs: int, n_terms: int) -> Plan:
    n = np.zeros(len(block.vocab), np.int64)
    for t, x in df.items():
        n[t] = x
    rank = np.empty(len(n), np.int64)
    rank[np.lexsort((np.arange(len(n)), -n))] = np.arange(len(n))
    w = np.array([weight(n_docs, int(x)) if x else 0 for x in n], np.int64)
    queries = []
    for row, item_id, (at, often) in zip(block.rows, block.ids, block.asked):
        order = np.argsort(rank[at])
        queries.append((row, item_id, rank[at][order], (w[at] * often)[order]))
    return Plan(rank, queries, n_docs, n_terms)


def _read(batches, plan: Plan):
    for batch in batches:
        m = length_part(batch.column("n").to_numpy(), plan.n_docs, plan.n_terms)
        ids = batch.column("doc_id").to_pylist()
        at, tf = batch.column("terms"), batch.column("tf")
        for i in range(batch.num_rows):
            r = plan.rank[at[i].values.to_numpy()]
            order = np.argsort(r)
            yield ids[i], int(m[i]), r[order], tf[i].values.to_numpy()[order].astype(np.int64)


def _search(shared, item_type, tree_docs, leaf, top):
    def run(batches):
        plan = shared.value
        best = [[] for _ in plan.queries]
        dense = np.zeros(len(plan.rank), np.int64)

        def look(vectors):
            tree = Tree(vectors, leaf)
            for (_, _, ranks, factor), heap in zip(plan.queries, best):
                dense[ranks] = factor
                tree.search(ranks, dense, heap, top)
                dense[ranks] = 0

        vectors = []
        for v in _read(batches, plan):
            vectors.append(v)
            if len(vectors) == tree_docs:
                look(vectors)
                vectors = []
        if vectors:
            look(vectors)
        for (row, item_id, _, _), heap in zip(plan.queries, best):
            yield pa.RecordBatch.from_arrays([
                pa.array([row] * len(heap), pa.int64()), pa.array([item_id] * len(heap), item_type),
                pa.array([None if e[1] == -_NULL_ID else -e[1] for e in heap], pa.int64()),
                pa.array([e[0] for e in heap], pa.int64())], ["item", "item_id", "doc_id", "score"])
    return run


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS,
                  tree_docs: int = TREE_DOCS, leaf: int = LEAF) -> DataFrame:
    """item (number of the item's row), item_id, rank, doc_id and score of the
    ``top`` best documents of every item."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark = prepare(docs.sparkSession)
    id_type = items.schema["item_id"].dataType
    schema = f"item long, item_id {id_type.simpleString()}, doc_id long, score long"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = spark.createDataFrame([], schema)
    for block in blocks_of(items, block_terms):
        shared = spark.sparkContext.broadcast(block)
        vectors = materialise(rows.mapInArrow(
            _vectors(shared), "doc_id long, n long, terms array<int>, tf array<int>"), "vectors")
        shared.unpersist()
        total = vectors.agg(F.count("*").alias("n"), F.sum("n").alias("terms")).first()
        if not total["n"]:
            break
        df = vectors.select(F.explode("terms").alias("t")).groupBy("t").count()
        df = {r["t"]: r["count"] for r in df.collect()}  # one row a term of the block
        shared = spark.sparkContext.broadcast(plan_of(block, df, total["n"], total["terms"]))
        kept = materialise(vectors.filter("size(terms) > 0").mapInArrow(
            _search(shared, to_arrow_type(id_type), tree_docs, leaf, top), schema), "best")
        shared.unpersist()
        found = found.unionByName(kept)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("item", "item_id", "rank", "doc_id", "score"))


def digest(result: DataFrame) -> DataFrame:
    return result.select("item_id", "rank", "doc_id", "score")


def brute_force(docs: list[tuple], items: list[tuple], top: int = TOP) -> list[tuple]:
    """Reference answer for tests: every document against every item."""
    vectors = [(d, Counter(terms((t or "").encode()))) for d, t in docs]
    vectors = [(d, v) for d, v in vectors if v]
    n_docs, n_terms = len(vectors), sum(sum(v.values()) for _, v in vectors)
    df = defaultdict(int)
    for _, v in vectors:
        for t in v:
            df[t] += 1
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, v in vectors:
            m = 75 + (25 * sum(v.values()) * n_docs) // n_terms
            s = sum(weight(n_docs, df[t]) * (SCALE * v[t] // (1000 * v[t] + 12 * m))
                    for t in terms((text or "").encode()) if t in v)
            if s > 0:
                scores.append((-s, doc_id is None, doc_id, s))
        scores.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item_id, i + 1, d, s) for i, (_, _, d, s) in enumerate(scores[:top])]
    return out
