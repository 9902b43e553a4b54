"""Substring dedup by relative Lempel-Ziv parsing over words.

``fragments`` brings together what may repeat. Each block is an indexed
reference: its fragments are factored greedily, in order of doc_id, against
everything that smaller doc_ids put into the reference. A factor of at least
``WINDOW`` words is a duplicate span. Where a factor ends, the windows across
its end are looked up one by one, since a greedy factor may hide a copy that
begins inside it and goes on in another reference.

Defined results: null and empty texts have no words; rows with equal doc_id
are no copies of each other; a null doc_id comes after all others and two
such rows are no copies of each other; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from donorlake.llm.fragments import Spec, covered_symbols, find_runs, unpack
from donorlake.llm.util import Interner

WINDOW = 13
_INTERNED = Interner()


def word_symbols(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    docs = [t.split() for t in texts]
    starts = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
    sym = np.concatenate([np.empty(0, np.uint64), *(_INTERNED.ids(d) for d in docs)])
    return sym, starts


SPEC = Spec("rlz", WINDOW, 4, True, word_symbols, 4 << 20)


class Reference:
    """Indexed reference of one anchor: where each window first stands."""

    def __init__(self, width: int = WINDOW, item: int = 8):
        self.text, self.at, self.width, self.item = bytearray(), {}, width, item

    def window(self, seq: bytes, i: int) -> bytes:
        return seq[i * self.item : (i + self.width) * self.item]

    def add(self, seq: bytes) -> None:
        base = len(self.text) // self.item
        n = len(seq) // self.item
        for i in range(n - self.width + 1):
            self.at.setdefault(self.window(seq, i), base + i)
        self.text += seq + b"\0" * self.item  # no factor runs past a fragment

    def factor(self, seq: bytes, i: int) -> int:
        """Words of the longest extension of the window at ``i`` where it
        stands in the reference; 0 if it does not."""
        q = self.at.get(self.window(seq, i))
        if q is None:
            return 0
        n, k, size = len(seq) // self.item, self.width, self.item
        while i + k < n and seq[(i + k) * size : (i + k + 1) * size] == \
                self.text[(q + k) * size : (q + k + 1) * size] and (q + k + 1) * size <= len(self.text):
            k += 1
        return k

    def parse(self, seq: bytes) -> list[int]:
        """First words of the windows of ``seq`` that the reference holds."""
        out, i, last = [], 0, len(seq) // self.item - self.width
        while i <= last:
            k = self.factor(seq, i)
            if not k:
                i += 1
                continue
            end = i + k - self.width + 1
            out.extend(range(i, end))
            i = end  # windows across the factor's end are looked up next
        return out


def as_runs(windows: list[int]) -> tuple[np.ndarray, np.ndarray]:
    w = np.array(windows, np.int64)
    cut = np.flatnonzero(np.append(True, np.diff(w) != 1))
    return w[cut], np.diff(np.append(cut, len(w)))


def decide(pdf):
    """Factor the fragments of each anchor in order of doc_id; fragments of
    the same document do not see each other."""
    anchors, orders, seqs = pdf["anchor"].to_numpy(), pdf["order"].to_numpy(), pdf["symbols"].tolist()
    by = np.lexsort((orders, anchors))
    reference, anchor, order, pending = None, None, None, []
    for i in by.tolist():
        if anchors[i] != anchor:
            reference, anchor, order, pending = Reference(), anchors[i], orders[i], []
        elif orders[i] != order:
            for s in pending:
                reference.add(s)
            order, pending = orders[i], []
        windows = reference.parse(seqs[i])
        pending.append(seqs[i])
        if windows:
            yield (i, *as_runs(windows))


def _cut(batches):
    for b in unpack(batches):
        docs = [t.split() for t in b.texts]
        n = [len(d) for d in docs]
        gone = covered_symbols(b.extra["runs"], sum(n), WINDOW)
        spans, kept, at = [], [], 0
        for d in docs:
            mask = gone[at : at + len(d)]
            at += len(d)
            edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
            spans.append([{"begin": int(x), "end": int(y)} for x, y in edge.reshape(-1, 2)])
            kept.append(b" ".join(w for w, g in zip(d, mask.tolist()) if not g))
        yield pa.RecordBatch.from_pydict({
            "doc_id": pa.array(b.ids, pa.int64()), "n_words": pa.array(n, pa.int64()),
            "spans": pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
            "kept": pa.array([k.decode() for k in kept], pa.string())})


def substring_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, spans (removed words: begin, end exclusive) and kept
    (the other words joined by one space) of every row."""
    batches, runs = find_runs(docs, SPEC, decide)
    return batches.join(runs, "g", "left").mapInArrow(
        _cut, "doc_id long, n_words long, spans array<struct<begin:bigint,end:bigint>>, kept string")


def digest(result: DataFrame) -> DataFrame:
    return result.selectExpr(
        "doc_id", "n_words", "aggregate(spans, 0L, (a, s) -> a + s.end - s.begin) AS n_removed",
        "sha2(kept, 256) AS kept_sha256")


def brute_force(rows: list[tuple]) -> list[tuple]:
    first: dict[tuple, int] = {}
    docs = [(i, (t or "").encode().split()) for i, t in rows]
    key = lambda i: float("inf") if i is None else i
    for i, w in docs:
        for p in range(len(w) - WINDOW + 1):
            x = tuple(w[p : p + WINDOW])
            first[x] = min(first.get(x, key(i)), key(i))
    out = []
    for i, w in docs:
        gone = set()
        for p in range(len(w) - WINDOW + 1):
            if first[tuple(w[p : p + WINDOW])] < key(i):
                gone.update(range(p, p + WINDOW))
        kept = b" ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out
