"""Suffix-array dedup over bytes by threshold-bounded interval expansion.

``fragments`` brings together what may repeat. Each block joins its
fragments into one text, orders its suffixes as deep as the threshold needs,
takes the Burrows-Wheeler transform and extends intervals backwards, breadth
first: an interval of the string w (length l) is split by the preceding
symbol c into the intervals of cw, and a boundary reached for the first time
at level l has a longest common prefix of l. Common prefixes thus come out by
increasing value, and the expansion stops at ``LENGTH``: boundaries not
reached by then separate suffixes that agree on ``LENGTH`` bytes or more.

Defined results: null and empty texts have no bytes; any second start counts,
in the same row, in a row with the same doc_id or elsewhere; removal may cut
a UTF-8 character, so what is kept is bytes; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from donorlake.llm.fragments import Spec, covered_symbols, find_runs, unpack

LENGTH = 400
#: Symbols of one transform; an anchor's fragments are never parted.
JOINED = 1 << 20


def byte_symbols(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    return np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64), starts


SPEC = Spec("suffix", LENGTH, 48, False, byte_symbols, 2 << 20)


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``text`` (symbols 0..256) in the order of their first
    ``depth`` symbols, by doubling over the groups not yet apart."""
    n, step = len(text), 7
    padded = np.concatenate([text.astype(np.int64), np.zeros(step, np.int64)])
    key = np.zeros(n, np.int64)
    for j in range(step):
        key = (key << 9) | padded[j : j + n]
    order = np.argsort(key)
    value = key[order]
    rank = np.empty(n + 1, np.int64)  # first slot of a suffix's group, plus 1
    rank[n] = 0
    slots = np.arange(n)
    while True:
        new = np.ones(len(slots), bool)
        new[1:] = (value[1:] != value[:-1]) if len(slots) else new[1:]
        first = slots[np.flatnonzero(new)]
        size = np.diff(np.append(np.flatnonzero(new), len(slots)))
        rank[order[slots]] = np.repeat(first, size) + 1
        if step >= depth:
            return order
        slots = slots[np.repeat(size > 1, size)]  # a group's slots stay together
        if not len(slots):
            return order
        suffix = order[slots]
        value = rank[suffix] * (n + 2) + rank[np.minimum(suffix + step, n)]
        by = np.argsort(value)
        order[slots] = suffix[by]
        value = value[by]
        step *= 2


def expand_intervals(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Boundaries between neighbours of ``order`` whose common prefix is
    shorter than ``depth`` (True at the right neighbour; 0 and n are True).
    Symbol 0 separates texts; strings are not extended across it."""
    n = len(text)
    bwt = text[order - 1]
    by_symbol = np.argsort(bwt.astype(np.uint16), kind="stable")
    lf = np.empty(n, np.int64)  # slot of the suffix that begins one symbol earlier
    lf[by_symbol] = np.arange(n)
    same = bwt[by_symbol][1:] == bwt[by_symbol][:-1]
    after, before = np.full(n, n), np.full(n, -1)  # next and last slot with the same symbol
    after[by_symbol[:-1][same]] = by_symbol[1:][same]
    before[by_symbol[1:][same]] = by_symbol[:-1][same]
    apart = np.zeros(n + 1, bool)
    apart[0] = apart[n] = True
    low, high = np.array([0]), np.array([n])
    for level in range(depth):
        size = high - low
        slot = np.arange(size.sum()) + np.repeat(low - (np.cumsum(size) - size), size)
        keep = bwt[slot] != 0 if level else np.ones(len(slot), bool)
        first = keep & (before[slot] < np.repeat(low, size))
        last = keep & (after[slot] >= np.repeat(high, size))
        # intervals of strings of one length are disjoint: sorted ends pair up
        low, high = np.sort(lf[slot[first]]), np.sort(lf[slot[last]]) + 1
        fresh = ~apart[high]
        if not level:  # the last symbol's interval ends at n, which is known
            fresh |= high == n
        low, high = low[fresh], high[fresh]
        apart[high] = True
        if not len(low):
            break
    return apart


def repeated_starts(parts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each part, where a string of ``length`` bytes begins that begins
    at least twice in all of them."""
    sizes = np.array([len(p) + 1 for p in parts])
    text = np.zeros(sizes.sum(), np.int16)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    for p, b in zip(parts, begin.tolist()):
        text[b : b + len(p)] = np.frombuffer(p, np.uint8).astype(np.int16) + 1
    order = suffix_order(text, length + 1)
    group = np.cumsum(expand_intervals(text, order, length)[:-1])
    many = np.bincount(group)[group] > 1
    twice = np.zeros(len(text), bool)
    twice[order[many]] = True
    return [np.flatnonzero(twice[b : b + max(0, len(p) - length + 1)]) for p, b in zip(parts, begin.tolist())]


def decide(pdf):
    """Runs of repeated windows of a block's fragments. Rows without symbols
    are single windows of hot anchors, told apart by their hash."""
    anchors, symbols = pdf["anchor"].to_numpy(), pdf["symbols"].tolist()
    by = np.argsort(anchors, kind="stable").tolist()
    chunk: list[int] = []
    held, i = 0, 0
    while i < len(by):
        j = i
        while j < len(by) and anchors[by[j]] == anchors[by[i]]:
            j += 1
        rows = by[i:j]
        i = j
        full = [r for r in rows if symbols[r]]
        if len(rows) - len(full) > 1:
            yield from ((r, np.array([0]), np.array([1])) for r in rows if not symbols[r])
        chunk += full
        held += sum(len(symbols[r]) for r in full)
        if held >= JOINED:
            yield from _runs_of(chunk, symbols)
            chunk, held = [], 0
    if chunk:
        yield from _runs_of(chunk, symbols)


def _runs_of(rows, symbols):
    for r, at in zip(rows, repeated_starts([symbols[r] for r in rows])):
        if len(at):
            cut = np.flatnonzero(np.append(True, np.diff(at) != 1))
            yield r, at[cut], np.diff(np.append(cut, len(at)))


def _cut(batches):
    for b in unpack(batches):
        n = [len(t) for t in b.texts]
        gone = covered_symbols(b.extra["runs"], sum(n), LENGTH)
        spans, kept, at = [], [], 0
        for t in b.texts:
            mask = gone[at : at + len(t)]
            at += len(t)
            edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))).reshape(-1, 2)
            spans.append([{"begin": int(x), "end": int(y)} for x, y in edge])
            kept.append(np.frombuffer(t, np.uint8)[~mask].tobytes())
        yield pa.RecordBatch.from_pydict({
            "doc_id": pa.array(b.ids, pa.int64()), "n_bytes": pa.array(n, pa.int64()),
            "spans": pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
            "kept": pa.array(kept, pa.binary())})


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, spans (maximal removed byte runs: begin, end
    exclusive) and kept (the other bytes) of every row."""
    batches, runs = find_runs(docs, SPEC, decide)
    return batches.join(runs, "g", "left").mapInArrow(
        _cut, "doc_id long, n_bytes long, spans array<struct<begin:bigint,end:bigint>>, kept binary")


def digest(result: DataFrame) -> DataFrame:
    return result.selectExpr(
        "doc_id", "n_bytes", "aggregate(spans, 0L, (a, s) -> a + s.end - s.begin) AS n_removed",
        "cast(size(spans) AS long) AS n_spans", "sha2(kept, 256) AS kept_sha256")


def brute_force(rows: list[tuple], length: int = LENGTH) -> list[tuple]:
    from collections import Counter

    docs = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(hash(t[p : p + length]) for _, t in docs for p in range(len(t) - length + 1))
    out = []
    for i, t in docs:
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - length + 1):
            if seen[hash(t[p : p + length])] > 1:
                gone[p : p + length] = True
        edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out.append((i, len(t), int(gone.sum()), int((edge == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out
