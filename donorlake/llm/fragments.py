"""Shared fragments: finds the stretches of documents whose windows of
``width`` symbols may also start elsewhere, and brings equal ones together.

Every window of ``width`` symbols is owned by one *anchor*, the least-hashed
``k``-symbol shingle inside it (leftmost on ties), so equal windows have
equal anchors. Consecutive windows with the same anchor make a *fragment*.

1. ``stage``: documents become compressed batches in the shared folder.
2. ``census``: each batch sends the distinct hashes of its fragments and
   anchors (one entry a batch and hash, however often it occurs there) to
   buckets, which answer which fragments lie in several batches, and which
   anchors have several different fragments or more than ``HOT`` of them.
3. ``resolve``: a fragment that occurs again whole is settled by that. Where
   an anchor has different fragments, one copy of each goes to the anchor's
   block with its symbols, and the operator decides there window by window.
   Fragments of a hot anchor are dealt out as single windows instead, so no
   block depends on how many documents share a passage.
4. ``spans_by_batch`` brings all runs back to the batches, where texts are cut.

Order: a window counts as a copy of one with a smaller order key. ``doc_id``
is the key for first-occurrence semantics; for any-other-occurrence
semantics the batch number stands in and a second occurrence suffices.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from donorlake.llm.util import materialise, mix64, prepare, sliced, texts_of

#: Different fragments of one anchor that a block takes before the anchor is
#: dealt out window by window.
HOT = 4000
#: Order key of rows without a doc_id: after all others.
LAST = np.iinfo(np.int64).max

_P = 0x9E3779B97F4A7C15 | 1
_PINV = pow(_P, -1, 1 << 64)
_GOLD = np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class Spec:
    """How an operator reads documents. ``symbols`` turns the texts of a
    batch into one array of 64-bit symbols and the start of each text."""

    name: str
    width: int
    k: int
    by_doc: bool
    symbols: Callable
    batch_bytes: int


# ---------------------------------------------------------------- hashing

def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n + 1, np.uint64(base & (2**64 - 1)))
    out[0] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)


class Hasher:
    """Polynomial hashes mod 2^64 of stretches of one symbol array."""

    def __init__(self, sym: np.ndarray):
        n = len(sym)
        self.inv = _powers(n, _PINV)
        self.sums = np.empty(n + 1, np.uint64)
        self.sums[0] = 0
        np.cumsum(mix64(sym + _GOLD) * _powers(n, _P)[:n], out=self.sums[1:])

    def of(self, begin: np.ndarray, length) -> np.ndarray:
        raw = (self.sums[begin + length] - self.sums[begin]) * self.inv[begin]
        return mix64(raw + np.atleast_1d(length).astype(np.uint64) * _GOLD)

    def every(self, k: int) -> np.ndarray:
        raw = (self.sums[k:] - self.sums[:-k]) * self.inv[: len(self.sums) - k]
        return mix64(raw + np.array([k], np.uint64) * _GOLD)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    size, m = 1, x
    while size * 2 <= w:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    return np.minimum(m[: len(x) - w + 1], m[w - size :]) if size < w else m


@dataclass
class Fragments:
    doc: np.ndarray  # index of the document in its batch
    begin: np.ndarray  # first window, position in the batch's symbols
    windows: np.ndarray  # number of windows
    anchor: np.ndarray  # hash of the anchor
    hash: np.ndarray  # hash of all symbols of the fragment


def fragments(sym: np.ndarray, starts: np.ndarray, width: int, k: int) -> tuple[Fragments, Hasher | None]:
    n = len(sym)
    empty = np.empty(0, np.int64)
    if n < width:
        return Fragments(empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)), None
    h = Hasher(sym)
    bits = np.uint64(max(n, 2).bit_length())
    shingle = h.every(k)
    key = (shingle >> bits << bits) | np.arange(len(shingle), dtype=np.uint64)
    low = sliding_min(key, width - k + 1) & ((np.uint64(1) << bits) - np.uint64(1))
    lens = np.diff(starts)
    doc = np.repeat(np.arange(len(lens)), lens)
    p = np.flatnonzero(doc[: n - width + 1] == doc[width - 1 :])  # windows inside one document
    if not len(p):
        return Fragments(empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)), h
    at, d = low[p].astype(np.int64), doc[p]
    first = np.ones(len(p), bool)
    first[1:] = (at[1:] != at[:-1]) | (d[1:] != d[:-1])
    f = np.flatnonzero(first)
    count = np.diff(np.append(f, len(p)))
    begin = p[f]
    return Fragments(d[f], begin, count, shingle[at[f]], h.of(begin, count + width - 1)), h


# ---------------------------------------------------------------- batches

def _pack(batch_bytes):
    def run(batches):
        import zstandard

        z = zstandard.ZstdCompressor(level=1)
        part, k = TaskContext.get().partitionId(), 0
        for batch in sliced(batches, limit=batch_bytes):
            texts = texts_of(batch)
            g = (part << 32) + k
            k += 1
            yield pa.RecordBatch.from_pydict({
                "g": pa.array([g], pa.int64()),
                "ids": pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                "sizes": pa.array([[len(t) for t in texts]], pa.list_(pa.int32())),
                "z": pa.array([z.compress(b"".join(texts))], pa.binary())})
    return run


def stage(docs: DataFrame, spec: Spec) -> DataFrame:
    """Batches of documents in the shared folder: g, ids, sizes, z."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return materialise(
        rows.mapInArrow(_pack(spec.batch_bytes), "g long, ids array<long>, sizes array<int>, z binary"),
        f"{spec.name}-batches")


@dataclass
class Batch:
    g: int
    ids: list
    texts: list[bytes]
    extra: dict


def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[Batch]:
    import zstandard

    z = zstandard.ZstdDecompressor()
    for rows in batches:
        for i in range(rows.num_rows):
            row = {n: rows.column(n)[i] for n in rows.schema.names}
            sizes = row.pop("sizes").as_py()
            raw = z.decompress(row.pop("z").as_py(), max_output_size=sum(sizes) or 1)
            cuts = np.concatenate([[0], np.cumsum(sizes)]).tolist()
            yield Batch(row.pop("g").as_py(), row.pop("ids").as_py(),
                        [raw[a:b] for a, b in zip(cuts, cuts[1:])], row)


def _read(batch: Batch, spec: Spec):
    sym, starts = spec.symbols(batch.texts)
    frag, hasher = fragments(sym, starts, spec.width, spec.k)
    if spec.by_doc:
        order = np.array([LAST if x is None else x for x in batch.ids], np.int64)
    else:
        order = np.full(len(batch.ids), batch.g, np.int64)
    return sym, starts, frag, hasher, order


# ---------------------------------------------------------------- census

_ENTRY_R = np.dtype([("hash", "<u8"), ("order", "<i8")])
_ENTRY_H = np.dtype([("anchor", "<u8"), ("some", "<u4"), ("n", "<u4")])
#: ``some`` of an anchor with several different fragments in the batch.
_SEVERAL = 0xFFFFFFFF


def first_orders(frag: Fragments, order: np.ndarray):
    """Distinct fragment hashes of a batch with the least order key of each,
    how often each occurs, and the index of each fragment among them."""
    uniq, index, n = np.unique(frag.hash, return_inverse=True, return_counts=True)
    least = np.full(len(uniq), LAST, np.int64)
    np.minimum.at(least, index, order[frag.doc])
    return uniq, least, n, index


def anchor_entries(frag: Fragments) -> np.ndarray:
    """One entry for each anchor of a batch."""
    pairs = np.unique(np.stack([frag.anchor, frag.hash], axis=1), axis=0) if len(frag.hash) else \
        np.empty((0, 2), np.uint64)
    uniq, at, n = np.unique(pairs[:, 0], return_index=True, return_counts=True)
    out = np.empty(len(uniq), _ENTRY_H)
    out["anchor"], out["n"] = uniq, n
    some = (pairs[at, 1] >> np.uint64(32)).astype(np.uint32)
    some[some == _SEVERAL] = 0
    some[n > 1] = _SEVERAL
    out["some"] = some
    return out


def _buckets(values: np.ndarray, n: int) -> np.ndarray:
    return ((values >> np.uint64(40)) % np.uint64(n)).astype(np.int64)


def _census_map(spec: Spec, n_buckets: int):
    def run(batches):
        for b in unpack(batches):
            _, _, frag, _, order = _read(b, spec)
            uniq, least, _, _ = first_orders(frag, order)
            r = np.empty(len(uniq), _ENTRY_R)
            r["hash"], r["order"] = uniq, least
            out = []
            for kind, entries, key in ((0, r, uniq), (1, (a := anchor_entries(frag)), a["anchor"])):
                bucket = _buckets(key, n_buckets)
                by = np.argsort(bucket, kind="stable")
                cut = np.searchsorted(bucket[by], np.arange(n_buckets + 1))
                out += [(kind * n_buckets + i, entries[by[cut[i] : cut[i + 1]]].tobytes())
                        for i in range(n_buckets) if cut[i + 1] > cut[i]]
            yield pa.RecordBatch.from_pydict({
                "bucket": pa.array([i for i, _ in out], pa.int32()),
                "g": pa.array([b.g] * len(out), pa.int64()),
                "entries": pa.array([x for _, x in out], pa.binary())})
    return run


def _census_reduce(n_buckets: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        kind = int(pdf["bucket"].iloc[0]) // n_buckets
        dtype = _ENTRY_H if kind else _ENTRY_R
        parts = [np.frombuffer(x, dtype) for x in pdf["entries"]]
        owner = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
        e = np.concatenate(parts)
        key = e["anchor"] if kind else e["hash"]
        uniq, index, n = np.unique(key, return_inverse=True, return_counts=True)
        if kind:
            low = np.full(len(uniq), _SEVERAL, np.uint32)
            high = np.zeros(len(uniq), np.uint32)
            np.minimum.at(low, index, e["some"])
            np.maximum.at(high, index, e["some"])
            total = np.zeros(len(uniq), np.int64)
            np.add.at(total, index, e["n"].astype(np.int64))
            tell = (n > 1) & ((low != high) | (high == _SEVERAL))
            value = total
        else:
            value = np.full(len(uniq), LAST, np.int64)
            np.minimum.at(value, index, e["order"])
            tell = n > 1
        rows = np.flatnonzero(tell[index])
        out = np.empty(len(rows), _ENTRY_R)
        out["hash"], out["order"] = key[rows], value[index[rows]]
        cut = np.searchsorted(owner[rows], np.arange(len(parts) + 1))
        answer = [out[a:b].tobytes() for a, b in zip(cut, cut[1:])]
        pdf = pd.DataFrame({"g": pdf["g"].to_numpy(), "kind": kind, "entries": answer})
        return pdf[pdf["entries"].str.len() > 0]
    return run


def census(batches: DataFrame, spec: Spec) -> DataFrame:
    """For each batch: ``shared`` (fragments that other batches also hold,
    with the least order key) and ``several`` (anchors with different
    fragments elsewhere, with their number)."""
    n = int(batches.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = batches.mapInArrow(_census_map(spec, n), "bucket int, g long, entries binary")
    told = sent.groupBy("bucket").applyInPandas(_census_reduce(n), "g long, kind int, entries binary")
    pick = lambda k: F.collect_list(F.when(F.col("kind") == k, F.col("entries")))
    return told.groupBy("g").agg(pick(0).alias("shared"), pick(1).alias("several"))


# ---------------------------------------------------------------- resolving

def _table(blobs) -> tuple[np.ndarray, np.ndarray]:
    blobs = (blobs.as_py() if hasattr(blobs, "as_py") else blobs) or []
    e = np.concatenate([np.frombuffer(x, _ENTRY_R) for x in blobs] or [np.empty(0, _ENTRY_R)])
    e = e[np.argsort(e["hash"])]
    return e["hash"], e["order"]


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), default, np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], default)


def _runs(begin: np.ndarray, length: np.ndarray) -> bytes:
    return np.stack([begin, length], axis=1).astype("<i8").tobytes()


_RESOLVED = "g long, kind int, block long, packed binary"
_LEVEL = 1


def pack_rows(rows: list[tuple]) -> bytes:
    """Fragments (anchor, order, symbols, places) of one batch and block."""
    import zstandard

    numbers = np.array([(r[0], r[1], len(r[2]), len(r[3])) for r in rows], "<i8").reshape(-1, 4)
    return zstandard.compress(b"".join([
        np.int64(len(rows)).tobytes(), numbers.T.tobytes(), *(r[2] for r in rows), *(r[3] for r in rows)]), _LEVEL)


def unpack_rows(packed: bytes) -> tuple[np.ndarray, np.ndarray, list[bytes], list[bytes]]:
    import zstandard

    raw = zstandard.decompress(packed)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    anchor, order, *sizes = np.frombuffer(raw, "<i8", 4 * n, 8).reshape(4, n)
    cut = (8 + 32 * n + np.concatenate([[0], np.cumsum(np.concatenate(sizes))])).tolist()
    parts = [raw[a:b] for a, b in zip(cut, cut[1:])]
    return anchor, order, parts[:n], parts[n:]


def _resolve_map(spec: Spec, n_blocks: int):
    def run(batches):
        for b in unpack(batches):
            sym, _, frag, hasher, order = _read(b, spec)
            if hasher is None or not len(frag.doc):
                continue
            uniq, least, n, index = first_orders(frag, order)
            shared_key, shared_order = _table(b.extra["shared"])
            elsewhere = _lookup(shared_key, shared_order, uniq, -1)  # -1: in no other batch
            here_only = ~np.isin(uniq, shared_key)
            first = np.where(here_only, least, elsewhere)
            mine = order[frag.doc]
            if spec.by_doc:
                done = mine > first[index]
            else:
                done = ((n > 1) | ~here_only)[index]
            # anchors with several fragments, here or in other batches
            local = anchor_entries(frag)
            key, total = _table(b.extra["several"])
            n_frag = _lookup(key, total, frag.anchor, 0)
            at = np.searchsorted(local["anchor"], frag.anchor)
            n_frag = np.maximum(n_frag, np.where(local["some"][at] == _SEVERAL, local["n"][at], 0))
            asked = (n_frag > 0) & (mine == first[index])
            runs = [(frag.begin[done], frag.windows[done])]
            rows = []
            # one copy of each fragment; all places that wait for the answer
            cool = np.flatnonzero(asked & (n_frag <= HOT))
            cool = cool[np.argsort(index[cool], kind="stable")]
            cut = np.flatnonzero(np.append(True, np.diff(index[cool]) != 0)) if len(cool) else []
            for a, z in zip(cut, np.append(cut[1:], len(cool)) if len(cool) else []):
                i = cool[a]
                at, w = int(frag.begin[i]), int(frag.windows[i])
                wait = frag.begin[cool[a:z]]
                if not spec.by_doc and done[i]:
                    wait = wait[:0]
                rows.append((int(frag.anchor[i] % np.uint64(n_blocks)), int(frag.anchor[i].astype(np.int64)),
                             int(mine[i]), spec_bytes(sym[at : at + w + spec.width - 1], spec),
                             wait.astype("<i8").tobytes()))
            hot = np.flatnonzero(asked & (n_frag > HOT))
            if len(hot):
                more, settled = _hot_windows(spec, hasher, frag, hot, done, mine, sym, n_blocks)
                rows += more
                runs.append((settled, np.ones(len(settled), np.int64)))
            begin = np.concatenate([x for x, _ in runs])
            if len(begin):
                yield _rows(b.g, 0, [(0, _runs(begin, np.concatenate([x for _, x in runs])))])
            if rows:
                rows.sort(key=lambda r: r[0])
                yield _rows(b.g, 1, [(block, pack_rows([r[1:] for r in own]))
                                     for block, own in itertools.groupby(rows, lambda r: r[0])])
    return run


def spec_bytes(sym: np.ndarray, spec: Spec) -> bytes:
    """Symbols as they travel: bytes as bytes, others as 64-bit values."""
    return (sym.astype(np.uint8) if spec.name == "suffix" else sym.astype("<u8")).tobytes()


def _rows(g, kind, rows):
    return pa.RecordBatch.from_arrays([
        pa.array([g] * len(rows), pa.int64()), pa.array([kind] * len(rows), pa.int32()),
        pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())],
        [x.split()[0] for x in _RESOLVED.split(", ")])


def _hot_windows(spec, hasher, frag, hot, done, mine, sym, n_blocks):
    """The windows of hot anchors, each different one once: its hash stands
    for its symbols. Also windows that the batch itself settles."""
    w = frag.windows[hot]
    at = np.repeat(frag.begin[hot], w) + np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
    hashes = hasher.of(at, spec.width)
    order = np.repeat(mine[hot], w)
    settled_before = np.repeat(done[hot], w)
    uniq, index, n = np.unique(hashes, return_inverse=True, return_counts=True)
    least = np.full(len(uniq), LAST, np.int64)
    np.minimum.at(least, index, order)
    if spec.by_doc:
        settled = order > least[index]
    else:
        many = np.zeros(len(uniq), np.int64)
        np.add.at(many, index, np.where(settled_before, 2, 1))
        settled = (many > 1)[index]
    wait = ~settled & ~settled_before
    by = np.argsort(index, kind="stable")
    cut = np.concatenate([[0], np.cumsum(n)])
    rows = []
    for u in range(len(uniq)):
        places = by[cut[u] : cut[u + 1]]
        places = at[places[wait[places]]].astype("<i8").tobytes()
        # every window is sent once: others may be copies of it
        rows.append((int(uniq[u] % np.uint64(n_blocks)), int(uniq[u].astype(np.int64)), int(least[u]),
                     b"" if spec.name == "suffix" else
                     sym[at[by[cut[u]]] : at[by[cut[u]]] + spec.width].astype("<u8").tobytes(), places))
    return rows, at[settled & ~settled_before]


def resolve(batches: DataFrame, told: DataFrame, spec: Spec, n_blocks: int) -> DataFrame:
    joined = batches.join(told, "g", "left")
    return materialise(joined.mapInArrow(_resolve_map(spec, n_blocks), _RESOLVED), f"{spec.name}-resolved")


def spread_runs(places: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Runs (offset in a fragment, windows) at all places of the fragment."""
    return np.stack([
        (places[:, None] + begin[None, :]).ravel(),
        np.broadcast_to(length, (len(places), len(length))).ravel()], axis=1)


def _answers(decide):
    """``decide`` takes the fragment rows of a block and yields (row,
    offsets, lengths) for every fragment with runs."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        found: dict[int, list] = {}
        anchor, order, symbols, places = zip(*map(unpack_rows, pdf["packed"]))
        g = np.repeat(pdf["g"].to_numpy(), [len(x) for x in anchor])
        places = list(itertools.chain.from_iterable(places))
        rows = pd.DataFrame({"anchor": np.concatenate(anchor), "order": np.concatenate(order),
                             "symbols": list(itertools.chain.from_iterable(symbols))})
        for i, begin, length in decide(rows):
            at = np.frombuffer(places[i], "<i8")
            if len(at) and len(begin):
                found.setdefault(int(g[i]), []).append(spread_runs(at, begin, length))
        return pd.DataFrame({
            "g": np.array(list(found), np.int64),
            "places": [np.concatenate(x).astype("<i8").tobytes() for x in found.values()]})
    return run


def find_runs(docs: DataFrame, spec: Spec, decide) -> tuple[DataFrame, DataFrame]:
    """(batches, runs): runs of windows that occur before (or elsewhere), as
    blobs of (first window, windows) for each batch."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_blocks = n * 4
    batches = stage(docs, spec)
    found = resolve(batches, census(batches, spec), spec, n_blocks)
    asked = found.filter("kind = 1").select("block", "g", "packed")
    # a fixed number of tasks: bytes do not tell how long a block takes
    answers = asked.repartition(n, "block").groupBy("block").applyInPandas(_answers(decide), "g long, places binary")
    settled = found.filter("kind = 0").select("g", F.col("packed").alias("places"))
    runs = settled.unionByName(answers).groupBy("g").agg(F.collect_list("places").alias("runs"))
    return batches, runs


def covered_symbols(runs, n: int, width: int) -> np.ndarray:
    """Which of a batch's ``n`` symbols lie in a window of the runs."""
    blobs = (runs.as_py() if hasattr(runs, "as_py") else runs) or []
    delta = np.zeros(n + 1, np.int64)
    for blob in blobs:
        r = np.frombuffer(blob, "<i8").reshape(-1, 2)
        np.add.at(delta, r[:, 0], 1)
        np.add.at(delta, r[:, 0] + r[:, 1] + width - 1, -1)
    return np.cumsum(delta)[:n] > 0
