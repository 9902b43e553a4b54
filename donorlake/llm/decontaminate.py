"""Benchmark decontamination as a prefix-filtered set join.

An item window is the set of its word shingles and must be contained in a
document whole, so its *necessary prefix* is a single shingle: the rarest
one over all documents. A document joins a window only where that shingle
occurs (prefix filter), only where the whole window fits around it
(positional and length bounds), and each candidate is then verified word by
word. ``containment`` is the best share of an item's windows found inside
one stretch of the document as long as the item.

The benchmark side is a query set. It is cut into blocks of at most
``BLOCK_WORDS`` words by a hash of the item; each block is one broadcast, so
a task holds one block at a time whatever the size of the benchmark.

Defined results: a null text has no words; an item without words or with a
null id matches nothing; repeated rows are answered row by row; an empty
benchmark leaves every document clean; other columns of either table are
ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from donorlake.llm.util import prepare, sliced, texts_of

WINDOW = 10
SHINGLE = 3
BLOCK_WORDS = 500_000

#: Every byte outside the word class becomes a space, A-Z becomes a-z.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)


def words(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


@dataclass
class Block:
    """The windows of one block of items over a vocabulary of item words."""

    vocab: dict[bytes, int]
    items: list  # item ids
    item_words: list[int]  # words of each item
    windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]
    # length -> (word ids [n, length], index into items, offset in the item)


def build_block(rows: list[tuple], window: int = WINDOW) -> Block:
    vocab: dict[bytes, int] = {}
    items, sizes = [], []
    found = defaultdict(lambda: ([], [], []))
    for item_id, text in rows:
        ws = words((text or "").encode())
        if not ws or item_id is None:
            continue
        ids = [vocab.setdefault(w, len(vocab)) for w in ws]
        items.append(item_id)
        sizes.append(len(ids))
        length = min(window, len(ids))
        a, b, c = found[length]
        for k in range(len(ids) - length + 1):
            a.append(ids[k : k + length])
            b.append(len(items) - 1)
            c.append(k)
    return Block(vocab, items, sizes, {
        n: (np.array(a, np.int64), np.array(b), np.array(c)) for n, (a, b, c) in found.items()
    })


def shingle_codes(ids: np.ndarray, size: int, base: int) -> np.ndarray:
    """Code of the shingle at each position, -1 where a word is unknown."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.empty(0, np.int64)
    code, known = np.zeros(n, np.int64), np.ones(n, bool)
    for k in range(size):
        part = ids[k : k + n]
        known &= part >= 0
        code = code * base + part
    code[~known] = -1
    return code


def window_codes(block: Block, length: int) -> np.ndarray:
    """Shingle codes of each window: [windows, shingles]."""
    size, base = min(SHINGLE, length), len(block.vocab) + 1
    ids = block.windows[length][0]
    return np.stack([
        sum(ids[:, k + j] * base ** (size - 1 - j) for j in range(size))
        for k in range(length - size + 1)
    ], axis=1)


def batch_ids(block: Block, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word ids of all texts, -1 for words no item has and once after each
    text; where each text begins."""
    get, parts, starts, at = block.vocab.get, [], [], 0
    for t in texts:
        ws = words(t)
        starts.append(at)
        at += len(ws) + 1
        parts.append(np.fromiter(map(get, ws, repeat(-1)), np.int32, len(ws)))
        parts.append(np.array([-1], np.int32))
    ids = np.concatenate(parts).astype(np.int64) if parts else np.empty(0, np.int64)
    return ids, np.array([*starts, at])


def count_shingles(block: Block, ids: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Occurrences in ``ids`` of the shingles that windows of each length have."""
    out = {}
    for length in block.windows:
        size = min(SHINGLE, length)
        if size in out:
            continue
        code = shingle_codes(ids, size, len(block.vocab) + 1)
        own = np.unique(np.concatenate([
            window_codes(block, n).ravel() for n in block.windows if min(SHINGLE, n) == size
        ]))
        code = code[code >= 0]
        at = np.minimum(np.searchsorted(own, code), len(own) - 1)
        hit = own[at] == code
        out[size] = own, np.bincount(at[hit], minlength=len(own))
    return out


@dataclass
class Prefixes:
    """Rarest shingle of each window of one length, sorted by code."""

    codes: np.ndarray  # sorted prefix codes, one for each window
    window: np.ndarray  # window index
    offset: np.ndarray  # where the prefix shingle stands in the window


def choose_prefixes(block: Block, rarity: dict[int, tuple[np.ndarray, np.ndarray]]) -> dict[int, Prefixes]:
    out = {}
    for length in block.windows:
        codes = window_codes(block, length)
        own, n = rarity[min(SHINGLE, length)]
        order = n[np.searchsorted(own, codes)]
        # the global order is (count, code); ties inside a window by offset
        best = np.lexsort((codes.ravel(), order.ravel())).argsort().reshape(codes.shape).argmin(1)
        code = codes[np.arange(len(codes)), best]
        sort = np.argsort(code, kind="stable")
        out[length] = Prefixes(code[sort], sort, best[sort])
    return out


def matches(block: Block, prefixes: dict[int, Prefixes], ids: np.ndarray) -> Iterator[tuple]:
    """(length, start in ``ids``, window index) of every verified occurrence."""
    for length, (win, _, _) in block.windows.items():
        p = prefixes[length]
        code = shingle_codes(ids, min(SHINGLE, length), len(block.vocab) + 1)
        pos = np.flatnonzero(code >= 0)
        lo = np.searchsorted(p.codes, code[pos], "left")
        hi = np.searchsorted(p.codes, code[pos], "right")
        keep = hi > lo
        pos, lo, n = pos[keep], lo[keep], (hi - lo)[keep]
        which = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        start = np.repeat(pos, n) - p.offset[which]
        fits = (start >= 0) & (start + length <= len(ids))
        start, w = start[fits], p.window[which[fits]]
        good = np.ones(len(start), bool)
        for k in range(length):
            good[good] = ids[start[good] + k] == win[w[good], k]
        yield length, start[good], w[good]


def best_containment(starts: list[int], offsets: list[int], n_windows: int, span: int) -> float:
    """Largest share of an item's windows that begin within ``span``
    consecutive positions of a document."""
    order = sorted(zip(starts, offsets))
    best, first, inside = 0, 0, defaultdict(int)
    for at, off in order:
        inside[off] += 1
        while order[first][0] <= at - span:
            gone = order[first][1]
            inside[gone] -= 1
            if not inside[gone]:
                del inside[gone]
            first += 1
        best = max(best, len(inside))
    return best / n_windows


def _counter(block):
    def run(batches):
        total: dict[int, tuple] = {}
        for batch in sliced(batches):
            ids, _ = batch_ids(block.value, texts_of(batch))
            for size, (own, n) in count_shingles(block.value, ids).items():
                total[size] = (own, n + total[size][1]) if size in total else (own, n)
        for size, (own, n) in total.items():
            hit = n > 0
            yield pa.RecordBatch.from_pydict({
                "size": pa.array(np.full(hit.sum(), size), pa.int32()),
                "code": pa.array(own[hit], pa.int64()), "n": pa.array(n[hit], pa.int64())})
    return run


def _matcher(blocks, passthrough: list[str]):
    def run(batches):
        for batch in sliced(batches):
            texts = texts_of(batch)
            n_docs = len(texts)
            hit = n_words = starts = None
            per_item: list[dict] = [defaultdict(lambda: ([], [])) for _ in range(n_docs)]
            facts: dict = {}
            for shared in blocks:
                block, prefixes = shared.value
                ids, starts = batch_ids(block, texts)
                n_words = np.diff(starts) - 1
                if hit is None:
                    hit = np.zeros(len(ids) + 1, np.int64)
                for length, start, w in matches(block, prefixes, ids):
                    np.add.at(hit, start, 1)
                    np.add.at(hit, start + length, -1)
                    _, item, offset = block.windows[length]
                    doc = np.searchsorted(starts, start, "right") - 1
                    for d, s, i, o in zip(doc.tolist(), start.tolist(), item[w].tolist(), offset[w].tolist()):
                        key = block.items[i]
                        size = block.item_words[i]
                        facts[key] = max(facts.get(key, (0, 0)), (size - length + 1, size - length + 1))
                        a, b = per_item[d][key]
                        a.append(s)
                        b.append(o)
            if hit is None:  # no item at all
                n_words = np.array([len(words(t)) for t in texts], np.int64)
                starts = np.concatenate([[0], np.cumsum(n_words + 1)])
                hit = np.zeros(starts[-1] + 1, np.int64)
            covered = np.cumsum(hit) > 0
            total = np.concatenate([[0], np.cumsum(covered)])
            n_hit = total[starts[1:]] - total[starts[:-1]]
            lists = [sorted(map(str, x)) for x in per_item]
            found = [max((best_containment(*x[k], *facts[k]) for k in x), default=0.0) for x in per_item]
            cols = {c: batch.column(c) for c in passthrough}
            yield pa.RecordBatch.from_arrays([
                *cols.values(),
                pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                pa.array([len(x) for x in lists], pa.int64()),
                pa.array(lists, pa.list_(pa.string())),
                pa.array(found, pa.float64()), pa.array(n_hit > 0)],
                [*cols, "n_words", "n_hit", "n_items", "items", "containment", "contaminated"])
    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  block_words: int = BLOCK_WORDS, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Every row of ``docs`` (columns ``keep``) with the benchmark words it
    holds: n_words, n_hit, n_items, items (ids as sorted strings),
    containment, contaminated."""
    spark = prepare(docs.sparkSession)
    items = benchmark.select("item_id", "text").filter("item_id IS NOT NULL AND text IS NOT NULL")
    n_words = items.select(F.sum(F.size(F.split("text", r"\s+"))).alias("n")).first()["n"] or 0
    n_blocks = -(-n_words // block_words)
    blocks = []
    for k in range(n_blocks):
        part = items.filter(F.pmod(F.xxhash64(F.col("item_id").cast("string")), F.lit(n_blocks)) == k)
        block = build_block([tuple(r) for r in part.collect()], window)
        if not block.items:
            continue
        rarity = {}
        for length in block.windows:
            size = min(SHINGLE, length)
            rarity.setdefault(size, []).append(window_codes(block, length).ravel())
        rarity = {s: np.unique(np.concatenate(x)) for s, x in rarity.items()}
        counts = {s: np.zeros(len(own), np.int64) for s, own in rarity.items()}
        seen = (docs.select("text").mapInArrow(_counter(spark.sparkContext.broadcast(block)),
                                               "size int, code long, n long")
                .groupBy("size", "code").agg(F.sum("n").alias("n")))
        for r in seen.collect():  # at most one row for each shingle of the block
            counts[r["size"]][np.searchsorted(rarity[r["size"]], r["code"])] = r["n"]
        prefixes = choose_prefixes(block, {s: (rarity[s], counts[s]) for s in rarity})
        blocks.append(spark.sparkContext.broadcast((block, prefixes)))
    kept = docs.select(*dict.fromkeys([*keep, "text"]))
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name in keep)
    return kept.mapInArrow(
        _matcher(blocks, list(keep)),
        f"{out}, n_words long, n_hit long, n_items long, items array<string>, "
        "containment double, contaminated boolean")


def digest(result: DataFrame) -> DataFrame:
    """The checked columns of ``decontaminate``'s result."""
    return result.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def brute_force(docs: list[tuple], items: list[tuple], window: int = WINDOW) -> list[tuple]:
    """Reference answer for tests: every window at every position."""
    out = []
    for doc_id, text in docs:
        ws = words((text or "").encode())
        hit, found = set(), set()
        for item_id, item in items:
            iw = words((item or "").encode())
            if not iw or item_id is None:
                continue
            n = min(window, len(iw))
            for k in range(len(iw) - n + 1):
                for p in range(len(ws) - n + 1):
                    if ws[p : p + n] == iw[k : k + n]:
                        hit.update(range(p, p + n))
                        found.add(str(item_id))
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(ws), len(hit), len(found), sha, bool(hit)))
    return out
