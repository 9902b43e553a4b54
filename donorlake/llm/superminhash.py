"""Near-duplicate detection with SuperMinHash signatures.

Every shingle draws a random permutation of the signature's components; the
rank it gives a component (plus a fraction) competes for that component's
minimum. The ranks of one shingle are correlated (each occurs once), which
lowers the variance against independent hashes, and a document stops at the
first rank that is above all its minima.

Equal shingle sets become one node first, so copies never meet in pairs.
Nodes that agree in a band of the signature share a bucket, and buckets that
share nodes form a family. A family of at most ``BLOCK`` shingles travels to
one task, each set once, where an inverted index counts the common shingles
of a set with all others and a local union-find leaves out what is already
joined: only links that join two groups leave the task. A larger family is
first cut down bucket by bucket: members are verified against the bucket's
leader, on full sets, and what is then in one group is not compared again;
the buckets that still hold different groups become units of their own, dealt
into blocks of ``BLOCK`` shingles that meet two at a time. Either way every
pair of different sets that shares a bucket is compared or already joined (a
pair at the threshold shares a bucket but for 1 in 8 million). Links between
groups are closed by hooking and pointer jumping, the distributed form of
union-find.

Defined results: null or empty text, or text without words, has an empty
set, links with nothing and is kept; rows are linked by text only (a
repeated doc_id does not link); a null doc_id never names a group unless all
its members have none; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from donorlake.llm.fragments import Hasher
from donorlake.llm.util import LOWER, Interner, freeing, materialise, mix64, prepare, sliced, texts_of

BANDS = 40
ROWS = 5
COMPONENTS = BANDS * ROWS
SIMILARITY = 80  # per cent
#: Shingles that a task compares at once (16 MB of hashes).
BLOCK = 1 << 21
#: Shingles whose permutations are held at once (one byte a component).
HELD = 40_000
#: Text bytes whose shingles are held at once.
HELD_BYTES = 1 << 20
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_FAR = np.int64(1 << 62)
_INTERNED = Interner()


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the ``k``-word shingles of each text, A-Z
    lower-cased; of a text with fewer words, its whole sequence as one."""
    docs = [t.translate(LOWER).split() for t in texts]
    sizes = np.array([len(d) for d in docs], np.int64)
    if not sizes.sum():
        return [np.empty(0, np.uint64) for _ in docs]
    h = Hasher(np.concatenate([_INTERNED.ids(d) for d in docs if d]))
    begin = np.concatenate([[0], np.cumsum(sizes)])
    full = h.every(k) if sizes.sum() >= k else np.empty(0, np.uint64)
    out = []
    for b, n in zip(begin.tolist(), sizes.tolist()):
        if n >= k:
            out.append(np.unique(full[b : b + n - k + 1]))
        elif n:
            out.append(h.of(np.array([b]), np.array([n])))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def draws(shingle: np.ndarray, level: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Fraction (32 bits) and swap position of each shingle at one rank."""
    x = mix64(shingle + np.uint64((level + 1) * int(_GOLD) & (2**64 - 1)))
    low = (x & np.uint64(0xFFFFFFFF)).astype(np.int64)
    at = level + ((x >> np.uint64(32)) * np.uint64(m - level) >> np.uint64(32)).astype(np.int64)
    return low, at


def signatures(sets: list[np.ndarray], m: int = COMPONENTS) -> np.ndarray:
    """[documents, m]: least rank and fraction, as rank << 32 | fraction."""
    sig = np.full((len(sets), m), _FAR)
    sizes = np.array([len(s) for s in sets], np.int64)
    begin, group = 0, []
    held = 0
    for i, n in enumerate(sizes.tolist()):
        group.append(i)
        held += n
        if held >= HELD or i == len(sizes) - 1:
            _sign(sig, sets, group, m)
            group, held = [], 0
    return sig


def _sign(sig: np.ndarray, sets: list[np.ndarray], group: list[int], m: int) -> None:
    shingle = np.concatenate([sets[i] for i in group])
    doc = np.repeat(np.array(group), [len(sets[i]) for i in group])
    if not len(shingle):
        return
    flat = sig.reshape(-1)
    low, at = draws(shingle, 0, m)
    np.minimum.at(flat, doc * m + at, low)
    open_ = sig.max(1) >= (1 << 32)
    keep = open_[doc]
    shingle, doc, at = shingle[keep], doc[keep], at[keep]
    # what a swap leaves at the positions above the present rank
    perm = np.broadcast_to(np.arange(m, dtype=np.uint8), (len(doc), m)).copy()
    row = np.arange(len(doc))
    perm[row, at] = 0
    for level in range(1, m):
        if not len(doc):
            return
        low, at = draws(shingle, level, m)
        component = perm[row, at]
        perm[row, at] = perm[:, level]
        np.minimum.at(flat, doc * m + component, low + (level << 32))
        touched = np.unique(doc)
        closed = touched[sig[touched].max(1) < (level + 1) << 32]
        if len(closed):  # early stop: no later rank can be a minimum
            gone = np.zeros(len(sig), bool)
            gone[closed] = True
            keep = ~gone[doc]
            shingle, doc, perm = shingle[keep], doc[keep], perm[keep]
            row = np.arange(len(doc))


def band_keys(sig: np.ndarray) -> np.ndarray:
    """[documents, BANDS]: one hash for each band, the band's number in it."""
    x = sig.astype(np.uint64).reshape(len(sig), BANDS, ROWS)
    out = mix64(np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(sig), BANDS)) + _GOLD)
    for r in range(ROWS):
        out = mix64(out + x[:, :, r] * _GOLD)
    return out.astype(np.int64)


def _digest(s: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(s.tobytes())


def _sign_batches(k):
    def run(batches):
        for batch in sliced(batches, limit=HELD_BYTES):
            sets = shingle_sets(texts_of(batch), k)
            sig = signatures(sets)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"),
                "n": pa.array([len(s) for s in sets], pa.int64()),
                "node": pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                "bands": pa.array(list(band_keys(sig)), pa.list_(pa.int64()))})
    return freeing(run, _INTERNED)


def sign(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n (set size), node (digest of the set), bands of every document."""
    return docs.select("doc_id", "text").mapInArrow(
        _sign_batches(k), "doc_id long, n long, node binary, bands array<long>")


# ------------------------------------------------------------ verification

def _node_sets(k):
    def run(batches):
        for batch in sliced(batches, limit=HELD_BYTES):
            sets = shingle_sets(texts_of(batch), k)
            rows = [(i, s.tobytes()) for i, (n, s) in enumerate(zip(batch.column("node").to_pylist(), sets))
                    if len(s) and _digest(s) == n]
            own = batch.select([c for c in batch.schema.names if c != "text"]).take(pa.array([r[0] for r in rows], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*own.columns, pa.array([r[1] for r in rows], pa.binary())], [*own.schema.names, "items"])
    return freeing(run, _INTERNED)


def sets_of(rows: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """``nodes`` (doc_id, node, more binary columns) with items, the sorted
    set that the text of doc_id has. The texts are dealt by doc_id whatever
    the number of nodes, so that the job is the same at every size."""
    more = [c for c in nodes.columns if c != "doc_id"]
    texts = rows.alias("r").join(nodes.hint("merge").alias("a"), F.expr("r.doc_id <=> a.doc_id")).select(
        *(f"a.{c}" for c in more), "r.text")
    return texts.mapInArrow(_node_sets(k), ", ".join(f"{c} binary" for c in more) + ", items binary")


def _verify(batches):
    for batch in batches:
        ok = []
        for x, y in zip(batch.column("a_items").to_pylist(), batch.column("b_items").to_pylist()):
            p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = np.concatenate([p, q])
            both.sort()
            inter = int((both[1:] == both[:-1]).sum())
            ok.append(100 * inter >= SIMILARITY * (len(p) + len(q) - inter))
        yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The candidate pairs (a, b) that are links; ``a`` travels to its leader ``b``."""
    side = lambda c: sets.select(F.col("node").alias(c), F.col("items").alias(f"{c}_items"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_verify, "a binary, b binary")


def joined(group: list[bytes], part: list[int], sets: list[np.ndarray]) -> list[tuple[bytes, bytes]]:
    """Pairs of groups that links between ``sets`` join, no pair that the
    others already connect. Sets of two parts are compared across them only."""
    names, label = np.unique(np.array(group, object), return_inverse=True)
    if len(names) < 2:
        return []
    part = np.array(part)
    across = bool((part != part[0]).any())
    size = np.array([len(s) for s in sets], np.int64)
    begin = np.concatenate([[0], np.cumsum(size)])
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    held = np.repeat(np.arange(len(sets)), size)[np.argsort(ids, kind="stable")]
    start = np.concatenate([[0], np.cumsum(np.bincount(ids))])
    out = []
    for i in range(len(sets) - 1):
        other = label != label[i]
        other[:i] = False
        if across:
            other &= part != part[i]
        other &= 100 * np.minimum(size, size[i]) >= SIMILARITY * np.maximum(size, size[i])
        if not other.any():
            continue
        mine = ids[begin[i] : begin[i + 1]]
        count = start[mine + 1] - start[mine]
        at = np.repeat(start[mine] - np.cumsum(count) + count, count) + np.arange(count.sum())
        both = np.bincount(held[at], minlength=len(sets))
        found = np.unique(label[other & (100 * both >= SIMILARITY * (size + size[i] - both))])
        if len(found):
            out += [(names[label[i]], names[g]) for g in found]
            label[np.isin(label, found)] = label[i]
    return out


def _settle(batches):
    def links(rows):
        pairs = joined(*zip(*rows)) if len(rows) > 1 else []
        return pa.RecordBatch.from_arrays(
            [pa.array([p[i] for p in pairs], pa.binary()) for i in (0, 1)], ["a", "b"])

    now, rows = None, []
    for batch in batches:
        for unit, x, y, group, part, items in zip(*(c.to_pylist() for c in batch.columns)):
            if (unit, x, y) != now:
                yield links(rows)
                now, rows = (unit, x, y), []
            rows.append((group, part, np.frombuffer(items, np.uint64)))
    yield links(rows)


def deal(units: DataFrame, sets: DataFrame, block: int) -> DataFrame:
    """Sets dealt to the comparisons of ``units`` (unit, node, group, load, the
    shingles of the unit): a unit over ``block`` is cut into parts by hash, and
    every two parts (and each with itself) meet once, as (unit, x, y)."""
    parts = F.ceil(F.col("load") / F.lit(block))
    dealt = units.withColumn("part", F.pmod(F.xxhash64("node"), parts).cast("long")).withColumn("other", F.explode(
        F.sequence(F.lit(0).cast("long"), parts.cast("long") - 1)))
    return dealt.join(sets, "node").select(
        "unit", F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y"), "group", "part", "items")


def settle(dealt: DataFrame) -> DataFrame:
    """(a, b) groups that links inside a unit join."""
    unit = ["unit", "x", "y"]
    return dealt.repartition(*unit).sortWithinPartitions(*unit).mapInArrow(freeing(_settle), "a binary, b binary")


# ------------------------------------------------------------ grouping

#: Links whose local groups a task holds at once.
HELD_LINKS = 500_000


def _forest(batches):
    """Links as (least, node) stars of the groups they form in this task."""
    root: dict[bytes, bytes] = {}

    def find(x):
        top = x
        while (up := root.setdefault(top, top)) != top:
            top = up
        while x != top:
            root[x], x = top, root[x]
        return top

    def stars():
        pairs = [(find(x), x) for x in list(root)]
        pairs = [p for p in pairs if p[0] != p[1]]
        root.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([p[i] for p in pairs], pa.binary()) for i in (0, 1)], ["a", "b"])

    for batch in batches:
        for a, b in zip(*(c.to_pylist() for c in batch.columns)):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
        if len(root) > HELD_LINKS:
            yield stars()
    yield stars()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node each node of ``edges`` (a, b) is
    connected with. Links are first joined inside each task; then every round
    hooks nodes to their least neighbour, shortens the paths, and goes on with
    the links between the nodes hooked to, which get fewer each time. The
    rounds' tables are put together backwards."""
    levels = []
    while True:
        edges = materialise(edges.select("a", "b").mapInArrow(freeing(_forest), "a binary, b binary").distinct(), "links")
        if levels and edges.isEmpty():
            break
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("up"))
        up = materialise(up, "hooks")
        over = up.select(F.col("node").alias("up"), F.col("up").alias("beyond"))
        up = materialise(up.join(over, "up").select("node", F.col("beyond").alias("up")), "hooks")
        levels.append(up)
        side = lambda c: up.select(F.col("node").alias(c), F.col("up").alias(f"{c}_up"))  # noqa: E731, B023
        edges = (edges.join(side("a"), "a").join(side("b"), "b")
                 .select(F.col("a_up").alias("a"), F.col("b_up").alias("b")).filter("a <> b"))
    roots = levels.pop().select("node", F.col("up").alias("root"))
    while levels:
        later = roots.select(F.col("node").alias("up"), "root")
        roots = materialise(levels.pop().join(later, "up", "left").select(
            "node", F.coalesce("root", "up").alias("root")), "roots")
    return roots


def _lead(members: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links of each bucket's members with its leader, the set with most
    copies, and as units what is left in a bucket in different groups."""
    first = members.groupBy("key").agg(F.max_by(
        F.struct("node", "n"), F.struct("copies", "node")).alias("leader"))
    close = f"100 * least(n, b_n) >= {SIMILARITY} * greatest(n, b_n)"
    pairs = (members.join(first.select("key", F.col("leader.node").alias("b"), F.col("leader.n").alias("b_n")), "key")
             .filter("node <> b").filter(close).select(F.col("node").alias("a"), "b").distinct())
    found = materialise(verify(pairs, sets), "verified")
    held = members.join(components(found), "node", "left").withColumn("group", F.coalesce("root", "node"))
    split = (held.groupBy("key").agg(F.min("group").alias("x"), F.max("group").alias("y"), F.sum("n").alias("load"))
             .filter("x <> y").select("key", "load"))
    units = held.join(split, "key").select(
        F.encode(F.concat(F.lit("bucket "), F.col("key").cast("string")), "utf-8").alias("unit"), "node", "group", "load")
    return found, materialise(units, "unsettled")


# ------------------------------------------------------------ the operator

def near_duplicates(docs: DataFrame, k: int = 5, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id linked with, itself
    included), kept (it is that document), group_rows (rows of its group).
    ``block`` is how many shingles a task compares at once; results do not
    depend on it."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = materialise(sign(rows, k), "signatures")
    nodes = signed.filter("n > 0").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.first("n").alias("n"),
        F.first("bands").alias("bands"))
    nodes = materialise(nodes, "nodes")
    banded = nodes.select("node", F.explode("bands").alias("key"))
    shared = (nodes.select(F.explode("bands").alias("key")).groupBy("key")
              .agg(F.count("*").alias("size")).filter("size > 1").select("key"))
    members = banded.join(shared, "key")
    members = materialise(members, "buckets")
    asked = members.select("node").distinct().join(nodes.select("node", "doc_id", "copies", "n"), "node")
    asked = materialise(asked, "candidates")

    # families: what buckets connect
    least = members.groupBy("key").agg(F.min("node").alias("a"))
    families = components(members.join(least, "key").filter("node <> a").select("a", F.col("node").alias("b")))
    placed = asked.join(families, "node")
    load = placed.groupBy("root").agg(F.sum("n").alias("load"))
    placed = materialise(placed.join(load, "root"), "families")
    small = placed.filter(F.col("load") <= block).select("doc_id", "node", F.col("root").alias("unit"))
    none = F.lit(0).cast("long")
    links = settle(sets_of(rows, small, k).select(
        "unit", none.alias("x"), none.alias("y"), F.col("node").alias("group"), none.alias("part"), "items"))
    large = placed.filter(F.col("load") > block)
    if not large.isEmpty():
        sets = materialise(sets_of(rows, large.select("doc_id", "node"), k).dropDuplicates(["node"]), "sets")
        found, units = _lead(members.join(large.select("node", "copies", "n"), "node"), sets)
        links = links.union(settle(deal(units, sets, block))).union(found)
    # written before they are joined: a task never holds two Python workers
    roots = components(materialise(links, "settled"))

    groups = signed.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows"))
    groups = groups.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = groups.groupBy("root").agg(F.min("least").alias("component"), F.sum("rows").alias("group_rows"))
    of_node = groups.join(named, "root").filter("group_rows > 1").select("node", "component", "group_rows")
    component = F.coalesce("component", "doc_id")
    return signed.select("doc_id", "n", "node").join(of_node, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        F.coalesce("group_rows", F.lit(1)).alias("group_rows"))


def digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_shingles", "component_id", "kept")


def brute_force(rows: list[tuple], k: int) -> list[tuple]:
    sets = []
    for _, t in rows:
        w = (t or "").encode().translate(LOWER).split()
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and min(len(a), len(b)) * 100 >= SIMILARITY * max(len(a), len(b)):
                x = len(a & b)
                if 100 * x >= SIMILARITY * (len(a) + len(b) - x):
                    root[find(i)] = find(j)
    least: dict[int, int] = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return [(doc, len(sets[i]), least[find(i)], doc == least[find(i)]) for i, (doc, _) in enumerate(rows)]
