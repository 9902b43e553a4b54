"""Source divergence audit by chunk factorisation.

A corpus has far fewer distinct whitespace chunks than chunks, and white space
never lies inside a term, so terms are taken from chunks, not from texts:

1. Documents are coded once into batches: the distinct chunks of the batch,
   by the bucket of their hash, and, for each document, which of them it has
   and how often.
2. A batch sends each of its distinct chunks once to its bucket. A bucket tokenises every distinct chunk it ever sees once and answers
   each batch with the terms, in the order in which the chunks came.
3. The batch joins the terms back. A document that has a term in several
   chunks counts once for it, so distinct documents are counted here, inside
   the document; occurrences are added up. Each batch sends out one row for
   each (lang, source, term).

Sums by (lang, source, term) and over (lang, term) follow in one shuffle, terms in fewer than
``MIN_DOCS`` documents of a language go, and every (lang, source) group is
compared with the others over all kept terms: with p = 1 + floor(10^9 (count +
5) / (N + 5 V)), the distance of two groups is the sum of abs(p - p'), where a
term that a group lacks has the p of count 0. Pairs of sources are summed in
buckets of terms, a block of sources at a time, so that a bucket sends one row
a pair. The counts of a hot source are pre-aggregated by batch and by task.

Defined results: null text, lang and source are ''; a group without terms is
compared all the same; a language without kept terms has distance 0 between
its sources; a source alone in its language has no pairs; repeated rows count
as documents of their own; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from donorlake.llm.util import freeing, materialise, mix64, prepare, texts_of

MIN_DOCS = 30
TOP_TERMS = 50
SCALE = 1_000_000_000
SMOOTH = 5
#: Text that is coded together: distinct chunks are fewer in more text.
BATCH_BYTES = 14 << 20
#: Counts a task combines before it sends them out.
HELD_ROWS = 600_000
SOURCE_BLOCK = 128
TERM_BLOCK = 4096

#: Every byte outside the term class becomes a space, A-Z becomes a-z.
TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


# ------------------------------------------------------------ coded documents

class _Numbers(dict):
    """Numbers handed out in order of first appearance."""

    def __missing__(self, key):
        n = self[key] = len(self)
        return n


def _code(n_buckets):
    def run(batches):
        part, k, coder = TaskContext.get().partitionId(), 0, _Coder()
        for batch in batches:
            for text, lang, source in zip(texts_of(batch), batch.column("lang").to_pylist(), batch.column("source").to_pylist()):
                coder.add(text, lang, source)
                if coder.size >= BATCH_BYTES:
                    yield coder.row((part << 32) + k, n_buckets)
                    k, coder = k + 1, _Coder()
        if coder.group:
            yield coder.row((part << 32) + k, n_buckets)
    return run


class _Coder:
    """Distinct chunks of some documents, and which each document has."""

    def __init__(self):
        self.chunks, self.groups = _Numbers(), _Numbers()
        self.group, self.sizes, self.ids, self.counts = [], [], [], []
        self.size = 0

    def add(self, text: bytes, lang: str, source: str) -> None:
        counted = Counter(text.split())
        self.ids.append(np.fromiter(map(self.chunks.__getitem__, counted), np.int32, len(counted)))
        self.counts.append(np.fromiter(counted.values(), np.int32, len(counted)))
        self.sizes.append(len(counted))
        self.group.append(self.groups[lang, source])
        self.size += len(text) + 100

    def row(self, g: int, n_buckets: int) -> pa.RecordBatch:
        """Chunks are numbered bucket by bucket, so that a bucket's chunks
        and its answer are a range of numbers."""
        import zstandard

        z = zstandard.ZstdCompressor(level=3)
        chunks = [*self.chunks]
        bucket = (mix64(np.fromiter(map(xxhash.xxh3_64_intdigest, chunks), np.uint64, len(chunks)))
                  % np.uint64(n_buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cut = np.searchsorted(bucket[order], np.arange(n_buckets + 1)).tolist()
        place = np.empty(len(chunks), np.int32)
        place[order] = np.arange(len(chunks))
        filled = [i for i in range(n_buckets) if cut[i + 1] > cut[i]]
        packed = lambda x: z.compress(x.astype("<i4").tobytes())
        sent = [{"bucket": i, "chunks": z.compress(b" ".join([chunks[j] for j in order[cut[i] : cut[i + 1]]]))}
                for i in filled]
        return pa.RecordBatch.from_pydict({
            "g": pa.array([g], pa.int64()),
            "langs": pa.array([[a for a, _ in self.groups]], pa.list_(pa.string())),
            "sources": pa.array([[b for _, b in self.groups]], pa.list_(pa.string())),
            "doc_group": pa.array([self.group], pa.list_(pa.int32())),
            "sizes": pa.array([self.sizes], pa.list_(pa.int32())),
            "ids": pa.array([packed(place[np.concatenate(self.ids)])], pa.binary()),
            "counts": pa.array([packed(np.concatenate(self.counts))], pa.binary()),
            "cut": pa.array([cut], pa.list_(pa.int32())),
            "sent": pa.array([sent], pa.list_(pa.struct([("bucket", pa.int32()), ("chunks", pa.binary())])))})


_CODED = ("g long, langs array<string>, sources array<string>, doc_group array<int>, sizes array<int>, "
          "ids binary, counts binary, cut array<int>, sent array<struct<bucket: int, chunks: binary>>")


def code(docs: DataFrame, n_buckets: int) -> DataFrame:
    """One row for each batch of documents."""
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")))
    return materialise(rows.mapInArrow(freeing(_code(n_buckets)), _CODED), "coded")


def _unpack(blob: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompressobj().decompress(blob)


def _tokenise(batches):
    """Terms of every distinct chunk of the task's buckets, made once."""
    import zstandard

    z = zstandard.ZstdCompressor(level=3)
    known: dict[bytes, bytes] = {}

    def look_up(chunk):
        found = known.get(chunk)
        if found is None:
            found = known[chunk] = b" ".join(terms(chunk))
        return found

    for batch in batches:
        answers = [z.compress(b"\n".join(map(look_up, _unpack(x).split()))) for x in batch.column("chunks").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("g"), batch.column("bucket"), pa.array(answers, pa.binary())], ["g", "bucket", "terms"])
    known.clear()


def _rejoin(batches):
    """Counts of a task's batches by (lang, source, term), combined while
    they are few enough to hold."""
    held, n = [], 0
    for rows in batches:
        for i in range(rows.num_rows):
            row = {c: rows.column(c)[i].as_py() for c in rows.schema.names}
            numbers = _Numbers()
            width, flat = np.zeros(row["cut"][-1], np.int64), {}
            for a in row["answers"] or []:
                first = row["cut"][a["bucket"]]
                split = [x.split() for x in _unpack(a["terms"]).split(b"\n")]
                if first + len(split) != row["cut"][a["bucket"] + 1]:
                    raise ValueError(f"bucket {a['bucket']} answered {len(split)} chunks")
                width[first : first + len(split)] = [len(x) for x in split]
                flat[first] = np.array([numbers[t] for x in split for t in x], np.int64)
            flat = np.concatenate([np.empty(0, np.int64), *(flat[k] for k in sorted(flat))])
            held.append(_table(count_terms(row, width, flat, len(numbers)), [*numbers], row))
            n += held[-1].num_rows
            if n > HELD_ROWS:
                held = [_combined(held)]
                n = held[0].num_rows
                if n > HELD_ROWS // 2:
                    yield from held[0].to_batches(max_chunksize=50_000)
                    held, n = [], 0
    if held:
        yield from _combined(held).to_batches(max_chunksize=50_000)


def _combined(tables: list[pa.Table]) -> pa.Table:
    if len(tables) == 1:
        return tables[0]
    keys = ["lang", "source", "term"]
    found = pa.concat_tables(tables).group_by(keys, use_threads=False).aggregate([("docs", "sum"), ("n", "sum")])
    return found.select([*keys, "docs_sum", "n_sum"]).rename_columns([*keys, "docs", "n"]).combine_chunks()


def count_terms(row: dict, width: np.ndarray, flat: np.ndarray, n_terms: int) -> tuple[np.ndarray, ...]:
    """(group, term, documents, occurrences) of a batch. Chunk c has
    ``width[c]`` terms, one after the other in ``flat``."""
    begin = np.cumsum(width) - width
    ids, counts = (np.frombuffer(_unpack(row[c]), "<i4") for c in ("ids", "counts"))
    sizes, group = np.array(row["sizes"], np.int64), np.array(row["doc_group"], np.int64)
    w = width[ids]
    at = np.repeat(begin[ids] - np.cumsum(w) + w, w) + np.arange(w.sum())
    # one entry for each document and term
    key = np.repeat(np.repeat(np.arange(len(sizes)), sizes) * n_terms, w) + flat[at]
    key, n = _summed(key, np.repeat(counts, w).astype(np.int64))
    doc, term = np.divmod(key, max(n_terms, 1))
    key = group[doc] * n_terms + term
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.diff(key[order], prepend=-1))
    docs = np.diff(np.append(first, len(key)))
    total = np.add.reduceat(n[order], first) if len(first) else n
    group, term = np.divmod(key[order][first], max(n_terms, 1))
    return group, term, docs, total


def _summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    return key[first], np.add.reduceat(n[order], first) if len(first) else n


def _table(counted, names: list[bytes], row: dict) -> pa.Table:
    group, term, docs, n = counted
    texts = (pa.array(x, pa.string()) for x in (row["langs"], row["sources"], [x.decode() for x in names]))
    return pa.table([x.take(pa.array(at)) for x, at in zip(texts, (group, group, term))]
                    + [pa.array(docs, pa.int64()), pa.array(n, pa.int64())], ["lang", "source", "term", "docs", "n"])


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, docs, n): documents that have the term and its
    occurrences, over all rows; dealt by (lang, term)."""
    spark = prepare(docs.sparkSession)
    n_buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    coded = code(docs, n_buckets)
    answers = (
        coded.select("g", F.explode("sent").alias("s")).select("g", "s.bucket", "s.chunks")
        .repartition(n_buckets, "bucket").mapInArrow(freeing(_tokenise), "g long, bucket int, terms binary")
        .groupBy("g").agg(F.collect_list(F.struct("bucket", "terms")).alias("answers")))  # n_buckets entries at most
    counted = coded.drop("sent").join(answers, "g", "left").mapInArrow(
        freeing(_rejoin), "lang string, source string, term string, docs long, n long")
    return (counted.repartition("lang", "term").groupBy("lang", "source", "term")
            .agg(F.sum("docs").alias("docs"), F.sum("n").alias("n")))


# ------------------------------------------------------------ the audit

def _p(n: str, total: str, v: str):
    """1 + floor(SCALE (n + SMOOTH) / (total + SMOOTH v)), exact."""
    return F.expr(f"1 + cast(cast({n} + {SMOOTH} as decimal(25, 0)) * cast({SCALE} as decimal(10, 0)) "
                  f"div cast({total} + {SMOOTH} * {v} as decimal(25, 0)) as long)")


def _distances(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Sums of abs(p - p') over the kept terms of a bucket, for each pair of
    the language's sources (a before b). ``left``: (lang, bucket, term,
    source, p); ``right``: (lang, bucket, source, p0)."""
    right = right.sort_values("source", kind="stable", ignore_index=True)
    names = right["source"].tolist()
    floor = right["p0"].to_numpy(np.int64)
    place = {s: i for i, s in enumerate(names)}
    term, term_names = pd.factorize(left["term"])
    source = left["source"].map(place).to_numpy(np.int64) if len(left) else np.empty(0, np.int64)
    p = left["p"].to_numpy(np.int64)
    order = np.argsort(term, kind="stable")
    term, source, p = term[order], source[order], p[order]

    def dense(begin, end, a):
        """p of terms begin..end for the block of sources from ``a``."""
        out = np.repeat(floor[None, a : a + SOURCE_BLOCK], end - begin, axis=0)
        lo, hi = np.searchsorted(term, [begin, end])
        own = (source[lo:hi] >= a) & (source[lo:hi] < a + SOURCE_BLOCK)
        out[term[lo:hi][own] - begin, source[lo:hi][own] - a] = p[lo:hi][own]
        return out

    out = []
    for a in range(0, len(names), SOURCE_BLOCK):
        for b in range(a, len(names), SOURCE_BLOCK):
            total = np.zeros((min(SOURCE_BLOCK, len(names) - a), min(SOURCE_BLOCK, len(names) - b)), np.int64)
            for begin in range(0, len(term_names), TERM_BLOCK):
                end = min(begin + TERM_BLOCK, len(term_names))
                x, y = dense(begin, end, a), dense(begin, end, b)
                for i in range(total.shape[0]):
                    total[i] += np.abs(y - x[:, i : i + 1]).sum(0)
            i, j = np.nonzero(np.add.outer(np.arange(total.shape[0]) + a, -(np.arange(total.shape[1]) + b)) < 0)
            out += [(key[0], names[a + x], names[b + y], d) for x, y, d in zip(i, j, total[i, j].tolist())]
    return pd.DataFrame(out, columns=["lang", "a", "b", "value"])


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: distances to the language's
    other sources (part ``pair``) and the terms a source has more of than its
    language (part ``term``)."""
    spark = prepare(docs.sparkSession)
    of_term = Window.partitionBy("lang", "term")  # one row a source
    kept = materialise(
        term_counts(docs).withColumns({"lang_docs": F.sum("docs").over(of_term), "lang_n": F.sum("n").over(of_term)})
        .filter(F.col("lang_docs") >= min_docs).select("lang", "source", "term", "n", "lang_n"), "kept")
    langs = (kept.groupBy("lang", "term").agg(F.max("lang_n").alias("lang_n"))
             .groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total")))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = materialise(
        docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
        .join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
        .select("lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("v", "lang_total", "total")))
        .withColumn("p0", F.when(F.col("v") > 0, _p("0", "total", "v")).otherwise(0)), "groups")

    scored = (kept.join(groups.drop("p0"), ["lang", "source"])
              .select("lang", "source", "term", _p("n", "total", "v").alias("p"), _p("lang_n", "lang_total", "v").alias("q")))
    by_rank = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    top = (scored.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                         (F.col("p") - F.col("q")).alias("value"))
           .withColumn("rank", F.row_number().over(by_rank)).filter(F.col("rank") <= top_terms))

    n_buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bucket = F.pmod(F.xxhash64("term"), F.lit(n_buckets)).cast("int")
    left = scored.select("lang", bucket.alias("bucket"), "term", "source", "p")
    right = groups.select("lang", F.explode(F.sequence(F.lit(0), F.lit(n_buckets - 1))).alias("bucket"), "source", "p0")
    halves = (left.groupBy("lang", "bucket").cogroup(right.groupBy("lang", "bucket"))
              .applyInPandas(_distances, "lang string, a string, b string, value long")
              .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    halves = materialise(halves, "distances")
    both = halves.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        halves.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))
    pairs = both.select("lang", "source", F.lit("pair").alias("part"), "item", "value",
                        F.row_number().over(by_rank).alias("rank"))
    return pairs.unionByName(top)


def digest(result: DataFrame) -> DataFrame:
    return result.select("lang", "source", "part", "item", "value", "rank")


def brute_force(docs: list[tuple], min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> list[tuple]:
    """Reference answer for tests from (text, lang, source): whole texts,
    every group against every other."""
    rows = [(terms((t or "").encode()), a or "", b or "") for t, a, b in docs]
    out = []
    for lang in {a for _, a, _ in rows}:
        mine = [(ws, s) for ws, a, s in rows if a == lang]
        df = Counter(t for ws, _ in mine for t in set(ws))
        vocab = sorted(t for t, n in df.items() if n >= min_docs)
        count = {s: Counter() for _, s in mine}
        for ws, s in mine:
            count[s].update(t for t in ws if df[t] >= min_docs)
        whole = sum(count.values(), Counter())

        def p(c, v=len(vocab)):
            n = sum(c.values())
            return {t: 1 + SCALE * (c[t] + SMOOTH) // (n + SMOOTH * v) for t in vocab}

        q, ps = p(whole), {s: p(c) for s, c in count.items()}
        for s in ps:
            pair = sorted((-sum(abs(ps[s][t] - ps[o][t]) for t in vocab), o) for o in ps if o != s)
            out += [(lang, s, "pair", o, -v, i + 1) for i, (v, o) in enumerate(pair)]
            more = sorted((q[t] - ps[s][t], t) for t in vocab if count[s][t] and ps[s][t] > q[t])[:top_terms]
            out += [(lang, s, "term", t.decode(), -v, i + 1) for i, (v, t) in enumerate(more)]
    return out
