"""Class-based n-gram language model with exchange clustering.

Words are hashed to ``UNITS`` units, and exchange clustering assigns each
unit to one of ``CLASSES`` classes: a unit moves to the class that raises the
likelihood of the class bigrams most. The counts an exchange needs (how often
each unit follows and precedes each class) are summed over the whole corpus
in every round; their size is fixed by the model. A text's probability is the
product of class transitions and word emissions, both smoothed; emissions use
the exact count of every word.

The corpus is coded once into batches (distinct word hashes of the batch and
its tokens as indices). Word counts are exchanged the same way: a batch sends
each of its distinct words once to a bucket, and the bucket answers with the
total, so a frequent word is one entry a batch.

Defined results: null and empty texts are one end token; a null doc_id is
training text; without any training text every count is 0; repeated rows are
scored row by row and count as often as they occur; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from donorlake.llm.util import LOWER, Interner, freeing, materialise, prepare, sliced, texts_of

UNITS = 1 << 14
CLASSES = 32
ROUNDS = 3
BATCH_BYTES = 2 << 20
#: Weight of the class unigram in a transition.
BACKOFF = 5.0
#: Units whose counts travel together.
_CHUNK = 256
_INTERNED = Interner()


def held_out() -> F.col:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False))


# ------------------------------------------------------------ coded corpus

def _code(batches):
    import zstandard

    z = zstandard.ZstdCompressor(level=1)
    part, k = TaskContext.get().partitionId(), 0
    for batch in sliced(batches, limit=BATCH_BYTES):
        docs = [t.translate(LOWER).split() for t in texts_of(batch)]
        ids = np.concatenate([np.empty(0, np.uint64), *(_INTERNED.ids(d) for d in docs)])
        words, local = np.unique(ids, return_inverse=True)
        local = local.astype("<u2" if len(words) <= 1 << 16 else "<u4")
        yield pa.RecordBatch.from_pydict({
            "g": pa.array([(part << 32) + k], pa.int64()),
            "ids": pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
            "held": pa.array([batch.column("held_out").to_pylist()], pa.list_(pa.bool_())),
            "sizes": pa.array([[len(d) for d in docs]], pa.list_(pa.int32())),
            "words": pa.array([words.astype("<u8").tobytes()], pa.binary()),
            "tokens": pa.array([z.compress(local.tobytes())], pa.binary())})
        k += 1


def code(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out().alias("held_out"))
    return materialise(rows.mapInArrow(
        freeing(_code, _INTERNED), "g long, ids array<long>, held array<boolean>, sizes array<int>, words binary, tokens binary"), "coded")


@dataclass
class Coded:
    g: int
    ids: list
    held: np.ndarray  # by document
    sizes: np.ndarray  # words of each document
    words: np.ndarray  # distinct word hashes
    tokens: np.ndarray  # index into words
    extra: dict


def _read(batches):
    import zstandard

    z = zstandard.ZstdDecompressor()
    for rows in batches:
        for i in range(rows.num_rows):
            row = {n: rows.column(n)[i].as_py() for n in rows.schema.names}
            sizes = np.array(row.pop("sizes"), np.int64)
            words = np.frombuffer(row.pop("words"), "<u8")
            width = "<u2" if len(words) <= 1 << 16 else "<u4"
            raw = z.decompress(row.pop("tokens"), max_output_size=int(sizes.sum()) * int(width[-1]) or 1)
            yield Coded(row.pop("g"), row.pop("ids"), np.array(row.pop("held"), bool), sizes, words,
                        np.frombuffer(raw, width).astype(np.int64), row)


def units_of(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(20)).astype(np.int64) % UNITS


# ------------------------------------------------------------ word counts

_UNIT = np.dtype([("unit", "<i8"), ("words", "<i8"), ("tokens", "<i8")])


def _by_bucket(words: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order that puts a batch's words bucket by bucket, and where each
    bucket begins in it: sender and receiver agree on it, so an answer needs
    no words."""
    bucket = units_of(words) % n_buckets
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(n_buckets + 1))


def _send_words(n_buckets):
    def run(batches):
        import zstandard

        z = zstandard.ZstdCompressor(level=1)
        for b in _read(batches):
            train = np.repeat(~b.held, b.sizes)
            n = np.bincount(b.tokens[train], minlength=len(b.words)).astype("<i8")
            order, cut = _by_bucket(b.words, n_buckets)
            filled = [i for i in range(n_buckets) if cut[i + 1] > cut[i]]
            part = lambda x, i: x[order[cut[i] : cut[i + 1]]].tobytes()
            yield pa.RecordBatch.from_pydict({
                "bucket": pa.array(filled, pa.int32()), "g": pa.array([b.g] * len(filled), pa.int64()),
                "words": pa.array([part(b.words, i) for i in filled], pa.binary()),
                "n": pa.array([z.compress(part(n, i)) for i in filled], pa.binary())})
    return run


def _count_words(pdf: pd.DataFrame) -> pd.DataFrame:
    import zstandard

    z, d = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
    parts = [np.frombuffer(x, "<u8") for x in pdf["words"]]
    words, index = np.unique(np.concatenate(parts), return_inverse=True)
    total = np.zeros(len(words), np.int64)
    np.add.at(total, index, np.concatenate([np.frombuffer(d.decompress(x), "<i8") for x in pdf["n"]]))
    known = total > 0
    unit, at, n = np.unique(units_of(words[known]), return_inverse=True, return_counts=True)
    of_unit = np.empty(len(unit), _UNIT)
    of_unit["unit"], of_unit["words"] = unit, n
    of_unit["tokens"] = np.bincount(at, weights=total[known], minlength=len(unit))
    cut = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    answers = [z.compress(total[index[a:b]].astype("<i8").tobytes()) for a, b in zip(cut, cut[1:])]
    bucket = int(pdf["bucket"].iloc[0])
    return pd.DataFrame({"g": [*pdf["g"], -1], "bucket": bucket, "n": [*answers, of_unit.tobytes()]})


def n_buckets_of(coded: DataFrame) -> int:
    return int(coded.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def count_words(coded: DataFrame, n_buckets: int) -> DataFrame:
    """Total training counts of the words of each batch (g) by bucket, and
    with g = -1 the distinct words and tokens of each unit."""
    sent = coded.mapInArrow(_send_words(n_buckets), "bucket int, g long, words binary, n binary")
    return materialise(sent.groupBy("bucket").applyInPandas(_count_words, "g long, bucket int, n binary"), "counts")


# ------------------------------------------------------------ clustering

def _neighbours(classes):
    """Sums over a task's training text: [unit, class before | class after],
    class ``CLASSES`` being the end of a text."""
    def run(batches):
        import zstandard

        of_unit, wide = classes.value, CLASSES + 1
        before, after = np.zeros((UNITS + 1) * wide, np.int64), np.zeros((UNITS + 1) * wide, np.int64)
        for b in _read(batches):
            unit = units_of(b.words)[b.tokens]
            # each text as its words and one end, unit UNITS
            ends = np.cumsum(b.sizes)
            flat = np.insert(unit, ends, UNITS)
            keep = np.repeat(~b.held, b.sizes + 1)
            cls = of_unit[flat]
            previous = np.concatenate([[CLASSES], cls[:-1]]) if len(cls) else cls
            before += np.bincount(flat[keep] * wide + previous[keep], minlength=len(before))
            inner = keep & (flat != UNITS)
            following = np.append(cls[1:], CLASSES)
            after += np.bincount(flat[inner] * wide + following[inner], minlength=len(after))
        table = np.concatenate([before.reshape(-1, wide), after.reshape(-1, wide)], axis=1)
        z = zstandard.ZstdCompressor(level=1)
        chunks = [c for c in range(0, UNITS + 1, _CHUNK) if table[c : c + _CHUNK].any()]
        yield pa.RecordBatch.from_pydict({
            "chunk": pa.array(chunks, pa.int32()),
            "sums": pa.array([z.compress(table[c : c + _CHUNK].astype("<i4" if table.max() < 2**31 else "<i8").tobytes())
                              for c in chunks], pa.binary()),
            "item": pa.array([4 if table.max() < 2**31 else 8] * len(chunks), pa.int32())})
    return run


def _add_chunks(pdf: pd.DataFrame) -> pd.DataFrame:
    import zstandard

    z = zstandard.ZstdDecompressor()
    total = None
    for blob, item in zip(pdf["sums"], pdf["item"]):
        x = np.frombuffer(z.decompress(blob), f"<i{item}").astype(np.int64)
        total = x if total is None else total + x
    return pd.DataFrame({"chunk": [int(pdf["chunk"].iloc[0])],
                         "sums": [zstandard.ZstdCompressor().compress(total.tobytes())], "item": [8]})


def neighbour_counts(coded: DataFrame, of_unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(before, after), each [UNITS + 1, CLASSES + 1], over the training text."""
    import zstandard

    shared = coded.sparkSession.sparkContext.broadcast(of_unit)
    schema = "chunk int, sums binary, item int"
    summed = coded.mapInArrow(_neighbours(shared), schema).groupBy("chunk").applyInPandas(_add_chunks, schema)
    table = np.zeros((UNITS + 1, 2 * (CLASSES + 1)), np.int64)
    z = zstandard.ZstdDecompressor()
    for r in summed.collect():  # UNITS / _CHUNK rows
        x = np.frombuffer(z.decompress(bytes(r["sums"])), "<i8").reshape(-1, table.shape[1])
        table[r["chunk"] : r["chunk"] + len(x)] = x
    return table[:, : CLASSES + 1], table[:, CLASSES + 1 :]


def first_classes(tokens: np.ndarray) -> np.ndarray:
    """Classes to begin with: the most frequent units one each for half of
    the classes, the others dealt out by frequency."""
    order = np.argsort(-tokens, kind="stable")
    out = np.empty(UNITS + 1, np.int64)
    out[UNITS] = CLASSES
    half = CLASSES // 2
    out[order[:half]] = np.arange(half)
    out[order[half:]] = half + np.arange(UNITS - half) % (CLASSES - half)
    return out


def exchange(of_unit: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """One sweep: each unit, most frequent first, moves to the class with the
    highest likelihood of its bigrams; class counts follow every move."""
    out = of_unit.copy()
    wide = CLASSES + 1
    pairs = np.zeros((wide, wide))  # [class before, class]
    np.add.at(pairs.T, of_unit, before.astype(float))
    size = before.sum(1)
    log = lambda x: np.log(np.maximum(x, 1e-9))
    for u in np.argsort(-size[:UNITS], kind="stable"):
        n = size[u]
        if not n:
            break
        a, left, right = out[u], before[u].astype(float), after[u].astype(float)
        pairs[:, a] -= left
        pairs[a, :] -= right
        np.maximum(pairs, 0, out=pairs)
        # change of the likelihood when the unit joins each class
        into, out_of = pairs[:, :CLASSES].T, pairs[:CLASSES]
        total = into.sum(1)
        xlogx = lambda x: x * log(x)
        gain = (xlogx(into + left) - xlogx(into)).sum(1) + (xlogx(out_of + right) - xlogx(out_of)).sum(1)
        gain -= 2 * (xlogx(total + n) - xlogx(total))
        b = int(np.argmax(gain))
        if gain[b] <= gain[a] + 1e-9:
            b = a
        out[u] = b
        pairs[:, b] += left
        pairs[b, :] += right
    return out


# ------------------------------------------------------------ the model

@dataclass
class Model:
    of_unit: np.ndarray  # class of each unit
    transition: np.ndarray  # log10 [class before, class], CLASSES = end
    floor: np.ndarray  # log10 of the emission denominator of each class
    n_tokens: int  # training tokens, ends included
    n_types: int  # distinct training tokens, the end included
    n_ends: int


def fit(coded: DataFrame, counts: DataFrame, rounds: int = ROUNDS) -> Model:
    words, tokens = np.zeros(UNITS, np.int64), np.zeros(UNITS, np.int64)
    for r in counts.filter("g = -1").collect():  # at most UNITS entries in all
        e = np.frombuffer(bytes(r["n"]), _UNIT)
        words[e["unit"]], tokens[e["unit"]] = e["words"], e["tokens"]
    of_unit = first_classes(tokens)
    for _ in range(rounds):
        of_unit = exchange(of_unit, *neighbour_counts(coded, of_unit))
    before, _ = neighbour_counts(coded, of_unit)
    wide = CLASSES + 1
    pairs = np.zeros((wide, wide))
    np.add.at(pairs.T, of_unit, before.astype(float))
    size = pairs.sum(0)
    prior = (size + 0.5) / (size.sum() + 0.5 * wide)
    transition = (pairs + BACKOFF * prior) / (pairs.sum(1, keepdims=True) + BACKOFF)
    class_words = np.bincount(of_unit[:UNITS], weights=words, minlength=wide)
    class_tokens = np.bincount(of_unit[:UNITS], weights=tokens, minlength=wide)
    n_ends = int(size[CLASSES])
    return Model(of_unit, np.log10(transition), np.log10(class_tokens + 0.5 * (class_words + 1)),
                 int(tokens.sum()) + n_ends, int(words.sum()) + (n_ends > 0), n_ends)


def _score(shared, n_buckets):
    def run(batches):
        import zstandard

        d = zstandard.ZstdDecompressor()
        m = shared.value
        scale = np.log10(m.n_tokens + 0.5 * (m.n_types + 1))
        for b in _read(batches):
            order, cut = _by_bucket(b.words, n_buckets)
            n = np.zeros(len(b.words), np.int64)
            for x in b.extra["answers"] or []:
                i = x["bucket"]
                n[order[cut[i] : cut[i + 1]]] = np.frombuffer(d.decompress(x["n"]), "<i8")
            cls = m.of_unit[units_of(b.words)]
            begin = np.concatenate([[0], np.cumsum(b.sizes)])
            doc = np.repeat(np.arange(len(b.sizes)), b.sizes)
            total = lambda x: np.bincount(doc, weights=x, minlength=len(b.sizes))
            base_word, emit = np.log10(n + 0.5) - scale, np.log10(n + 0.5) - m.floor[cls]
            token_class = cls[b.tokens]
            previous = np.concatenate([[CLASSES], token_class[:-1]]) if len(token_class) else token_class
            filled = b.sizes > 0
            if len(previous):
                previous[begin[:-1][filled]] = CLASSES
            last = np.full(len(b.sizes), CLASSES)
            last[filled] = token_class[begin[1:][filled] - 1]
            base = total(base_word[b.tokens]) + np.log10(m.n_ends + 0.5) - scale
            score = total(emit[b.tokens] + m.transition[previous, token_class]) + m.transition[last, CLASSES]
            known = total((n > 0)[b.tokens]).astype(np.int64) + (m.n_ends > 0)
            k = len(b.sizes)
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(b.ids, pa.int64()), "held_out": pa.array(b.held),
                "n_tokens": pa.array(b.sizes + 1, pa.int64()), "n_known": pa.array(known, pa.int64()),
                "train_tokens": pa.array([m.n_tokens] * k, pa.int64()),
                "base_score": pa.array(base, pa.float64()), "score": pa.array(score, pa.float64())})
    return run


def class_lm(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score
    (log10) and perplexity of every row."""
    spark = prepare(docs.sparkSession)
    coded = code(docs)
    n_buckets = n_buckets_of(coded)
    counts = count_words(coded, n_buckets)
    model = spark.sparkContext.broadcast(fit(coded, counts, rounds))
    answers = counts.filter("g >= 0").groupBy("g").agg(F.collect_list(F.struct("bucket", "n")).alias("answers"))
    scored = coded.join(answers, "g", "left").mapInArrow(
        _score(model, n_buckets), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double")
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
