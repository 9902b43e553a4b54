"""Quality classifier by importance resampling.

Target text (labelled good and not toxic) and raw text (every document of the
corpus, labelled or not) are modelled as hashed n-grams: words and word pairs
fall into ``BUCKETS`` buckets, and each model is the smoothed distribution
over them. The log ratio of the two models is the importance weight; an
n-gram that good text never has weighs against a document, the more the more
often the corpus has it. A document is as good as its worst passage, so
weights are taken over passages of ``PASSAGE`` words, and a document carries
the least weight of its passages, of words or of pairs; the sum over a text of
n < ``PASSAGE`` words counts sqrt(PASSAGE / n) times. What labelled bad text
says weighs too: the same passages are weighed by good against labelled text,
for n-grams of labelled bad text only, on a scale on which both best cuts
agree, and the lesser weight counts.
Documents are drawn without replacement by Gumbel top-k: the k largest of
weight + Gumbel noise (a hash of the document's id gives its noise, so
reruns agree). k is the number of documents of the corpus whose weight, without
noise, passes the cut that best parts labelled good from labelled bad; the
k-th largest noisy weight is found exactly by counting. A document whose
weight lies ``CLEAR`` or more under the cut takes no noise: all k that pass
stay above it, whatever their noise, so it cannot be drawn. Rows that tie with
the k-th (repeated rows of one document) are drawn with it.

The target model and the cut are fitted on a bounded sample: at most
``SAMPLE`` labelled documents, the least by a hash of doc_id. For the cut a
labelled document is weighed without its own n-grams in the labelled counts,
as if it had no label. The raw model counts every document, and every
document is weighed.

Defined results: null and empty texts have no passage and are rejected;
labels without a document are ignored; contradicting labels of one document
count as bad; without labels of both kinds nothing is rejected but empty
texts; other columns are carried only when named in ``keep``.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from donorlake.llm.util import LOWER, Interner, freeing, materialise, mix64, prepare, sliced, texts_of

BUCKETS = 1 << 20
PARTS = ("word", "pair")
PASSAGE = 64
#: Word pairs overlap, so their log ratios count for less.
PAIR_SHARE = 0.4
SMOOTHING = 5.0
#: Standard errors of a count that a log ratio must exceed to say anything.
ERRORS = 2.0
SAMPLE = 20_000
#: Width of the Gumbel noise against log weights.
TEMPERATURE = 0.25
#: Weight under the cut from which a document is clearly rejected. The least
#: noise, -log(-log(2^-53)) = -3.61 temperatures, is less than that.
CLEAR = 4 * TEMPERATURE
#: Log ratios are multiples of this, so sums of them are exact in any order.
STEP = 2.0 ** -16
#: Buckets whose counts travel together.
CHUNK = 1 << 14
#: Bins that one round of the search for the k-th weight counts.
BINS = 4096
_INTERNED = Interner(50_000)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def ngram_buckets(texts: list[bytes], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each word, bucket of each word pair, start of each text);
    the last word of a text is paired with its end."""
    docs = [_INTERNED.ids(t.translate(LOWER).split()) for t in texts]  # words of one text at a time
    starts = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
    ids = np.concatenate([np.empty(0, np.uint64), *docs])
    after = np.append(ids[1:], np.uint64(0)) if len(ids) else ids
    after[starts[1:][np.diff(starts) > 0] - 1] = 0
    word = (mix64(ids + _GOLD) % np.uint64(buckets)).astype(np.int64)
    pair = (mix64(mix64(ids) + after * _GOLD) % np.uint64(buckets)).astype(np.int64)
    return word, pair, starts


def passage_sums(values: np.ndarray, starts: np.ndarray, passage: int = PASSAGE) -> np.ndarray:
    """Least sum of ``values`` over passages of each text (half a passage
    apart, the last one at the end); NaN for texts without words."""
    total = np.concatenate([[0.0], np.cumsum(values)])
    out = np.full(len(starts) - 1, np.nan)
    n = np.diff(starts)
    short = (n > 0) & (n <= passage)
    out[short] = total[starts[1:][short]] - total[starts[:-1][short]]
    long = np.flatnonzero(n > passage)
    if len(long):
        count = -(-(n[long] - passage) // (passage // 2)) + 1
        doc = np.repeat(np.arange(len(long)), count)
        k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        at = starts[long][doc] + np.minimum(k * (passage // 2), n[long][doc] - passage)
        sums = total[at + passage] - total[at]
        out[long] = np.minimum.reduceat(sums, np.cumsum(count) - count)
    return out


def _count(batches):
    """Sums over a task's documents: n-grams of all of them (n) and of those
    labelled good and bad."""
    import zstandard

    total = {p: np.zeros((3, BUCKETS), np.int64) for p in PARTS}
    for batch in sliced(batches):
        word, pair, starts = ngram_buckets(texts_of(batch))
        kind = np.repeat(np.asarray(batch.column("kind")), np.diff(starts))
        for part, codes in zip(PARTS, (word, pair)):
            np.add.at(total[part][0], codes, 1)
            for k in (1, 2):
                np.add.at(total[part][k], codes[kind == k], 1)
    z = zstandard.ZstdCompressor(level=1)
    chunks = range(0, BUCKETS, CHUNK)
    for i, part in enumerate(PARTS):
        yield pa.RecordBatch.from_pydict({
            "chunk": pa.array([i * BUCKETS + c for c in chunks], pa.int32()),
            "counts": pa.array([z.compress(total[part][:, c : c + CHUNK].tobytes()) for c in chunks], pa.binary())})


def _add(batches):
    """Sums of the counts of each chunk, one batch at a time."""
    import zstandard

    d, z, total = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1), {}
    for batch in batches:
        for chunk, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts")):
            x = np.frombuffer(d.decompress(counts.as_py()), np.int64)
            total[chunk] = total[chunk] + x if chunk in total else x
    yield pa.RecordBatch.from_pydict({
        "chunk": pa.array(list(total), pa.int32()),
        "counts": pa.array([z.compress(x.tobytes()) for x in total.values()], pa.binary())})


def labelled_sample(labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, kind): 1 good and not toxic, 2 otherwise; at most ``sample``."""
    good = F.min(F.when((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), 1).otherwise(0))
    by = F.xxhash64(F.col("doc_id").cast("string"))
    return (labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
            .agg((2 - good).cast("int").alias("kind")).orderBy(by, "doc_id").limit(sample))


def count_ngrams(docs: DataFrame, sample: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """part -> (occurrences in all documents, in the good and in the bad ones
    of the sample) by bucket."""
    import zstandard

    tagged = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id", "left")
    tagged = tagged.select("text", F.coalesce("kind", F.lit(0)).alias("kind"))
    schema = "chunk int, counts binary"
    sums = tagged.mapInArrow(freeing(_count, _INTERNED), schema).repartition("chunk").mapInArrow(_add, schema)
    table, d = np.zeros((len(PARTS), 3, BUCKETS), np.int64), zstandard.ZstdDecompressor()
    for r in sums.collect():  # 2 x BUCKETS / CHUNK rows
        part, at = divmod(r["chunk"], BUCKETS)
        table[part, :, at : at + CHUNK] = np.frombuffer(d.decompress(bytes(r["counts"])), np.int64).reshape(3, -1)
    return {p: tuple(x) for p, x in zip(PARTS, table)}


def expected(counts: dict) -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray, float]]:
    """part -> (occurrences in good text, those in bad text, those expected in
    good text if it were like the corpus, good share of the labelled text)."""
    return {p: (good.astype(np.int32), bad.astype(np.int32), (n * (good.sum() / max(1, n.sum()))).astype(np.float32),
                good.sum() / max(1, good.sum() + bad.sum()))
            for p, (n, good, bad) in counts.items()}


def log_ratio(good: np.ndarray, want: np.ndarray) -> np.ndarray:
    """log target probability - log raw probability, ``SMOOTHING`` added to
    both counts. An n-gram of good text counts by what its ratio exceeds the
    error of its count; one that good text never has counts in full."""
    ratio = np.log((good + SMOOTHING) / (want + SMOOTHING))
    sure = np.sign(ratio) * np.maximum(np.abs(ratio) - ERRORS / np.sqrt(want + SMOOTHING), 0)
    return np.where(good > 0, sure, ratio).astype(np.float32)


def contrast(good: np.ndarray, bad: np.ndarray, share: float) -> np.ndarray:
    """The log ratio of good to labelled text; n-grams that bad text never
    has are left to the raw model."""
    ratio = np.log((good + SMOOTHING) / ((good + bad) * share + SMOOTHING))
    return np.where(bad > 0, ratio, 0).astype(np.float32)


def log_ratios(model: dict, scale: float) -> list[np.ndarray]:
    """Ratios of words and pairs to the corpus, then to the labelled text."""
    ratios = [*(log_ratio(good, want) for good, _, want, _ in model.values()),
              *(scale * contrast(good, bad, share) for good, bad, _, share in model.values())]
    return [(np.round(x / STEP) * STEP).astype(np.float32) for x in ratios]


def _least(word: np.ndarray, pair: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Weight of the worst passage. The spread of a sum goes with the root of
    its terms, so a shorter text is brought to the scale of a full passage."""
    sums = np.minimum(passage_sums(word, starts), PAIR_SHARE * passage_sums(pair, starts))
    return sums * np.sqrt(PASSAGE / np.clip(np.diff(starts), 1, PASSAGE))


def _packed(spark, model):
    """Broadcast of a compressed model: each executor keeps a copy on disk."""
    import zstandard

    return spark.sparkContext.broadcast(zstandard.ZstdCompressor(level=3).compress(pickle.dumps(model)))


def _unpacked(shared):
    import zstandard

    return pickle.loads(zstandard.ZstdDecompressor().decompress(shared.value))


def _weigh_apart(shared):
    """Weights of labelled documents without their own labelled counts."""
    def run(batches):
        model = _unpacked(shared)
        for batch in sliced(batches):
            kind = np.asarray(batch.column("kind"))
            word, pair, starts = ngram_buckets(texts_of(batch))
            raw, labelled = [], []
            for part, codes in zip(PARTS, (word, pair)):
                good, bad, want, share = model[part]
                own = np.zeros(len(codes), np.int64)
                for i in np.flatnonzero(np.diff(starts)):
                    rows = slice(starts[i], starts[i + 1])
                    _, at, n = np.unique(codes[rows], return_inverse=True, return_counts=True)
                    own[rows] = n[at]
                of = np.repeat(kind, np.diff(starts))
                n_good = np.maximum(good[codes] - own * (of == 1), 0)
                n_bad = np.maximum(bad[codes] - own * (of == 2), 0)
                raw.append(log_ratio(n_good, want[codes]))
                labelled.append(contrast(n_good, n_bad, share))
            weights = (pa.array(_least(*x, starts), pa.float64(), from_pandas=True) for x in (raw, labelled))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("kind"), *weights],
                                             ["doc_id", "kind", "raw", "labelled"])
    return run


def fit_cut(docs: DataFrame, sample: DataFrame, model: dict) -> tuple[float, float]:
    """(scale of the labelled weights, cut) on the sample's documents, weighed
    as if unlabelled."""
    shared = _packed(docs.sparkSession, model)
    seen = (docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
            .select(F.col("doc_id").cast("long").alias("doc_id"), "kind", "text"))
    seen = seen.mapInArrow(freeing(_weigh_apart(shared), _INTERNED), "doc_id long, kind int, raw double, labelled double")
    scored = (seen.filter("raw IS NOT NULL").groupBy("doc_id", "kind")
              .agg(F.min("raw").alias("raw"), F.min("labelled").alias("labelled")).toArrow())  # <= sample
    good = scored["kind"].to_numpy() == 1
    if not good.any() or good.all():
        return 1.0, float("-inf")
    raw, labelled = scored["raw"].to_numpy(), scored["labelled"].to_numpy()
    cuts = [best_cut(x[good], x[~good]) for x in (raw, labelled)]
    scale = cuts[0] / cuts[1] if cuts[0] < 0 and cuts[1] < 0 else 1.0
    weight = np.minimum(raw, scale * labelled)
    return scale, best_cut(weight[good], weight[~good])


def _weigh(shared, keep):
    def run(batches):
        raw_word, raw_pair, labelled_word, labelled_pair = _unpacked(shared)
        for batch in sliced(batches):
            word, pair, starts = ngram_buckets(texts_of(batch))
            weight = np.minimum(_least(raw_word[word], raw_pair[pair], starts),
                                _least(labelled_word[word], labelled_pair[pair], starts))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(weight, pa.float64(), from_pandas=True)],
                [*keep, "log_weight"])
    return run


def weigh(docs: DataFrame, ratios: list[np.ndarray], keep: list[str]) -> DataFrame:
    shared = _packed(docs.sparkSession, ratios)
    rows = docs.select(*dict.fromkeys([*keep, "text"]))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in keep)
    return rows.mapInArrow(freeing(_weigh(shared, keep), _INTERNED), f"{fields}, log_weight double")


def best_cut(good: np.ndarray, bad: np.ndarray) -> float:
    """Weight below which a document is rejected: the middle of the widest
    stretch with the fewest errors, an error on good text counting ``5``."""
    values = np.unique(np.concatenate([good, bad]))
    cuts = np.concatenate([[values[0] - 1], (values[1:] + values[:-1]) / 2, [values[-1] + 1]])
    cost = 5 * np.searchsorted(np.sort(good), cuts) + len(bad) - np.searchsorted(np.sort(bad), cuts)
    least = np.flatnonzero(cost == cost.min())
    width = np.diff(np.concatenate([[values[0] - 1], values, [values[-1] + 1]]))
    return float(cuts[least[np.argmax(width[least])]])


def kth_largest(values: DataFrame, k: int) -> float:
    """The k-th largest of the double column ``x`` (no nulls): each round
    counts ``BINS`` bins of the range that still holds it."""
    if k < 1:
        return float("inf")
    low, high = values.agg(F.min("x"), F.max("x")).first()
    if low is None or k > values.count():
        return float("-inf")
    x = F.col("x")
    while low < high:
        width = (high - low) / BINS
        bin_of = F.least(F.floor((x - F.lit(low)) / F.lit(width)), F.lit(BINS - 1)) if width > 0 else (x > low).cast("int")
        bins = (values.filter(x.between(low, high)).groupBy(bin_of.alias("bin"))
                .agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
                .collect())  # <= BINS
        for r in sorted(bins, key=lambda r: -r["bin"]):
            if k <= r["n"]:
                break
            k -= r["n"]
        low, high = r["low"], r["high"]
    return low


def perturbed(weighed: DataFrame, cut: float) -> DataFrame:
    """``weighed`` with noisy_weight."""
    # uniform in (0, 1) from the id
    u = (F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("gumbel")), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    noise = F.when(F.col("log_weight") > F.lit(cut - CLEAR), F.lit(-TEMPERATURE) * F.log(-F.log(u))).otherwise(0.0)
    return weighed.withColumn("noisy_weight", F.col("log_weight") + noise)


def resample(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id",),
             sample: int = SAMPLE) -> DataFrame:
    """Columns ``keep`` with log_weight, noisy_weight and kept."""
    spark = prepare(docs.sparkSession)
    rows = [tuple(r) for r in labelled_sample(labels, sample).collect()]
    tags = spark.createDataFrame(rows, "doc_id long, kind int")
    model = expected(count_ngrams(docs, tags))
    scale, cut = fit_cut(docs, tags, model)
    ratios = log_ratios(model, scale)
    # two doubles a document are written, not its text
    drawn = perturbed(weigh(docs, ratios, ["doc_id"]), cut).filter("log_weight IS NOT NULL")
    drawn = materialise(drawn.select("log_weight", F.col("noisy_weight").alias("x")), "weights")
    k = drawn.filter(F.col("log_weight") > F.lit(cut)).count()
    least = kth_largest(drawn, k)
    weighed = perturbed(weigh(docs, ratios, list(dict.fromkeys([*keep, "doc_id"]))), cut)
    kept = F.coalesce(F.col("noisy_weight") >= F.lit(least), F.lit(False))
    return weighed.withColumn("kept", kept).select(*dict.fromkeys(keep), "log_weight", "noisy_weight", "kept")


def digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "log_weight", "noisy_weight", "kept")
