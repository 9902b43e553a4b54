"""Language identification with a byte convolutional network.

The network reads windows of ``WINDOW`` bytes: byte embeddings, filters of
several widths, a max pool over the window, softmax. It is trained in numpy
on the driver on a bounded sample of labelled text (``SAMPLE`` documents a
language, the least by a hash of their id, so the sample does not depend on
file order) and applied in batches to *every* window of every text; the
windows' log probabilities are averaged.

Text is lower-cased for A-Z and only letters are scored: bytes that are no
letter become one space, so digits, symbols and mark-up carry no language.

Defined results: null text, and text without letters, is ``und`` with score
0; language labels that are null are never learned; with no labelled row to
learn from everything is ``und``; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from donorlake.llm.util import prepare, sliced, texts_of

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
EMBED = 8
SAMPLE = 400
PIECES = 16
EPOCHS = 6
BATCH = 64
RATE = 0.01
UNKNOWN = "und"

#: Bytes that separate: everything in ASCII but letters; A-Z become a-z.
LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def plain(text: str) -> bytes:
    """Letters of a text as UTF-8, runs of anything else as one space."""
    if not text.isascii():
        text = "".join(c if c.isalpha() or c.isascii() else " " for c in text)
    return b" ".join(text.encode().translate(LETTERS).split())


def windows(text: bytes, size: int = WINDOW) -> np.ndarray:
    """[windows, size] bytes that cover ``text``; the last one is padded."""
    n = -(-len(text) // size)
    return np.frombuffer(text.ljust(n * size, b" "), np.uint8).reshape(n, size)


@dataclass
class Network:
    langs: list[str]
    embed: np.ndarray  # [256, EMBED]
    filters: np.ndarray  # [4 * EMBED, filters]: shorter filters are zero at the end
    bias: np.ndarray
    out: np.ndarray  # [filters, languages]
    out_bias: np.ndarray

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Filter maxima of each window [windows, filters] and the inputs of
        all filter positions [windows, positions, width * EMBED]."""
        n, size = x.shape
        e = self.embed[x]
        wide = max(WIDTHS)
        places = size - wide + 1
        seen = np.lib.stride_tricks.sliding_window_view(e.reshape(n, size * EMBED), wide * EMBED, 1)[:, ::EMBED]
        seen = np.ascontiguousarray(seen)
        return (seen.reshape(n * places, -1) @ self.filters).reshape(n, places, -1), seen

    def log_probs(self, x: np.ndarray) -> np.ndarray:
        act, _ = self.pooled(x)
        top = np.maximum(act.max(1) + self.bias, 0)
        z = top @ self.out + self.out_bias
        z = z - z.max(1, keepdims=True)
        return z - np.log(np.exp(z).sum(1, keepdims=True))


def _mask() -> np.ndarray:
    """Which weights of the widest filter each filter has."""
    wide = max(WIDTHS)
    cols = [np.repeat(np.arange(wide) < w, EMBED) for w in WIDTHS for _ in range(FILTERS)]
    return np.stack(cols, axis=1).astype(np.float32)


def train(x: np.ndarray, y: np.ndarray, langs: list[str], seed: int = 7) -> Network:
    """Adam on cross entropy; ``x`` windows [n, WINDOW], ``y`` class indices."""
    rng = np.random.default_rng(seed)
    mask, n_filters = _mask(), FILTERS * len(WIDTHS)
    net = Network(
        langs, rng.normal(0, 0.5, (256, EMBED)).astype(np.float32),
        (rng.normal(0, 0.3, mask.shape) * mask).astype(np.float32), np.zeros(n_filters, np.float32),
        rng.normal(0, 0.3, (n_filters, len(langs))).astype(np.float32), np.zeros(len(langs), np.float32))
    names = ["embed", "filters", "bias", "out", "out_bias"]
    first = {k: np.zeros_like(getattr(net, k)) for k in names}
    second = {k: np.zeros_like(getattr(net, k)) for k in names}
    weight = np.bincount(y, minlength=len(langs)).astype(np.float32)
    weight = weight.sum() / np.maximum(weight, 1) / len(langs)
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(x), BATCH):
            rows = order[at : at + BATCH]
            xb, yb = x[rows], y[rows]
            act, seen = net.pooled(xb)
            best = act.argmax(1)  # [rows, filters]
            top = np.take_along_axis(act, best[:, None, :], 1)[:, 0] + net.bias
            hidden = np.maximum(top, 0)
            z = hidden @ net.out + net.out_bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(yb)), yb] -= 1
            p *= (weight[yb] / len(yb))[:, None]
            grad = {"out": hidden.T @ p, "out_bias": p.sum(0)}
            d = (p @ net.out.T) * (top > 0)
            grad["bias"] = d.sum(0)
            inputs = seen[np.arange(len(yb))[:, None], best]  # [rows, filters, width * EMBED]
            grad["filters"] = np.einsum("rfi,rf->if", inputs, d) * mask
            back = np.einsum("if,rf->rfi", net.filters, d).reshape(len(yb), n_filters, max(WIDTHS), EMBED)
            where = xb[np.arange(len(yb))[:, None, None], best[:, :, None] + np.arange(max(WIDTHS))]
            g = np.zeros_like(net.embed)
            np.add.at(g, where.ravel(), back.reshape(-1, EMBED))
            grad["embed"] = g
            step += 1
            for k in names:
                first[k] = 0.9 * first[k] + 0.1 * grad[k]
                second[k] = 0.999 * second[k] + 0.001 * grad[k] ** 2
                move = RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                setattr(net, k, (getattr(net, k) - move).astype(np.float32))
    return net


def training_sample(docs: DataFrame, sample: int = SAMPLE) -> list[tuple[str, str]]:
    """(lang, text) of at most ``sample`` documents a language, the least by
    a hash of doc_id: ``PIECES`` pieces spread over the whole text of each."""
    known = docs.filter("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
    langs = [r["lang"] for r in known.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()]
    by, ids = F.xxhash64(F.col("doc_id").cast("string")), []
    for lang in langs:
        rows = known.filter(F.col("lang") == lang).select("doc_id", by.alias("h"))
        ids += [r["doc_id"] for r in rows.orderBy("h", "doc_id").limit(sample).collect()]
    pieces = F.transform(F.sequence(F.lit(0), F.lit(PIECES - 1)), lambda i: F.substring(
        "text", (F.floor(i * F.length("text") / PIECES) + 1).cast("int"),
        F.least(F.lit(WINDOW), F.ceil(F.length("text") / PIECES)).cast("int")))
    picked = known.filter(F.col("doc_id").isin(ids)).select("lang", F.array_join(pieces, "").alias("t"))
    # a repeated doc_id brings more rows than ids: the bound still holds
    return sorted((r["lang"], r["t"]) for r in picked.limit(2 * sample * max(1, len(langs))).collect())


def fit(docs: DataFrame, sample: int = SAMPLE) -> Network | None:
    """A network for the languages of ``docs`` (text, lang)."""
    prepare(docs.sparkSession)
    rows = training_sample(docs, sample)
    langs = sorted({lang for lang, _ in rows})
    xs, ys = [], []
    for lang, text in rows:
        w = windows(plain(text))
        # what is short of a window counts as little as it holds
        w = w[: max(1, len(plain(text)) // WINDOW)]
        xs.append(w)
        ys += [langs.index(lang)] * len(w)
    if not ys:
        return None
    return train(np.concatenate(xs), np.array(ys), langs)


def _predict(net, keep):
    def run(batches):
        for batch in sliced(batches, limit=4 << 20):
            texts = [plain(t.decode()) for t in texts_of(batch)]
            cut = [windows(t) for t in texts]
            n = np.array([len(c) for c in cut])
            model = net.value
            lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if model is not None and n.sum():
                flat = np.concatenate(cut)
                logs = np.concatenate([model.log_probs(flat[i : i + 256]) for i in range(0, len(flat), 256)])
                # a padded last window counts by the bytes it has
                part = np.concatenate([np.minimum(WINDOW, len(t) - WINDOW * np.arange(k)) for t, k in zip(texts, n)])
                logs = logs * (part / WINDOW)[:, None]
                total = np.concatenate([[0], np.cumsum(n)])
                for i in np.flatnonzero(n):
                    z = logs[total[i] : total[i + 1]].sum(0) / part[total[i] : total[i + 1]].sum() * WINDOW
                    p = np.exp(z - z.max())
                    p /= p.sum()
                    best = int(p.argmax())
                    lang[i], score[i] = model.langs[best], float(p[best])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                [*keep, "lang_pred", "score"])
    return run


def predict(docs: DataFrame, net: Network | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep``, lang_pred and score of every row; only ``text`` is
    read by the network."""
    spark = prepare(docs.sparkSession)
    rows = docs.select(*keep, "text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in keep)
    shared = spark.sparkContext.broadcast(net)  # a few thousand weights
    return rows.mapInArrow(_predict(shared, list(keep)), f"{fields}, lang_pred string, score double")


def held_out() -> F.col:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def language_id(docs: DataFrame) -> DataFrame:
    """Learns from the rows that are not held out and predicts all."""
    net = fit(docs.filter(~held_out()).select("doc_id", "text", "lang"))
    return predict(docs, net).withColumn("held_out", held_out())


def digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "held_out", "lang_pred", "score")
