"""Quality rules with adaptive thresholds.

One pass computes each document's rule values. Their distribution for each
(language, source) is kept as a mergeable quantile sketch: counts of
logarithmic bins of relative width ``GAMMA`` - 1, so two sketches merge by
adding counts and a quantile is right to about half a bin. Sketches are
partial-aggregated before the shuffle, and a group has a bounded number of
bins. A group of fewer than ``MIN_GROUP`` documents takes the merged sketch
of its language. The thresholds (fences: quartile -/+ ``REACH`` x spread,
the spread at least a floor) are joined back and replace fixed cutoffs.

Defined results: a null or empty text has no words and fails the base rule;
null language or source is a group of its own, named ''; repeated rows are
judged row by row; other columns are ignored; no documents, no rows.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from donorlake.llm.util import materialise, mix64, prepare, sliced, texts_of

GAMMA = 1.02
REACH = 3.0
MIN_GROUP = 100
MIN_WORDS = 50
MAX_REPEAT_PCT = 50

#: rule -> (numerator, denominator, smallest spread, lower fence too)
RULES = {
    "word_length": ("word_chars", "n_words", 1.0, True),
    "symbols": ("n_symbols", "n_words", 0.1, False),
    "dup_lines": ("n_dup_lines", "n_lines", 0.2, False),
    "repeats": ("n_repeat_words", "n_words", 0.1, False),
}

_SPACE_AND_TAILS = b" \t\n\x0b\x0c\r" + bytes(range(0x80, 0xC0))
_SYMBOLS = b"#*$%&|<>"
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class _Ids(dict):
    def __missing__(self, word):
        n = self[word] = len(self)
        return n


def repeated_words(docs: list[list[bytes]]) -> np.ndarray:
    """Words of each document inside 3-word windows that it holds twice."""
    ids, sizes = _Ids(), np.array([len(d) for d in docs], np.int64)
    flat = np.concatenate([
        np.empty(0, np.uint64), *(np.fromiter(map(ids.__getitem__, d), np.uint64, len(d)) for d in docs)])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    doc = np.repeat(np.arange(len(docs)), sizes)
    covered = np.zeros(len(flat) + 1, np.int64)
    if len(flat) >= 3:
        inside = np.flatnonzero(doc[2:] == doc[:-2])
        code = mix64(flat[inside] + doc[inside].astype(np.uint64) * _GOLDEN)
        code = mix64(code + flat[inside + 1])
        code = mix64(code * _GOLDEN + flat[inside + 2])
        order = np.argsort(code)
        same = code[order][1:] == code[order][:-1]
        again = np.zeros(len(code), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        at = inside[again]
        np.add.at(covered, at, 1)
        np.add.at(covered, at + 3, -1)
    total = np.concatenate([[0], np.cumsum(np.cumsum(covered)[:-1] > 0)])
    return total[starts[1:]] - total[starts[:-1]]


def line_counts(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them equal to an earlier line."""
    lines = Counter(text.split(b"\n"))
    filled = [(n, line) for line, n in lines.items() if line.strip(b" \t\n\x0b\x0c\r")]
    return sum(n for n, _ in filled), sum(n - 1 for n, _ in filled)


def _measure(batches):
    for batch in sliced(batches):
        texts = texts_of(batch)
        docs = [t.split() for t in texts]
        lines = [line_counts(t) for t in texts]
        long = lambda x: pa.array(x, pa.int64())
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), batch.column("lang"), batch.column("source"),
            long([len(d) for d in docs]),
            long([len(t.translate(None, _SPACE_AND_TAILS)) for t in texts]),
            long([len(t) - len(t.translate(None, _SYMBOLS)) for t in texts]),
            long([a for a, _ in lines]), long([b for _, b in lines]),
            long(repeated_words(docs))],
            ["doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_lines",
             "n_dup_lines", "n_repeat_words"])


def measure(docs: DataFrame) -> DataFrame:
    """Rule values of every document, from its whole text."""
    prepare(docs.sparkSession)
    rows = docs.select("doc_id", "text", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
                       F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"))
    doc_id = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_measure, f"doc_id {doc_id}, lang string, source string, n_words long, "
                           "word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long")


def sketch(values: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Mergeable quantile sketch: documents by logarithmic bin (null bin:
    zero and below)."""
    bin_ = F.when(F.col(value) > 0, F.ceil(F.log(F.col(value)) / F.lit(float(np.log(GAMMA)))))
    return values.groupBy(*keys, bin_.alias("bin")).agg(F.count("*").alias("n"))


def merge(sketches: DataFrame, keys: list[str]) -> DataFrame:
    return sketches.groupBy(*keys, "bin").agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, keys: list[str], qs: dict[str, float]) -> DataFrame:
    """Quantiles named ``qs`` and the number of values ``total``, by key."""
    from pyspark.sql import Window

    by = Window.partitionBy(*keys)
    run = by.orderBy(F.col("bin").asc_nulls_first())
    ranked = sketches.withColumns({
        "upto": F.sum("n").over(run), "total": F.sum("n").over(by),
        "value": F.coalesce(F.lit(2 / (GAMMA + 1)) * F.pow(F.lit(GAMMA), F.col("bin")), F.lit(0.0))})
    return ranked.groupBy(*keys).agg(
        F.max("total").alias("total"),
        *(F.min(F.when(F.col("upto") > F.floor(F.lit(q) * (F.col("total") - 1)), F.col("value"))).alias(name)
          for name, q in qs.items()))


def thresholds(values: DataFrame) -> DataFrame:
    """lang, source, rule, low, high for every group of ``values``."""
    long = values.filter("n_words > 0").select(
        "lang", "source",
        F.explode(F.array(*(
            F.struct(F.lit(name).alias("rule"),
                     (F.col(a) / F.greatest(F.col(b), F.lit(1))).alias("value"))
            for name, (a, b, _, _) in RULES.items()))).alias("r")).select("lang", "source", "r.rule", "r.value")
    fine = sketch(long, ["lang", "source", "rule"], "value")
    qs = {"q1": 0.25, "q3": 0.75}
    own = quantiles(fine, ["lang", "source", "rule"], qs)
    lang = quantiles(merge(fine, ["lang", "rule"]), ["lang", "rule"], {"l1": 0.25, "l3": 0.75}).drop("total")
    floor = F.create_map(*(F.lit(x) for name, r in RULES.items() for x in (name, r[2])))
    low = F.create_map(*(F.lit(x) for name, r in RULES.items() for x in (name, r[3])))
    own_group = F.col("total") >= MIN_GROUP
    q1, q3 = F.when(own_group, F.col("q1")).otherwise(F.col("l1")), F.when(own_group, F.col("q3")).otherwise(F.col("l3"))
    spread = F.lit(REACH) * F.greatest(q3 - q1, floor[F.col("rule")])
    return own.join(lang, ["lang", "rule"]).select(
        "lang", "source", "rule", F.when(low[F.col("rule")], q1 - spread).alias("low"), (q3 + spread).alias("high"))


def quality_rules(docs: DataFrame) -> DataFrame:
    """Every document with its rule values, base_failed, failed (names of the
    adaptive rules it breaks) and kept."""
    values = materialise(measure(docs), "quality-values")
    limits = thresholds(values).groupBy("lang", "source").agg(
        F.map_from_entries(F.collect_list(F.struct("rule", F.struct("low", "high")))).alias("limits"))
    joined = values.join(limits, ["lang", "source"], "left")
    broken = []
    for name, (a, b, _, _) in RULES.items():
        x, lim = F.col(a) / F.greatest(F.col(b), F.lit(1)), F.col("limits")[name]
        bad = F.coalesce((x > lim["high"]) | F.coalesce(x < lim["low"], F.lit(False)), F.lit(False))
        broken.append(F.when(bad, F.lit(name)))
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    return joined.withColumns({
        "base_failed": base, "failed": F.array_compact(F.array(*broken)),
    }).withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0)).drop("limits")


def digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")
