"""Corpus pipeline: filter, deduplicate, decontaminate, redact, tokenise.

``STAGES`` are (name, function) pairs; each function takes (spark, docs,
sf_dir) and returns a DataFrame that is written as Parquet and reread as the
next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from donorlake.llm import bpe, decontaminate, pii, resample, superminhash
from donorlake.llm.util import materialise, table

#: Columns of ``documents``; others are left behind.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier draws; the others go."""
    scored = resample.resample(docs, table(spark, sf_dir, "labels"), keep=COLUMNS)
    return scored.filter("kept").select(*COLUMNS)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles). The
    doc_id decides: an id that is kept (null counts as one) keeps all its
    texts. Of a kept row that occurs again with its doc_id, one stays; only
    the texts of such ids are compared."""
    kept = superminhash.near_duplicates(docs, k=5).filter("kept").groupBy(
        F.col("doc_id").alias("kept_id")).agg(F.count("*").alias("copies"))
    kept = materialise(kept, "kept")
    rows = docs.select(*COLUMNS)

    def those(ids: DataFrame) -> DataFrame:
        return rows.join(ids.hint("shuffle_hash"), rows["doc_id"].cast("long").eqNullSafe(ids["kept_id"]), "left_semi")

    once, again = kept.filter("copies = 1"), kept.filter("copies > 1")
    if again.isEmpty():
        return those(once)
    return those(once).union(those(again).dropDuplicates(["doc_id", "text"]))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of any benchmark item."""
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), keep=COLUMNS)
    return found.filter("NOT contaminated").select(*COLUMNS)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; n_chars follows the text."""
    found = pii.detect(docs, pii.fit(docs), keep=COLUMNS)
    return pii.redact(found).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document and whether they decode to its text. What
    is encoded is written first: no task holds an encoding and a decoding
    Python worker at once."""
    encoded = materialise(bpe.encode(docs, keep=("doc_id", "lang", "source", "text")), "encoded")
    decoded = bpe.decode(encoded, keep=("doc_id", "lang", "source", "text", "ids"))
    return decoded.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.col("raw").eqNullSafe(F.coalesce("text", F.lit("")).cast("binary")).alias("round_trip"))


STAGES = [
    ("quality_classifier", classify),
    ("near_dedup", deduplicate),
    ("decontamination", decontaminated),
    ("pii", redact),
    ("byte_bpe", tokenise),
]

#: Models trained from labels and hashed groups have no SQL form; the stages
#: are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
