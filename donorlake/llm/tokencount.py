"""Token counts by overlap resynchronisation.

Texts of one chunk are encoded where they are read. A huge text is cut into
chunks that overlap, every chunk is encoded on its own (rows dealt over the
cluster) with offsets, and neighbours are spliced at a boundary that is
*proven* stable: an edge between two pre-tokens that both encodings have. The
pre-token pattern only looks forward, and so does the search for special
strings, so from an edge both share they go on alike; the edge counts on the
left side only where the cut-off end of the left chunk cannot have moved it
(``MARGIN`` characters, longer than any literal of the pattern or special
string). An edge between tokens *inside* a pre-token proves nothing and is not
used. Chunks send only their edges inside the overlaps, never their tokens, so
splicing is a plain aggregation:

    tokens = sum over seams (left tokens before the edge - right tokens
    before it) + tokens of the last chunk.

Where a seam has no such edge (one pre-token longer than the overlap), the
document is cut again with overlaps and chunks ``WIDEN`` times as long, until
one chunk holds it all.

Defined results: null and empty texts have 0 bytes and 0 tokens; repeated rows
are counted row by row; other columns are carried only when named in ``keep``.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from donorlake.llm.util import materialise, prepare, sliced, texts_of

CHUNK = 1 << 16
OVERLAP = 1 << 9
MARGIN = 16
WIDEN = 4
#: Tokens a text may have.
LIMIT = 1024


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_TOKENIZERS: dict = {}


def tokenizer(path: str):
    """One tokenizer a worker process, as its file defines it but for begin
    and end tokens, truncation and padding. One thread: Spark gives each task
    a core."""
    if path not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        longest = max((len(a.content) for a in t.get_added_tokens_decoder().values()), default=0)
        if longest >= MARGIN:
            raise ValueError(f"special strings must be shorter than {MARGIN} characters, not {longest}")
        _TOKENIZERS[path] = t
    return _TOKENIZERS[path]


def _whole(path, keep):
    def run(batches):
        t = tokenizer(path)
        for batch in sliced(batches, limit=2 << 20):
            texts = texts_of(batch)
            found = t.encode_batch_fast([x.decode() for x in texts], add_special_tokens=False)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array([len(x) for x in texts], pa.int64()),
                 pa.array([len(e) for e in found], pa.int64())], [*keep, "n_bytes", "n_tokens"])
    return run


def chunk_starts(n: int, chunk: int, overlap: int) -> range:
    """Where chunks of ``chunk + overlap`` characters begin; the last one
    reaches the end of the text."""
    return range(0, max(n - overlap, 1), chunk)


def _cut(chunk, overlap):
    def run(batches):
        for batch in batches:
            for row, text in zip(batch.column("__row").to_pylist(), batch.column("text").to_pylist()):
                starts = chunk_starts(len(text), chunk, overlap)
                for first in range(0, len(starts), 16):
                    some = starts[first : first + 16]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([row] * len(some), pa.int64()),
                        pa.array(range(first, first + len(some)), pa.int32()),
                        pa.array(list(some), pa.int64()),
                        pa.array([a == starts[-1] for a in some]),
                        pa.array([text[a : a + chunk + overlap] for a in some], pa.string())],
                        ["__row", "k", "begin", "last", "part"])
    return run


def edges(t, text: str) -> tuple[np.ndarray, np.ndarray, int]:
    """Where the pre-tokens of ``text`` begin, the tokens before each, and
    the number of tokens."""
    e = t.encode(text, add_special_tokens=False)
    words = np.array(e.word_ids, np.int64)
    first = np.flatnonzero(np.diff(words, prepend=-1))
    at = np.array([a for a, _ in e.offsets], np.int64)[first] if len(words) else words
    return at, first, len(words)


_SEAMS = "__row long, seam int, at long, n long, is_left boolean, last_n long"


def _encode_chunks(path, chunk, overlap):
    def run(batches):
        t = tokenizer(path)
        for batch in batches:
            for row, k, begin, last, part in zip(*(batch.column(i).to_pylist() for i in range(5))):
                at, n, total = edges(t, part)
                head, tail = at <= overlap, at >= chunk
                tail &= at <= len(part) - MARGIN
                here = ([] if k == 0 else [(k, at[head], n[head], False)]) + (
                    [] if last else [(k + 1, at[tail], n[tail], True)])
                for seam, where, before, is_left in here:
                    m = len(where)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(m, row), pa.int64()), pa.array(np.full(m, seam), pa.int32()),
                        pa.array(where + begin, pa.int64()), pa.array(before, pa.int64()),
                        pa.array(np.full(m, is_left)), pa.nulls(m, pa.int64())],
                        ["__row", "seam", "at", "n", "is_left", "last_n"])
                if last:  # k seams are needed
                    yield pa.RecordBatch.from_arrays([
                        pa.array([row], pa.int64()), pa.array([k], pa.int32()), pa.nulls(1, pa.int64()),
                        pa.nulls(1, pa.int64()), pa.nulls(1, pa.bool_()), pa.array([total], pa.int64())],
                        ["__row", "seam", "at", "n", "is_left", "last_n"])
    return run


def splice(huge: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """(__row, n_tokens) of the texts whose seams all have a stable edge."""
    found = (
        huge.select("__row", "text")
        .mapInArrow(_cut(chunk, overlap), "__row long, k int, begin long, last boolean, part string")
        .repartition("__row", "k").mapInArrow(_encode_chunks(path, chunk, overlap), _SEAMS))
    at_edge = found.groupBy("__row", "seam", "at").agg(
        F.max(F.when(F.col("is_left"), F.col("n"))).alias("left_n"),
        F.max(F.when(~F.col("is_left"), F.col("n"))).alias("right_n"),
        F.max("last_n").alias("last_n"))
    seams = at_edge.groupBy("__row", "seam").agg(
        F.min_by(F.col("left_n") - F.col("right_n"),
                 F.when(F.col("left_n").isNotNull() & F.col("right_n").isNotNull(), F.col("at"))).alias("skip"),
        F.max("last_n").alias("last_n"))
    return (
        seams.groupBy("__row").agg(
            F.count("skip").alias("spliced"), F.sum("skip").alias("skip"), F.max("last_n").alias("last_n"),
            F.max(F.when(F.col("last_n").isNotNull(), F.col("seam"))).alias("needed"))
        .filter("spliced = needed")
        .select("__row", (F.coalesce("skip", F.lit(0)) + F.col("last_n")).alias("n_tokens")))


def count_tokens(docs: DataFrame, path: str | None = None, keep: tuple[str, ...] = ("doc_id",),
                 limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Columns ``keep`` with n_bytes, n_tokens and over_limit of every row."""
    prepare(docs.sparkSession)
    path = path or vocabulary_path()
    rows = docs.select(*dict.fromkeys([*keep, "text"]))
    huge = F.coalesce(F.length("text"), F.lit(0)) > chunk + overlap
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in keep),
                        "n_bytes long, n_tokens long"])
    result = rows.filter(~huge).mapInArrow(_whole(path, list(keep)), schema)
    # row numbers must not change when a task runs again, so they are written
    pending = long_rows = materialise(
        rows.filter(huge).withColumns({"__row": F.monotonically_increasing_id(),
                                       "n_bytes": F.octet_length("text").cast("long")}), "huge")
    while not pending.isEmpty():
        done = materialise(splice(pending, path, chunk, overlap), "spliced")
        result = result.unionByName(
            long_rows.join(done, "__row").select(*keep, "n_bytes", "n_tokens"))
        pending = pending.join(done, "__row", "left_anti")
        chunk, overlap = chunk * WIDEN, overlap * WIDEN
    return result.withColumn("over_limit", F.col("n_tokens") > limit)


def digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def brute_force(docs: list[tuple], path: str | None = None, limit: int = LIMIT) -> list[tuple]:
    """Reference answer for tests: the library on whole texts."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path or vocabulary_path())
    out = []
    for doc_id, text in docs:
        n = len(t.encode(text or "", add_special_tokens=False).ids)
        out.append((doc_id, len((text or "").encode()), n, n > limit))
    return out
