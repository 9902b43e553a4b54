"""Byte-level BPE encoding and decoding by overlapping chunks.

A long text is cut into chunks that overlap, and the chunks are
pre-tokenised independently of each other (as rows dealt over the cluster).
The pre-token pattern has no look-behind, so from any position that two
tokenisations share they go on alike: neighbours are stitched at the first
boundary that both chunks have (*resynchronisation*). Where an overlap
holds no common boundary, the left tokenisation simply goes on through the
next chunk. Pieces are then merged by rank. Decoding concatenates the raw
bytes of the ids.

A boundary counts only if the chunk's end cannot have changed it
(``LOOKAHEAD`` characters of margin, the longest literal of the pattern).

Defined results: null and empty texts have no tokens; repeated rows are
encoded row by row; other columns are carried only when named in ``keep``.
"""

from __future__ import annotations

import base64
import hashlib
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from donorlake.llm.util import freeing, prepare, sliced, texts_of

CHUNK = 1 << 16
OVERLAP = 1 << 10
LOOKAHEAD = 3
CACHED_PIECES = 50_000


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def split_pattern():
    """The public split pattern; white space as the Unicode property."""
    import public_tokenizers
    import regex

    return regex.compile(
        public_tokenizers.PATTERN.replace(r"[^\s", r"[^\p{White_Space}")
        .replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}"))


def boundaries(pattern, text: str, begin: int, end: int) -> list[int]:
    """``begin`` and the ends of the pre-tokens from there that hold whatever
    follows ``end``."""
    last = len(text) if end >= len(text) else end - LOOKAHEAD
    out = [begin]
    out += (e for e in (m.end() for m in pattern.finditer(text, begin, end)) if e <= last)
    return out


def chunk_ranges(n: int, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    return [(s, min(n, s + chunk + overlap)) for s in range(0, max(n, 1), chunk)]


def stitch(pattern, text: str, chunks: list[list[int]], chunk: int = CHUNK) -> list[int]:
    """One list of boundaries of the whole text from those of its chunks."""
    out = chunks[0]
    for nxt in chunks[1:]:
        if out[-1] >= nxt[-1]:
            continue  # a pre-token reached past this chunk
        own = set(nxt)
        k = len(out) - 1
        common = -1
        while k >= 0 and out[k] >= nxt[0]:
            if out[k] in own:
                common = k
            k -= 1
        if common >= 0:
            out = out[: common + 1] + nxt[nxt.index(out[common]) + 1 :]
        else:  # no common boundary: go on from the left
            out = extend(pattern, text, out, nxt[-1])
    return extend(pattern, text, out, len(text))


def extend(pattern, text: str, out: list[int], target: int) -> list[int]:
    """Tokenise on from the last boundary until ``target`` is reached."""
    reach = CHUNK
    while out[-1] < target:
        more = boundaries(pattern, text, out[-1], min(len(text), max(target, out[-1] + reach)))
        reach *= 2
        out = out + more[1:]
    return out


class Encoder:
    """Merges of pieces by rank, with a bounded cache of frequent pieces."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern = split_pattern()
        self.encoding = tiktoken.Encoding(
            "public", pat_str=self.pattern.pattern, mergeable_ranks=ranks, special_tokens={})
        self.cache = _Pieces(self.encoding)

    def encode(self, text: str, cuts: list[int] | None = None) -> np.ndarray:
        if cuts is None:  # one chunk
            pieces = self.pattern.findall(text)
        else:
            pieces = [text[a:b] for a, b in zip(cuts, cuts[1:])]
        return np.fromiter(chain.from_iterable(map(self.cache.__getitem__, pieces)), np.int32)


class _Pieces(dict):
    def __init__(self, encoding):
        super().__init__()
        self.encoding = encoding

    def __missing__(self, piece: str) -> list[int]:
        if len(self) >= CACHED_PIECES:
            self.clear()
        ids = self.encoding.encode_ordinary(piece)
        if len(piece) <= 64:
            self[piece] = ids
        return ids


def id_lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))


def _encode_short(path, keep):
    def run(batches):
        enc = Encoder.shared(path)
        for batch in sliced(batches, limit=2 << 20):
            ids = id_lists([enc.encode(t.decode()) for t in texts_of(batch)])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), ids], [*keep, "ids"])
    return freeing(run)


def _cut_chunks(chunk, overlap, keep):
    def run(batches):
        made, part = 0, TaskContext.get().partitionId()
        for batch in sliced(batches, limit=4 << 20):
            for i, t in enumerate(texts_of(batch)):
                text = t.decode()
                ranges = chunk_ranges(len(text), chunk, overlap)
                n = len(ranges)
                # one key for the chunks of a row, also if rows repeat
                key = hashlib.blake2b(t, digest_size=12).digest() + (part << 40 | made).to_bytes(8, "big")
                made += 1
                yield pa.RecordBatch.from_arrays([
                    *(pa.concat_arrays([batch.column(c).slice(i, 1)] * n) for c in keep),
                    pa.array([key] * n, pa.binary()), pa.array(range(n), pa.int32()),
                    pa.array([a for a, _ in ranges], pa.int64()),
                    pa.array([b == len(text) for _, b in ranges]),
                    pa.array([text[a:b] for a, b in ranges], pa.string())],
                    [*keep, "__row", "__k", "__begin", "__last", "__part"])
    return run


def _pretokenise(batches):
    pattern = split_pattern()
    for batch in batches:
        cuts = []
        for begin, last, part in zip(*(batch.column(c).to_pylist() for c in ("__begin", "__last", "__part"))):
            if last:
                found = boundaries(pattern, part, 0, len(part))
            else:  # the text goes on: a character stands for what is cut off
                found = boundaries(pattern, part + "\0", 0, len(part))
            cuts.append([begin + x for x in found])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(cuts, pa.list_(pa.int64()))], [*batch.schema.names, "__cuts"])


def _join_chunks(path, chunk, keep, out):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__k")
        enc = Encoder.shared(path)
        parts = pdf["__part"].tolist()
        text = "".join(p[:chunk] for p in parts[:-1]) + parts[-1]
        cuts = stitch(enc.pattern, text, [list(map(int, c)) for c in pdf["__cuts"]], chunk)
        one = pdf.iloc[:1][keep].copy()
        if "text" in out:
            one["text"] = text
        one["ids"] = [enc.encode(text, cuts)]
        return one[[*out, "ids"]]
    return run


_SHARED: dict[str, Encoder] = {}


def _shared(path: str) -> Encoder:
    """One encoder a worker process."""
    if path not in _SHARED:
        _SHARED[path] = Encoder(path)
    return _SHARED[path]


Encoder.shared = staticmethod(_shared)


def encode(docs: DataFrame, path: str | None = None, keep: tuple[str, ...] = ("doc_id",),
           chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Columns ``keep`` and ``ids`` (array<int>) for every row of ``docs``.

    Texts of one chunk are encoded where they are read; longer ones travel
    as chunk rows, are pre-tokenised apart and stitched."""
    prepare(docs.sparkSession)
    path = path or vocabulary_path()
    rows = docs.select(*dict.fromkeys([*keep, "text"]))
    long = F.coalesce(F.length("text"), F.lit(0)) > chunk
    typed = {f.name: f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema}
    result = ", ".join([*(typed[c] for c in keep), "ids array<int>"])
    short = rows.filter(~long).mapInArrow(_encode_short(path, list(keep)), result)
    carried = [c for c in keep if c != "text"]  # the text comes back from its chunks
    cut = ", ".join([*(typed[c] for c in carried), "__row binary, __k int, __begin long, __last boolean, __part string"])
    chunks = (
        rows.filter(long).mapInArrow(_cut_chunks(chunk, overlap, carried), cut)
        .repartition("__row", "__k").mapInArrow(_pretokenise, f"{cut}, __cuts array<long>"))
    stitched = chunks.groupBy("__row").applyInPandas(_join_chunks(path, chunk, carried, list(keep)), result)
    return short.unionByName(stitched)


def _decode(path, keep):
    def run(batches):
        raw = _raw_tokens(path)
        for batch in _small(batches):
            ids = batch.column("ids")
            out = [b"".join(map(raw.__getitem__, x.tolist() if hasattr(x, "tolist") else x))
                   for x in (ids[i].values.to_numpy() for i in range(len(ids)))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(out, pa.binary())], [*keep, "raw"])
    return freeing(run)


_RAW: dict[str, list[bytes]] = {}


def _raw_tokens(path: str) -> list[bytes]:
    """Bytes of each id, once a worker process."""
    if path not in _RAW:
        with open(path, "rb") as f:
            ranks = sorted((int(b), base64.b64decode(a)) for a, b in map(bytes.split, f))
        _RAW[path] = [b""] * (ranks[-1][0] + 1)
        for i, token in ranks:
            _RAW[path][i] = token
    return _RAW[path]


def _small(batches, limit: int = 1 << 19):
    """Batches of at most ``limit`` ids (one longer document makes its own)."""
    for batch in batches:
        n = np.diff(batch.column("ids").offsets.to_numpy())
        begin, total = 0, 0
        for i, size in enumerate(n.tolist()):
            if i > begin and total + size > limit:
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += size
        if batch.num_rows:
            yield batch.slice(begin)


def decode(encoded: DataFrame, path: str | None = None, keep: tuple[str, ...] = ("doc_id", "ids")) -> DataFrame:
    """Columns ``keep`` and ``raw``, the bytes that ``ids`` stand for."""
    prepare(encoded.sparkSession)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema if f.name in keep)
    return encoded.mapInArrow(_decode(path or vocabulary_path(), list(keep)), f"{fields}, raw binary")


def digest(decoded: DataFrame) -> DataFrame:
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("raw", 256).alias("decoded_sha256"))
