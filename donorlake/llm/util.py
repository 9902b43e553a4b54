"""Shared helpers of the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from donorlake.session import apply_defaults, scratch_path

#: Rows handed to a Python task at once. Documents may be long, so a batch
#: is kept far below Spark's default of 10,000 rows.
ARROW_ROWS = 1000
ARROW_BYTES = 16 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of this subpackage: small Arrow batches."""
    apply_defaults(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark removes the shuffle files of a job when the job has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: a lineage
    cut that survives lost executors. The shuffle files below it are of no
    more use and go at once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    return spark.read.schema(df.schema).parquet(path)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def sliced(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds at most ``limit`` text bytes (one
    longer document makes a batch of its own)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0))
        begin, total = 0, 0
        for i in range(n):
            if i > begin and total + int(sizes[i]) > limit:
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += int(sizes[i])
        yield batch.slice(begin, n - begin)


_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bit mixer of unsigned 64-bit values (a bijection)."""
    x = x ^ (x >> _S33)
    x = x * _M1
    x ^= x >> _S33
    x = x * _M2
    x ^= x >> _S33
    return x


class Interner(dict):
    """word -> 64-bit hash, each word hashed once per task."""

    def __init__(self, limit: int = 150_000):
        import xxhash

        super().__init__()
        self._hash, self._limit = xxhash.xxh3_64_intdigest, limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self._limit:
            self.clear()
        h = self[word] = self._hash(word)
        return h

    def ids(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def trim() -> None:
    """Give the free pages of the C heap back, where the library can (glibc):
    one live object above them keeps them with the process otherwise."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def freeing(run, *caches):
    """``run`` over a task's batches, giving memory back when it ends: Python
    workers stay idle beside the JVM while it shuffles."""
    def whole(batches):
        try:
            yield from run(batches)
        finally:
            for c in caches:
                c.clear()
            pa.default_memory_pool().release_unused()
            trim()
    return whole


#: A-Z to a-z, every other byte unchanged.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
