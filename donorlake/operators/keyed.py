"""Keyed tables: merges that touch only what they must (SNK4, SNK5).

A table is a set of immutable Parquet files and a chain of versions. A
version's manifest has one row a file: its rows, the range of its key hashes,
a Bloom filter of them and the share of its rows that are deleted. Deleted
rows are named by (file, row number) beside it.

    <path>/data/<batch>/          files, sorted by key hash in ``buckets`` ranges
    <path>/versions/<n>/files     the manifest
    <path>/versions/<n>/deletes   deleted rows of its files
    <path>/versions/<n>/about     key and bucket count

A merge writes its rows as new files, finds the rows that they replace in the
files whose range and filter admit one of its keys (only the key columns of
these are read), and writes the next version. Nothing is rewritten until more
than ``COMPACT`` of a file is deleted; then its remaining rows move to a new
file. A version is a folder that is renamed into place when it is complete:
readers see the old table or the new one, and of two writers one fails.

A row without a key is identified by all its columns, so a batch that runs
again replaces its rows, with or without keys.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from donorlake.session import shuffles_freed

BUCKETS = 16
#: Rows of a file: the unit that is read for a key, and compacted.
FILE_ROWS = 1_000_000
#: Bits of a Bloom filter for each row; three probes give 3 % false hits.
BLOOM_BITS = 8
COMPACT = 0.3
#: An append of more than ``FILE_ROWS`` rows goes through the key hash in shares,
#: so many at most, and frees a share's shuffles before the next.
SHARES = 8
#: One of so many hashes is tried first where there are many.
FEW = 64
KEPT_VERSIONS = 3
_HASH = "_key_hash"

_FILES = "file string, n long, lo long, hi long, bloom binary, deleted long"


class MergeConflict(RuntimeError):
    """Another writer has made the next version."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm.org.apache.hadoop.fs.Path


def version(spark: SparkSession, path: str) -> int | None:
    """The newest complete version, None where there is no table."""
    fs, p, _ = _fs(spark, f"{path}/versions")
    if not fs.exists(p):
        return None
    return max((int(s.getPath().getName()) for s in fs.listStatus(p) if s.getPath().getName().isdigit()), default=None)


def _part(spark: SparkSession, path: str, v: int, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/versions/{v}/{name}")


def files_of(spark: SparkSession, path: str, v: int) -> DataFrame:
    return spark.read.schema(_FILES).parquet(f"{path}/versions/{v}/files")


def _deletes(spark: SparkSession, path: str, v: int) -> DataFrame:
    return spark.read.schema("file string, row long").parquet(f"{path}/versions/{v}/deletes")


def _read_files(spark: SparkSession, schema: T.StructType, files: Sequence[str]) -> DataFrame:
    """Rows of some files with their place, (``_file``, ``_row``)."""
    df = spark.read.schema(schema).parquet(*files)
    return df.withColumns({"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")})


def _live(spark: SparkSession, path: str, v: int, files: Sequence[str], schema: T.StructType, deleted: bool) -> DataFrame:
    rows = _read_files(spark, schema, files)
    if deleted:
        gone = _deletes(spark, path, v).select(F.col("file").alias("_f"), F.col("row").alias("_r"))
        rows = rows.join(gone, (F.col("_file") == F.col("_f")) & (F.col("_row") == F.col("_r")), "left_anti")
    return rows


def _about(spark: SparkSession, path: str, v: int) -> tuple[str, int, T.StructType]:
    row = _part(spark, path, v, "about").first()
    return row["key"], row["buckets"], T.StructType.fromJson(json.loads(row["schema"]))


def keyed(spark: SparkSession, path: str, v: int | None = None) -> DataFrame | None:
    """The table's rows (of version ``v``), None where nothing was written."""
    v = version(spark, path) if v is None else v
    if v is None:
        return None
    _, _, schema = _about(spark, path, v)
    cols = [c for c in schema.names if c != _HASH]
    # file names are the table's metadata, one entry a file; whole files and
    # files with deleted rows are read apart, so the former meet no join
    named = files_of(spark, path, v).select("file", "deleted").collect()
    parts = []
    for some, deleted in (([r["file"] for r in named if not r["deleted"]], False),
                          ([r["file"] for r in named if r["deleted"]], True)):
        if some:
            parts.append(_live(spark, path, v, some, schema, deleted).select(*cols))
    if not parts:
        return spark.createDataFrame([], schema).select(*cols)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


# ------------------------------------------------------------ files

def _hashed(df: DataFrame, key: str) -> DataFrame:
    whole = F.xxhash64(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}))
    return df.withColumn(_HASH, F.when(F.col(key).isNotNull(), F.xxhash64(key)).otherwise(whole))


def _keys(df: DataFrame, key: str) -> DataFrame:
    """Hashes and keys alone (a key in a struct, so no key equals no key): of
    a row with a key nothing else is read."""
    kept = [_HASH, F.struct(key).alias("_k")]
    named = df.filter(F.col(key).isNotNull()).withColumn(_HASH, F.xxhash64(key)).select(*kept)
    return named.unionByName(_hashed(df.filter(F.col(key).isNull()), key).select(*kept))


def _bucket(buckets: int, hashed: str = _HASH):
    """Ranges of the key hash of equal width."""
    share = f"cast({hashed} as double) / 18446744073709551616.0 + 0.5"
    return F.expr(f"least(cast(floor(({share}) * {buckets}) as int), {buckets - 1})")


def _write_files(rows: DataFrame, folder: str, buckets: int) -> None:
    """Files of one hash range each: a large range is split over tasks by the
    rebalance and every file is sorted, so files hold narrow ranges. Without
    buckets the rows are in one range and dealt already."""
    dealt = rows.withColumn("_b", _bucket(buckets)).hint("rebalance", "_b") if buckets else rows.withColumn("_b", F.lit(0))
    (dealt.sortWithinPartitions("_b", _HASH).drop("_b")
     .write.mode("overwrite").option("maxRecordsPerFile", FILE_ROWS).option("compression", "zstd").parquet(folder))


def bloom_of(hashes: np.ndarray, bits: int = BLOOM_BITS) -> bytes:
    size = max(64, 8 * -(-len(hashes) * bits // 8))
    out = np.zeros(size, bool)
    for at in _probes(hashes, size):
        out[at] = True
    return np.packbits(out).tobytes()


def _probes(hashes: np.ndarray, size: int):
    h = hashes.astype(np.uint64)
    a, b = h & np.uint64(0xFFFFFFFF), h >> np.uint64(32)
    return [((a + np.uint64(i) * b) % np.uint64(size)).astype(np.int64) for i in range(3)]


def may_hold(bloom: bytes, hashes: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(bloom, np.uint8))
    found = np.ones(len(hashes), bool)
    for at in _probes(hashes, len(bits)):
        found &= bits[at].astype(bool)
    return found


def _describe(spark: SparkSession, *folders: str) -> DataFrame:
    """Manifest rows of the files of some folders: a file has at most
    ``FILE_ROWS`` rows, so a group of its hashes is bounded."""
    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        h = pdf[_HASH].to_numpy()
        return pd.DataFrame({"file": [pdf["file"].iloc[0]], "n": [len(h)], "lo": [h.min()], "hi": [h.max()],
                             "bloom": [bloom_of(h)], "deleted": [0]})

    hashes = spark.read.parquet(*folders).select(F.col("_metadata.file_path").alias("file"), _HASH)
    return hashes.groupBy("file").applyInPandas(one, _FILES)


def candidates(files: DataFrame, hashes: DataFrame, buckets: int, many: bool = False) -> list[str]:
    """Files that may hold one of the hashes, by range and Bloom filter. Both
    sides meet by hash range; no other file of the table is opened. Of many
    hashes a few find most files; all of them are sent only for the others."""
    if many:
        found = candidates(files, hashes.filter(F.col(_HASH) % FEW == 0), buckets)
        files = files.filter("n > deleted").join(files.sparkSession.createDataFrame([(f,) for f in found], "file string"), "file", "left_anti")
        return found if files.isEmpty() else found + candidates(files, hashes, buckets)
    spread = files.filter("n > deleted").select(
        "file", "lo", "hi", "bloom", F.explode(F.sequence(_bucket(buckets, "lo"), _bucket(buckets, "hi"))).alias("_b"))
    wanted = hashes.select(_HASH, _bucket(buckets).alias("_b")).distinct()

    def test(key, some: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
        h = np.sort(keys[_HASH].to_numpy())
        hit = []
        for f, lo, hi, bloom in zip(some["file"], some["lo"], some["hi"], some["bloom"]):
            inside = h[np.searchsorted(h, lo) : np.searchsorted(h, hi, "right")]
            if len(inside) and may_hold(bloom, inside).any():
                hit.append(f)
        return pd.DataFrame({"file": hit}, dtype=object)

    found = spread.groupBy("_b").cogroup(wanted.groupBy("_b")).applyInPandas(test, "file string")
    return [r["file"] for r in found.distinct().collect()]  # file names: metadata


# ------------------------------------------------------------ versions

def _commit(spark: SparkSession, path: str, v: int, files: DataFrame, deletes: DataFrame | None, key: str,
            buckets: int, schema: T.StructType) -> None:
    aside = f"{path}/versions/_{uuid.uuid4().hex}"
    files.write.parquet(f"{aside}/files")
    kept = spark.read.schema(_FILES).parquet(f"{aside}/files").select("file")
    (spark.createDataFrame([], "file string, row long") if deletes is None
     else deletes.join(kept, "file", "left_semi")).write.parquet(f"{aside}/deletes")
    spark.createDataFrame([(key, buckets, schema.json())], "key string, buckets int, schema string").write.parquet(f"{aside}/about")
    fs, source, new = _fs(spark, aside)
    target = new(f"{path}/versions/{v}")
    # a folder that exists would take the source inside itself
    if fs.exists(target) or not fs.rename(source, target) or fs.exists(new(f"{path}/versions/{v}/{source.getName()}")):
        raise MergeConflict(f"{path}: version {v} was written by another merge")


def vacuum(spark: SparkSession, path: str, keep: int = KEPT_VERSIONS) -> int:
    """Remove versions before the newest ``keep`` and data folders that none
    of the others names; the number of folders removed."""
    fs, p, new = _fs(spark, f"{path}/versions")
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    numbers = sorted(int(n) for n in names if n.isdigit())
    held = numbers[-keep:]
    used = {r["batch"] for v in held for r in files_of(spark, path, v).select(
        F.element_at(F.split("file", "/"), -2).alias("batch")).distinct().collect()}
    gone = [f"{path}/versions/{v}" for v in numbers if v not in held]
    gone += [f"{path}/data/{s.getPath().getName()}" for s in fs.listStatus(new(f"{path}/data"))
             if s.getPath().getName() not in used]
    for g in gone:
        fs.delete(new(g), True)
    return len(gone)


def _first(new: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    spark = new.sparkSession
    folder = f"{path}/data/{uuid.uuid4().hex}"
    rows = _hashed(new, key)
    _write_files(rows, folder, buckets)
    _commit(spark, path, 1, _describe(spark, folder), None, key, buckets, rows.schema)
    return keyed(spark, path)


def _open(spark: SparkSession, path: str, key: str, buckets: int | None) -> tuple[int, int, T.StructType] | None:
    v = version(spark, path)
    if v is None:
        return None
    own_key, own_buckets, schema = _about(spark, path, v)
    if own_key != key or buckets not in (None, own_buckets):
        raise ValueError(f"{path} has key {own_key!r} and {own_buckets} buckets, not {key!r} and {buckets}")
    return v, own_buckets, schema


def _same(key: str):
    """Equal keys; rows without one are equal by the hash of all columns."""
    return (F.col(f"o.{_HASH}") == F.col(f"i.{_HASH}")) & F.col(f"o.{key}").eqNullSafe(F.col(f"i.{key}"))


def merge_replace(new: DataFrame, path: str, key: str, high_water: str | None = None,
                  buckets: int | None = None) -> DataFrame:
    """SNK4: delete the rows whose key occurs in ``new`` and insert ``new``.
    With ``high_water`` only rows of ``new`` at or above the table's largest
    value there are taken (late rows of the top value, and a row with a NULL
    there, are always taken). A table keeps the bucket count it was made with;
    another one is refused."""
    spark = new.sparkSession
    found = _open(spark, path, key, buckets)
    if found is None:
        return _first(new, path, key, buckets or BUCKETS)
    v, buckets, schema = found
    if high_water:
        top = keyed(spark, path, v).agg(F.max(high_water)).first()[0]
        if top is not None:
            new = new.filter((F.col(high_water) >= F.lit(top)) | F.col(high_water).isNull())
    cols = [c for c in schema.names if c != _HASH]
    folder = f"{path}/data/{uuid.uuid4().hex}"
    _write_files(_hashed(new.select(*cols), key), folder, buckets)  # evaluated once
    incoming = spark.read.schema(schema).parquet(folder)
    files, deletes = files_of(spark, path, v), _deletes(spark, path, v)
    touched = candidates(files, incoming, buckets)
    if touched:
        narrow = T.StructType([schema[key], schema[_HASH]])
        keys = incoming.select(_HASH, key).distinct().alias("i")
        replaced = (_live(spark, path, v, touched, narrow, True).alias("o").join(keys, _same(key), "left_semi")
                    .select(F.col("_file").alias("file"), F.col("_row").alias("row")))
        aside = f"{path}/data/{uuid.uuid4().hex}"  # named once, counted and listed
        replaced.write.parquet(aside)
        replaced = spark.read.schema("file string, row long").parquet(aside)
        deletes = deletes.unionByName(replaced)
        counts = replaced.groupBy("file").agg(F.count("*").alias("more"))
        files = (files.join(counts, "file", "left")
                 .withColumn("deleted", F.col("deleted") + F.coalesce("more", F.lit(0))).select(*files.columns))
    added = [_describe(spark, folder)]
    worn = [r["file"] for r in files.filter(F.col("deleted") > COMPACT * F.col("n")).select("file").collect()]
    if worn:
        gone = deletes.select(F.col("file").alias("_f"), F.col("row").alias("_r"))
        rest = (_read_files(spark, schema, worn)
                .join(gone, (F.col("_file") == F.col("_f")) & (F.col("_row") == F.col("_r")), "left_anti"))
        moved = f"{path}/data/{uuid.uuid4().hex}"
        _write_files(rest.select(*schema.names), moved, buckets)
        files = files.join(spark.createDataFrame([(w,) for w in worn], "file string"), "file", "left_anti")
        added.append(_describe(spark, moved))
    for a in added:
        files = files.unionByName(a)
    _commit(spark, path, v + 1, files, deletes, key, buckets, schema)
    return keyed(spark, path)


def _shares(n: int) -> list[tuple[int, int]]:
    """The first and last hash of ``n`` ranges of equal width."""
    edges = [-(2**63) + i * 2**64 // n for i in range(n + 1)]
    return [(lo, hi - 1) for lo, hi in zip(edges, edges[1:])]


def append_new(new: DataFrame, path: str, key: str, buckets: int | None = None, stored: bool = False) -> DataFrame:
    """SNK5: append only rows whose key the table does not hold yet (a row
    without a key: only where no equal row is there). Only files that may
    hold such a key are read, and of those only the key. ``new`` is evaluated
    once, into a copy that goes when its rows are appended; ``stored`` says
    that it only reads files, which are then read again instead of copied."""
    spark = new.sparkSession
    found = _open(spark, path, key, buckets)
    with shuffles_freed(spark):
        if found is None:
            _first(new, path, key, buckets or BUCKETS)
        else:
            _append(new, path, key, *found, stored)
    return keyed(spark, path)


def _append(new: DataFrame, path: str, key: str, v: int, buckets: int, schema: T.StructType, stored: bool) -> None:
    spark = new.sparkSession
    columns, narrow = T.StructType([f for f in schema if f.name != _HASH]), T.StructType([schema[key], schema[_HASH]])
    aside, folders = f"{path}/data/{uuid.uuid4().hex}", []
    if not stored:  # as it comes: only the rows that stay are dealt by key
        new.select(*columns.names).write.option("compression", "zstd").parquet(f"{aside}/rows")
        new = spark.read.schema(columns).parquet(f"{aside}/rows")
    new = new.select(*[F.col(f.name).cast(f.dataType) for f in columns])
    n, files = new.count(), files_of(spark, path, v)
    # where the table has less than half as many rows as come, most stay; else the keys are compared before rows move
    keys_first = n <= 2 * files.agg(F.coalesce(F.sum(F.expr("n - deleted")), F.lit(0))).first()[0]
    shares = _shares(min(SHARES, max(1, -(-n // FILE_ROWS))))
    ranges, many = max(buckets, -(-n // FILE_ROWS)), len(shares) > 1
    same = (F.col(f"o.{_HASH}") == F.col(f"i.{_HASH}")) & (F.struct(f"o.{key}") == F.col("i._k"))
    for i, (lo, hi) in enumerate(shares):
        inside = F.col(_HASH).between(lo, hi)
        near = files.filter((F.col("lo") <= hi) & (F.col("hi") >= lo))
        near = near.withColumns({"lo": F.greatest("lo", F.lit(lo)), "hi": F.least("hi", F.lit(hi))})
        rows, keys, ordered = _hashed(new, key).filter(inside), _keys(new, key).filter(inside), False
        if touched := candidates(near, keys.select(_HASH), ranges, many):
            held = _live(spark, path, v, touched, narrow, True).filter(inside).select(_HASH, F.struct(key).alias("_k")).distinct()
            if keys_first:
                keys.distinct().alias("o").join(held.alias("i"), [_HASH, "_k"], "left_anti").write.parquet(f"{aside}/{i}")
                unseen = spark.read.schema(keys.schema).parquet(f"{aside}/{i}")
                if unseen.isEmpty():
                    continue
                rows = rows.alias("o").join(unseen.alias("i"), same, "left_semi")
            else:  # many rows are dealt by the join, which sorts them; the share is their range
                held, ordered = held.hint("merge") if many else held, many
                rows = rows.alias("o").join(held.alias("i"), same, "left_anti")
            rows = rows.select("o.*")
        folders.append(f"{path}/data/{uuid.uuid4().hex}")
        _write_files(rows, folders[-1], 0 if ordered else ranges)
    fs, p, _ = _fs(spark, aside)
    fs.delete(p, True)
    if folders:
        files = files.unionByName(_describe(spark, *folders))
    _commit(spark, path, v + 1, files, _deletes(spark, path, v), key, buckets, schema)
