"""Delimited files read by byte range (SRC1 multi-line, SRC3, SRC10).

A table of files becomes a table of byte ranges, dealt over the cluster, and
each range is read by a ranged read of the file system: files of any size are
split, and what is known of a file (its delimiter, its columns) is a column of
its ranges, so nothing is collected.

Quoted fields may hold line breaks. Whether a byte is inside quotes depends on
every quote before it, so one pass counts the quotes of each range, a running
sum over the ranges of a file gives the state at each range's first byte, and
the second pass finds its first record from there: a record belongs to the
range that its first byte is in, and is read on past the range's end. Without
line breaks in quotes (``multiline=False``) the counting pass is left out.

The format is RFC 4180: a quote inside a field is doubled and such a field is
quoted. File systems are those of Arrow (local or mounted, and by their scheme
s3, gs, hdfs).
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from donorlake.session import local_path

CORRUPT = "_corrupt_record"
#: Why a file could not be read, where the caller asks for it.
FAILED = "_failed"
SPLIT_BYTES = 64 << 20
WINDOW = 1 << 20
HEAD_BYTES = 1 << 16


def filesystem(uri: str):
    """(Arrow file system, path on it) of a file name as Spark gives it."""
    from pyarrow import fs

    if not re.match(r"^[A-Za-z][A-Za-z0-9+.-]+:", uri) or uri.startswith("file:"):
        return fs.LocalFileSystem(), local_path(uri)
    return fs.FileSystem.from_uri(uri)


def files_of(spark: SparkSession, path: str | Sequence[str], glob: str = "*") -> DataFrame:
    """(file, size, modified) of every file below ``path``, from Spark's file
    index; no file is opened."""
    paths = [path] if isinstance(path, str) else list(path)
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
            .load(paths).select(F.col("path").alias("file"), F.col("length").alias("size"),
                                F.col("modificationTime").alias("modified")))


# ------------------------------------------------------------ heads

def first_line(file: str, limit: int = HEAD_BYTES) -> bytes:
    """The first line of a file, or its first ``limit`` bytes."""
    fs, path = filesystem(file)
    head, step = b"", 1 << 12
    with fs.open_input_file(path) as f:
        while len(head) < limit:
            more = f.read(min(step, limit - len(head)))
            head += more
            if not more or b"\n" in more:
                break
            step *= 4
    return head.split(b"\n", 1)[0].rstrip(b"\r")


def with_first_line(files: DataFrame, n_tasks: int, encoding: str = "utf-8") -> DataFrame:
    """Files with ``head``, their first line: tasks of several files that
    read a bounded head of each."""
    schema = T.StructType([*files.schema.fields, T.StructField("head", T.StringType())])

    def run(batches):
        for b in batches:
            heads = [first_line(f).decode(encoding, "replace") for f in b.column("file").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(heads, pa.string())], schema.names)

    return files.repartition(n_tasks, "file").mapInArrow(run, schema)


# ------------------------------------------------------------ ranges

def tasks_for(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> int:
    """How many tasks read the files: by their bytes, from the listing."""
    total = files.agg(F.sum("size")).first()[0] or 0
    return int(min(max(total // split_bytes + 1, files.sparkSession.sparkContext.defaultParallelism), 200_000))


def ranges_of(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Each file's byte ranges: begin, end and the columns of the file."""
    begins = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(split_bytes).cast("long"))
    return (files.withColumn("begin", F.explode(begins))
            .withColumn("end", F.least(F.col("begin") + split_bytes, F.col("size"))))


def _windows(f, begin: int, end: int, step: int = WINDOW) -> Iterator[bytes]:
    while begin < end:
        data = f.read_at(min(step, end - begin), begin)
        if not data:
            return
        yield data
        begin += len(data)


def with_quote_state(ranges: DataFrame, quote: str | None, n_tasks: int) -> DataFrame:
    """Ranges with ``inside`` and ``inside_end``: whether their first byte
    and the byte after them lie inside quotes."""
    if quote is None:
        return ranges.withColumns({"inside": F.lit(False), "inside_end": F.lit(False)})
    schema = T.StructType([*ranges.schema.fields, T.StructField("_quotes", T.LongType())])
    q = quote.encode()

    def count(batches):
        for b in batches:
            n = []
            for file, begin, end in zip(*(b.column(c).to_pylist() for c in ("file", "begin", "end"))):
                fs, path = filesystem(file)
                try:
                    with fs.open_input_file(path) as f:
                        n.append(sum(x.count(q) for x in _windows(f, begin, end)))
                except OSError:  # reported where the range is read
                    n.append(0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(n, pa.int64())], schema.names)

    upto = Window.partitionBy("file").orderBy("begin").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("_quotes").over(upto)
    counted = ranges.repartition(n_tasks, "file", "begin").mapInArrow(count, schema)
    return counted.withColumns({"inside": (total - F.col("_quotes")) % 2 == 1, "inside_end": total % 2 == 1}).drop("_quotes")


def unquoted_breaks(data: np.ndarray, inside: bool, quote: int | None) -> tuple[np.ndarray, bool]:
    """Positions of the line breaks outside quotes, and whether the data
    ends inside quotes."""
    breaks = data == 10
    if quote is None:
        return np.flatnonzero(breaks), False
    state = np.bitwise_xor.accumulate((data == quote).view(np.uint8)) ^ np.uint8(inside)
    return np.flatnonzero(breaks & (state == 0)), bool(state[-1])


def record_at(f, pos: int, size: int, inside: bool, quote: int | None) -> int:
    """Where the first record begins that begins at ``pos`` or later."""
    if pos <= 0 or pos >= size:
        return min(max(pos, 0), size)
    if not inside and f.read_at(1, pos - 1) == b"\n":
        return pos
    for data in _windows(f, pos, size, 1 << 16):
        breaks, inside = unquoted_breaks(np.frombuffer(data, np.uint8), inside, quote)
        if len(breaks):
            return pos + int(breaks[0]) + 1
        pos += len(data)
    return size


def records(f, begin: int, end: int, quote: int | None, step: int = 4 * WINDOW) -> Iterator[list[bytes]]:
    """The records of begin..end, both at a record's first byte, in blocks."""
    rest = b""
    for data in _windows(f, begin, end, step):
        data = rest + data
        breaks, _ = unquoted_breaks(np.frombuffer(data, np.uint8), False, quote)
        cut = [0, *(breaks + 1).tolist()]
        rest = data[cut[-1] :]
        if len(cut) > 1:
            yield [data[a:b] for a, b in zip(cut, cut[1:])]
    if rest:
        yield [rest]


def _parse(lines: list[str], sep: str, quote: str | None) -> list[list[str | None] | None]:
    """Fields of each record, None where it is no CSV."""
    how = ({"quotechar": quote, "quoting": csv.QUOTE_NOTNULL} if quote
           else {"quoting": csv.QUOTE_NONE, "quotechar": None})
    try:
        found = list(csv.reader(lines, delimiter=sep, **how))
        if len(found) == len(lines):
            return found
    except csv.Error:
        pass
    out = []
    for line in lines:
        try:
            fields = list(csv.reader([line], delimiter=sep, **how))
            out.append(fields[0] if len(fields) == 1 else None)
        except csv.Error:
            out.append(None)
    return out


def read_ranges(ranges: DataFrame, columns: Sequence[str] | None, sep: str | None = None, quote: str | None = '"',
                header: bool = True, encoding: str = "utf-8", carry: Sequence[str] = (),
                keep_failed: bool = False) -> DataFrame:
    """Rows of ranges with a quote state: ``columns`` as text (an empty field
    is NULL, a quoted empty one ''), ``_corrupt_record`` (the raw record where
    its width is not that of the columns, whose fields are then NULL) and the
    ranges' columns named in ``carry``. Without ``columns`` a row is its
    ``fields`` as they are. Ranges may have columns ``sep`` and ``quote`` (''
    for none) of their own. With ``keep_failed`` a range that cannot be read is one
    row with the reason in ``_failed`` instead of a failed job."""
    data = ([T.StructField(c, T.StringType()) for c in columns] if columns is not None
            else [T.StructField("fields", T.ArrayType(T.StringType()))])
    notes = [T.StructField(c, T.StringType()) for c in (CORRUPT, *([FAILED] if keep_failed else []))]
    schema = T.StructType([*data, *notes, *(ranges.schema[c] for c in carry)])
    width = None if columns is None else len(columns)

    none = None if width is None else [None] * width

    def batch(rows, corrupt, failed, source, i):
        if width is None:
            cols = [pa.array(rows, pa.list_(pa.string()))]
        else:
            cols = [pa.array(x, pa.string()) for x in (zip(*rows) if rows else [[]] * width)]
        cols.append(pa.array(corrupt, pa.string()))
        if keep_failed:
            cols.append(pa.array(failed, pa.string()))
        cols += [source.column(c).take(pa.array([i] * len(rows), pa.int64())) for c in carry]
        return pa.RecordBatch.from_arrays(cols, schema.names)

    def one(row, source, i):
        fs, path = filesystem(row["file"])
        how = row.get("quote", quote) or None
        q = ord(how) if how else None
        with fs.open_input_file(path) as f:
            begin = record_at(f, row["begin"], row["size"], row["inside"], q)
            end = record_at(f, row["end"], row["size"], row["inside_end"], q)
            skip = header and begin == 0
            for block in records(f, begin, end, q):
                lines = [x.decode(encoding, "replace").rstrip("\r\n") for x in block]
                lines = [x for x in lines if x]
                if skip and lines:
                    lines, skip = lines[1:], False
                parsed = _parse(lines, row.get("sep") or sep, how)
                fits = [x is not None and width in (None, len(x)) for x in parsed]
                yield batch([x if ok else none for x, ok in zip(parsed, fits)],
                            [None if ok else x for x, ok in zip(lines, fits)], [None] * len(lines), source, i)

    def run(batches):
        csv.field_size_limit(2**31 - 1)
        for source in batches:
            for i, row in enumerate(source.to_pylist()):
                try:
                    yield from one(row, source, i)
                except (OSError, UnicodeError) as e:
                    if not keep_failed:
                        raise
                    yield batch([none], [None], [f"{type(e).__name__}: {e}"[:500]], source, i)

    return ranges.mapInArrow(run, schema)


# ------------------------------------------------------------ scans

def multiline_scan(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], sep: str = ",",
                   quote: str = '"', header: bool = True, encoding: str = "utf-8", glob: str = "*",
                   split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """SRC1 with line breaks inside quoted fields, split like any other file
    (Spark's ``multiLine`` gives one task a file). Rows of the wrong width
    carry their raw record in ``_corrupt_record`` (ROW1)."""
    files = files_of(spark, path, glob)
    n = tasks_for(files, split_bytes)
    ranges = with_quote_state(ranges_of(files, split_bytes), quote, n)
    return read_ranges(ranges.repartition(n, "file", "begin"), columns, sep, quote, header, encoding)


def scan_mixed_delimiters(spark: SparkSession, path: str, columns: Sequence[str],
                          tab_suffixes: Sequence[str] = (".txt",), quote: str | None = '"', header: bool = True,
                          encoding: str = "utf-8", split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """SRC3: files with different delimiters under one folder. A file whose
    name ends in a ``tab_suffixes`` entry is tab-separated; any other is
    decided by its first line alone (more tabs than commas). The delimiter is
    a column of the file table that its ranges take along."""
    files = files_of(spark, path)
    n = tasks_for(files, split_bytes)
    headed = with_first_line(files, n, encoding)
    by_name = F.lit(False)
    for s in tab_suffixes:
        by_name = by_name | F.lower("file").endswith(s)
    count = lambda c: F.length("head") - F.length(F.replace("head", F.lit(c), F.lit("")))
    routed = headed.withColumn("sep", F.when(by_name | (count("\t") > count(",")), F.lit("\t")).otherwise(F.lit(",")))
    ranges = with_quote_state(ranges_of(routed.drop("head"), split_bytes), None, n)
    return read_ranges(ranges.repartition(n, "file", "begin"), columns, None, quote, header, encoding)
