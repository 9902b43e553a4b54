"""Zip archives as a Spark data source (SRC4).

``spark.read.format("donorlake_zip")`` plans from the central directory of
each archive, read by ranged reads of the file system: in mode ``all`` the
matching members are the units of work, packed into partitions by compressed
size, so the members of one archive run in several tasks; in mode
``first_csv`` (one member of each archive) the archives are. A task streams
its members: an archive or member of any size takes a bounded amount of
memory, and nothing is spooled to an executor's disk. Inner zips are read in
place: zipfile seeks inside the outer member (a stored one by offset, a
deflated one by reading on).

Options: ``path`` (folder or file), ``mode``, ``member_pattern``,
``max_depth``, ``sep``, ``quote`` ('' for none), ``encoding``,
``split_bytes``.
"""

from __future__ import annotations

import csv
import io
import itertools
import re
import zipfile
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from donorlake.sources.ranges import filesystem

FORMAT = "donorlake_zip"
SCHEMA = "archive string, member string, record_no long, fields array<string>"
#: Records a task holds at once while it streams a member.
RECORDS_AT_ONCE = 5000
#: Compressed bytes of the members that one task takes.
SPLIT_BYTES = 64 << 20
#: Up to here each unit of work is a task of its own; more are packed, several
#: to a task, as long as a task has less than SPLIT_BYTES.
TASKS = 512


def archives_below(path: str) -> list[tuple[str, int]]:
    """The .zip files of a folder (or the file itself) with their sizes, hidden ones left out."""
    from pyarrow import fs as pafs

    fs, root = filesystem(path)
    scheme = re.match(r"^[A-Za-z][A-Za-z0-9+.-]+:", path)
    prefix = "" if fs.type_name == "local" else f"{scheme.group(0)}//"
    info = fs.get_file_info(root)
    if info.type == pafs.FileType.File:
        return [(prefix + root, info.size)]
    found = fs.get_file_info(pafs.FileSelector(root, recursive=True))
    return sorted((prefix + x.path, x.size) for x in found if x.is_file and x.base_name.lower().endswith(".zip")
                  and x.base_name[0] not in "._")


def open_archive(path: str) -> zipfile.ZipFile:
    """An archive over ranged reads; closing it closes the file."""
    fs, name = filesystem(path)
    return zipfile.ZipFile(io.BufferedReader(_Ranged(fs.open_input_file(name)), 1 << 18))


class _Ranged(io.RawIOBase):
    """A random-access Arrow file as a raw Python file."""

    def __init__(self, file):
        self.file = file

    def readable(self):
        return True

    def seekable(self):
        return True

    def seek(self, offset, whence=0):
        return self.file.seek(offset, whence)

    def tell(self):
        return self.file.tell()

    def readinto(self, b):
        data = self.file.read(len(b))
        b[: len(data)] = data
        return len(data)

    def close(self):
        if not self.closed:
            self.file.close()
        super().close()


def members(archive: zipfile.ZipFile, levels: int, prefix: str = "") -> Iterator[tuple]:
    """(name, archive, entry) of every file, in order; an inner zip is opened
    in its place while ``levels`` allow it."""
    for entry in archive.infolist():
        if entry.is_dir():
            continue
        if levels > 0 and entry.filename.lower().endswith(".zip"):
            with archive.open(entry) as inner, zipfile.ZipFile(inner) as z:
                yield from members(z, levels - 1, f"{prefix}{entry.filename}/")
        else:
            yield prefix + entry.filename, archive, entry


class Members(InputPartition):
    """Some members of one archive by number (None: the first csv)."""

    def __init__(self, archive: str, numbers: tuple[int, ...] | None, size: int = 0):
        self.archive, self.numbers, self.size = archive, numbers, size


class Pack(InputPartition):
    """Units of work that one task takes, one after another."""

    def __init__(self, units: list[Members]):
        self.units = units


def packed(units: list[Members], tasks: int = TASKS, split: int = SPLIT_BYTES) -> list[InputPartition]:
    """A task for each unit, or packs of about equal bytes where there are
    more than ``tasks``: so many, and one more for every ``split`` bytes."""
    if len(units) <= tasks:
        return units
    goal = sum(u.size for u in units) / (tasks + sum(u.size for u in units) // split)
    out, some, size = [], [], 0
    for u in units:
        if some and size + u.size / 2 > goal:
            out.append(Pack(some))
            some, size = [], 0
        some.append(u)
        size += u.size
    return [*out, Pack(some)]


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.mode = options.get("mode", "all")
        if self.mode not in ("all", "first_csv"):
            raise ValueError(f"mode is 'all' or 'first_csv', not {self.mode!r}")
        self.pattern = options.get("member_pattern") or r"\.(csv|txt)$"
        self.levels = int(options.get("max_depth", "2")) - 1
        self.sep, self.quote = options.get("sep", ","), options.get("quote", '"')
        self.encoding = options.get("encoding", "utf-8")
        self.split = int(options.get("split_bytes", SPLIT_BYTES))

    def partitions(self):
        found = archives_below(self.path)
        if self.mode == "first_csv":
            return packed([Members(a, None, size) for a, size in found]) or [Members("", ())]
        with ThreadPoolExecutor(16) as pool:  # one directory read an archive
            return packed(list(itertools.chain.from_iterable(pool.map(self.plan, (a for a, _ in found))))) or [Members("", ())]

    def plan(self, path: str) -> list[Members]:
        wanted, out, some, size = re.compile(self.pattern), [], [], 0
        with open_archive(path) as z:
            for i, e in enumerate(z.infolist()):
                if e.is_dir() or not wanted.search(e.filename):
                    continue
                if some and size + e.compress_size > self.split:
                    out.append(Members(path, tuple(some), size))
                    some, size = [], 0
                some.append(i)
                size += e.compress_size
        return [*out, Members(path, tuple(some), size)] if some else out

    def read(self, partition):
        csv.field_size_limit(2**31 - 1)
        for unit in getattr(partition, "units", [partition]):
            yield from self.unit(unit)

    def unit(self, partition: Members):
        if not partition.archive:
            return
        with open_archive(partition.archive) as z:
            if partition.numbers is not None:
                entries = z.infolist()
                for i in partition.numbers:
                    yield from self.batches(partition.archive, entries[i].filename, z, entries[i])
                return
            for name, inner, entry in members(z, self.levels):
                if name.lower().endswith(".csv"):
                    yield from self.batches(partition.archive, name, inner, entry)
                    return
        raise ValueError(f"{partition.archive}: no csv member within {self.levels + 1} levels")

    def batches(self, path, name, archive, entry) -> Iterator[pa.RecordBatch]:
        """A member's records: quoted separators and line breaks stay in their
        field, blank lines are skipped."""
        how = {"quotechar": self.quote} if self.quote else {"quoting": csv.QUOTE_NONE}
        with archive.open(entry) as raw:
            text = io.TextIOWrapper(raw, encoding=self.encoding, errors="ignore", newline="")
            reader, done = csv.reader(text, delimiter=self.sep, **how), 0
            while chunk := list(itertools.islice(reader, RECORDS_AT_ONCE)):
                rows = [(done + i, r) for i, r in enumerate(chunk, 1) if r]
                done += len(chunk)
                yield pa.RecordBatch.from_arrays([
                    pa.array([path] * len(rows), pa.string()), pa.array([name] * len(rows), pa.string()),
                    pa.array([i for i, _ in rows], pa.int64()), pa.array([r for _, r in rows], pa.list_(pa.string()))],
                    ["archive", "member", "record_no", "fields"])


class ZipSource(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _Reader(self.options)


def archive_scan(spark: SparkSession, path: str, mode: str = "all", member_pattern: str = r"\.(csv|txt)$",
                 max_depth: int = 2, sep: str = ",", quote: str | None = '"', encoding: str = "utf-8",
                 split_bytes: int = SPLIT_BYTES):
    """SRC4: zip archives under ``path`` -> (archive, member, record_no,
    fields). ``mode='all'`` reads every member whose name matches;
    ``mode='first_csv'`` the first ``.csv`` found, looking into inner zips
    ``max_depth`` - 1 levels deep (an archive without one is an error)."""
    spark.dataSource.register(ZipSource)
    return (spark.read.format(FORMAT).options(
        mode=mode, member_pattern=member_pattern, max_depth=max_depth, sep=sep, quote=quote or "",
        encoding=encoding, split_bytes=split_bytes).load(path))
