"""Derive landing-format inputs (archives, workbooks, envelopes, pages)
from driver tables inside Spark tasks.

The driver tables are Parquet; the loaders are for the file shapes the
public sources publish. These builders render table rows into those shapes
in bounded groups (a fixed number of rows per archive/workbook/page), so a
group never grows with the table and the work runs in parallel.
"""

from __future__ import annotations

import functools
import io
import itertools
import zipfile
from collections.abc import Sequence
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BINARY_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("content", T.BinaryType()),
])


def bucketed_lines(df: DataFrame, bucket: Column, line: Column, order: Column) -> DataFrame:
    """(bucket, lines in order) with a bounded number of rows per bucket."""
    g = df.select(bucket.alias("bucket"), order.alias("o"), line.alias("line")).groupBy("bucket").agg(
        F.array_sort(F.collect_list(F.struct("o", "line"))).alias("rows"))
    return g.select("bucket", F.transform("rows", lambda r: r["line"]).alias("lines"))


def zip_archives(groups: DataFrame, header: str, nested_every: int = 2) -> DataFrame:
    """One zip per bucket holding ``data.csv`` (header + lines) and a
    ``readme.txt``; every ``nested_every``-th archive wraps the csv in an
    inner zip to exercise the nested search."""

    def render(b, lines):
        text = "\n".join([header, *lines]) + "\n"
        inner = io.BytesIO()
        with zipfile.ZipFile(inner, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("readme.txt", "filing export\n")
            z.writestr(f"filings_{b}.csv", text)
        data = inner.getvalue()
        if nested_every and int(b) % nested_every == 0:
            outer = io.BytesIO()
            with zipfile.ZipFile(outer, "w") as z:
                z.writestr("notes.txt", "nested\n")
                z.writestr(f"inner_{b}.zip", data)
            data = outer.getvalue()
        return f"archive_{b}.zip", data

    return groups.mapInArrow(_each_file(render), BINARY_SCHEMA)


def _plain(lines: pa.Array) -> list:
    """Lines, or rows of cells, as Python lists: their texts are converted at once."""
    if not pa.types.is_list(lines.type):
        return lines.to_numpy(zero_copy_only=False).tolist()
    cells, at = iter(lines.flatten().to_numpy(zero_copy_only=False).tolist()), lines.value_lengths().to_pylist()
    return [list(itertools.islice(cells, n or 0)) for n in at]


def _each_file(render):
    """The files of (bucket, lines) rows, handed on one by one."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                path, data = render(batch.column("bucket")[i].as_py(), _plain(batch.column("lines")[i].values))
                yield pa.RecordBatch.from_arrays([pa.array([path], pa.string()), pa.array([data], pa.binary())], BINARY_SCHEMA.names)

    return run


def _serial(iso_or_yyyymmdd: str) -> str:
    import datetime as dt

    t = iso_or_yyyymmdd.replace("-", "")
    d = dt.date(int(t[:4]), int(t[4:6]), int(t[6:8]))
    return str((d - dt.date(1899, 12, 30)).days)


def _xlsx(rows: Sequence[Sequence[str]], date_cols: Sequence[int] = ()) -> bytes:
    def col(i):
        s = ""
        i += 1
        while i:
            i, r = divmod(i - 1, 26)
            s = chr(65 + r) + s
        return s

    names = [col(i) for i in range(max((len(cells) for cells in rows), default=0))]
    dates, serial = set(date_cols), functools.cache(_serial)

    def cell(r, i, v):
        if r > 1 and i in dates:  # a real date cell: serial number + date style
            return f'<c r="{names[i]}{r}" s="1"><v>{serial(v)}</v></c>'
        if "&" in v or "<" in v or ">" in v:
            v = escape(v)
        return f'<c r="{names[i]}{r}" t="inlineStr"><is><t>{v}</t></is></c>'

    body = []
    for r, cells in enumerate(rows, start=1):
        cs = "".join([cell(r, i, v) for i, v in enumerate(cells) if v])
        body.append(f'<row r="{r}">{cs}</row>')
    sheet = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
             '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>'
             + "".join(body) + "</sheetData></worksheet>")
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", '<?xml version="1.0"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"/>')
        z.writestr("xl/workbook.xml", '<?xml version="1.0"?><workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"/>')
        z.writestr("xl/worksheets/sheet1.xml", sheet)
        z.writestr("xl/styles.xml", '<?xml version="1.0"?><styleSheet xmlns="http://schemas.openxmlformats.org/'
                   'spreadsheetml/2006/main"><cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs>'
                   '</styleSheet>')
    return out.getvalue()


def workbooks(groups: DataFrame, header: Sequence[str], date_cols: Sequence[str] = ()) -> DataFrame:
    """One .xlsx per bucket: header row then one row per array of cells
    (``lines`` holds arrays of text here). Blank cells are left out of the
    sheet, as spreadsheet writers do; ``date_cols`` (YYYYMMDD or ISO text)
    are written as date-formatted serial numbers."""
    date_idx = [list(header).index(c) for c in date_cols]

    def render(b, rows):
        return f"book_{b}.xlsx", _xlsx([list(header), *rows], date_idx)

    return groups.mapInArrow(_each_file(render), BINARY_SCHEMA)


#: Files (and groups of lines they are made of) that a Python worker is given
#: at once.
FILES_AT_ONCE = 16
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def write_binary(df: DataFrame, folder: str) -> str:
    """Write (path, content) rows as files of the shared folder. A file is
    written under a hidden name and renamed, so a task that runs again never
    leaves half a file. A worker holds ``FILES_AT_ONCE`` files at a time, however many
    a task has."""

    def run(batches):
        import uuid

        from donorlake.sources.ranges import filesystem

        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        for batch in batches:
            for p, c in zip(batch.column("path").to_pylist(), batch.column("content")):
                aside = f"{root}/.{uuid.uuid4().hex}"
                with fs.open_output_stream(aside) as out:
                    out.write(c.as_buffer())
                fs.create_dir(f"{root}/{p}".rsplit("/", 1)[0], recursive=True)
                fs.move(aside, f"{root}/{p}")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    spark = df.sparkSession
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(FILES_AT_ONCE))
    try:
        df.mapInArrow(run, "n long").agg(F.sum("n")).collect()
    finally:
        spark.conf.set(_BATCH, before)
    return folder
