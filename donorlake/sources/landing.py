"""Landing scans and row hygiene (SRC1-SRC12, ROW1-ROW8).

Everything lands as text: schemas are explicit ``StructType``s of strings,
never inferred. Rows whose width does not match the schema are not dropped
silently; ``split_valid`` separates them into a quarantine frame.

Zip archives are a data source of their own (``archives.py``); delimited files
with line breaks in fields or with a delimiter of their own are read by byte
range (``ranges.py``). Workbooks and saved HTML are rows decoded inside
``mapInPandas`` tasks, so the work spreads over the cluster; nothing is
collected to the driver except file listings.
"""

from __future__ import annotations

import functools
import itertools
import re
import zipfile
from collections.abc import Mapping, Sequence
from xml.sax.saxutils import unescape

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from donorlake.sources.archives import archive_scan, open_archive  # noqa: F401  (SRC4)
from donorlake.sources.ranges import (CORRUPT, files_of, multiline_scan, scan_mixed_delimiters,  # noqa: F401
                                      tasks_for)


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


# --- SRC1 / SRC2 / SRC3: delimited text ---------------------------------------------


def delimited_scan(spark: SparkSession, paths, columns: Sequence[str], sep: str = ",",
                   quote: str | None = '"', escape: str | None = '"', header: bool = True,
                   keep_corrupt: bool = True, encoding: str = "UTF-8") -> DataFrame:
    """SRC1: all-text scan. ``quote=None`` turns quoting off (pipe files).
    With ``keep_corrupt`` rows of the wrong width carry their raw line in
    ``_corrupt_record`` (ROW1)."""
    schema = text_schema(columns)
    if keep_corrupt:
        schema = schema.add(T.StructField(CORRUPT, T.StringType()))
    r = (spark.read.schema(schema).option("sep", sep).option("header", str(header).lower())
         .option("mode", "PERMISSIVE").option("encoding", encoding)
         .option("enforceSchema", "true"))
    if keep_corrupt:
        r = r.option("columnNameOfCorruptRecord", CORRUPT)
    r = r.option("quote", quote if quote is not None else "\u0000")
    if escape is not None:
        r = r.option("escape", escape)
    return r.csv(paths if isinstance(paths, str) else list(paths))


def existing_paths(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """File-system listing (driver metadata only): keep paths that exist."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        if hp.getFileSystem(conf).exists(hp):
            out.append(p)
    return out


def listed_values(spark: SparkSession, root: str, key: str) -> list[str]:
    """Values of the ``key=value`` folders below ``root`` (driver metadata,
    one entry a folder)."""
    hp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [st.getPath().getName() for st in fs.listStatus(hp)]
    return sorted(n[len(key) + 1 :] for n in names if n.startswith(f"{key}="))


def scan_years(spark: SparkSession, paths_by_year: Mapping[str, str], columns: Sequence[str],
               year_col: str = "year", **opts) -> DataFrame:
    """SRC2: one scan over many yearly files; years whose file is missing
    are skipped (other errors raise). The year comes from the file path."""
    present = {y: p for y, p in paths_by_year.items() if existing_paths(spark, [p])}
    if not present:
        return spark.createDataFrame([], text_schema([*columns, year_col]))
    df = delimited_scan(spark, list(present.values()), columns, **opts)
    # map each file back to its year by folder prefix, as a literal CASE;
    # scheme and authority slashes are normalised on both sides
    fp = F.regexp_replace(F.col("_metadata.file_path"), r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "/")
    year = F.lit(None).cast("string")
    for y, p in present.items():
        prefix = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "/", p.rstrip("/")) + "/"
        year = F.when(fp.startswith(prefix), F.lit(y)).otherwise(year)
    return df.withColumn(year_col, year)


# --- ROW1-ROW5: row hygiene ------------------------------------------------------------


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """ROW1: (good rows, quarantined raw lines). Short and long rows are
    both flagged by the CSV reader in PERMISSIVE mode."""
    # The width check only sees the columns a query requires (CSV column
    # pruning), and Spark refuses a scan whose only column is the corrupt
    # record (a bare count). Touching every data column in the predicate
    # keeps the full row in the parse, which is what a landing load reads.
    data = [c for c in df.columns if c != CORRUPT]
    touch = F.coalesce(F.length(F.concat_ws("", *[F.col(c) for c in data])), F.lit(0)) >= 0
    good = df.filter(F.col(CORRUPT).isNull() & touch).drop(CORRUPT)
    bad = df.filter(F.col(CORRUPT).isNotNull() & touch).select(F.col(CORRUPT).alias("raw_line"))
    return good, bad


def clean_text(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """ROW2: remove NUL characters (and the replacement char left by
    undecodable bytes) from text columns."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.regexp_replace(F.col(c), "[\u0000�]", "") for c in cols})


def drop_blank_lines(df: DataFrame, col: str = "value") -> DataFrame:
    """ROW3 for raw text lines (the CSV reader skips blank lines itself)."""
    return df.filter(F.length(F.trim(F.col(col))) > 0)


def fit_width(fields: Column, n: int, drop: int = 0) -> Column:
    """ROW4: drop the first ``drop`` fields (a leading year), trim, then pad
    with '' or cut to exactly ``n`` fields."""
    arr = F.transform(fields, lambda x: F.trim(x))
    if drop:
        arr = F.slice(arr, drop + 1, F.greatest(F.size(arr) - drop, F.lit(0)))
    return F.slice(F.concat(arr, F.array_repeat(F.lit(""), n)), 1, n)


def with_load_columns(df: DataFrame, **literals) -> DataFrame:
    """ROW5: append partition key / year / source file name."""
    out = df.withColumns({k: F.lit(v) for k, v in literals.items()})
    return out.withColumn("file_name", F.col("_metadata.file_name"))


# --- SRC4: archives ---------------------------------------------------------------------

def split_records(records: DataFrame, columns: Sequence[str], header: bool = True) -> tuple[DataFrame, DataFrame]:
    """ROW1 for archive records: (rows of the right width as text columns,
    the others as they are). A member's first record is its header."""
    if header:
        records = records.filter(F.col("record_no") > 1)
    fits = F.size("fields") == len(columns)
    good = records.filter(fits).select(*[F.col("fields")[i].alias(c) for i, c in enumerate(columns)])
    return good, records.filter(~fits)


# --- SRC5: workbooks ------------------------------------------------------------------

WORKBOOK_ROW_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("row_no", T.LongType()),
    T.StructField("cells", T.ArrayType(T.StringType())),
])

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}


def _col_index(ref: str) -> int:
    letters = "".join(ch for ch in ref if ch.isalpha())
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch.upper()) - 64)
    return n - 1


# Spreadsheet built-in number formats that are dates/times.
BUILTIN_DATE_FORMATS = set(range(14, 23)) | {45, 46, 47}


def _date_styles(zf: zipfile.ZipFile) -> set[int]:
    """Indexes of cell styles whose number format is a date/time."""
    import xml.etree.ElementTree as ET

    if "xl/styles.xml" not in zf.namelist():
        return set()
    root = ET.fromstring(zf.read("xl/styles.xml"))
    custom = {}
    for nf in root.iter(f"{{{_NS['m']}}}numFmt"):
        code = re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", nf.get("formatCode", ""))
        custom[int(nf.get("numFmtId", "0"))] = bool(re.search(r"[ymdhs]", code, re.I))
    xfs = root.find(f"m:cellXfs", _NS)
    out = set()
    if xfs is not None:
        for i, xf in enumerate(xfs.findall("m:xf", _NS)):
            fid = int(xf.get("numFmtId", "0"))
            if fid in BUILTIN_DATE_FORMATS or custom.get(fid, False):
                out.add(i)
    return out


def _serial_to_iso(v: str) -> str:
    """ISO text of a serial number, to the nearest second; a number below 1
    is a time of day."""
    import datetime as dt

    seconds = round(float(v) * 86_400)
    t = dt.datetime(1899, 12, 30) + dt.timedelta(seconds=seconds)
    if seconds < 86_400:
        return t.time().isoformat()
    return t.date().isoformat() if t.time() == dt.time(0) else t.isoformat()


def _sheet_parts(zf: zipfile.ZipFile) -> list[str]:
    """Parts of the sheets in workbook order; in part order where the
    workbook lists none."""
    import xml.etree.ElementTree as ET

    rel = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
    names = set(zf.namelist())
    if {"xl/workbook.xml", "xl/_rels/workbook.xml.rels"} <= names:
        targets = {r.get("Id"): r.get("Target", "") for r in ET.fromstring(zf.read("xl/_rels/workbook.xml.rels"))}
        listed = [targets.get(x.get(rel), "") for x in ET.fromstring(zf.read("xl/workbook.xml")).iter(f"{{{_NS['m']}}}sheet")]
        listed = [t.lstrip("/") if t.startswith("/") else f"xl/{t}" for t in listed]
        if listed and set(listed) <= names:
            return listed
    found = [n for n in names if re.match(r"xl/worksheets/sheet\d+\.xml$", n)]
    return sorted(found, key=lambda n: int(re.search(r"(\d+)\.xml$", n).group(1)))


#: Rows of a sheet that a task hands on at once.
SHEET_ROWS = 5000


def _elements(zf: zipfile.ZipFile, part: str, tag: str):
    """Elements of a part as they are read; each is dropped after its use."""
    import xml.etree.ElementTree as ET

    with zf.open(part) as f:
        root = None
        for event, el in ET.iterparse(f, events=("start", "end")):
            if root is None:
                root = el
            elif event == "end" and el.tag == f"{{{_NS['m']}}}{tag}":
                yield el
                root.clear()
                el.clear()


#: A row of plain cells, as spreadsheet writers put them. What is written any
#: other way (numbered characters, comments, other attributes) is left to the XML parser.
_CHARS = "[^<&\\x00-\\x08\\x0b-\\x1f\\ufffe\\uffff]*"
_TEXT = f"{_CHARS}(?:&(?:amp|lt|gt|quot|apos);{_CHARS})*"
_ROW = re.compile(f'\\s*<row(?: r="([0-9]+)"| [a-zA-Z:0-9]+="[^"<>&/]*")*>((?:<c [^>]*(?:/>|>(?:<v>{_TEXT}</v>|<is><t(?: xml:space="preserve")?>{_TEXT}</t></is>)</c>))*)</row>')
_CELL = re.compile(f'<c r="([A-Z]+)[0-9]+"(?: s="([0-9]+)")?(?: t="([a-zA-Z]+)")?(?:/>|>(?:<v>({_TEXT})</v>|<is><t(?: xml:space="preserve")?>({_TEXT})</t></is>)</c>)')
_HEAD = re.compile(rb'\s*(?:<\?xml version="1\.0"(?: encoding="(?:UTF|utf)-8")?(?: standalone="[a-z]+")?\?>)?\s*<worksheet [^>]*>')
_SHEET_BYTES = 1 << 18


def _plain_rows(f):
    """(row number, cells) of the leading rows of a sheet that are plain, and
    None when another one follows: a cell is (column, style, type, value, text)."""
    head = f.read(_SHEET_BYTES)
    found = _HEAD.match(head)
    start = head.find(b"<sheetData>")
    if not found or start < 0 or f'xmlns="{_NS["m"]}"'.encode() not in found.group() or b"<!" in head[:start] or b"<row" in head[:start]:
        yield None
        return
    rest = head[start + len(b"<sheetData>"):]
    while True:
        ended = rest.find(b"</sheetData>")
        cut = ended if ended >= 0 else rest.rfind(b"</row>") + len("</row>") if b"</row>" in rest else 0
        try:
            text, at = rest[:cut].decode("utf-8"), 0
        except UnicodeDecodeError:
            text, at = "<", 0
        if "]]>" in text:
            text = "<"
        while at < len(text):
            m = _ROW.match(text, at)
            if not m:
                if text[at:].strip():
                    yield None
                    return
                break
            cells = _CELL.findall(m.group(2))
            if m.group(2).count("<c ") != len(cells):
                yield None
                return
            if "&" in m.group(2):
                cells = [(*c[:3], *(unescape(x, {"&quot;": '"', "&apos;": "'"}) for x in c[3:])) for c in cells]
            yield m.group(1) or "0", cells
            at = m.end()
        if ended >= 0:
            while f.read(1 << 20):  # to the end: the archive checks its sum there
                pass
            return
        more = f.read(_SHEET_BYTES)
        rest = rest[cut:] + more
        if not more:
            yield None
            return


@functools.lru_cache(1 << 14)
def _column(letters: str) -> int:
    return _col_index(letters)


def _sheet_rows(zf: zipfile.ZipFile, sheet_idx: int):
    """(row number, cells) of a sheet, read on as they are asked for; of the
    workbook only its shared strings are held. Rows of plain cells are cut out
    of the text; from the first row that is written otherwise on, the sheet
    goes through the XML parser."""
    date_styles = _date_styles(zf)
    shared: list[str] = []
    if "xl/sharedStrings.xml" in zf.namelist():
        shared = ["".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")) for si in _elements(zf, "xl/sharedStrings.xml", "si")]
    part = _sheet_parts(zf)[sheet_idx]
    serials = functools.lru_cache(1 << 14)(_serial_to_iso)

    def value(t, style, v, text):
        """A cell's text; ``v`` and ``text`` are None where it has no value or no inline string."""
        if t == "inlineStr":
            return text or ""
        if not v:
            return ""
        if t == "s":
            return shared[int(v)]
        if t == "b":
            return "True" if v == "1" else "False"
        if t in (None, "n") and int(style) in date_styles:
            return serials(v)  # date-formatted number → ISO text
        return v

    def padded(cells):
        if list(cells) == list(range(len(cells))):
            return list(cells.values())
        return [cells.get(i, "") for i in range(max(cells) + 1 if cells else 0)]

    done = 0
    with zf.open(part) as f:
        for row in _plain_rows(f):
            if row is None:
                break
            yield int(row[0]), padded({_column(ref): x if t == "inlineStr" else value(t or None, s or "0", v, x)
                                       for ref, s, t, v, x in row[1]})
            done += 1
        else:
            return
    tag = {x: f"{{{_NS['m']}}}{x}" for x in ("c", "v", "is", "t")}
    for row in itertools.islice(_elements(zf, part, "row"), done, None):
        cells: dict[int, str] = {}
        for c in row:
            if c.tag != tag["c"]:
                continue
            v = next((x.text for x in c if x.tag == tag["v"]), None)
            is_ = next((x for x in c if x.tag == tag["is"]), None)
            text = None if is_ is None else "".join(x.text or "" for x in is_.iter(tag["t"]))
            cells[_col_index(c.get("r", "A1"))] = value(c.get("t"), c.get("s", "0"), v, text)
        yield int(row.get("r", "0")), padded(cells)


#: Bytes of workbooks that a task reads: the sheets are many times as large.
WORKBOOK_BYTES = 4 << 20


def workbook_rows(files: DataFrame, sheet_idx: int = 0) -> DataFrame:
    """SRC5 on a table of files: rows of sheet ``sheet_idx`` as text cells
    (missing cells → '', date-formatted cells → ISO dates). A workbook is read
    by ranged reads and its sheet streamed in blocks of rows."""

    def run(batches):
        for batch in batches:
            for path in batch.column("file").to_pylist():
                with open_archive(path) as zf:
                    rows = _sheet_rows(zf, sheet_idx)
                    while some := list(itertools.islice(rows, SHEET_ROWS)):
                        yield pa.RecordBatch.from_arrays([
                            pa.array([path] * len(some), pa.string()), pa.array([r for r, _ in some], pa.int64()),
                            pa.array([c for _, c in some], pa.list_(pa.string()))], WORKBOOK_ROW_SCHEMA.names)

    return files.select("file").mapInArrow(run, WORKBOOK_ROW_SCHEMA)


def workbook_scan(spark: SparkSession, path: str, columns: Sequence[str], sheet_idx: int = 0,
                  header: bool = True) -> DataFrame:
    """SRC5: ``.xlsx`` files → text columns; the header row is dropped."""
    files = files_of(spark, path, "*.xlsx")
    rows = workbook_rows(files.repartition(tasks_for(files, WORKBOOK_BYTES), "file"), sheet_idx)
    if header:
        rows = rows.filter(F.col("row_no") > 1)
    return rows.select(*[F.coalesce(F.try_element_at("cells", F.lit(i + 1)), F.lit("")).alias(c)
                         for i, c in enumerate(columns)])


# --- SRC6 / ROW8: JSON ---------------------------------------------------------------------


def json_envelope_split(df: DataFrame, col: str, fields: Sequence[str], path: str = "$.d",
                        quoted: bool = True, array_key: str = "Table") -> tuple[DataFrame, DataFrame]:
    """SRC6: (rows, unreadable envelopes). ``path`` locates the payload
    (``$.d`` holding a *quoted* JSON string, or ``$.data.items`` holding the
    array directly); every element becomes a row with the listed keys as
    text ('' when missing, ROW8). An envelope that is no JSON, is cut off, or
    has no such array is unreadable; an empty array is read, with no rows."""
    payload = F.get_json_object(F.col(col), path)
    if quoted:
        payload = F.get_json_object(payload, f"$.{array_key}")
    elem = T.ArrayType(T.MapType(T.StringType(), T.StringType()))
    keys = [c for c in df.columns if c != col]
    read = df.select(*df.columns, F.from_json(payload, elem).alias("_rows"))
    rows = read.filter("_rows IS NOT NULL").select(*keys, F.explode("_rows").alias("_e"))
    rows = rows.select(*keys, *[F.coalesce(F.col("_e")[k], F.lit("")).alias(k) for k in fields])
    return rows, read.filter("_rows IS NULL").drop("_rows")


def json_envelope_scan(df: DataFrame, col: str, fields: Sequence[str], path: str = "$.d",
                       quoted: bool = True, array_key: str = "Table") -> DataFrame:
    """SRC6: the rows of ``json_envelope_split``."""
    return json_envelope_split(df, col, fields, path, quoted, array_key)[0]


def nested_entity_scan(df: DataFrame, col: str, array_path: str, entity_key: str,
                       fields: Sequence[str]) -> DataFrame:
    """SRC6, ``aaData[].entityDTO`` form: flatten the nested object of each
    array element."""
    elem = T.ArrayType(T.MapType(T.StringType(), T.StringType()))
    arr = F.from_json(F.get_json_object(F.col(col), array_path), elem)
    rows = df.select(F.explode(arr).alias("_e"))
    ent = F.from_json(F.col("_e")[entity_key], T.MapType(T.StringType(), T.StringType()))
    return rows.select(*[F.coalesce(ent[k], F.lit("")).alias(k) for k in fields])


def normalize_json_row(c: Column) -> Column:
    """ROW8: JSON booleans → Yes/No, NULL/missing → ''."""
    return (F.when(c == "true", F.lit("Yes")).when(c == "false", F.lit("No"))
            .otherwise(F.coalesce(c, F.lit(""))))


# --- SRC7 / SRC8: saved HTML -----------------------------------------------------------------

HTML_ROW_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("row_idx", T.LongType()),
    T.StructField("cells", T.ArrayType(T.StringType())),
])


def _html_rows(container_tag, attrs, row_tag, cell_tags, min_cells, skip_header):
    from html.parser import HTMLParser

    class Rows(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.depth = 0  # >0 while inside a matching container
            self.rows, self.cur, self.cell, self.header = [], None, None, False

        def handle_starttag(self, tag, at):
            a = dict(at)
            if self.depth:
                if tag == container_tag:
                    self.depth += 1
            elif tag == container_tag and all(
                    (k == "class" and v in (a.get("class") or "").split()) or a.get(k) == v
                    for k, v in attrs.items()):
                self.depth = 1
                return
            if not self.depth:
                return
            if tag == row_tag:
                self.cur, self.header = [], False
            elif tag in cell_tags and self.cur is not None:
                self.cell = []
                if tag == "th":
                    self.header = True

        def handle_endtag(self, tag):
            if not self.depth:
                return
            if tag in cell_tags and self.cell is not None and self.cur is not None:
                self.cur.append(" ".join("".join(self.cell).split()))
                self.cell = None
            elif tag == row_tag and self.cur is not None:
                if self.cell is not None:  # cell closed implicitly
                    self.cur.append(" ".join("".join(self.cell).split()))
                    self.cell = None
                if len(self.cur) >= min_cells and not (skip_header and self.header):
                    self.rows.append(self.cur)
                self.cur = None
            elif tag == container_tag:
                self.depth -= 1

        def handle_data(self, data):
            if self.depth and self.cell is not None:
                self.cell.append(data)

    def run(batches):
        for pdf in batches:
            found = []  # rows of several pages go on together
            for pid, html in zip(pdf["page_id"], pdf["html"]):
                p = Rows()
                p.feed(html or "")
                p.close()
                found += [(int(pid), i, cells) for i, cells in enumerate(p.rows)]
                if len(found) >= SHEET_ROWS:
                    yield pd.DataFrame(found, columns=HTML_ROW_SCHEMA.names)
                    found = []
            if found:
                yield pd.DataFrame(found, columns=HTML_ROW_SCHEMA.names)

    return run


def extract_html_rows(pages: DataFrame, container_tag: str = "table", attrs: Mapping[str, str] | None = None,
                      row_tag: str = "tr", cell_tags: Sequence[str] = ("td", "th"), min_cells: int = 1,
                      skip_header: bool = True) -> DataFrame:
    """SRC7: rows of a table (by id/class) of saved pages as trimmed cell
    text arrays; rows with fewer than ``min_cells`` cells (pager, spacer)
    and header rows are skipped. One page is parsed per task row."""
    fn = _html_rows(container_tag, dict(attrs or {}), row_tag, tuple(cell_tags), min_cells, skip_header)
    return pages.select(F.col("page_id").cast("long"), "html").mapInPandas(fn, HTML_ROW_SCHEMA)


HREF_RE = r"""<a\s[^>]*?href\s*=\s*["']([^"']*)["']"""


def digit_folder(href: Column) -> Column:
    """SRC8 default predicate: the second-last path part is all digits once
    '_' is removed."""
    part = F.try_element_at(F.split(href, "/"), F.lit(-2))
    return F.regexp_replace(part, "_", "").rlike("^[0-9]+$")


def extract_links(pages: DataFrame, base_url: str, predicate=digit_folder) -> DataFrame:
    """SRC8: hrefs of anchors that pass ``predicate``, prefixed with the
    base URL. Pure column expressions (regex + explode), no parser."""
    hrefs = pages.select("page_id", F.explode(F.regexp_extract_all("html", F.lit(HREF_RE), 1)).alias("href"))
    return hrefs.filter(predicate(F.col("href"))).select(
        "page_id", F.concat(F.lit(base_url), F.col("href")).alias("link"))


# --- SRC9-SRC12 ---------------------------------------------------------------------------------


def itemization_scan(lines: DataFrame, columns: Sequence[str], prefix: str = "SA", drop_prefix: str = "SA3L",
                     sep: str = "|", col: str = "value") -> DataFrame:
    """SRC9: keep schedule-A items of a filing (form type starts with
    ``prefix``), drop lines without a form type and ``drop_prefix``
    lines; positional projection to fixed text columns."""
    parts = F.split(F.col(col), re.escape(sep), -1)
    form = F.lower(F.trim(F.try_element_at(parts, F.lit(1))))
    kept = lines.filter(form.isNotNull() & (form != "") & form.startswith(prefix.lower())
                        & ~form.startswith(drop_prefix.lower()))
    p2 = F.split(F.col(col), re.escape(sep), -1)
    return kept.select(*[F.coalesce(F.try_element_at(p2, F.lit(i + 1)), F.lit("")).alias(c)
                         for i, c in enumerate(columns)])


def route_by_filename(paths: Sequence[str], schemas: Mapping[str, Sequence[str]]) -> dict[str, list[str]]:
    """SRC10: the key contained in a file's name picks the table, else the
    one in the name of its folder (writers such as Spark name the folder);
    files matching no key are returned under ``None`` (skipped)."""
    routes: dict = {}
    for p in paths:
        folder, name = ["", *p.rstrip("/").split("/")][-2:]
        key = next((k for where in (name, folder) for k in schemas if k in where), None)
        routes.setdefault(key, []).append(p)
    return routes


def list_files(spark: SparkSession, path: str, glob: str = "*") -> list[str]:
    """File listing through Spark's file index (metadata only)."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "true").load(path).select("path"))
    return sorted(r["path"] for r in files.collect())


def map_headers(df: DataFrame, aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """SRC11: canonical column ← first present header alias, else ''."""
    have = {c.lower(): c for c in df.columns}
    out = []
    for canon, names in aliases.items():
        found = [have[n.lower()] for n in names if n.lower() in have]
        out.append((F.coalesce(*[F.col(f"`{f}`") for f in found], F.lit("")) if found else F.lit("")).alias(canon))
    return df.select(*out)


def landing(spark: SparkSession, root: str, source: str, table: str) -> DataFrame:
    """SRC12: a landing table by (source, table) under a landing root."""
    return spark.read.parquet(f"{root.rstrip('/')}/{source}/{table}")
