"""Loading files one transaction each (SRC10).

A run lists the files, picks each one's table by its name, leaves out those
that no table takes and those that an earlier run has loaded, and writes the
rows of the others, with the file they are from, to a stage folder a table: the
parts are as many as the tasks, not as the files. A file with an unreadable
part or more bad rows than ``max_bad`` fails alone: the table's rows are
written once more without its own. The stage folders are then renamed into the
tables and, last, the run's log is renamed into place: only what a log names is
read, so a run that stops in between leaves nothing. What is undone is left out
by the log as well.

    <root>/stage/<run>/<table>         rows of a run that goes on
    <root>/data/<table>/run=<run>      rows with their file_id, bad ones marked
    <root>/log/run=<run>               one row a file: what became of it
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from donorlake.sources import ranges as rg

LOADED, SKIPPED, FAILED = "loaded", "skipped", "failed"
_LOG = "file string, size long, modified timestamp, file_id string, table string, status string, rows long, bad_rows long, reason string"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    new = jvm.org.apache.hadoop.fs.Path
    return new(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), new


def _runs(spark: SparkSession, root: str) -> list[str]:
    fs, new = _fs(spark, root)
    if not fs.exists(new(f"{root}/log")):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(new(f"{root}/log")))
    return sorted(n[4:] for n in names if n.startswith("run="))


def log(spark: SparkSession, root: str) -> DataFrame:
    """What became of each file, by run."""
    schema = T.StructType([*T._parse_datatype_string(_LOG), T.StructField("run", T.StringType())])
    if not _runs(spark, root):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/log")


def table_of(schemas: Mapping[str, Sequence[str]]):
    """The table whose key the file's name contains, else its folder's."""
    parts = F.split("file", "/")
    name, folder = F.element_at(parts, -1), F.coalesce(F.try_element_at(parts, F.lit(-2)), F.lit(""))
    return F.coalesce(*[F.when(where.contains(k), F.lit(k)) for where in (name, folder) for k in schemas])


def load_files(spark: SparkSession, path: str | Sequence[str], schemas: Mapping[str, Sequence[str]], root: str,
               sep: str = ",", quote: str | None = '"', header: bool = True, encoding: str = "utf-8",
               glob: str = "*", max_bad: int = 0, split_bytes: int = rg.SPLIT_BYTES) -> DataFrame:
    """Load the files below ``path`` and report the run: table, status, files,
    rows, bad_rows. A file is the same as one loaded before if name, size and
    time are. Empty files are not listed (Spark's file index leaves them out)."""
    run = f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    stage = f"{root}/stage/{run}"
    ident = F.substring(F.sha2(F.concat_ws("|", "file", "size", F.col("modified").cast("string")), 256), 1, 20)
    rg.files_of(spark, path, glob).withColumns({"file_id": ident, "table": table_of(schemas)}).write.parquet(f"{stage}/_files")
    listed = spark.read.parquet(f"{stage}/_files")
    loaded = (log(spark, root).filter(F.col("status").isin(LOADED, FAILED, "undone"))
              .groupBy("file_id").agg(F.max_by("status", "run").alias("was")).filter(F.col("was") == LOADED))
    fresh = listed.filter("table IS NOT NULL").join(loaded, "file_id", "left_anti")
    n_tasks = rg.tasks_for(listed, split_bytes)
    counts = []
    for table, columns in schemas.items():
        mine = fresh.filter(F.col("table") == table)
        found = rg.with_quote_state(rg.ranges_of(mine, split_bytes), quote, n_tasks).repartition(n_tasks, "file", "begin")
        rows = rg.read_ranges(found, columns, sep, quote, header, encoding, carry=["file_id"], keep_failed=True)
        rows.write.parquet(f"{stage}/{table}")
        written = spark.read.schema(rows.schema).parquet(f"{stage}/{table}")
        counts.append(written.groupBy("file_id").agg(
            F.count_if(F.col(rg.CORRUPT).isNull() & F.col(rg.FAILED).isNull()).alias("rows"),
            F.count(rg.CORRUPT).alias("bad_rows"), F.max(rg.FAILED).alias("reason")))
    seen = counts[0]
    for c in counts[1:]:
        seen = seen.unionByName(c)
    took = fresh.select("file_id").withColumn("_fresh", F.lit(True))
    bad = F.coalesce("bad_rows", F.lit(0))
    outcome = (
        listed.join(took, "file_id", "left").join(seen, "file_id", "left")
        .withColumn("status", F.when(F.col("_fresh").isNull(), F.lit(SKIPPED))
                    .when(F.col("reason").isNotNull() | (bad > max_bad), F.lit(FAILED)).otherwise(F.lit(LOADED)))
        .select("file", "size", "modified", "file_id", "table", "status",
                F.coalesce("rows", F.lit(0)).alias("rows"), bad.alias("bad_rows"),
                F.when(F.col("_fresh").isNull(), F.when(F.col("table").isNull(), F.lit("no table")).otherwise(F.lit("loaded before")))
                .otherwise(F.coalesce("reason", F.when(bad > max_bad, F.format_string("%d bad rows", bad)))).alias("reason")))
    outcome.write.parquet(f"{stage}/_log")
    outcome = spark.read.schema(_LOG).parquet(f"{stage}/_log")
    fs, new = _fs(spark, root)
    failed = outcome.filter(F.col("status") == FAILED)
    parted = {r["table"] for r in failed.select("table").distinct().collect()}
    for table in schemas:
        staged = f"{stage}/{table}"
        if table in parted:
            spark.read.parquet(staged).join(failed.select("file_id"), "file_id", "left_anti").write.parquet(f"{staged}-kept")
            staged += "-kept"
        fs.mkdirs(new(f"{root}/data/{table}"))
        fs.rename(new(staged), new(f"{root}/data/{table}/run={run}"))
    fs.mkdirs(new(f"{root}/log"))
    fs.rename(new(f"{stage}/_log"), new(f"{root}/log/run={run}"))
    fs.delete(new(stage), True)
    return (log(spark, root).filter(F.col("run") == run).groupBy("table", "status")
            .agg(F.count("*").alias("files"), F.sum("rows").alias("rows"), F.sum("bad_rows").alias("bad_rows")))


def _stored(spark: SparkSession, root: str, table: str, columns: Sequence[str]) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in
                           (*columns, rg.CORRUPT, rg.FAILED, "run", "file_id")])
    fs, new = _fs(spark, root)
    base = f"{root}/data/{table}"
    paths = [p for r in _runs(spark, root) if fs.exists(new(p := f"{base}/run={r}"))]
    if not paths:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", base).parquet(*paths)
    undone = log(spark, root).filter(F.col("status") == "undone")
    if undone.isEmpty():
        return rows
    last = undone.groupBy("file_id").agg(F.max("run").alias("_undone"))
    return rows.join(last, "file_id", "left").filter("_undone IS NULL OR run > _undone").select(*schema.names)


def table(spark: SparkSession, root: str, name: str, columns: Sequence[str]) -> DataFrame:
    """The rows of all loaded files of a table, with the run and file."""
    rows = _stored(spark, root, name, columns)
    return rows.filter(F.col(rg.CORRUPT).isNull() & F.col(rg.FAILED).isNull()).drop(rg.CORRUPT, rg.FAILED)


def quarantine(spark: SparkSession, root: str, name: str, columns: Sequence[str]) -> DataFrame:
    """Bad rows of loaded files (at most ``max_bad`` a file)."""
    rows = _stored(spark, root, name, columns)
    return rows.filter(F.col(rg.CORRUPT).isNotNull()).select(F.col(rg.CORRUPT).alias("raw_line"), "run", "file_id")


def undo(spark: SparkSession, root: str, file: str) -> int:
    """Take a loaded file back out: its rows are no longer read, and the next
    run may load it again. The number of its rows."""
    held = log(spark, root).filter((F.col("file") == file) & (F.col("status") == LOADED)).collect()
    fs, new = _fs(spark, root)
    run = f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    rows = [tuple(r[c] for c in ("file", "size", "modified", "file_id", "table")) + ("undone", r["rows"], r["bad_rows"], "undone")
            for r in held]
    aside = f"{root}/stage/{run}"
    spark.createDataFrame(rows, _LOG).write.parquet(aside)
    fs.rename(new(aside), new(f"{root}/log/run={run}"))
    return sum(r["rows"] for r in held)
