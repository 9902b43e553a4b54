"""Delta sync of the master table to a serving table (SYN1-SYN6, TOP1).

State under one root, each a Parquet folder partitioned by batch id, so a
batch writes its own partitions and nothing else:

  delta-of  rows that a batch takes up
  pending   rows past the cap; the next batch takes all of them up
  consumed  the batches whose pending rows a batch has taken up
  serving   published rows, without the id
  ledger    keys of published rows

A row's key is its id; a row without an id has the hash of all its columns.
A batch takes up

* every incoming row whose key no *other* batch has published, and
* every row that still waits, unless its key comes in again to be taken up
  (then the incoming rows stand for it),

each row as often as it occurs, with or without a cap: rows of one key that a
cap parts are published by different batches. Order per run: delta -> cap, if
the caller asks for one -> publish -> pending -> consumed -> ledger. The
ledger is written last. A batch id may be used again: what its own first run
published, left pending or consumed does not count, and its partitions are
replaced, so nothing is lost or doubled.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from donorlake.operators.aggregates import newest_cut, tied_newest
from donorlake.operators.joins import without
from donorlake.operators.tables import exists, replace_slice

# Fixed value from the source configuration.
MAX_RETRIES = 1


_KEY = "_sync_key"


def _keyed(df: DataFrame, key: str) -> DataFrame:
    row = F.concat(F.lit("row:"), F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256))
    return df.withColumn(_KEY, F.coalesce(F.col(key).cast("string"), row))


def delta(master: DataFrame, ledger: DataFrame | None, key: str = "source_id") -> DataFrame:
    """SYN1 / SYN2: all rows on the first sync (empty ledger), else the rows
    whose key the ledger does not hold; rows without an id by all columns."""
    if ledger is None:
        return master
    synced = ledger.select(F.col(key).cast("string").alias(_KEY))
    return without(_keyed(master, key), synced, _KEY).drop(_KEY)


def publish(rows: DataFrame, target: str, batch_id: str, key: str = "source_id") -> int:
    """SYN4: serving rows carry no ``source_id``; one partition per batch,
    cleared when the batch holds no rows. The rows written are counted in the
    same job."""
    obs = Observation(f"publish_{uuid.uuid4().hex[:12]}")
    marked = rows.drop(key).withColumn("batch_id", F.lit(batch_id)).observe(obs, F.count(F.lit(1)).alias("rows"))
    replace_slice(marked, target, ["batch_id"], [{"batch_id": batch_id}])
    return int(obs.get["rows"])


def _retry(fn, retries: int = MAX_RETRIES):
    for attempt in range(retries + 1):
        try:
            return fn()
        except Exception:  # noqa: BLE001
            if attempt == retries:
                raise


@dataclass
class SyncReport:
    batch_id: str
    delta_rows: int
    overflow_rows: int
    published_rows: int


def _ledger_fields(key: str) -> T.StructType:
    return T.StructType().add(key, "string").add("synced_at", "timestamp")


class SyncError(RuntimeError):
    """A sync guard failed."""


def _batches(spark: SparkSession, path: str, fields: T.StructType | None = None) -> DataFrame | None:
    """A partitioned folder with its batch ids; ``fields`` are needed where
    it may hold no row at all."""
    if not exists(spark, path):
        return None
    reader = spark.read.option("mergeSchema", "false")
    if fields is not None:
        reader = reader.schema(T.StructType([*(f for f in fields if f.name != "batch_id"), T.StructField("batch_id", T.StringType())]))
    return reader.parquet(path)


def _write_counted(df: DataFrame, path: str, batch_id: str) -> int:
    """Write a batch's partition and count its rows in the same job."""
    obs = Observation(f"sync_{uuid.uuid4().hex[:12]}")
    marked = df.withColumn("batch_id", F.lit(batch_id)).observe(obs, F.count(F.lit(1)).alias("rows"))
    marked.write.mode("overwrite").partitionBy("batch_id").parquet(path)
    return int(obs.get["rows"])


def sync(master: DataFrame, root: str, batch_id: str, now: dt.datetime, max_rows: int | None = None,
         key: str = "source_id", newest: str = "contribution_datetime",
         max_overflow: int | None = None) -> SyncReport:
    """SYN6: one sync run (lock handling is left to the scheduler). Without
    ``max_rows`` everything is synced; with it the newest rows go first and
    the others wait as pending. Guards: the published rows must be those of
    the delta less the overflow, and an overflow above ``max_overflow``
    raises before anything is published."""
    spark: SparkSession = master.sparkSession
    other = F.col("batch_id") != F.lit(batch_id)
    mark = lambda x: x.withColumn("batch_id", F.lit(batch_id))
    mine = [{"batch_id": batch_id}]
    synced = _batches(spark, f"{root}/ledger", _ledger_fields(key))
    waiting = _batches(spark, f"{root}/pending", master.schema)
    rows = _keyed(delta(master, None if synced is None else synced.filter(other), key), key)
    from_batches = []
    if waiting is not None:
        done = _batches(spark, f"{root}/consumed", T.StructType().add("from_batch", "string"))
        held = waiting.filter(other).select("batch_id").distinct()
        if done is not None:
            held = held.join(done.filter(other).select(F.col("from_batch").alias("batch_id")), "batch_id", "left_anti")
        from_batches = [r["batch_id"] for r in held.collect()]  # batches that nobody took up: as a rule one
        if from_batches:
            late = waiting.filter(F.col("batch_id").isin(from_batches)).drop("batch_id")
            rows = rows.unionByName(without(_keyed(late, key), rows, _KEY))
    # the delta is written: later steps read a fixed set
    work = f"{root}/delta-of/{batch_id}"
    n = _retry(lambda: _write_counted(rows, work, batch_id))
    d = spark.read.schema(rows.schema).parquet(work)
    overflow = max(n - max_rows, 0) if max_rows is not None else 0
    if max_overflow is not None and overflow > max_overflow:
        raise SyncError(f"batch {batch_id}: {overflow} rows past the cap, more than {max_overflow}")
    kept, late = d, d.limit(0)
    if overflow:
        # the delta is a fixed set, so a filter parts it; only the rows that have
        # the cap's own value are numbered, and written: equal rows apart, none
        # is in both parts
        newer, tied, left = newest_cut(d, newest, max_rows)
        split = f"{root}/delta-capped/{batch_id}"
        tied_newest(d, tied, left, newest, key).write.mode("overwrite").parquet(split)
        split = spark.read.schema(d.schema.add("_in", "boolean")).parquet(split)
        kept = d.filter(newer).unionByName(split.filter("_in").drop("_in"))
        late = d.filter(~newer & ~tied).unionByName(split.filter("NOT _in").drop("_in"))
    published = _retry(lambda: publish(kept.drop(_KEY), f"{root}/serving", batch_id, key))
    if published != n - overflow:
        raise SyncError(f"batch {batch_id}: {published} rows published of {n - overflow}")
    if overflow or waiting is not None:
        replace_slice(mark(late.drop(_KEY)), f"{root}/pending", ["batch_id"], mine)
        replace_slice(mark(spark.createDataFrame([(b,) for b in from_batches], "from_batch string")),
                      f"{root}/consumed", ["batch_id"], mine)
    keys = kept.select(F.col(_KEY).alias(key)).distinct()
    _retry(lambda: replace_slice(mark(keys.withColumn("synced_at", F.lit(now).cast("timestamp"))),
                                 f"{root}/ledger", ["batch_id"], mine))
    return SyncReport(batch_id, n, overflow, n - overflow)


def publish_new(rows: DataFrame, root: str, batch_id: str, now: dt.datetime, own: str,
                key: str = "source_id") -> SyncReport:
    """Publish rows that their sender knows to be new: serving, then ledger.
    Only batches whose id does not begin with ``own`` are looked up."""
    spark = rows.sparkSession
    synced = _batches(spark, f"{root}/ledger", _ledger_fields(key))
    foreign = None if synced is None else synced.filter(~F.col("batch_id").startswith(own))
    if foreign is not None and foreign.isEmpty():  # by partition: the stream's own batches are not read
        foreign = None
    work = f"{root}/delta-of/{batch_id}"
    n = _retry(lambda: _write_counted(_keyed(delta(rows, foreign, key), key), work, batch_id))
    d = spark.read.schema(T.StructType([*rows.schema, T.StructField(_KEY, T.StringType())])).parquet(work)
    published = _retry(lambda: publish(d.drop(_KEY), f"{root}/serving", batch_id, key))
    if published != n:
        raise SyncError(f"batch {batch_id}: {published} rows published of {n}")
    keys = d.select(F.col(_KEY).alias(key)).distinct().withColumns(
        {"synced_at": F.lit(now).cast("timestamp"), "batch_id": F.lit(batch_id)})
    _retry(lambda: replace_slice(keys, f"{root}/ledger", ["batch_id"], [{"batch_id": batch_id}]))
    return SyncReport(batch_id, n, 0, n)


def serving(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/serving")


def delta_of(spark: SparkSession, root: str, batch_id: str) -> DataFrame:
    return spark.read.parquet(f"{root}/delta-of/{batch_id}").drop("batch_id", _KEY)


def ledger(spark: SparkSession, root: str, key: str = "source_id") -> DataFrame | None:
    """SYN5: synced ids; an id that is synced again keeps its insert_time and
    gets the later synced_at (an upsert on read: batches only add rows)."""
    rows = _batches(spark, f"{root}/ledger", _ledger_fields(key))
    return None if rows is None else rows.groupBy(key).agg(
        F.min("synced_at").alias("insert_time"), F.max("synced_at").alias("synced_at"))
