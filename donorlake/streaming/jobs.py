"""Structured Streaming re-aims of the incremental batch jobs (STR1, STR2).

The source pipeline has no stream processing; its "new files once" landing
and its per-run delta sync map onto a file-source stream with a
checkpoint (each file is processed exactly once) and ``foreachBatch``.
``trigger(availableNow=True)`` drains what is there and stops, which is
how a scheduled run uses them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from donorlake.operators import sync as syn
from donorlake.operators.dedup import best_per_key, desc, newest_order
from donorlake.operators.tables import exists
from donorlake.sources.landing import CORRUPT, text_schema

#: Batch ids of a stream's epochs begin with this.
EPOCH = "epoch-"
#: Keyed state on disk; an epoch's checkpoint holds its changes.
STATE_CONFS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # no look-up before each put, only to count keys
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def land_stream(spark: SparkSession, input_path: str, columns: Sequence[str], table_path: str,
                checkpoint: str, sep: str = ",", header: bool = True, quarantine_path: str | None = None,
                max_files_per_trigger: int | None = None) -> None:
    """STR1: land new delimited files exactly once into a Parquet table.
    Rows of the wrong width go to ``quarantine_path`` (unless given, a
    folder beside the table)."""
    quarantine_path = quarantine_path or f"{table_path.rstrip('/')}_quarantine"
    schema = text_schema(columns).add(T.StructField(CORRUPT, T.StringType()))
    r = (spark.readStream.schema(schema).option("sep", sep).option("header", str(header).lower())
         .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("escape", '"'))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    src = r.csv(input_path)

    def write_batch(batch: DataFrame, epoch: int) -> None:
        batch = batch.withColumn("_epoch", F.lit(epoch))
        full = F.coalesce(F.length(F.concat_ws("", *[F.col(c) for c in columns])), F.lit(0)) >= 0
        good = batch.filter(F.col(CORRUPT).isNull() & full).drop(CORRUPT)
        # idempotent per epoch: a replayed epoch replaces its own partition
        (good.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("_epoch").parquet(table_path))
        bad = batch.filter(F.col(CORRUPT).isNotNull() & full).select(F.col(CORRUPT).alias("raw_line"), "_epoch")
        (bad.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("_epoch").parquet(quarantine_path))

    q = (src.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def first_seen(stream: DataFrame, key: str, newest: str) -> DataFrame:
    """The rows of a stream whose key no earlier epoch had: of the rows that a
    key has in its first epoch the newest (then the least by all columns). What
    was seen is the state of a streaming aggregation in the checkpoint: an epoch
    reads and writes the state of its own keys only, however long the history is.
    Rows without a key are known by all their columns.

    In update mode every key of an epoch comes out once; those are new whose
    first and last epoch (by its start time, which a replayed epoch keeps) is the
    one that runs."""
    row = F.concat(F.lit("row:"), F.sha2(F.to_json(F.struct(*sorted(stream.columns)), {"ignoreNullFields": "false"}), 256))
    best = F.min(F.struct(*newest_order(stream, newest), *[F.col(c).alias(f"_t{i}") for i, c in enumerate(stream.columns)]))
    keyed = stream.withColumns({"_key": F.coalesce(F.col(key).cast("string"), row), "_at": F.current_timestamp()})
    return (keyed.groupBy("_key").agg(best.alias("_best"), F.min("_at").alias("_first"), F.max("_at").alias("_last"))
            .filter((F.col("_first") == F.current_timestamp()) & (F.col("_first") == F.col("_last")))
            .select(*[F.col(f"_best._t{i}").alias(c) for i, c in enumerate(stream.columns)]))


def sync_stream(spark: SparkSession, source_path: str, schema: T.StructType, root: str, checkpoint: str,
                now: dt.datetime, max_rows: int | None = None,
                max_files_per_trigger: int | None = None) -> list[syn.SyncReport]:
    """STR2: rows of new master files whose ``source_id`` was not published
    yet are published, a batch an epoch, so a replayed epoch replaces its own.

    Without a cap the ids that were seen are the stream's own state
    (``first_seen``): neither ledger nor serving is read, and an epoch costs
    what its rows cost. The ledger is written all the same; batches that are
    not the stream's own (runs before it) are left out by a join with theirs.

    With ``max_rows`` each micro-batch is deduplicated and synced like a batch
    run (ledger, pending): rows past the cap wait and are taken up by the next
    epoch; a run without new files takes up what still waits."""
    reports: list[syn.SyncReport] = []
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    src = r.parquet(source_path)

    def capped(batch: DataFrame, epoch: int) -> None:
        one = best_per_key(batch, ["source_id"], [desc("contribution_datetime")])
        reports.append(syn.sync(one, root, f"{EPOCH}{epoch:06d}", now, max_rows))

    def publish(batch: DataFrame, epoch: int) -> None:
        reports.append(syn.publish_new(batch, root, f"{EPOCH}{epoch:06d}", now, own=EPOCH))

    if max_rows is None:
        for name, value in STATE_CONFS.items():
            spark.conf.set(name, value)
        src, run = first_seen(src, "source_id", "contribution_datetime"), publish
    else:
        run = capped
    q = (src.writeStream.foreachBatch(run).outputMode("append" if max_rows is not None else "update")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if max_rows is not None and not reports and exists(spark, f"{root}/pending"):
        none = spark.createDataFrame([], schema)
        reports.append(syn.sync(none, root, f"idle-{now:%Y%m%dT%H%M%S}", now, max_rows))
    return reports
