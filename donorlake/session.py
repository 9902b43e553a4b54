"""Session construction and shared-storage helpers.

All jobs run on whatever session the caller hands in. ``get_session`` is
only a convenience for tests, the bench and local runs: it sets the
settings the engine relies on (UTC session zone, ANSI mode, AQE with skew
handling) and nothing cluster-specific.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job assumes. They are plain Spark SQL confs, so they can
# be applied to an existing (cluster) session too, see ``apply_defaults``.
ENGINE_CONFS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # dynamic overwrite is what replace_slice (SNK2) relies on
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_session(
    app: str = "donorlake",
    cpus: int | str = "*",
    shuffle_partitions: int | None = None,
    driver_memory: str = "16g",
    checkpoint_dir: str | None = None,
) -> SparkSession:
    """A local session (tests, bench). ``checkpoint_dir`` stands for the
    shared folder a cluster would name."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.checkpoint.dir", checkpoint_dir or tempfile.mkdtemp(prefix="donorlake-shared-"))
        .config(SCAN_PARTITIONS, str(os.cpu_count() if cpus == "*" else int(cpus)))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(
            "spark.sql.shuffle.partitions",
            str(shuffle_partitions or (8 if cpus == "*" else int(cpus))),
        )
    )
    for k, v in ENGINE_CONFS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Apply the engine's SQL confs to an existing session and make the
    package importable on the Python workers."""
    for k, v in ENGINE_CONFS.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Distribute this package to the executors once per SparkContext
    (``addPyFile``, the same mechanism as ``--py-files``): pandas functions
    that reference package helpers are unpickled on the workers."""
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="donorlake-pyfiles-"), "donorlake.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(key)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and job outputs.

    Read from ``spark.checkpoint.dir`` (what a cluster names as shared
    storage). Where it is unset, a session in local mode (a test) gets a
    fresh folder; on a cluster that is an error.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not root:
        current = sc.getCheckpointDir()
        if current:
            # getCheckpointDir appends a per-application uuid; use its parent
            root = current.rsplit("/", 1)[0]
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="donorlake-ckpt-")
        sc.setCheckpointDir(root)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/donorlake/{name}-{uuid.uuid4().hex[:12]}"


#: Spark's setting that removes a query's shuffle files when the query ends.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Inside, a query's shuffle files go when it ends, not when the driver
    happens to collect its garbage: steps of a job don't add up on disk."""
    was = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, was)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so stdlib code can touch local test paths."""
    if path.startswith("file:"):
        path = path[len("file:") :]
        while path.startswith("//"):
            path = path[1:]
    return path


#: Session setting: into how many partitions table scans are dealt. Unset,
#: scans keep their file splits, which is right for large tables; a session
#: over files of one row group each sets it to use all its cores.
SCAN_PARTITIONS = "spark.donorlake.scanPartitions"


def spread(df):
    """Deal a scan into the number of partitions the session asks for, if it
    does. Filters and column pruning still reach the scan below it."""
    n = df.sparkSession.conf.get(SCAN_PARTITIONS, None)
    return df.repartition(int(n)) if n else df


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
