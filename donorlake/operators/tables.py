"""Table maintenance on partitioned Parquet folders (SNK1-SNK8).

* replace a slice = dynamic partition overwrite on a *derived* physical
  partition column (year, month, status…); a slice named by the caller that
  the new data no longer holds is cleared;
* key merges (delete+insert) and appends of unseen keys keep versions of a
  table of immutable files (``keyed.py``);
* every write is idempotent on re-run (same batch → same partitions).
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from donorlake.operators.keyed import append_new, keyed, merge_replace  # noqa: F401  (SNK4, SNK5)


def full_refresh(df: DataFrame, path: str) -> str:
    """SNK1: truncate and load."""
    df.write.mode("overwrite").parquet(path)
    return path


def replace_slice(df: DataFrame, path: str, slice_cols: Sequence[str],
                  slices: Sequence[Mapping[str, object]] = ()) -> str:
    """SNK2: replace the slices (partition values) present in ``df``, and
    clear those of ``slices`` that ``df`` has no row for. The data is written
    first; a failed write clears nothing."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*slice_cols).parquet(path))
    if slices:
        spark = df.sparkSession
        present = {tuple(map(str, r)) for r in df.select(*slice_cols).distinct().collect()}
        for s in slices:
            if tuple(str(s[c]) for c in slice_cols) not in present:
                fs, p, _ = _fs(spark, _slice_path(spark, path, slice_cols, s))
                fs.delete(p, True)
    return path


def _slice_path(spark: SparkSession, path: str, cols: Sequence[str], values: Mapping[str, object]) -> str:
    name = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    return "/".join([path.rstrip("/"), *(name(c, str(values[c])) for c in cols)])


def slice_by_date(df: DataFrame, date: Column, grain: str = "year", name: str | None = None) -> DataFrame:
    """SNK2/SNK3: derive the physical slice column from a real date (a text
    range such as ``"Date" >= 'MM/DD/YYYY'`` compares wrongly across years;
    parse first, then slice)."""
    fmt = {"year": "yyyy", "month": "yyyy-MM", "day": "yyyy-MM-dd"}[grain]
    return df.withColumn(name or f"slice_{grain}", F.date_format(date, fmt))


def append(df: DataFrame, path: str, batch_id: str, batch_col: str = "batch_id") -> str:
    """SNK6: append, idempotent per batch: the batch is its own partition,
    so a re-run of the same batch replaces instead of duplicating."""
    return replace_slice(df.withColumn(batch_col, F.lit(batch_id)), path, [batch_col])


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return fs.exists(p)


class BuildStopped(RuntimeError):
    """Raised by ``build`` when a model breaks its rules; ``report`` holds
    (model, rule, violations) of every rule that ran."""

    def __init__(self, report: list[tuple[str, str, int]]):
        self.report = report
        super().__init__("; ".join(f"{m}.{r}: {n} rows" for m, r, n in report if n))


def build(models: Mapping[str, tuple[Sequence[str], Callable[..., DataFrame]]], root: str,
          spark: SparkSession, rules: Mapping[str, Sequence] | None = None,
          report: list[tuple[str, str, int]] | None = None) -> dict[str, DataFrame]:
    """SNK7: materialise models in dependency order; each model reads its
    upstream models back from storage (lineage cut, restartable). A model
    with ``rules`` (``quality.Rule``) is checked when it is written; if it
    breaks one, models that need it are not built and ``BuildStopped`` is
    raised after the others are. ``report`` collects every rule's result."""
    from donorlake.operators.quality import run_suite

    report = [] if report is None else report
    done: dict[str, DataFrame] = {}
    broken: set[str] = set()
    visiting: set[str] = set()

    def visit(name: str) -> DataFrame | None:
        if name in done or name in broken:
            return done.get(name)
        if name in visiting:
            raise ValueError(f"cycle at {name}")
        visiting.add(name)
        deps, fn = models[name]
        inputs = {dep: visit(dep) for dep in deps}
        visiting.discard(name)
        if any(dep in broken for dep in deps):
            broken.add(name)
            return None
        path = f"{root.rstrip('/')}/{name}"
        fn(**inputs).write.mode("overwrite").parquet(path)
        out = spark.read.parquet(path)
        found = [] if not rules or name not in rules else [
            (name, f"{r['rule']}({r['column']})", r["violations"])
            for r in run_suite(out, rules[name], materialize=False).collect()]
        report.extend(found)
        if any(n for _, _, n in found):
            broken.add(name)
        else:
            done[name] = out
        return done.get(name)

    for n in models:
        visit(n)
    if broken:
        raise BuildStopped(report)
    return done


def write_with_report(df: DataFrame, path: str, table: str) -> dict:
    """SNK8: write and count in the same job (``observe``), no second scan."""
    obs = Observation(f"load_{table}_{int(time.time() * 1e6)}")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return {"table": table, "rows": int(obs.get["rows"])}
