"""Versioned table writes.

A table is a folder of versions ``<root>/<name>/version=<n>``; readers take
the newest published version. A write never touches the version being read,
so 'overwrite the input' is safe; the previous versions are the backups. The
write is verified by re-reading its row count before it is published: by a
marker of its own, or by the run that names it in the ledger.
"""

from __future__ import annotations

import json
import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ledger import Ledger, file_system, read_batches

_VERSION = re.compile(r"^version=(\d+)$")
MARKER = "_PUBLISHED"


_fs = file_system


def published_versions(spark: SparkSession, root: str, name: str) -> list[int]:
    fs, p, jvm = _fs(spark, os.path.join(root, name))
    if not fs.exists(p):
        return []
    out = set(Ledger(spark, root).versions(name))
    for st in fs.listStatus(p):
        m = _VERSION.match(st.getPath().getName())
        if m and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), MARKER)):
            out.add(int(m.group(1)))
    return sorted(out)


def latest_path(spark: SparkSession, root: str, name: str) -> str | None:
    v = published_versions(spark, root, name)
    return os.path.join(root, name, f"version={v[-1]}") if v else None


def read_latest(spark: SparkSession, root: str, name: str, schema=None) -> DataFrame | None:
    p = latest_path(spark, root, name)
    if p is None:
        return None if schema is None else spark.createDataFrame([], schema)
    return spark.read.parquet(p)


def write_version(df: DataFrame, root: str, name: str, partition_by=(), verify: bool = True,
                  expected_rows: int | None = None, order_by=(), publish_empty: bool = True, publish: bool = True) -> str | None:
    """Write ``df`` as the next version and publish it after a row-count check.
    ``order_by`` sorts the output (a range-partitioned sort, e.g. by url).
    With ``publish_empty=False`` an empty result is left unpublished and None
    is returned (the plan runs once; no separate emptiness probe). With
    ``publish=False`` the version is left for a run of the ledger to name."""
    if order_by:
        df = df.orderBy(*order_by)
    spark = df.sparkSession
    versions = published_versions(spark, root, name)
    fs, p, jvm = _fs(spark, os.path.join(root, name))
    n = (max(versions) + 1) if versions else 1
    while fs.exists(jvm.org.apache.hadoop.fs.Path(p, f"version={n}")):
        n += 1   # skip an unpublished (failed) attempt
    path = os.path.join(root, name, f"version={n}")
    # rows that entered the write are counted while it runs and compared with what can be read back
    from pyspark.sql import Observation
    seen = Observation(f"rows-{uuid.uuid4().hex}")
    w = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    if verify or not publish_empty:
        written = spark.read.parquet(path).count()
        for expected in (seen.get["n"], expected_rows):
            if expected is not None and written != expected:
                raise IOError(f"{name}: wrote {written} rows, expected {expected}")
        if written == 0 and not publish_empty:
            return None
    if not publish:
        return path
    out = fs.create(jvm.org.apache.hadoop.fs.Path(path, MARKER), True)
    out.write(bytearray(json.dumps({"version": n}).encode()))
    out.close()
    return path


def truncate_table(spark: SparkSession, root: str, name: str) -> str:
    """Publish an empty version with the current schema (the old one stays as backup)."""
    cur = read_latest(spark, root, name)
    if cur is None:
        raise FileNotFoundError(f"no table {name} under {root}")
    return write_version(cur.limit(0), root, name, expected_rows=0)


def append_rows(df: DataFrame, path: str, partition_by=("run_date", "batch_id")) -> None:
    """Add a batch to the base. The rows carry the batch's own ``batch_id``;
    its partition is written as a whole, so a batch that is replayed replaces
    what its first try wrote, and other batches are never touched (they are the
    snapshots of the base: dropping a batch's folders undoes it)."""
    df.withColumn("batch_id", F.col("batch_id").cast("string")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def read_base(spark: SparkSession, root: str) -> DataFrame | None:
    """The base: all batches that committed runs name."""
    return read_batches(spark, root, "base")


def with_run_columns(df: DataFrame, run_ts: str) -> DataFrame:
    """Metadata columns: one literal timestamp per run, and its date."""
    ts = F.to_timestamp(F.lit(run_ts))
    return df.withColumn("extracted_at", ts).withColumn("run_date", F.to_date(ts))
