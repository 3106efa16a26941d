"""Shared pieces: input tables, text columns and intermediate tables.

Intermediate tables are Parquet folders below ``spark.checkpoint.dir``: every
executor reads them, so a lost executor costs only the tasks it was running.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsledger.plans.ledger import file_system
from newsledger.session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACE = r"[\x20\x09-\x0D]"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the
    lineage, and later plans see its true size. ``codec`` of the files: the
    session's if none is named."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def stored_texts(df: DataFrame, name: str) -> DataFrame:
    """As ``stored``, in files that take less disk and more time."""
    return stored(df, name, "zstd")


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within, Spark deletes the shuffle files of each query as it ends, not
    when the driver happens to collect its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def drop_stored(*tables: DataFrame) -> None:
    """Delete tables of ``stored`` that nothing will read any more: what was
    made of them is stored itself."""
    for t in tables:
        fs, path, _ = file_system(t.sparkSession, t.stored_at)
        fs.delete(path, True)


def text_or_empty(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def lower_ascii(c: Column) -> Column:
    """A-Z lower-cased and nothing else. ``lower`` does just that on a text of
    one-byte characters and is much faster than ``translate``."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def small_side(df: DataFrame, rows: int, most: int) -> DataFrame:
    """Broadcast ``df`` only if its counted ``rows`` are at most ``most``; beyond
    it neither side is, however small the planner takes their files to be."""
    return F.broadcast(df) if rows <= most else df.hint("merge")


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"{name}_"
    return name


def hashed_id(c: str) -> Column:
    """crc32 of the id's decimal text (null: of the empty text)."""
    return F.crc32(F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary"))
