"""Loader for the driver-provided parquet tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

#: Optional session setting: partitions for tables that come as one file (a file
#: of one row group is read by one task). Off unless set; see bench.py.
PARTITIONS_CONF = "spark.newsledger.tablePartitions"


def table(spark: SparkSession, sf_dir: str, name: str, partitions: int | None = None) -> DataFrame:
    """Read one parquet table; Catalyst prunes columns and pushes filters.
    ``partitions`` (or the session setting) deals the rows out anew, which only
    small test tables of one file need."""
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    partitions = partitions or int(spark.conf.get(PARTITIONS_CONF, "0"))
    return df.repartition(partitions) if partitions else df
