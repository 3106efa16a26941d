"""Session helpers.

Library code never creates a session: every operator takes DataFrames and
returns DataFrames. ``local_session`` exists for tests and the bench only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "newsledger") -> SparkSession:
    """Local session for tests / bench (UTC, AQE on, small shuffle width)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as is. Where it is unset, a folder is created on a local master (tests)
    and an error raised on any other: a machine-local folder would be lost.
    """
    current = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if current:
        # SparkContext keeps its own copy; make sure Dataset.checkpoint() sees it.
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_CONF} must name a folder that all executors share")
    path = tempfile.mkdtemp(prefix="newsledger-ckpt-")
    spark.conf.set(CHECKPOINT_CONF, path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def work_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables."""
    return os.path.join(ensure_checkpoint_dir(spark), *parts)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to a new table in the shared folder and read back.
    Whatever is derived from it sees the same rows, also after lost executors."""
    spark = df.sparkSession
    path = work_path(spark, "staged", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
