"""Incremental run over arriving input files.

Each micro-batch of new input files is a run of its own (``foreachBatch``): the
rows that no committed run has finished are processed and filled, heat, base and
keys are written and named in the run ledger by one commit, with the counts of
the run. With ``Trigger.AvailableNow`` the query drains whatever files exist and
stops - the streaming equivalent of re-running the batch job. The source
checkpoint records which files were consumed, so a restarted job neither skips
nor repeats a file. A batch is known by its checkpoint and number: one that was
committed is not run again when it is replayed, one that failed half-way has
left nothing that is read and runs anew. Of rows of one key in a batch the first
by value is processed; rows without a key all are.
"""

from __future__ import annotations

import zlib
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.incremental import first_per_key
from ..plans import run as runmod
from ..plans.ledger import Ledger


def batch_name(spark: SparkSession, out_root: str, checkpoint: str, batch_id: int) -> str:
    """The batch's number; if a run of another source has that name, with a
    mark of this checkpoint."""
    taken = {b["folder"].rsplit("=", 1)[1] for b in Ledger(spark, out_root).batches("base")}
    return str(batch_id) if str(batch_id) not in taken else f"s{zlib.crc32(checkpoint.encode()):08x}-{batch_id}"


def start(spark: SparkSession, input_dir: str, schema: T.StructType, out_root: str, classifier,
          extractor, settings: runmod.RunSettings, checkpoint: str,
          max_files_per_trigger: int | None = None, fmt: str = "parquet"):
    """Start the available-now query; returns the StreamingQuery. ``checkpoint``
    must be a lasting shared folder: without it a restart would read all files
    again. Each batch is stamped with its own start time unless the settings
    name a fixed ``run_ts``."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(input_dir)
    fixed = settings.run_ts != runmod.RunSettings.run_ts

    def handle(batch: DataFrame, batch_id: int) -> None:
        now = datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
        s = replace(settings, run_ts=settings.run_ts if fixed else now)
        session, source = batch.sparkSession, f"{checkpoint}#{batch_id}"
        if Ledger(session, out_root).find(source):
            return
        keyed = batch.where(F.col(s.key).isNotNull())
        others = [c for c in batch.columns if c != s.key]
        rows = first_per_key(keyed, s.key, others).unionByName(batch.where(F.col(s.key).isNull()))
        runmod.run_incremental(session, rows, out_root, classifier, extractor, s, source,
                               batch_name(session, out_root, checkpoint, batch_id))

    return (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
