"""The keys of what was processed, kept as a bucketed table.

Every run adds its own keys as a partition ``run=<name>``, cut into the same
buckets by the key's hash. To find out what is new, only the distinct keys of
the input are shuffled, into the index's buckets, and each bucket is joined where
it lies: the base itself is not read and no stored key is moved again (as long as
the index has no fewer buckets than the session has shuffle partitions; with fewer
Spark prefers to deal both sides anew). A run's keys count once the caller names
the run (a run that failed is never named). ``merge`` writes the keys of many runs
as one, so that a bucket is not read from many small files for ever.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.ledger import file_system
from ..session import staged

BUCKETS = 256            # of a new index; about the tasks that should read it
META = "_index.json"


class KeyIndex:
    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        """Open the index at ``path``, or set it up with so many buckets."""
        self.spark = spark
        fs, p, jvm = file_system(spark, path)
        self.path = str(fs.makeQualified(p).toString())
        meta = jvm.org.apache.hadoop.fs.Path(p, META)
        if fs.exists(meta):
            stream = fs.open(meta)
            self.buckets = json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["buckets"]
            stream.close()
        else:
            self.buckets = buckets or BUCKETS
            fs.mkdirs(p)
            out = fs.create(meta, True)
            out.write(bytearray(json.dumps({"buckets": self.buckets}).encode()))
            out.close()
        # a name of its own per folder; the files, not the catalog, hold what lasts
        self.table = f"key_index_{hashlib.md5(self.path.encode()).hexdigest()}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} (key STRING, final BOOLEAN, run STRING) USING parquet PARTITIONED BY (run) "
                  f"CLUSTERED BY (key) SORTED BY (key) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")

    def append(self, rows: DataFrame, run: str, key: str = "url", final=None) -> None:
        """Add a run's keys; ``final`` says (per row) whether the key is done
        with. A run that is added again replaces what its first try added."""
        done = F.lit(True) if final is None else F.coalesce(final, F.lit(False))
        keys = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("string").alias("key")).agg(F.max(done).alias("final"))
        # stored first: the rows may have been found by this index
        staged(keys, "keys").repartition(self.buckets, "key").createOrReplaceTempView(view := f"{self.table}_new")
        self.spark.sql(f"INSERT OVERWRITE {self.table} PARTITION (run = '{run}') SELECT key, final FROM {view}")
        self.spark.catalog.dropTempView(view)

    def entries(self, runs: Sequence[str], only_final: bool = True) -> DataFrame:
        """Keys of the named runs, as they lie in their buckets."""
        self.spark.catalog.refreshTable(self.table)
        found = self.spark.table(self.table).where(F.col("run").isin(*runs) if runs else F.lit(False))
        return (found.where("final") if only_final else found).select("key")

    def known(self, rows: DataFrame, runs: Sequence[str], key: str = "url", only_final: bool = True) -> DataFrame:
        """(key): which of the rows' distinct keys are in the index."""
        asked = rows.select(F.col(key).cast("string").alias("key")).where(F.col("key").isNotNull()).distinct()
        return asked.join(self.entries(runs, only_final).hint("merge"), "key", "left_semi")

    def merge(self, runs: Sequence[str], into: str) -> None:
        """Write the keys of the named runs once more as the run ``into``."""
        found = self.spark.read.schema("key string, final boolean").parquet(*[os.path.join(self.path, f"run={r}") for r in runs])
        self.append(found, into, "key", F.col("final"))

    def new_rows(self, rows: DataFrame, runs: Sequence[str], key: str = "url", only_final: bool = True) -> DataFrame:
        """Rows whose key is in no named run. Null keys and rows of one key
        stay as they are; a key with many rows costs the index one lookup."""
        known = self.known(rows, runs, key, only_final).withColumnRenamed("key", "__known")
        return rows.join(known, F.col(key).cast("string") == F.col("__known"), "left_anti")
