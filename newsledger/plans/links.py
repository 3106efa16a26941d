"""The link table: collected links, newest batch first, never renumbered.

Links are kept in batches, each a folder ``batch=<number>`` of its own with the
position of every link inside it, and a run writes nothing but its new links. The
order of the table is (batch descending, position), which later batches do not
change. Dense positions over the whole table are made when it is read, without
moving a row: the ledger knows how many links every batch has, so a link's
position is its position in its batch plus the links of all newer batches.

Which links are known is asked of the table's key index; links, keys and count
of a run are one commit of the ledger (see ``ledger``).
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.incremental import with_row_index
from ..operators.key_index import KeyIndex
from .ledger import Ledger
from .run import mail_links

LINKS, KEYS = "links", "link_keys"


def append_links(spark: SparkSession, collected: DataFrame, root: str, key: str = "url", pos: str = "pos",
                 source: str | None = None) -> int:
    """Put the collected links (unique keys, in the order of ``pos``) that are
    not in the table yet before all others. Returns how many those are; if there
    are none, or ``source`` was appended before, nothing is written."""
    ledger = Ledger(spark, root)
    if source is not None and ledger.find(source):
        return 0
    number = ledger.next_number()
    index = KeyIndex(spark, os.path.join(root, KEYS), int(spark.conf.get("spark.sql.shuffle.partitions")))
    known = [b["folder"].removeprefix("run=") for b in ledger.batches(KEYS)]
    fresh = index.new_rows(collected, known, key, only_final=False) if known else collected
    name = f"{number:08d}-{uuid.uuid4().hex}"
    path = os.path.join(root, LINKS, f"batch={name}")
    with_row_index(fresh, [pos], "_pos").drop(pos).withColumnRenamed("_pos", pos).write.parquet(path)
    written = spark.read.parquet(path)
    n = written.count()
    if n:
        index.append(written, name, key)
        ledger.commit({"source": source, "batches": {LINKS: {"folder": f"batch={name}", "rows": n}, KEYS: {"folder": f"run={name}"}}}, number)
    return n


def read_links(spark: SparkSession, root: str, pos: str = "pos") -> DataFrame | None:
    """All links with their position in the whole table and ``batch`` (0 the
    newest). None if there is none."""
    batches = Ledger(spark, root).batches(LINKS)
    if not batches:
        return None
    rows, newer = [], 0
    for k, b in enumerate(reversed(batches)):
        rows.append((b["folder"].removeprefix("batch="), k, newer))
        newer += b["rows"]
    offsets = spark.createDataFrame(rows, "_batch string, _age int, _newer long")          # one row a batch
    base = os.path.join(root, LINKS)
    links = spark.read.option("basePath", base).option("mergeSchema", True).parquet(*[os.path.join(base, b["folder"]) for b in batches])
    links = links.withColumnRenamed("batch", "_batch").join(F.broadcast(offsets), "_batch")
    return links.withColumn(pos, F.col(pos) + F.col("_newer")).withColumn("batch", F.col("_age")).drop("_batch", "_age", "_newer")


def run_collect_links(spark: SparkSession, mails: DataFrame, root: str, source: str | None = None) -> int:
    """Links of alert mails (msg_pos, html) put before the table's links."""
    return append_links(spark, mail_links(mails), root, source=source)
