"""The run ledger: one commit for everything a run writes.

A run writes its outputs (versions of tables, a batch of the base, a run of the
key index) under names that nobody reads yet. Its last act is one small file,
``<root>/runs/<number>.json``, that names them all, put in place by a rename that
fails if the number is taken. Readers go by these files only, so they see all of
a run or nothing of it, whichever write it stopped after; of two runs at a time
one commits and the other fails without a trace in what is read. What a stopped
run left behind stays unseen until ``remove_orphans`` deletes it.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession

FOLDER = "runs"


class CommitConflict(Exception):
    """Another run committed first; nothing of this run is visible."""


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path, JVM) of any path or URI."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


class Ledger:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.folder = spark, root, os.path.join(root, FOLDER)

    def runs(self) -> list[dict]:
        """What the committed runs say, in their order (one small file a run)."""
        fs, p, _ = file_system(self.spark, self.folder)
        if not fs.exists(p):
            return []
        found = self.spark.read.text(self.folder, wholetext=True, pathGlobFilter="*.json").collect()
        return sorted((json.loads(r.value) for r in found), key=lambda r: r["run"])

    def commit(self, entry: dict, expected: int | None = None) -> int:
        """Publish a run; ``expected`` is the number it was prepared as (by
        default the next one). Returns the number."""
        number = expected or self.next_number()
        fs, folder, jvm = file_system(self.spark, self.folder)
        fs.mkdirs(folder)
        path = lambda name: jvm.org.apache.hadoop.fs.Path(folder, name)
        draft, final = path(f".{uuid.uuid4().hex}"), path(f"{number:08d}.json")
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(entry | {"run": number}, sort_keys=True, default=str).encode()))
        out.close()
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(folder.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        no_option = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            files.rename(files.makeQualified(draft), files.makeQualified(final), no_option)       # fails if the number is taken
        except Exception as e:
            fs.delete(draft, False)
            if "FileAlreadyExists" in str(e):
                raise CommitConflict(f"run {number} of {self.root} was committed by another run") from e
            raise
        return number

    def next_number(self) -> int:
        return max((r["run"] for r in self.runs()), default=0) + 1

    def find(self, source: str) -> dict | None:
        """The committed run of a source, e.g. of a stream's batch."""
        return next((r for r in self.runs() if r.get("source") == source), None)

    def versions(self, table: str) -> list[int]:
        return sorted(r["tables"][table] for r in self.runs() if table in r.get("tables", {}))

    def batches(self, table: str) -> list[dict]:
        """Batches of an appended table, oldest first, without those that a
        later batch replaces."""
        found = [r["batches"][table] for r in self.runs() if table in r.get("batches", {})]
        gone = {f for b in found for f in b.get("replaces", ())}
        return [b for b in found if b["folder"] not in gone]

    def summaries(self) -> DataFrame | None:
        """One row per run: its number and its counts."""
        rows = [{"run": r["run"]} | r["summary"] for r in self.runs() if r.get("summary")]
        names = list(dict.fromkeys(k for r in rows for k in r))
        return self.spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ", ".join(f"`{n}` long" for n in names)) if rows else None

    def remove_orphans(self) -> list[str]:
        """Delete what no committed run names or a later one replaces (call it
        while no run is going on): unpublished versions, batches and key runs.
        Returns the paths."""
        fs, root, jvm = file_system(self.spark, self.root)
        runs, gone = self.runs(), []
        named = {(t, f"version={v}") for r in runs for t, v in r.get("tables", {}).items()}
        named |= {(t, b["folder"]) for t in {t for r in runs for t in r.get("batches", {})} for b in self.batches(t)}
        for pattern in ("*/version=*", "*/batch=*", "*/run=*", "*/run_date=*/batch_id=*"):
            for found in fs.globStatus(jvm.org.apache.hadoop.fs.Path(root, pattern)) or []:
                p = found.getPath()
                below = str(p.toUri().getPath())[len(str(fs.makeQualified(root).toUri().getPath())):].strip("/")
                table, folder = below.split("/", 1)
                if (table, folder) not in named and not fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_PUBLISHED")):
                    fs.delete(p, True)
                    gone.append(below)
        return sorted(gone)


def read_batches(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """Committed batches of an appended table; None if there is none."""
    batches = Ledger(spark, root).batches(table)
    if not batches:
        return None
    base = os.path.join(root, table)
    return spark.read.option("basePath", base).option("mergeSchema", True).parquet(*[os.path.join(base, b["folder"]) for b in batches])
