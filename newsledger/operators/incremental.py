"""Keyed table operators: incremental anti-join, keyed update, first/last
wins per key, upserts, content attachment, ordered prepend, positional index.

Per-key choices use aggregates (``min``/``max_by`` over structs) rather than
``row_number`` windows: aggregates combine map-side, so a key that holds a
third of all rows is reduced before the shuffle instead of landing whole in
one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.common import py_strip
from ..functions.predicates import content_is_valid, is_nonblank, status_ok
from ..session import staged


# --------------------------------------------------------------------------
# anti-join (skip what was already processed)
# --------------------------------------------------------------------------
def processed_keys(base: DataFrame, key: str = "url", outcomes=None,
                   outcome_col: str = "outcome") -> DataFrame:
    """Distinct non-null keys of the base table (optionally only rows whose
    outcome is final, so failed rows are retried)."""
    b = base
    if outcomes is not None and outcome_col in base.columns:
        b = b.filter(F.col(outcome_col).isin(*outcomes))
    return b.select(key).where(F.col(key).isNotNull()).distinct()


def new_rows(input_df: DataFrame, base: DataFrame | None, key: str = "url",
             skip_processed: bool = True, mode: str = "incremental",
             outcomes=None) -> DataFrame:
    """Input rows whose key is not in the base. Null keys and duplicates
    inside the input are kept. Pass-through when skipping is off, the mode is
    'full', there is no base, or either side lacks the key column."""
    if (not skip_processed or mode == "full" or base is None
            or key not in input_df.columns or key not in base.columns):
        return input_df
    return input_df.join(processed_keys(base, key, outcomes), on=key, how="left_anti")


# --------------------------------------------------------------------------
# first / last wins per key
# --------------------------------------------------------------------------
def _pick(df: DataFrame, key, order: list[str], agg) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in order], F.struct(*[F.col(c) for c in rest]).alias("_row"))
    out = df.groupBy(*keys).agg(agg(packed).alias("_best"))
    return out.select(*keys, *[F.col("_best._row")[c].alias(c) for c in rest])


def first_per_key(df: DataFrame, key, order: list[str]) -> DataFrame:
    """The row with the smallest ``order`` tuple per key."""
    return _pick(df, key, order, F.min)


def last_per_key(df: DataFrame, key, order: list[str]) -> DataFrame:
    """The row with the largest ``order`` tuple per key (dict-overwrite
    semantics: the last occurrence wins)."""
    return _pick(df, key, order, F.max)


def upsert_newest_first(new: DataFrame, old: DataFrame, key: str = "link",
                        pos: str = "pos", front=("link", "added_at_utc")) -> DataFrame:
    """New rows before old ones, the first row per key kept, key columns moved
    to the front. Result carries ``src`` (0 new, 1 old) and ``pos`` for the
    sink's ordering."""
    both = (new.withColumn("src", F.lit(0))
            .unionByName(old.withColumn("src", F.lit(1)), allowMissingColumns=True))
    kept = first_per_key(both, key, ["src", pos])
    cols = [c for c in front if c in kept.columns] + [c for c in kept.columns if c not in front]
    return kept.select(*cols)


# --------------------------------------------------------------------------
# content attachment
# --------------------------------------------------------------------------
def last_ok_content(articles: DataFrame, key: str = "url", pos: str = "pos",
                    accepted=("ok",), default_status: str | None = None) -> DataFrame:
    """Per URL: the last article row whose status is accepted."""
    ok = articles.filter(status_ok("scrape_status", accepted, default_status) & is_nonblank("content") & F.col(key).isNotNull())
    # positions are compared without the texts; ties on the position take the larger text
    last = ok.groupBy(key).agg(F.max(pos).alias(pos))
    return ok.select(key, pos, "content").join(last, [key, pos]).groupBy(key).agg(F.max("content").alias("content"))


def attach_content_inner(articles: DataFrame, urls: DataFrame, key: str = "url",
                         pos: str = "pos") -> DataFrame:
    """One row per URL that has an ok article: its last content plus label (and
    context, if the table has it) of the URL table's first row for that URL
    (null when absent); the label is cleared when the content is not valid."""
    content = last_ok_content(articles, key, pos)
    carry = [c for c in ("context", "is_news") if c in urls.columns]
    first_label = first_per_key(urls.select(key, pos, *carry), key, [pos]).select(key, *carry)
    joined = content.join(first_label, on=key, how="left")
    return joined.withColumn("is_news", F.when(content_is_valid("content"), F.col("is_news")))


def attach_content_left(urls: DataFrame, articles: DataFrame, key: str = "url",
                        pos: str = "pos") -> DataFrame:
    """Every URL-table row with its last ok content; the label is cleared
    when the content is not valid (even if it was classified)."""
    content = last_ok_content(articles, key, pos)
    joined = urls.join(content, on=key, how="left")
    valid = content_is_valid("content")
    return joined.withColumn("is_news", F.when(valid, F.col("is_news")).otherwise(F.lit(None).cast("int")))


def content_for_classification(content: Column, context: Column) -> Column:
    """Article content, else the context text, else null (blank counts as missing)."""
    c = F.nullif(py_strip(content), F.lit(""))
    x = F.nullif(py_strip(context), F.lit(""))
    return F.coalesce(c, x)


def keyed_update(table: DataFrame, results: DataFrame, key: str = "url",
                 value: str = "is_news", pos: str = "pos") -> DataFrame:
    """Set ``value`` from ``results`` by key: matched rows take the result
    (even a null one), the last result per key wins, others keep theirs."""
    latest = last_per_key(results.select(key, pos, value), key, [pos]) \
        .select(F.col(key), F.col(value).alias("_new"), F.lit(True).alias("_matched"))
    out = table.join(latest, on=key, how="left")
    return out.withColumn(value, F.when(F.col("_matched"), F.col("_new")).otherwise(F.col(value))) \
        .drop("_new", "_matched")


# --------------------------------------------------------------------------
# positions
# --------------------------------------------------------------------------
def with_row_index(df: DataFrame, order: list[str], name: str = "pos",
                   num_partitions: int | None = None, extra_totals: bool = False) -> DataFrame:
    """0-based position of each row in ``order`` (which must be unique),
    computed without moving all rows into one task: range-partition, number
    rows inside each partition, add the row counts of earlier partitions
    (a table with one row per partition, broadcast). The ranged rows are stored
    once, as range bounds are sampled anew each time they are computed.
    With ``extra_totals`` a ``_total`` column holds the row count."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    ranged = ranged.withColumn("_pid", F.spark_partition_id()) \
        .withColumn("_mid", F.monotonically_increasing_id())
    ranged = staged(ranged, "ranged")
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"),
                            F.sum("_n").over(Window.partitionBy(F.lit(1))).alias("_total"))
    out = ranged.join(F.broadcast(offsets), on="_pid", how="inner")
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    out = out.withColumn(name, F.col("_off") + local)
    keep = df.columns + [name] + (["_total"] if extra_totals else [])
    return out.select(*keep)


def batch_progress(df: DataFrame, order: list[str], batch_size: int = 50) -> DataFrame:
    """Batch number and cumulative percent done (integer floor) per row."""
    idx = with_row_index(df, order, "pos", extra_totals=True)
    return (idx.withColumn("batch_no", F.floor(F.col("pos") / batch_size).cast("long"))
            .withColumn("progress_pct", F.expr("((pos + 1) * 100) div _total").cast("long"))
            .drop("_total"))


def prepend_new(collected: DataFrame, existing: DataFrame, key: str = "url",
                pos: str = "pos") -> DataFrame:
    """New keys (not in ``existing``) first in collected order, then the
    existing rows in their order. Adds ``is_new`` and a dense ``pos``: each side
    is numbered by itself and the existing rows move up by the number of new
    ones, so the two never meet in a sort."""
    fresh = collected.join(existing.select(key).where(F.col(key).isNotNull()).distinct(), on=key, how="left_anti")
    fresh = with_row_index(fresh, [pos], "_pos").drop(pos)
    old = with_row_index(existing, [pos], "_pos").drop(pos).withColumn("_pos", F.col("_pos") + F.lit(fresh.count()))
    return fresh.withColumn("is_new", F.lit(True)).unionByName(
        old.withColumn("is_new", F.lit(False)), allowMissingColumns=True).withColumnRenamed("_pos", pos)


def union_by_name(*dfs: DataFrame) -> DataFrame:
    """Union-all by column name; a column missing on one side is null there."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out
