"""Exact dedup over an extendible-hash index kept in shared files.

1. Every row gives an index entry: 64-bit key and SHA-256 of its normalised
   text, original length, id. No text is shuffled for this.
2. The directory is grown by doubling: a bucket (all keys with the same leading
   bits) that holds more than ``bucket_keys`` distinct keys is split by one
   more bit. A histogram of eight bits at a time serves eight doublings.
3. Entries are dealt to owner tasks by bucket, i.e. by key range. A key with
   more than ``page_rows`` entries (a hot text) continues in overflow pages, which
   go to different owners; so an owner never holds more than a page of one text.
4. Entries with the same key form a chain. The bytes of each chain's texts are
   compared: texts are grouped by their bytes, copies combined before they move,
   and where one (key, digest) has two different texts the text is made part of
   the digest.
5. Each owner walks its chains and writes the index: every entry with the row that
   stays of its chain's digest and the number of rows, as far as its page goes. No
   row is sent again for this. Chains of several pages are put together from one
   entry a page.

Row rules: null text counts as empty; of equal texts (white space deleted) the
row with the most code points, then the smallest id (a null id last), then the
first row of a tie stays. Repeated rows are rows of their own. An empty table
gives an empty result. Only id and text are read, so other columns never clash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, small_side, stored, text_or_empty

BITS = 8                      # doublings served by one histogram
BROADCAST_KEYS = 1_000_000    # 8 bytes each
OWNED_BY = ("depth", "prefix", "chain", "page")


def prefix(key: Column, depth: int) -> Column:
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def directory(keys: DataFrame, bucket_keys: int) -> DataFrame:
    """Leaf buckets (depth, prefix, n) for distinct ``key``s: every key lies
    in exactly one leaf; no leaf above ``bucket_keys`` keys can be split."""
    leaves, open_, base = None, keys.select("key"), 0
    while True:
        fine = open_.groupBy(prefix(F.col("key"), base + BITS).alias("p")).agg(F.count("*").alias("n"))
        tree = fine.select(
            "n", "p", F.explode(F.sequence(F.lit(0), F.lit(BITS))).alias("d")
        ).groupBy((F.col("d") + base).alias("depth"),
                  F.expr(f"shiftright(p, {BITS} - d)").alias("prefix")).agg(F.sum("n").alias("n"))
        tree = stored(tree, "directory")
        parent = tree.where(F.col("n") > bucket_keys).select(
            (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("up"))
        found = tree.where(F.col("depth") > base).withColumn("up", F.shiftright("prefix", 1)).join(
            parent, ["depth", "up"], "left_semi").select("depth", "prefix", "n")
        if base == 0:
            found = found.unionByName(tree.where("depth = 0"))
        fits = F.col("n") <= bucket_keys               # always true at 64 bits: a single key
        leaves = found.where(fits) if leaves is None else leaves.unionByName(found.where(fits))
        full = found.where(~fits & (F.col("depth") == base + BITS))
        if full.isEmpty():
            return leaves
        open_ = open_.withColumn("prefix", prefix(F.col("key"), base + BITS)).join(
            full.select("prefix"), "prefix", "left_semi").select("key")
        base += BITS


def located(keys: DataFrame, leaves: DataFrame) -> DataFrame:
    """Keys with their bucket: equality join on (depth, prefix) for the few
    depths that occur (at most 65)."""
    depths = sorted(r[0] for r in leaves.select("depth").distinct().collect())
    at = F.array(*[F.struct(F.lit(d).alias("depth"), prefix(F.col("key"), d).alias("prefix")) for d in depths])
    return keys.select("*", F.inline(at)).join(leaves.select("depth", "prefix"), ["depth", "prefix"]) if depths \
        else keys.select("*", F.lit(0).alias("depth"), F.lit(0).cast("long").alias("prefix")).limit(0)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_keys: int = 4096,
          page_rows: int = 256, owners: int | None = None,
          key: Callable[[Column], Column] = lambda t: F.xxhash64(t),
          digest: Callable[[Column], Column] = lambda t: F.sha2(t, 256)) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    spark = docs.sparkSession
    text = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("raw")).select(
        "id", F.char_length("raw").cast("long").alias("length"), F.regexp_replace("raw", f"{SPACE}+", "").alias("norm"))
    hashed = text.select("id", "length", key(F.col("norm")).alias("key"), digest(F.col("norm")).alias("digest"),
                         F.sha2("norm", 256).alias("sha"), "norm")
    entries = stored(hashed.drop("norm").withColumn("row", F.monotonically_increasing_id()), "entries")

    keys = stored(entries.groupBy("key").agg(F.count("*").alias("n")), "keys")

    # bytes of the texts that share a key; copies collapse before the shuffle
    shared = keys.where("n > 1").select("key")
    texts = hashed.select("key", "digest", "norm").join(
        small_side(shared, shared.count(), BROADCAST_KEYS), "key", "left_semi").groupBy("key", "digest", "norm").agg(
        F.count("*").alias("n"))
    differ = stored(texts.groupBy("key", "digest").agg(F.count("*").alias("texts")).where("texts > 1"), "collisions").select("key", "digest")
    if not differ.isEmpty():
        # one digest, different bytes: the text itself tells those rows apart
        clash = hashed.join(differ, ["key", "digest"], "left_semi").withColumn("digest", F.concat("digest", F.lit(":"), "norm")).drop("norm")
        entries = entries.join(differ, ["key", "digest"], "left_anti").unionByName(
            stored(clash.withColumn("row", F.monotonically_increasing_id()), "clashes"))

    owners = owners or int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = index_of(entries, located(keys, directory(keys, bucket_keys)), owners, page_rows)
    return found(index).withColumnRenamed("id", id_col)


def index_of(entries: DataFrame, placed: DataFrame, owners: int, page_rows: int) -> DataFrame:
    """The index as its owners write it: entries in the order of bucket, key and
    page, each with ``best``, the row that stays of its chain's digest, and
    ``size``, its rows, within the page. The chains lie whole in an owner's
    partition, which is why neither moves a row."""
    pages = F.ceil(F.col("n") / page_rows)
    owned = entries.join(placed, "key").withColumn(
        "page", F.when(pages > 1, F.pmod("row", pages)).otherwise(F.lit(0)).cast("long")).withColumn(
        "chain", F.when(pages > 1, F.col("key"))).repartition(owners, *OWNED_BY)      # a hot key has pages of its own
    order = F.struct((-F.col("length")).alias("l"), F.col("id").isNull().alias("z"), F.col("id").alias("id"), F.col("row").alias("row"))
    chain = Window.partitionBy(*OWNED_BY, "key", "digest")
    walked = owned.withColumn("best", F.min(order).over(chain)).withColumn("size", F.count(F.lit(1)).over(chain))
    return stored(walked.sortWithinPartitions("depth", "prefix", "key", "page"), "index")


def found(index: DataFrame) -> DataFrame:
    """The result from the index: as it stands for chains of one page; the pages
    of longer ones are put together from one entry each."""
    def result(rows: DataFrame) -> DataFrame:
        return rows.select("id", F.col("best.id").alias("keep_id"), F.col("size").alias("group_size"),
                           (F.col("row") == F.col("best.row")).alias("kept"), F.col("sha").alias("text_sha256"))
    long = index.where("chain IS NOT NULL")
    whole = stored(long.where("row = best.row").groupBy("key", "digest").agg(F.min("best").alias("best"), F.sum("size").alias("size")), "long-chains")
    joined = long.drop("best", "size").join(small_side(whole, whole.count(), BROADCAST_KEYS // 16), ["key", "digest"])
    return result(index.where("chain IS NULL")).unionByName(result(joined))
