"""Benchmark decontamination by winnowing.

Every text becomes an array of words; of each ``SPAN - GRAM + 1`` consecutive
word k-grams the smallest hash is kept (the rightmost of equal ones). Two texts
that share ``SPAN`` consecutive words therefore keep a common hash at the same
place of the shared span, so joining kept hashes misses no such span. Items of
fewer than ``SPAN`` words are matched whole: all document k-grams of such an
item's length are kept for that length (at most ``SPAN - 1`` lengths exist).

Each joined pair fixes how item and document lie over each other; the hit is
extended by comparing the words along that line, in both directions at once,
and runs of at least ``SPAN`` equal words (or the whole short item) count.

Documents with equal texts are compared once. All steps are built-in functions.

Row rules: null text has no words, is never hit and no item. Of repeated item
ids each text counts, the id once; a null item id is written as the empty
string. Repeated documents each get their row. Without items or documents the
result has no hits or no rows. Only id and text columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, small_side, stored, text_or_empty

SPAN, GRAM = 13, 5
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
HIT_SHARE = 20                # contaminated: at least one word in 20 is hit
BROADCAST_ROWS = 1_000_000    # fingerprints of items, keys of documents


def words(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0))


def at_each(n: Column, f) -> Column:
    """f of 1 .. n as an array; empty if n < 1."""
    return F.when(n >= 1, F.transform(F.sequence(F.lit(1), n), f)).otherwise(F.array())


def gram_hashes(w: Column, size: int) -> Column:
    return at_each(F.size(w) - (size - 1), lambda i: F.xxhash64(F.slice(w, i, size)))


def window_least(column: str, span: int, gram: int) -> Column:
    """Minimum of each window of an array COLUMN. It must be a plain column: an
    expression would be evaluated again for every window."""
    width = span - gram + 1
    c = F.col(column)
    return at_each(F.size(c) - (width - 1), lambda i: F.array_min(F.slice(c, i, width)))


def unrepeated(column: str) -> Column:
    """An array column without elements that equal the one before: what equal
    neighbouring windows kept (array_distinct compares all pairs of structs)."""
    c = F.col(column)
    return F.filter(c, lambda x, i: (i == 0) | (x != F.get(c, i - 1)))


def places(df: DataFrame, keep: list[str], w: str, kind: int, span: int, gram: int) -> DataFrame:
    """``keep`` and one row (kind, h, back: minus place) per kept k-gram."""
    hashed = df.select(*keep, F.transform(gram_hashes(F.col(w), kind or gram), lambda x, i: F.struct(
        x.alias("h"), (-i).alias("back"))).alias("grams"))
    if not kind:
        hashed = hashed.select(*keep, window_least("grams", span, gram).alias("grams"))
    return hashed.select(*keep, F.lit(kind).alias("kind"), F.inline(F.col("grams") if kind else unrepeated("grams")))


def hits(docs: DataFrame, items: DataFrame, text_col: str, item_id: str, item_text: str,
         span: int = SPAN, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """(documents with text key and number of words, spans: text key, item, first
    word, words) for all runs of ``span`` or more words shared with an item."""
    gram = min(gram, span)
    item = stored(items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"),
                               words(text_or_empty(item_text)).alias("iw")).where(F.size("iw") > 0).distinct(), "items")
    short = sorted(r[0] for r in item.where(F.size("iw") < span).select(F.size("iw")).distinct().collect())
    # kind 0: winnowed k-grams of items of span words or more; kind L: whole items of L < span words
    marks = places(item.where(F.size("iw") >= span), ["item"], "iw", 0, span, gram)
    for n in short:
        marks = marks.unionByName(places(item.where(F.size("iw") == n), ["item"], "iw", n, span, gram))
    marks = stored(marks, "marks")
    keys = marks.select("kind", "h").distinct()
    n_keys, n_marks = keys.count(), marks.count()

    key = [F.xxhash64(text_or_empty(text_col)).alias("k1"), F.xxhash64(F.lit("text"), text_or_empty(text_col)).alias("k2")]
    rest = [c for c in docs.columns if c != text_col]
    split = docs.select(*rest, *key, words(text_or_empty(text_col)).alias("w"))
    hashed = split.select(*rest, "k1", "k2", F.size("w").cast("long").alias("n_words"), gram_hashes(F.col("w"), gram).alias("g0"),
                          *[F.array_distinct(gram_hashes(F.col("w"), n)).alias(f"h{n}") for n in short])
    kept = stored(hashed.withColumn("h0", F.array_distinct(window_least("g0", span, gram))).drop("g0"), "winnowed")
    kinds = [0, *short]
    prints = None
    for n in kinds:
        part = kept.select("k1", "k2", F.lit(n).alias("kind"), F.explode(f"h{n}").alias("h"))
        prints = part if prints is None else prints.unionByName(part)
    found = stored(prints.join(small_side(keys, n_keys, BROADCAST_ROWS), ["kind", "h"], "left_semi").select("k1", "k2").distinct(), "found")

    n_found = found.count()
    texts = docs.select(*key, text_or_empty(text_col).alias("t")).join(
        small_side(found, n_found, BROADCAST_ROWS), ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.first("t").alias("t"))
    texts = stored(texts.select("k1", "k2", words(F.col("t")).alias("w")), "texts")
    spots = None
    for n in kinds:
        part = places(texts, ["k1", "k2"], "w", n, span, gram)
        spots = part if spots is None else spots.unionByName(part)
    line = spots.withColumnRenamed("back", "dback").join(
        small_side(marks, n_marks, BROADCAST_ROWS), ["kind", "h"]).select(
        "k1", "k2", "item", (F.col("back") - F.col("dback")).alias("shift")).distinct()
    # the item begins `shift` words after the document's first (before it if negative)
    laid = line.join(item, "item").join(texts, ["k1", "k2"])
    first, skip = F.greatest("shift", F.lit(0)), F.greatest(-F.col("shift"), F.lit(0))
    both = F.least(F.size("w") - first, F.size("iw") - skip)
    laid = laid.select("k1", "k2", "item", first.alias("first"), both.alias("n"), F.least(F.size("iw"), F.lit(span)).alias("least"),
                       F.zip_with(F.slice("w", first + 1, both), F.slice("iw", skip + 1, both), lambda x, y: x == y).alias("same"))
    breaks = F.concat(F.array(F.lit(-1)), F.filter(F.transform("same", lambda x, i: F.when(~x, i)), lambda i: i.isNotNull()), F.array(F.col("n")))
    runs = laid.withColumn("breaks", breaks).select("k1", "k2", "item", "least", F.inline(F.expr(
        "transform(sequence(1, size(breaks) - 1), i -> named_struct('first', first + breaks[i - 1] + 1, 'words', breaks[i] - breaks[i - 1] - 1))")))
    spans = runs.where(F.col("words") >= F.col("least")).select("k1", "k2", "item", "first", "words").distinct()
    return kept.drop(*[f"h{n}" for n in kinds]), stored(spans, "spans")


def report(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           item_id: str = "item_id", item_text: str = "text", span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """One row per document: id, n_words, n_hit, n_items, items_sha256, contaminated."""
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    every, spans = hits(given, items, "text", item_id, item_text, span, gram)
    covered = F.expr("""aggregate(spans, named_struct('n', 0, 'upto', 0), (a, s) -> named_struct(
        'n', a.n + greatest(0, s.first + s.words - greatest(s.first, a.upto)),
        'upto', greatest(a.upto, s.first + s.words))).n""")
    per_text = spans.groupBy("k1", "k2").agg(F.sort_array(F.collect_set(F.struct("first", "words"))).alias("spans"),
                                             F.sort_array(F.collect_set("item")).alias("items"))
    per_text = stored(per_text.select("k1", "k2", covered.cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256")), "hit-texts")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return every.join(per_text, ["k1", "k2"], "left").select(
        F.col("id").alias(id_col), "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * HIT_SHARE >= F.col("n_words"))).alias("contaminated"))


def remove(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
           span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """``docs`` without the contaminated rows, all columns as they are."""
    rows = docs.select(F.col(text_col).alias("text"))
    keyed = report(rows.withColumn("key", F.struct(F.xxhash64(text_or_empty("text")).alias("a"), F.xxhash64(
        F.lit("text"), text_or_empty("text")).alias("b"))), items, "key", "text", item_id, item_text, span, gram)
    bad = stored(keyed.where("contaminated").select("key.a", "key.b").distinct(), "contaminated")
    t = text_or_empty(F.col(f"`{text_col}`"))
    return docs.join(small_side(bad, bad.count(), BROADCAST_ROWS),
                     (F.xxhash64(t) == bad.a) & (F.xxhash64(F.lit("text"), t) == bad.b), "left_anti")
