"""Vocabulary cascade with the fuzzy stage.

The similarity ratio has no JVM built-in, so it runs as a vectorised helper on
the *distinct* values that the cheap stages leave unmatched, and is joined
back on the value. The join's right side holds one row per distinct value, so
a hot value on the left streams through without being buffered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.categories import (Vocabulary, category_result, clean_value, exact_match,
                                    fuzzy_udf, synonym_match)
from ..functions.common import py_strip
from ..session import staged
from .fuzzy import Measure, closest, closest_folded


def with_category(df: DataFrame, column: str, vocab: Vocabulary, out: str | None = None) -> DataFrame:
    """Add ``out`` = category result struct for ``column`` (all stages)."""
    out = out or f"{column}_result"
    if not vocab.fuzzy or not vocab.all_terms:
        return df.withColumn(out, category_result(F.col(column), vocab))
    raw = F.col(column).cast("string")
    cleaned = clean_value(raw, vocab)
    cheap = synonym_match(cleaned, vocab).isNotNull() | exact_match(py_strip(raw), vocab).isNotNull()
    open_ = F.coalesce((cleaned != "") & ~cheap, F.lit(False))
    # values that need no fuzzy stage match nothing and are spread over the tasks
    spread = F.concat(F.lit("\u0000"), (F.monotonically_increasing_id() % 1024).cast("string"))
    keyed = df.withColumn("_fz_key", F.when(open_, cleaned).otherwise(spread))
    pending = df.select(cleaned.alias("_fz_key"), open_.alias("_open")).filter("_open").select("_fz_key").distinct()
    best = pending.withColumn("_fz_term", fuzzy_udf(vocab)(F.col("_fz_key")))
    joined = keyed.join(best, on="_fz_key", how="left")
    return joined.withColumn(out, category_result(F.col(column), vocab, F.col("_fz_term"))) \
        .drop("_fz_key", "_fz_term")


def with_vocabulary_table(df: DataFrame, column: str, terms: DataFrame, out: str, default: str | None = None,
                          prefixes: tuple = (), case_sensitive: bool = False, similar: Measure | None = None) -> DataFrame:
    """Exact and synonym match against a vocabulary table (term, synonym, rank)
    of any size: ``synonym`` is null for the term itself; of equal spellings the
    synonym wins, then the lowest rank. With ``similar`` a value that has neither
    takes the most similar term (case matters first, then, unless
    ``case_sensitive``, it does not). Adds ``out`` = (value, match_kind).

    The distinct values of the column are looked up, so a hot value costs one
    row in the join; blank and unmatched values take the default."""
    fold = (lambda c: c) if case_sensitive else F.lower
    spelled = terms.select(fold(F.coalesce("synonym", "term")).alias("_key"), F.struct(
        F.col("synonym").isNull().alias("_own"), "rank", "term").alias("_hit")).groupBy("_key").agg(F.min("_hit").alias("_hit"))
    cleaned = clean_value(F.col(column).cast("string"), Vocabulary((), (), prefixes))
    key = cleaned if similar else fold(cleaned)
    values = df.select(key.alias("_value")).where(F.coalesce(F.col("_value") != "", F.lit(False))).distinct().withColumn(
        "_key", fold(F.col("_value")))
    found = values.join(spelled, "_key").select("_value", F.struct(
        F.col("_hit.term").alias("value"), F.when(F.col("_hit._own"), "exact").otherwise("synonym").alias("match_kind")).alias("_found"))
    if similar:
        found = staged(found, "spelled")
        open_ = staged(values, "values").join(found.select("_value"), "_value", "left_anti").select(F.col("_value").alias("text"))
        own = terms.groupBy(F.col("term").alias("text")).agg(F.min("rank").alias("rank"))
        near = (closest(open_, own.select("text"), similar) if case_sensitive else closest_folded(open_, own, similar))
        found = found.unionByName(near.select(F.col("value").alias("_value"), F.struct(
            F.col("term").alias("value"), F.lit("fuzzy").alias("match_kind")).alias("_found")))
    blank = F.coalesce(F.col("_k") == "", F.lit(True))
    spread = F.concat(F.lit("\u0000"), (F.monotonically_increasing_id() % 1024).cast("string"))
    keyed = df.withColumn("_k", key).withColumn("_j", F.when(blank, spread).otherwise(F.col("_k")))
    none = F.struct(F.lit(default).cast("string").alias("value"), F.when(blank, "blank").otherwise("none").alias("match_kind"))
    return keyed.join(found, F.col("_j") == F.col("_value"), "left").withColumn(out, F.coalesce("_found", none)).drop("_k", "_j", "_value", "_found")
