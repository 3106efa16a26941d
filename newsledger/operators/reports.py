"""Run, content, fetch and integrity summaries: each one aggregate pass that
returns a one-row DataFrame (no driver loops, no accumulators)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import py_strip
from ..functions.predicates import is_invalid_label

# Row outcomes of an incremental run.
OUTCOME_EMPTY = "empty_content"
OUTCOME_IRRELEVANT = "irrelevant"
OUTCOME_EXTRACTED = "extracted"
OUTCOME_FAILED = "extraction_failed"
OUTCOME_CLASSIFICATION_FAILED = "classification_failed"    # not final: retried by the next run
FINAL_OUTCOMES = (OUTCOME_IRRELEVANT, OUTCOME_EXTRACTED)


def count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")


def run_summary(processed: DataFrame, total_input: DataFrame | None = None,
                outcome: str = "outcome") -> DataFrame:
    """Counts of one run: new, relevant, irrelevant (empty content is neither),
    extraction success/failure; ``already_processed`` when the full input is
    given (input minus new)."""
    o = F.col(outcome)
    summary = processed.agg(
        F.count(F.lit(1)).alias("new_records"),
        count_if(o.isin(OUTCOME_EXTRACTED, OUTCOME_FAILED)).alias("classified_relevant"),
        count_if(o == OUTCOME_IRRELEVANT).alias("classified_irrelevant"),
        count_if(o == OUTCOME_EMPTY).alias("empty_content"),
        count_if(o == OUTCOME_EXTRACTED).alias("extraction_success"),
        count_if(o == OUTCOME_FAILED).alias("extraction_failed"),
    )
    if total_input is not None:
        tot = total_input.agg(F.count(F.lit(1)).alias("total_input"))
        summary = combine_rows(summary, tot)
        summary = summary.withColumn("already_processed", F.col("total_input") - F.col("new_records"))
    return summary


def combine_rows(*one_row_frames: DataFrame) -> DataFrame:
    """Put single-row aggregates with different columns side by side without
    a join: union them by name (missing columns null) and take each
    column's max over the few rows."""
    out = one_row_frames[0]
    for d in one_row_frames[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out.agg(*[F.max(F.col(c)).alias(c) for c in out.columns])


def fetch_summary(df: DataFrame, status: str = "scrape_status", had_content: str = "had_content") -> DataFrame:
    s = F.col(status)
    return df.agg(
        F.count(F.lit(1)).alias("total_urls"),
        count_if(F.col(had_content)).alias("already_had_content"),
        count_if(~F.col(had_content)).alias("newly_fetched"),
        count_if(s == "ok").alias("successful_fetches"),
        count_if(s.startswith("error")).alias("failed_fetches"),
        count_if(s.startswith("skipped")).alias("skipped"),
    )


def integrity_report(df: DataFrame, key: str = "url", label: str = "is_news",
                     required=("url",)) -> DataFrame:
    """Duplicate keys (a warning), invalid labels, empty keys and missing
    columns (failures) and the overall verdict, as one row."""
    missing = [c for c in required if c not in df.columns]
    k = F.col(key) if key in df.columns else F.lit(None).cast("string")
    lab = F.col(label) if label in df.columns else F.lit(None).cast("int")
    total = F.count(F.lit(1))
    # a null key counts as one more distinct value, as in a pandas duplicate test
    distinct = F.countDistinct(k) + F.max(F.when(k.isNull(), 1).otherwise(0))
    rep = df.agg(
        total.alias("total_rows"),
        (total - distinct).cast("long").alias("duplicate_keys"),
        count_if(is_invalid_label(lab)).alias("invalid_labels"),
        count_if(k.isNull() | (py_strip(k.cast("string")) == "")).alias("empty_keys"),
    )
    return (rep.withColumn("missing_columns", F.lit(len(missing)).cast("long"))
            .withColumn("passed", (F.col("invalid_labels") == 0) & (F.col("empty_keys") == 0)
                        & (F.col("missing_columns") == 0)))


def content_summary(df: DataFrame, content: str = "content", label: str = "is_news",
                    confidence: str | None = "confidence", method: str | None = "method_used",
                    error: str | None = "error_details", low: float = 0.6) -> DataFrame:
    """Article-table summary: total, empty, valid, classified, low confidence,
    fallback used / succeeded, errors (absent optional columns count 0)."""
    from ..functions.predicates import content_is_valid, is_labelled
    has = lambda c: c is not None and c in df.columns
    conf = F.col(confidence) if has(confidence) else F.lit(None).cast("double")
    meth = F.col(method) if has(method) else F.lit(None).cast("string")
    err = F.col(error) if has(error) else F.lit(None).cast("string")
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        count_if(~content_is_valid(content)).alias("empty_content"),
        count_if(content_is_valid(content)).alias("valid_content"),
        count_if(is_labelled(label)).alias("classified"),
        count_if(conf < low).alias("low_confidence"),
        count_if(meth == "fallback").alias("fallback_used"),
        count_if((meth == "fallback") & is_labelled(label)).alias("fallback_success"),
        count_if(err.isNotNull()).alias("errors"),
    )


def update_summary(before: DataFrame, after: DataFrame, key: str = "url", label: str = "is_news",
                   batch_size: int = 50) -> DataFrame:
    """Label-update summary: rows processed (unlabelled before), updated
    (label set now), skipped (already labelled), batches of ``batch_size``.
    Every row of ``before`` counts once; its new label is that of its key in
    ``after`` (the largest of repeated ones). Null keys match each other."""
    from ..functions.predicates import is_labelled
    now = after.groupBy(F.col(key).alias("_k")).agg(F.max(label).alias("_a"))
    j = before.select(F.col(key).alias("_key"), F.col(label).alias("_b")).join(now, F.col("_key").eqNullSafe(F.col("_k")), "left")
    out = update_counts(j, "_b", "_a", batch_size)
    return out


def update_counts(rows: DataFrame, before: str, after: str, batch_size: int = 50) -> DataFrame:
    """The same for rows that carry the label before and after."""
    from ..functions.predicates import is_labelled
    out = rows.withColumnsRenamed({before: "_b", after: "_a"}).agg(count_if(~is_labelled("_b")).alias("processed"),
                count_if(~is_labelled("_b") & is_labelled("_a")).alias("updated"),
                count_if(is_labelled("_b")).alias("skipped"),
                count_if(~is_labelled("_b") & ~is_labelled("_a")).alias("errors"))
    return out.withColumn("batches", F.ceil(F.col("processed") / F.lit(batch_size)).cast("long"))


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rows (a display helper; the limit is the feature)."""
    return df.limit(n)


# --------------------------------------------------------------------------
# consistency of independent tables
# --------------------------------------------------------------------------
MOST_TABLES = 62


def presence(tables: dict[str, DataFrame], key: str = "url") -> DataFrame:
    """Which keys are in which of the tables: one row per pattern that occurs
    (``tables``: their names, comma-joined in the given order) with the number of
    keys and of rows. One union of keys with a bit per table and one aggregate,
    combined map-side, whatever the number of tables; null keys are counted as the
    pattern ``null key`` of their table."""
    if not 0 < len(tables) <= MOST_TABLES:
        raise ValueError(f"one to {MOST_TABLES} tables can be compared")
    parts = [t.select(F.col(key).cast("string").alias("key"), F.lit(1 << i).cast("long").alias("bit")) for i, t in enumerate(tables.values())]
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    # rows of null keys are a key of their own per table
    keyed = both.groupBy("key", F.when(F.col("key").isNull(), F.col("bit")).alias("alone")).agg(
        F.bit_or("bit").alias("bits"), F.count(F.lit(1)).alias("n"))
    counted = keyed.groupBy("bits", F.col("key").isNull().alias("no_key")).agg(F.count(F.lit(1)).alias("n_keys"), F.sum("n").alias("n_rows"))
    names = F.filter(F.array(*[F.when(F.col("bits").bitwiseAND(1 << i) != 0, F.lit(n)) for i, n in enumerate(tables)]), lambda x: x.isNotNull())
    joined = F.array_join(names, ",")
    return counted.select(F.when(F.col("no_key"), F.concat(F.lit("null key: "), joined)).otherwise(joined).alias("tables"),
                          "bits", F.when(F.col("no_key"), 0).otherwise(F.col("n_keys")).cast("long").alias("n_keys"), "n_rows")


def subset_violations(tables: dict[str, DataFrame], rules, key: str = "url") -> DataFrame:
    """For every rule (a, b), keys of ``a`` that are not in ``b``: (rule,
    n_keys, is_consistent), all rules from one pass of ``presence``."""
    names = list(tables)
    p = presence(tables, key)
    counts = p.agg(*[F.coalesce(F.sum(F.when((F.col("bits").bitwiseAND(1 << names.index(a)) != 0) & (F.col("bits").bitwiseAND(1 << names.index(b)) == 0),
                                             F.col("n_keys"))), F.lit(0)).cast("long").alias(f"r{i}") for i, (a, b) in enumerate(rules)])
    rows = F.array(*[F.struct(F.lit(f"{a} in {b}").alias("rule"), F.col(f"r{i}").alias("n_keys")) for i, (a, b) in enumerate(rules)])
    return counts.select(F.inline(rows)).withColumn("is_consistent", F.col("n_keys") == 0)


# --------------------------------------------------------------------------
# counts by place, cause, month
# --------------------------------------------------------------------------
def counts_by(df: DataFrame, dimensions, sets, measure: str | None = None, multi: dict[str, str] | None = None,
              unknown: str = "unknown") -> DataFrame:
    """Counts and sums of ``measure`` by several sets of dimensions in one
    aggregate (GROUPING SETS). ``multi``: dimensions that hold lists, with their
    separator; a row counts for each of its different values. Where a set leaves a
    list out, the row counts once. Blank and missing values are ``unknown``; in the
    result a dimension outside the row's set is null, ``grouping`` names the set.
    """
    multi = multi or {}
    if len(multi) > 3:
        raise ValueError("at most three dimensions can hold lists")
    out = df.select(*[F.col(f"`{d}`").cast("string").alias(d) for d in dimensions],
                    (F.col(f"`{measure}`") if measure else F.lit(0)).alias("_m"))
    for d in dimensions:
        if d in multi:
            items = F.array_distinct(F.filter(F.transform(F.split(F.col(f"`{d}`"), multi[d]), py_strip), lambda x: x != ""))
            some = F.when(F.size(items) > 0, items).otherwise(F.array(F.lit(unknown)))
            out = out.select(*[F.col(f"`{c}`") for c in out.columns if c != d], F.posexplode(some).alias(f"_at_{d}", d))
        else:
            out = out.withColumn(d, F.coalesce(F.nullif(py_strip(F.col(f"`{d}`")), F.lit("")), F.lit(unknown)))
    lists = list(multi)
    # per subset of lists left out: the rows that stand for the whole row there
    once = {}
    for mask in range(1 << len(lists)):
        first = F.lit(True)
        for i, d in enumerate(lists):
            if mask >> i & 1:
                first = first & (F.col(f"_at_{d}") == 0)
        once[mask] = first
    aggs = [c for mask, first in once.items() for c in (F.sum(F.when(first, 1).otherwise(0)).alias(f"_n{mask}"), F.sum(F.when(first, F.col("_m"))).alias(f"_s{mask}"))]
    columns = [F.col(f"`{d}`") for d in dimensions]
    grouped = out.groupingSets([[F.col(f"`{d}`") for d in s] for s in sets], *columns).agg(
        *[F.grouping(c).alias(f"_g_{d}") for c, d in zip(columns, dimensions)], *aggs)

    def pick(kind: str):
        value = F.col(f"_{kind}0")
        for mask in range(1, 1 << len(lists)):
            out_ = F.lit(True)
            for i, d in enumerate(lists):
                out_ = out_ & (F.col(f"_g_{d}") == (mask >> i & 1))
            value = F.when(out_, F.col(f"_{kind}{mask}")).otherwise(value)
        return value
    name = F.array_join(F.filter(F.array(*[F.when(F.col(f"_g_{d}") == 0, F.lit(d)) for d in dimensions]), lambda x: x.isNotNull()), ",")
    return grouped.select(name.alias("grouping"), *dimensions, pick("n").cast("long").alias("n"),
                          *([F.coalesce(pick("s"), F.lit(0)).alias(f"sum_{measure}")] if measure else []))
