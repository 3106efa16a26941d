"""The incremental run and the article-to-label run as Spark jobs.

incremental run: read input and base -> anti-join on the key (only final
outcomes count as processed) -> stop if nothing is new -> classify ->
extract for relevant rows -> clean the extracted fields -> metadata ->
write 'filled' (all processed rows) once, then derive 'heat' (relevant rows),
the base append and the run's keys from the written table, so the model never
runs twice and the lineage is cut at a table in shared storage -> name all four
in the run ledger, which is the one commit.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import booleans, dates, numbers, times
from ..functions import model as model_functions
from ..functions.common import py_strip
from ..operators import incremental as inc
from ..operators import reports
from ..operators.classify import classify, extract, processing_status
from ..operators.key_index import KeyIndex
from . import sinks
from .ledger import Ledger


@dataclass
class RunSettings:
    key: str = "url"
    mode: str = "incremental"          # 'full' reprocesses everything
    skip_processed: bool = True
    retry_unfinished: bool = True      # only extracted/irrelevant rows count as processed
    fields: tuple = ()                 # extracted field names
    field_types: dict = field(default_factory=dict)   # name -> integer/float/boolean/date/time/text
    classify_template: str | None = None
    extract_template: str | None = None
    extract_slots: dict = field(default_factory=dict)  # the extraction template's slots besides content
    base_enabled: bool = True          # False: every input row is new and no base is written
    run_ts: str = "1970-01-01 00:00:00"
    as_of: str | None = None

    @classmethod
    def from_config(cls, config, **more) -> "RunSettings":
        """Settings of a RunConfig: key, mode, base switch, enabled fields with
        their types, templates and the extraction template's slots."""
        columns = config.enabled_columns()
        return cls(**{
            "key": config.key, "mode": config.mode, "skip_processed": config.skip_processed, "base_enabled": config.base_enabled,
            "fields": tuple(c["name"] for c in columns), "field_types": {c["name"]: c.get("data_type", "text") for c in columns},
            "classify_template": config.prompt("classification").get("user_template"),
            "extract_template": config.prompt("extraction").get("user_template"),
            "extract_slots": {"fields_description": model_functions.fields_description(columns),
                              "example_json": model_functions.example_json(columns)}} | more)


def coerce_fields(df: DataFrame, types: dict, as_of=None) -> DataFrame:
    """Typed copies of extracted text fields (per row: a bad value is null,
    never the whole column). ``raw_fields`` keeps the texts of the fields that
    had one, ``coercion_errors`` names those that could not be typed."""
    names = [n for n in types if n in df.columns]
    if not names:
        return df
    raw = F.map_filter(F.create_map(*[x for n in names for x in (F.lit(n), F.col(f"`{n}`").cast("string"))]),
                       lambda _, v: v.isNotNull() & (py_strip(v) != ""))
    out = df.withColumn("raw_fields", raw)
    for name, t in types.items():
        if name not in df.columns:
            continue
        c = F.col(f"`{name}`")
        if t == "integer":
            # a fraction is an error here, not a whole number
            whole = numbers.parsed_number(c)
            out = out.withColumn(name, F.when(whole == F.floor(whole), numbers.integer_result(c, words=False)["value"]))
        elif t == "float":
            out = out.withColumn(name, numbers.parsed_number(c))      # not rounded
        elif t == "boolean":
            out = out.withColumn(name, booleans.live_boolean(c))
        elif t == "date":
            out = out.withColumn(name, dates.date_result(c, as_of=as_of)["value"])
        elif t == "time":
            out = out.withColumn(name, times.time_result(c)["value"])
        else:
            out = out.withColumn(name, py_strip(c))
    bad = [F.when(F.map_contains_key("raw_fields", F.lit(n)) & F.col(f"`{n}`").isNull(), F.lit(n)) for n in names]
    return out.withColumn("coercion_errors", F.filter(F.array(*bad), lambda x: x.isNotNull()))


def process(input_df: DataFrame, base: DataFrame | None, classifier, extractor,
            s: RunSettings) -> DataFrame:
    """The lazy plan of one run (no action)."""
    outcomes = reports.FINAL_OUTCOMES if s.retry_unfinished else None
    return process_new(inc.new_rows(input_df, base, s.key, s.skip_processed, s.mode, outcomes), classifier, extractor, s)


def process_new(new: DataFrame, classifier, extractor, s: RunSettings) -> DataFrame:
    """The lazy plan from the rows that are new to the output rows."""
    c = classify(new, classifier, "content", s.classify_template)
    x = extract(c, extractor, list(s.fields), "content", s.extract_template, slots=s.extract_slots)
    x = coerce_fields(x, s.field_types, s.as_of)
    x = x.withColumn("processing_status", processing_status(F.col("is_relevant")))
    return sinks.with_run_columns(x, s.run_ts)


def key_index(spark: SparkSession, out_root: str) -> KeyIndex:
    return KeyIndex(spark, os.path.join(out_root, "keys"), int(spark.conf.get("spark.sql.shuffle.partitions")))


def new_to_base(spark: SparkSession, input_df: DataFrame, out_root: str, s: RunSettings) -> DataFrame:
    """Input rows that no committed run has finished, by the key index."""
    runs = [b["folder"].removeprefix("run=") for b in Ledger(spark, out_root).batches("keys")]
    if not runs or not s.base_enabled or not s.skip_processed or s.mode == "full" or s.key not in input_df.columns:
        return input_df
    return key_index(spark, out_root).new_rows(input_df, runs, s.key, s.retry_unfinished)


def run_incremental(spark: SparkSession, input_df: DataFrame, out_root: str, classifier, extractor,
                    s: RunSettings, source: str | None = None, batch: str | None = None) -> DataFrame | None:
    """Execute one run. Returns the run summary (one row) or None when there
    was nothing new (outputs are then left as they are). ``source`` names what
    the input is (a stream's batch): a source that was committed is not run
    again. ``batch`` names the base's batch."""
    ledger = Ledger(spark, out_root)
    if source is not None and ledger.find(source):
        return None
    number = ledger.next_number()
    processed = process_new(new_to_base(spark, input_df, out_root, s), classifier, extractor, s)
    # the processed rows are written once; nothing new -> nothing published
    filled_path = sinks.write_version(processed, out_root, "filled", publish_empty=False, publish=False)
    if filled_path is None:
        return None
    filled = spark.read.parquet(filled_path)
    heat_path = sinks.write_version(filled.filter(F.col("is_relevant") == 1), out_root, "heat", publish=False)
    version = lambda path: int(path.rsplit("=", 1)[1])
    entry = {"tables": {"filled": version(filled_path), "heat": version(heat_path)}, "run_ts": s.run_ts, "source": source}
    if s.base_enabled:
        batch = batch or f"run-{os.path.basename(filled_path)}"
        sinks.append_rows(filled.withColumn("batch_id", F.lit(batch)), os.path.join(out_root, "base"))
        entry["batches"] = {"base": {"folder": f"run_date={s.run_ts[:10]}/batch_id={quoted(batch)}"}}
        if s.key in filled.columns:
            keys = f"{number:08d}-{uuid.uuid4().hex}"
            key_index(spark, out_root).append(filled, keys, s.key, F.col("outcome").isin(*reports.FINAL_OUTCOMES))
            entry["batches"]["keys"] = {"folder": f"run={keys}"}
    summary = reports.run_summary(filled, total_input=input_df)
    ledger.commit(entry | {"summary": summary.first().asDict()}, number)
    return summary


def merge_keys(spark: SparkSession, out_root: str) -> None:
    """Write the keys of all runs as one; one commit replaces the many."""
    ledger = Ledger(spark, out_root)
    number, folders = ledger.next_number(), [b["folder"] for b in ledger.batches("keys")]
    if len(folders) > 1:
        into = f"{number:08d}-{uuid.uuid4().hex}"
        key_index(spark, out_root).merge([f.removeprefix("run=") for f in folders], into)
        ledger.commit({"batches": {"keys": {"folder": f"run={into}", "replaces": folders}}}, number)


def quoted(name: str) -> str:
    """A partition value as Spark writes it in a folder's name."""
    return name.replace("%", "%25").replace("=", "%3D").replace(":", "%3A").replace("/", "%2F")


def run_article_labels(articles: DataFrame, urls_t: DataFrame, classifier) -> DataFrame:
    """Article-to-label run: attach the last ok content to each URL and label
    the valid ones with the classifier; invalid content and failed calls give a
    null label. ``context`` is kept."""
    joined = inc.attach_content_inner(articles, urls_t).drop("is_news")
    labelled = classify(joined, classifier, "content", out="is_news")
    done = F.col("outcome").isin(reports.OUTCOME_IRRELEVANT, "relevant")
    return labelled.withColumn("is_news", F.when(done, F.col("is_news"))).drop("outcome")


def mail_links(mails: DataFrame) -> DataFrame:
    """(url, pos): the links of alert mails (msg_pos, html), first occurrence
    wins, in mail order."""
    from ..functions import urls
    ex = mails.select("msg_pos", F.posexplode(urls.extract_hrefs("html")).alias("link_pos", "href"))
    ex = ex.filter(F.col("href").startswith("http")).withColumn("url", urls.canonical_link("href"))
    ex = ex.filter(~urls.is_excluded_link("url"))
    firsts = inc.first_per_key(ex.select("url", "msg_pos", "link_pos"), "url", ["msg_pos", "link_pos"])
    return inc.with_row_index(firsts, ["msg_pos", "link_pos"], "pos").select("url", "pos")


def collect_links(mails: DataFrame, existing: DataFrame) -> DataFrame:
    """Links from alert mails prepended to a URL table (url, pos) that is not
    kept in batches: only new links, in mail order. ``plans.links`` keeps a link
    table to which runs only add."""
    return inc.prepend_new(mail_links(mails), existing.select("url", "pos"))


def refetch_missing(articles: DataFrame, pages: DataFrame, key: str = "url") -> DataFrame:
    """Fill content only where it is missing: rows that already have content
    are kept as they are; the others take the article text of their page
    (left join on the URL) and a fetch status. Adds ``had_content``. Of several
    page rows of a URL the largest article text counts, so no row multiplies;
    the html is reduced to its text before the join."""
    from ..functions import html, predicates
    flagged = articles.withColumn("had_content", predicates.has_content("content"))
    texts = pages.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"), (F.col("html").isNotNull() & (F.col("html") != "")).alias("_page"),
                                                       html.article_text("html").alias("_text"))
    texts = texts.groupBy("_key").agg(F.max("_page").alias("_page"), F.max("_text").alias("_text"))
    wanted = F.when(~F.col("had_content"), F.col(key))           # rows that have content look nothing up
    fetched = flagged.join(texts, wanted == F.col("_key"), "left")
    page = F.when(F.coalesce(F.col("_page"), F.lit(False)), F.lit("<page>"))
    status = html.fetch_status(predicates.is_platform(key), page, F.coalesce("_text", F.lit("")))
    fetched = fetched.withColumn("scrape_status", F.when(F.col("had_content"), F.col("scrape_status")).otherwise(status))
    return fetched.withColumn("content", F.when(F.col("had_content"), F.col("content")).when(
        F.col("scrape_status") == "ok", F.col("_text"))).drop("_key", "_page", "_text")
