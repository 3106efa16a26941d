"""Registered queries: each operator group run over whole test tables.

Each query takes (spark, sf_dir) and returns a DataFrame. Input strings that
the reference would receive from the web or a model are built *from table
columns* (the same construction appears in the oracle SQL), so every query's
work grows with the tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (booleans, categories, dates, html, model, numbers, predicates, text,
                         times, urls)
from ..functions.common import py_strip
from ..operators import columns as cols
from ..operators import incremental as inc
from ..operators import reports
from ..operators.categorical import with_category, with_vocabulary_table
from ..operators.fuzzy import Measure
from ..operators.classify import RuleExtractor, RuleScorer, classify, extract, processing_status, update_labels
from ..operators.validate import ColumnSpec, FLOAT, INTEGER, TEXT, column_report, validate
from ..session import work_path
from ..sources.tables import table

# Parameters of the checkable runs.
RELEVANCE_PATTERN = r"(?i)(thtion|attion)"
EXTRACT_FIELDS = (("first_word", r"([A-Za-z]+)"), ("first_number", r"([0-9]+)"),
                  ("token", r"token = \"([0-9a-f]+)\""))
AS_OF = "2025-12-31"
EXCLUDE_DOMAIN = r"(?i)spam-farm\.example|cheap-pills"
REDIRECT_PREFIX = "https://www.google.com/url?rct=j&sa=t&url="
REDIRECT_SUFFIX = "&ct=ga&usg=AFQjCN"
# English month abbreviations used to build month-name dates.
EN_MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
SEGMENTS = categories.Vocabulary(
    terms=("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"),
    synonyms=(("auto", "AUTOMOBILE"), ("car", "AUTOMOBILE"), ("home", "HOUSEHOLD")),
    default="UNKNOWN", fuzzy=False)
PART_TYPES = categories.Vocabulary(
    terms=("STANDARD", "LARGE", "SMALL", "MEDIUM", "PROMO", "ECONOMY"), default="UNKNOWN", fuzzy=True)
PART_WORDS = ("red", "blue", "green", "hot", "small", "large", "old", "new")


def _t(spark, sf, name):
    return table(spark, sf, name)


# ---------------------------------------------------------------- predicates
def content_validity(spark: SparkSession, sf: str) -> DataFrame:
    d = _t(spark, sf, "documents")
    return d.select("doc_id", predicates.content_is_valid("text").alias("is_valid"),
                    predicates.is_nonblank("text").alias("is_nonblank"))


def content_split(spark, sf):
    d = _t(spark, sf, "documents")
    return d.select("doc_id", predicates.has_content("text").alias("has_content"),
                    predicates.has_content(F.substring("text", 1, 10)).alias("has_content_10"),
                    predicates.has_content(F.substring("text", 1, 11)).alias("has_content_11"))


def domain_rules(spark, sf):
    p = _t(spark, sf, "pages")
    return p.select("page_id", predicates.is_excluded_domain("url", EXCLUDE_DOMAIN).alias("is_excluded"),
                    predicates.is_platform("url").alias("is_platform"),
                    F.col("url").startswith("http").alias("is_http"))


# ---------------------------------------------------------------- joins
def _earlier_crawl(pages: DataFrame) -> DataFrame:
    """Base of an earlier run: the pages it fetched over plain http."""
    return pages.filter(F.col("url").startswith("http://"))


def incremental_new(spark, sf):
    p = _t(spark, sf, "pages").select("page_id", "url")
    return inc.new_rows(p, _earlier_crawl(p))


def new_prepend(spark, sf):
    p = _t(spark, sf, "pages").select("url", F.col("page_id").alias("pos"))
    return inc.prepend_new(p, _earlier_crawl(p)).select("url", "is_new", "pos")


def _articles(d: DataFrame) -> DataFrame:
    return d.select(F.col("source").alias("url"), F.col("doc_id").alias("pos"), F.col("text").alias("content"),
                    F.when(F.length("text") >= 50, F.lit("ok")).otherwise(F.lit("error: extract")).alias("scrape_status"))


def content_lookup(spark, sf):
    d = _t(spark, sf, "documents")
    lab = _t(spark, sf, "labels")
    url_table = d.join(lab, "doc_id").select(F.col("source").alias("url"), F.col("doc_id").alias("pos"),
                                             F.col("quality").alias("is_news"))
    out = inc.attach_content_inner(_articles(d), url_table)
    return out.select("url", F.md5("content").alias("content_md5"), "is_news")


def content_attach_left(spark, sf):
    d = _t(spark, sf, "documents")
    lab = _t(spark, sf, "labels")
    urls_t = lab.join(d.select("doc_id", "lang"), "doc_id").select(
        F.col("doc_id"), F.concat(F.lit("src"), (F.col("doc_id") % 25).cast("string")).alias("url"),
        F.col("doc_id").alias("pos"), F.col("quality").alias("is_news"))
    out = inc.attach_content_left(urls_t, _articles(d))
    return out.select("doc_id", "url", F.md5("content").alias("content_md5"), "is_news")


def _first_turns(spark, sf):
    """The first turn of every conversation, as the context of a document."""
    c = inc.first_per_key(_t(spark, sf, "conversations").select("conv_id", "turn", "text"), "conv_id", ["turn"])
    return c.select(F.col("conv_id").alias("doc_id"), F.col("text").alias("context"))


def content_priority(spark, sf):
    d = _t(spark, sf, "documents")
    j = d.join(_first_turns(spark, sf), "doc_id", "left")
    chosen = inc.content_for_classification(F.col("text"), F.col("context"))
    src = (F.when(F.nullif(py_strip("text"), F.lit("")).isNotNull(), F.lit("content"))
           .when(F.nullif(py_strip("context"), F.lit("")).isNotNull(), F.lit("context")))
    return j.select("doc_id", src.alias("source_used"), F.md5(chosen).alias("chosen_md5"))


def keyed_update(spark, sf):
    d = _t(spark, sf, "documents").select(
        "doc_id", F.when(F.col("lang") == "en", F.lit(1)).otherwise(F.lit(0)).alias("is_news"))
    res = _t(spark, sf, "labels").select("doc_id", F.col("doc_id").alias("pos"),
                                          (F.col("quality") + F.col("toxic")).alias("is_news"))
    out = inc.keyed_update(d, res, key="doc_id", value="is_news")
    return out.select("doc_id", "is_news", predicates.is_labelled("is_news").alias("is_labelled"),
                      predicates.is_invalid_label("is_news").alias("is_invalid"))


# ---------------------------------------------------------------- dedupe / order / sets
def first_wins_dedupe(spark, sf):
    d = _t(spark, sf, "documents").select(F.md5("text").alias("text_md5"), "doc_id")
    return inc.first_per_key(d, "text_md5", ["doc_id"]).withColumnRenamed("doc_id", "first_doc_id")


def last_wins_dedupe(spark, sf):
    d = _t(spark, sf, "documents").select("source", "doc_id", "lang")
    return inc.last_per_key(d, "source", ["doc_id"]).select(
        "source", F.col("doc_id").alias("last_doc_id"), F.col("lang").alias("last_lang"))


def batch_progress(spark, sf):
    e = _t(spark, sf, "events").select("event_id")
    return inc.batch_progress(e, ["event_id"], 50).select("event_id", "batch_no", "progress_pct")


def union_by_name(spark, sf):
    c = _t(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
                                         F.col("c_nationkey").alias("nationkey"), F.col("c_mktsegment").alias("segment"),
                                         F.lit("customer").alias("src"))
    s = _t(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
                                         F.col("s_nationkey").alias("nationkey"), F.lit("supplier").alias("src"))
    return inc.union_by_name(c, s)


# ---------------------------------------------------------------- reports
def _url_table_with_labels(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id", F.col("source").alias("url"))
    lab = _t(spark, sf, "labels").select("doc_id", (F.col("quality") + F.col("toxic")).alias("is_news"))
    return d.join(lab, "doc_id", "left")


def integrity_report(spark, sf):
    return reports.integrity_report(_url_table_with_labels(spark, sf))


def _processed_documents(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id", "source", F.col("text").alias("content"))
    c = classify(d, RuleScorer(RELEVANCE_PATTERN))
    return extract(c, RuleExtractor(EXTRACT_FIELDS), [f for f, _ in EXTRACT_FIELDS])


def run_summary(spark, sf):
    d = _t(spark, sf, "documents")
    return reports.run_summary(_processed_documents(spark, sf), total_input=d)


def three_way_output(spark, sf):
    p = _processed_documents(spark, sf)
    return p.select("doc_id", "is_relevant", "outcome", processing_status(F.col("is_relevant")).alias("processing_status"),
                    "first_word", "first_number", "token",
                    (F.col("is_relevant") == 1).alias("in_heat_table"))


def fetch_summary(spark, sf):
    p = _t(spark, sf, "pages")
    t = p.select("url", "html", html.article_text("html").alias("txt"))
    # content of the earlier crawl (the plain http pages), not what this fetch found
    t = t.select(html.fetch_status(predicates.is_platform("url"), F.col("html"), F.col("txt")).alias("scrape_status"),
                 (predicates.has_content("txt") & F.col("url").startswith("http://")).alias("had_content"))
    return reports.fetch_summary(t)


# ---------------------------------------------------------------- URLs / HTML
def url_canonical(spark, sf):
    p = _t(spark, sf, "pages")
    return p.select("page_id", urls.strip_tracking_params("url").alias("canonical"),
                    urls.url_netloc("url").alias("host"), urls.host_path("url").alias("host_path"))


def _wrapped(url):
    return F.concat(F.lit(REDIRECT_PREFIX), urls.form_encode(url), F.lit(REDIRECT_SUFFIX))


def url_unwrap(spark, sf):
    p = _t(spark, sf, "pages")
    href = F.when(F.col("url").contains("/en/"), _wrapped(F.col("url"))).otherwise(F.col("url"))
    u = urls.unwrap_redirect(href)
    return p.select("page_id", u.alias("unwrapped"), urls.is_excluded_link(u).alias("is_excluded"))


def links(spark, sf):
    p = _t(spark, sf, "pages")
    mail = F.concat(F.lit('<a href="'), _wrapped(F.col("url")), F.lit('">source</a>'),
                    F.lit('<a href="https://www.google.com/alerts/remove?s=1">x</a>'), F.col("html"))
    ex = p.select("page_id", F.posexplode(urls.extract_hrefs(mail)).alias("link_pos", "href"))
    ex = ex.filter(F.col("href").startswith("http")).withColumn("url", urls.canonical_link("href"))
    ex = ex.filter(~urls.is_excluded_link("url"))
    firsts = inc.first_per_key(ex.select("url", "page_id", "link_pos"), "url", ["page_id", "link_pos"])
    return firsts.select("url", F.col("page_id").alias("first_page_id"), F.col("link_pos").alias("first_link_pos"))


def article_text(spark, sf):
    p = _t(spark, sf, "pages")
    t = p.select("page_id", "url", "html", html.article_text("html").alias("txt"))
    return t.select("page_id",
                    html.fetch_status(predicates.is_platform("url"), F.col("html"), F.col("txt")).alias("scrape_status"),
                    F.md5("txt").alias("text_md5"), F.length("txt").alias("n_chars"))


# ---------------------------------------------------------------- text
def _injected(d):
    return F.concat(F.lit("<b>"), F.col("text"), F.lit("</b> see http://x.example/"), F.col("doc_id").cast("string"),
                    F.lit(" &amp; www.y.example &nbsp; <i>end</i>"))


def text_clean(spark, sf):
    d = _t(spark, sf, "documents")
    c = text.clean_text(_injected(d), text.TextProfile(normalize_unicode=False))
    return d.select("doc_id", F.md5(c).alias("clean_md5"), F.length(c).alias("n_chars"))


def text_truncate(spark, sf):
    d = _t(spark, sf, "documents")
    r = text.text_result(F.col("text"), text.TextProfile(normalize_unicode=False, max_length=500))
    return d.select("doc_id", F.md5(r["value"]).alias("value_md5"), F.length(r["value"]).alias("n_chars"),
                    r["is_valid"].alias("is_valid"))


def nfkc(spark, sf):
    d = cols.with_nfkc(_t(spark, sf, "documents").select("doc_id", "text"), "text", "n")
    return d.select("doc_id", F.md5("n").alias("nfkc_md5"), (F.col("n") != F.col("text")).alias("changed"))


# ---------------------------------------------------------------- numbers / dates / times
def _int_text(p):
    s = F.col("p_size") * 3
    ss = s.cast("string")
    return (F.when(F.col("p_type") == "ECONOMY", F.concat(ss, F.lit(".0")))
            .when(F.col("p_type") == "SMALL", F.concat(F.lit("อายุ "), ss, F.lit(" ปี")))
            .when(F.col("p_type") == "LARGE", F.concat(F.lit("ประมาณ "), ss, F.lit(" สิบ")))
            .when(F.col("p_type") == "MEDIUM", F.concat(F.lit(" "), ss, F.lit(".9 ")))
            .when(F.col("p_type") == "PROMO", F.translate(ss, "0123456789", "๐๑๒๓๔๕๖๗๘๙"))
            .otherwise(F.concat(F.lit("-"), ss)))


def int_clamp(spark, sf):
    p = _t(spark, sf, "part")
    p = cols.with_integer(p, _int_text(p), "r", numbers.AGE_RANGE)
    p = cols.with_integer(p, F.col("p_size") + 2000, "y", numbers.YEAR_RANGE)
    return p.select("p_partkey", F.col("r.value").alias("age"), F.col("r.is_valid").alias("age_valid"),
                    F.col("y.value").alias("year"), F.col("y.error").alias("year_error"))


def _float_text(c):
    cents = F.abs(F.round(F.col("c_acctbal") * 100, 0).cast("long"))
    t = cents % 1000
    sign = F.when(F.col("c_acctbal") < 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, (t / 10).cast("long").cast("string"), F.lit(","), (t % 10).cast("string"), F.lit("°C"))


def float_range(spark, sf):
    c = _t(spark, sf, "customer")
    raw = _float_text(c)
    c = cols.with_float(c.withColumn("raw", raw), F.col("raw"), "r", numbers.ENV_TEMP_RANGE)
    return c.select("c_custkey", F.col("r.value").alias("value"), F.col("r.is_valid").alias("is_valid"),
                    F.col("r.error").alias("error"), numbers.outlier_flag(F.col("raw"), "environment").alias("is_outlier"))


def _date_text(e):
    y, m, d = F.year("ts"), F.month("ts"), F.dayofmonth("ts")
    s = lambda x: x.cast("string")
    thai = F.when(m.isNotNull(), F.element_at(F.array(*[F.lit(x) for x in dates.THAI_MONTHS]), m))
    eng = F.when(m.isNotNull(), F.element_at(F.array(*[F.lit(x) for x in EN_MONTHS]), m))
    et = F.col("event_type")
    return (F.when(et == "click", F.concat_ws("/", s(m), s(d), s(y + 543)))
            .when(et == "view", F.concat_ws("/", s(d), s(m), s(y)))
            .when(et == "signup", F.concat_ws(" ", F.lit("วันที่"), s(d), thai, s(y + 543)))
            .when(et == "purchase", F.concat_ws(" ", s(d), eng, s(y)))
            .otherwise(F.concat_ws("-", s(y + 543), s(m), s(d))))


def date_parse(spark, sf):
    e = _t(spark, sf, "events")
    e = cols.with_date(e, _date_text(e), "r", as_of=AS_OF)
    return e.select("event_id", F.col("r.value").alias("value"), F.col("r.is_valid").alias("is_valid"),
                    F.col("r.error").alias("error"))


def date_orders(spark, sf):
    o = _t(spark, sf, "orders")
    y, m, d = F.year("o_orderdate"), F.month("o_orderdate"), F.dayofmonth("o_orderdate")
    raw = F.concat_ws(".", d.cast("string"), m.cast("string"), (y + 543).cast("string"))
    o = cols.with_date(o, raw, "r", as_of=AS_OF)
    return o.select("o_orderkey", F.col("r.value").alias("value"), F.col("r.error").alias("error"))


def month_name(spark, sf):
    e = _t(spark, sf, "events")
    return e.select("event_id", dates.thai_month_name(F.to_date("ts")).alias("month_name"))


def _time_text(e):
    h, mi, sec = F.hour("ts"), F.minute("ts"), F.second("ts")
    s = lambda x: x.cast("string")
    et = F.col("event_type")
    return (F.when(et == "click", F.concat(F.lit("เวลา "), s(h), F.lit(":"), F.lpad(s(mi), 2, "0")))
            .when(et == "view", F.concat(s(h), F.lit("."), F.lpad(s(mi), 2, "0"), F.lit(" น.")))
            .when(et == "signup", F.concat_ws(":", F.lpad(s(h), 2, "0"), F.lpad(s(mi), 2, "0"), F.lpad(s(sec), 2, "0")))
            .when(et == "purchase", F.concat(s(h + 20), F.lit(":"), F.lpad(s(mi), 2, "0")))
            .otherwise(F.lit("unknown")))


def time_parse(spark, sf):
    e = _t(spark, sf, "events")
    r = times.time_result(_time_text(e))
    return e.select("event_id", r["value"].alias("value"), r["is_valid"].alias("is_valid"))


# ---------------------------------------------------------------- booleans / categories
def _bool_text(e):
    et = F.col("event_type")
    return (F.when(et == "click", F.lit("Yes"))
            .when(et == "view", F.lit("ไม่มีอาการ"))
            .when(et == "signup", F.concat(F.lit("not found "), (F.col("user_id") % 3).cast("string")))
            .when(et == "purchase", F.lit("มีอาการไข้สูง"))
            .otherwise(F.concat(F.lit("code "), (F.col("user_id") % 3).cast("string"))))


def boolean_map(spark, sf):
    e = _t(spark, sf, "events")
    r = booleans.boolean_result(_bool_text(e))
    return e.select("event_id", r["value"].alias("value"), r["is_valid"].alias("is_valid"), r["rule"].alias("rule"))


def _segment_text(c):
    seg = F.col("c_mktsegment")
    k = F.col("c_custkey") % 6
    return (F.when(k == 0, F.lower(seg))
            .when(k == 1, F.concat(F.lit("  "), seg, F.lit(" ")))
            .when(k == 2, F.substring(seg, 1, 5))
            .when(k == 3, F.concat(seg, F.lit(" dept")))
            .when(k == 4, F.when(seg == "AUTOMOBILE", F.lit("Car")).otherwise(F.lit("xx")))
            .otherwise(F.lit(None).cast("string")))


def category_cascade(spark, sf):
    c = _t(spark, sf, "customer")
    r = categories.category_result(_segment_text(c), SEGMENTS)
    return c.select("c_custkey", r["value"].alias("value"), r["match_kind"].alias("match_kind"))


def category_fuzzy(spark, sf):
    p = _t(spark, sf, "part")
    typo = F.concat(F.substring("p_type", 1, 2), F.substring("p_type", 4, 20))
    raw = F.when(F.col("p_size") % 2 == 0, typo).otherwise(F.lower("p_type"))
    out = with_category(p.select("p_partkey", raw.alias("raw")), "raw", PART_TYPES, "r")
    return out.select("p_partkey", F.col("r.value").alias("value"), F.col("r.match_kind").alias("match_kind"))


def category_table_fuzzy(spark, sf):
    """The first long word of every document (every other one lacking its third
    letter) against the benchmark's words as a vocabulary table: exact, then the
    nearest by edit distance."""
    d, b = _t(spark, sf, "documents"), _t(spark, sf, "benchmark")
    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{5,}"), F.lit(0))
    terms = b.select(F.explode(words).alias("term")).distinct().select("term", F.lit(None).cast("string").alias("synonym"), F.lit(0).alias("rank"))
    word = F.nullif(F.regexp_extract(F.lower("text"), "[a-z]{5,}", 0), F.lit(""))
    raw = F.when(F.col("doc_id") % 2 == 0, F.concat(F.substring(word, 1, 2), F.substring(word, 4, 1000))).otherwise(word)
    out = with_vocabulary_table(d.select("doc_id", raw.alias("raw")), "raw", terms, "r", "none", similar=Measure("edit", 0.7))
    return out.select("doc_id", "raw", F.col("r.value").alias("value"), F.col("r.match_kind").alias("match_kind"))


def age_group(spark, sf):
    p = _t(spark, sf, "part")
    return p.select("p_partkey", categories.age_group(F.col("p_size") * 2 - 5).alias("age_group"))


def multi_category(spark, sf):
    p = _t(spark, sf, "part")
    r = categories.multi_category_result(F.replace("p_name", F.lit(" "), F.lit(", ")), PART_WORDS)
    return p.select("p_partkey", F.size(r["items"]).alias("n_items"), F.size(r["invalid"]).alias("n_invalid"),
                    r["is_valid"].alias("is_valid"))


def category_counts(spark, sf):
    """Counts by place: customers per nation and region, with order totals."""
    c = _t(spark, sf, "customer")
    n = _t(spark, sf, "nation")
    r = _t(spark, sf, "region")
    o = _t(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    j = (c.join(n, c.c_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == r.r_regionkey)
         .join(o, c.c_custkey == o.o_custkey, "left"))
    return j.groupBy("r_name", "n_name").agg(F.count(F.lit(1)).alias("n_customers"),
                                               F.coalesce(F.sum("n_orders"), F.lit(0)).cast("long").alias("n_orders"))


def incident_counts(spark, sf):
    """Counts and quantities by place, cause and month at once: causes are the
    words of the part's name, so a row counts under each of them."""
    li, o = _t(spark, sf, "lineitem"), _t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c, n = _t(spark, sf, "customer").select("c_custkey", "c_nationkey"), _t(spark, sf, "nation")
    p = _t(spark, sf, "part").select("p_partkey", F.concat("p_name", F.lit(" "), "p_name").alias("cause"))
    rows = (li.join(p, li.l_partkey == p.p_partkey).join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
            .join(n, c.c_nationkey == n.n_nationkey).select(F.when(F.col("n_nationkey") > 0, F.col("n_name")).alias("place"), "cause",
                                                            F.month("l_shipdate").alias("month"), F.col("l_quantity").cast("long").alias("quantity")))
    return reports.counts_by(rows, ["place", "cause", "month"], [["place"], ["cause"], ["month"], ["place", "cause"], []], "quantity", {"cause": " "})


# ---------------------------------------------------------------- validation
VALIDATION_SPEC = (
    ColumnSpec("ที่", FLOAT, (1, 99999)),
    ColumnSpec("ปี", INTEGER, (2020, 2030)),
    ColumnSpec("ICD 10", TEXT, max_length=20, pattern=r"^[A-Z]\d{2}(\.\d{1,2})?$"),
)


def schema_validate(spark, sf):
    o = _t(spark, sf, "orders")
    df = o.select(F.col("o_orderkey").cast("string").alias("ที่"),
                  (F.year("o_orderdate") + 26).cast("string").alias("ปี"),
                  F.when(F.col("o_orderpriority").startswith("1"), F.lit("J45.9"))
                  .otherwise(F.col("o_orderpriority")).alias("ICD 10"))
    v = validate(df, VALIDATION_SPEC, normalize_unicode=False)
    return column_report(v)


def error_report(spark, sf):
    """Every failing cell of the validated orders."""
    from ..operators.validate import error_report as failing
    o = _t(spark, sf, "orders")
    df = o.select("o_orderkey", (F.year("o_orderdate") + 26).cast("string").alias("ปี"), F.when(
        F.col("o_orderkey") % 5 < 3, F.concat(F.lit("J"), F.lpad((F.col("o_orderkey") % 100).cast("string"), 2, "0"))).when(
        F.col("o_orderkey") % 5 == 3, F.col("o_orderpriority")).alias("ICD 10"))
    specs = (ColumnSpec("ปี", INTEGER, (2020, 2024)), ColumnSpec("ICD 10", TEXT, max_length=20, pattern=VALIDATION_SPEC[2].pattern))
    return failing(validate(df, specs, keep=["o_orderkey"], normalize_unicode=False), ["o_orderkey"])


def column_order(spark, sf):
    """The 39 columns of the conformed output in their order, with the number of
    rows that have a value."""
    from ..operators.validate import column_order_report
    out = heat_conform(spark, sf)
    assert not column_order_report(out.columns)
    counts = out.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(out.columns)])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("name"), F.col(f"c{i}").alias("n_filled"))
                                            for i, c in enumerate(out.columns)])))


#: A run configuration whose group switches turn a group on and another off.
COLUMNS_CONFIG = {"columns": {"bulk_operations": {"enable_all_basic_info": False, "enable_all_location": True},
                              "column_groups": {"basic_info": ["first_number"], "location": ["token"]},
                              "schema": [{"name": "first_word", "enabled": True}, {"name": "first_number", "enabled": True, "data_type": "integer"},
                                         {"name": "token", "enabled": False}, {"name": "outcome", "enabled": False}]}}


def enabled_columns(spark, sf):
    """Processed documents with the columns that the configuration enables."""
    from ..sources.config import RunConfig, apply_group_switches
    names = [c["name"] for c in RunConfig(apply_group_switches(COLUMNS_CONFIG)).enabled_columns()]
    return _processed_documents(spark, sf).select("doc_id", *names)


def table_presence(spark, sf):
    """Which document ids are in which tables, for five tables at once."""
    return reports.presence(_id_tables(spark, sf), "id").drop("bits")


def _id_tables(spark, sf):
    ids = {"documents": "doc_id", "labels": "doc_id", "conversations": "conv_id", "pages": "page_id", "benchmark": "item_id"}
    return {t: _t(spark, sf, t).select(F.col(c).alias("id")) for t, c in ids.items()}


def table_consistency(spark, sf):
    """Ids that should be in another table and are not."""
    rules = [("labels", "documents"), ("conversations", "documents"), ("documents", "labels"), ("benchmark", "pages"), ("documents", "conversations")]
    return reports.subset_violations(_id_tables(spark, sf), rules, "id")


def utf8_bytes(spark, sf):
    """Documents cut after a number of bytes, often inside a character."""
    d = _t(spark, sf, "documents")
    cut = F.substring(F.encode("text", "utf-8"), F.lit(1), (F.col("doc_id") % 400 + 1).cast("int"))
    r = text.utf8_result(cut)
    return d.select("doc_id", r["is_valid"].alias("is_valid"), F.md5(r["value"]).alias("value_md5"), F.char_length(r["value"]).alias("n_chars"))


# ---------------------------------------------------------------- trained classifiers
def _labelled_documents(spark, sf):
    d, lab = _t(spark, sf, "documents").select("doc_id", "text"), _t(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    return d.join(lab, "doc_id")


def train_classifier(spark, sf):
    """Accuracy of a naive Bayes classifier of the labelled documents."""
    from ..operators.classify import train_classifier as train
    return train(_labelled_documents(spark, sf), "nb", 3, id_col="doc_id")[1]


def two_stage_classify(spark, sf):
    """Word weights learned from the labelled documents; unsure documents go to
    the rule scorer."""
    from ..operators.classify import fit_word_weights, two_stage_classify as classify_
    local = fit_word_weights(_labelled_documents(spark, sf).where("doc_id % 5 <> 0"))
    d = _t(spark, sf, "documents").select("doc_id", F.when(F.col("doc_id") % 11 != 0, F.col("text")).alias("content"))
    out = classify_(d, local, RuleScorer(RELEVANCE_PATTERN))
    return out.select("doc_id", "is_relevant", "method_used", "fallback_triggered", F.round("confidence", 4).alias("confidence"))


# ---------------------------------------------------------------- model replies
def _reply_text(e):
    et = F.col("event_type")
    props = F.col("props")
    return (F.when(et == "click", F.concat(F.lit("```json\n"), props, F.lit("\n```")))
            .when(et == "view", props)
            .when(et == "signup", F.substring(props, 1, 5))
            .when(et == "purchase", F.lit("{}"))
            .otherwise(F.concat(F.lit("["), props, F.lit("]"))))


def json_fields(spark, sf):
    e = _t(spark, sf, "events")
    r = model.reply_fields(_reply_text(e), ["k"])
    return e.select("event_id", r["ok"].alias("ok"), r["k"].alias("k"),
                    numbers.integer_result(r["k"], numbers.NumberRange(), words=False)["value"].alias("k_int"))


def label_parse(spark, sf):
    e = _t(spark, sf, "events")
    et = F.col("event_type")
    reply = (F.when(et == "click", F.concat(F.lit("Answer: "), (F.col("user_id") % 2).cast("string")))
             .when(et == "view", F.lit("yes"))
             .when(et == "signup", F.concat((F.col("user_id") % 2).cast("string"), F.lit("0")))
             .when(et == "purchase", F.lit(None).cast("string"))
             .otherwise(F.lit("  1 ")))
    return e.select("event_id", model.label_from_reply(reply).alias("label"))


CLASSIFY_TEMPLATE = "Classify the article.\n\nArticle:\n{content}\n\nAnswer 0 or 1 only."


def prompt_render(spark, sf):
    d = _t(spark, sf, "documents")
    p = model.render_template(CLASSIFY_TEMPLATE, content=F.col("text"))
    return d.select("doc_id", F.md5(p).alias("prompt_md5"), F.length(p).alias("prompt_len"))


def classify_update(spark, sf):
    """Label only rows without a 0/1 label; content from the document, else
    the first conversation turn; no content -> null label."""
    d = _t(spark, sf, "documents").select("doc_id", "text")
    lab = _t(spark, sf, "labels").select("doc_id", F.col("quality").alias("is_news"))
    t = d.join(lab, "doc_id", "left").join(_first_turns(spark, sf), "doc_id", "left")
    out = update_labels(t, RuleScorer(RELEVANCE_PATTERN), "text")
    return out.select("doc_id", "is_news", (F.col("label_status") == "skipped").alias("was_labelled"))


def article_labels(spark, sf):
    """Articles with their last ok content, labelled; no valid content, no label."""
    from .run import run_article_labels
    d = _t(spark, sf, "documents")
    urls_t = d.join(_t(spark, sf, "labels"), "doc_id").select(
        F.col("source").alias("url"), F.col("doc_id").alias("pos"), F.col("lang").alias("context"), F.col("quality").alias("is_news"))
    out = run_article_labels(_articles(d), urls_t, RuleScorer(RELEVANCE_PATTERN))
    return out.select("url", "context", "is_news", F.md5("content").alias("content_md5"))


def update_summary(spark, sf):
    lab = _t(spark, sf, "labels")
    before = lab.select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("quality")).alias("is_news"))
    after = lab.select("doc_id", F.when(F.col("doc_id") % 3 != 0, F.col("quality")).alias("is_news"))
    return reports.update_summary(before, after, "doc_id")


def content_summary(spark, sf):
    d = _t(spark, sf, "documents").join(_t(spark, sf, "labels"), "doc_id", "left")
    return reports.content_summary(d.select(
        F.col("text").alias("content"), F.col("quality").alias("is_news"), (F.col("doc_id") % 100 / 100).alias("confidence"),
        F.when(F.col("doc_id") % 3 == 0, "fallback").otherwise("local").alias("method_used"),
        F.when(F.col("doc_id") % 7 == 0, "timeout").alias("error_details")))


def live_coercion(spark, sf):
    """Extracted texts typed as a run does it: fractions are no integers, floats
    are not rounded, what cannot be typed is null and named."""
    from .run import coerce_fields
    e = _t(spark, sf, "events")
    u = F.col("user_id").cast("string")
    n = F.when(F.col("user_id") % 4 == 0, u).when(F.col("user_id") % 4 == 1, F.concat(u, F.lit(".9"))).when(
        F.col("user_id") % 4 == 2, F.lit("abc")).otherwise(F.concat(u, F.lit(".0")))
    f = F.when(F.col("user_id") % 3 == 0, F.concat(u, F.lit(".65"))).when(F.col("user_id") % 3 == 1, F.lit("n/a"))
    out = coerce_fields(e.select("event_id", n.alias("n"), f.alias("f")), {"n": "integer", "f": "float"})
    return out.select("event_id", "n", "f", F.element_at("raw_fields", F.lit("n")).alias("n_raw"),
                      F.array_join("coercion_errors", ",").alias("errors"))


def collect_links(spark, sf):
    """Links of alert mails put before the links known already."""
    from .run import collect_links as run
    p = _t(spark, sf, "pages")
    at = lambda host, n, path: F.concat(F.lit(f"https://{host}"), (F.col("page_id") % n).cast("string"), F.lit(f".example.com/{path}"))
    a, b = at("n", 97, "a"), at("m", 53, "b")
    mails = p.select(F.col("page_id").alias("msg_pos"), F.concat(
        F.lit('<a href="'), a, F.lit('">a</a><a href="https://www.google.com/alerts/remove">x</a><a href="/rel">r</a><a href="'),
        b, F.lit('">b</a>')).alias("html"))
    existing = p.filter(F.col("page_id") % 10 == 0).select(a.alias("url"), F.col("page_id").alias("pos"))
    return run(mails, existing).select("url", "pos", "is_new")


def link_batches(spark, sf):
    """A link table after three collections, the last of which brings nothing
    new: every run writes its new links only."""
    from . import links as store
    p = _t(spark, sf, "pages")
    root = work_path(spark, "queries", uuid.uuid4().hex)
    at = lambda n: F.concat(F.lit("https://n"), (F.col("page_id") % n).cast("string"), F.lit(".example.com/"))
    mails = lambda n, rows: rows.select(F.col("page_id").alias("msg_pos"), F.concat(F.lit('<a href="'), at(n), F.lit('">a</a>')).alias("html"))
    for rows in (mails(53, p.where("page_id % 2 = 0")), mails(97, p), mails(60, p)):
        store.run_collect_links(spark, rows, root)
    return store.read_links(spark, root).select("url", "pos", "batch")


# ---------------------------------------------------------------- the incremental run
def two_runs(spark, sf):
    """Two incremental runs into one base, the second over all documents: the
    base afterwards, with the run that each row came from."""
    from . import sinks
    from .run import RunSettings, run_incremental
    d = _t(spark, sf, "documents").select("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("url"),
                                          F.when(F.col("doc_id") % 7 != 0, F.col("text")).alias("content"))
    root = work_path(spark, "queries", uuid.uuid4().hex)
    for day, rows in (("2025-01-01", d.where("doc_id % 3 <> 1")), ("2025-01-02", d)):
        run_incremental(spark, rows, root, RuleScorer(RELEVANCE_PATTERN), RuleExtractor(EXTRACT_FIELDS),
                        RunSettings(fields=tuple(f for f, _ in EXTRACT_FIELDS), run_ts=f"{day} 00:00:00"))
    return sinks.read_base(spark, root).select("doc_id", "outcome", "is_relevant", "first_word", F.dayofmonth("run_date").alias("run"))


def key_index_new(spark, sf):
    """Pages that two earlier runs have not finished, by the key index."""
    from ..operators.key_index import KeyIndex
    p = _t(spark, sf, "pages").select("page_id", "url")
    index = KeyIndex(spark, work_path(spark, "queries", uuid.uuid4().hex), int(spark.conf.get("spark.sql.shuffle.partitions")))
    index.append(p.where("page_id % 4 = 0"), "first", final=F.col("page_id") % 3 != 0)
    index.append(index.new_rows(p.where("page_id % 4 < 2"), ["first"]), "second", final=F.col("page_id") % 5 != 0)
    return index.new_rows(p, ["first", "second"])


def incremental_run(spark, sf):
    """Pages -> article text -> fetch status -> skip already processed URLs ->
    classify -> extract -> metadata columns."""
    p = _t(spark, sf, "pages")
    art = p.select("page_id", "url", "html", html.article_text("html").alias("content"))
    art = art.withColumn("scrape_status", html.fetch_status(predicates.is_platform("url"), F.col("html"),
                                                            F.col("content"))).drop("html")
    todo = inc.new_rows(art, _earlier_crawl(p).select("url"))
    c = classify(todo, RuleScorer(RELEVANCE_PATTERN))
    x = extract(c, RuleExtractor(EXTRACT_FIELDS), [f for f, _ in EXTRACT_FIELDS])
    return x.select("page_id", "url", "scrape_status", "is_relevant", "outcome",
                    processing_status(F.col("is_relevant")).alias("processing_status"),
                    "first_word", "first_number")


def consistency(spark, sf):
    """heat within filled within input: anti-join counts (all zero when consistent)."""
    p = _t(spark, sf, "pages").select("page_id", "url")
    filled = inc.new_rows(p, _earlier_crawl(p))
    processed = _processed_documents(spark, sf)
    heat = processed.filter(F.col("is_relevant") == 1).select("doc_id")
    docs = _t(spark, sf, "documents").select("doc_id")
    a = filled.join(p, ["page_id", "url"], "left_anti").agg(F.count(F.lit(1)).alias("filled_not_in_input"))
    b = heat.join(processed.select("doc_id"), "doc_id", "left_anti").agg(F.count(F.lit(1)).alias("heat_not_in_filled"))
    c = processed.select("doc_id").join(docs, "doc_id", "left_anti").agg(F.count(F.lit(1)).alias("filled_not_in_docs"))
    return reports.combine_rows(a, b, c)


def article_refetch(spark, sf):
    """Refetch only pages whose earlier fetch left no content (the https ones)."""
    from .run import refetch_missing
    p = _t(spark, sf, "pages")
    prior = p.select("url", F.when(F.col("url").startswith("http://"), html.article_text("html")).alias("content"),
                     F.when(F.col("url").startswith("http://"), F.lit("ok")).alias("scrape_status"))
    out = refetch_missing(prior, p)
    return out.select("url", "had_content", "scrape_status", F.md5("content").alias("content_md5"))


def heat_conform(spark, sf):
    """Processed documents in the ordered 39-column output form."""
    from ..operators.validate import HEAT_SPECS, conform
    d = _processed_documents(spark, sf)
    staged = d.filter(F.col("is_relevant") == 1).select(
        F.col("doc_id").cast("double").alias("ที่"), F.col("source").alias("ที่มาสื่อออนไลน์"),
        F.col("first_word").alias("หมายเหตุ"))
    return conform(staged, HEAT_SPECS)


def upsert_links(spark, sf):
    """Newest-first upsert of collected links into the link table."""
    p = _t(spark, sf, "pages")
    new = p.filter(F.col("url").contains("/en/")).select(F.col("url").alias("link"), F.col("page_id").alias("pos"))
    old = p.select(F.col("url").alias("link"), F.col("page_id").alias("pos"),
                   F.col("page_id").cast("string").alias("meta"))
    return inc.upsert_newest_first(new, old, "link", "pos").select("link", "src", "pos", "meta")


QUERIES = {
    "content_validity": content_validity,
    "content_split": content_split,
    "domain_rules": domain_rules,
    "incremental_new": incremental_new,
    "new_prepend": new_prepend,
    "content_lookup": content_lookup,
    "content_attach_left": content_attach_left,
    "content_priority": content_priority,
    "keyed_update": keyed_update,
    "first_wins_dedupe": first_wins_dedupe,
    "last_wins_dedupe": last_wins_dedupe,
    "batch_progress": batch_progress,
    "union_by_name": union_by_name,
    "integrity_report": integrity_report,
    "run_summary": run_summary,
    "three_way_output": three_way_output,
    "fetch_summary": fetch_summary,
    "url_canonical": url_canonical,
    "url_unwrap": url_unwrap,
    "links": links,
    "article_text": article_text,
    "text_clean": text_clean,
    "text_truncate": text_truncate,
    "nfkc": nfkc,
    "int_clamp": int_clamp,
    "float_range": float_range,
    "date_parse": date_parse,
    "date_orders": date_orders,
    "month_name": month_name,
    "time_parse": time_parse,
    "boolean_map": boolean_map,
    "category_cascade": category_cascade,
    "category_fuzzy": category_fuzzy,
    "category_table_fuzzy": category_table_fuzzy,
    "age_group": age_group,
    "multi_category": multi_category,
    "category_counts": category_counts,
    "incident_counts": incident_counts,
    "schema_validate": schema_validate,
    "error_report": error_report,
    "column_order": column_order,
    "enabled_columns": enabled_columns,
    "table_presence": table_presence,
    "table_consistency": table_consistency,
    "utf8_bytes": utf8_bytes,
    "two_stage_classify": two_stage_classify,
    "train_classifier": train_classifier,
    "json_fields": json_fields,
    "label_parse": label_parse,
    "prompt_render": prompt_render,
    "classify_update": classify_update,
    "article_labels": article_labels,
    "update_summary": update_summary,
    "content_summary": content_summary,
    "live_coercion": live_coercion,
    "collect_links": collect_links,
    "incremental_run": incremental_run,
    "two_runs": two_runs,
    "key_index_new": key_index_new,
    "link_batches": link_batches,
    "consistency": consistency,
    "article_refetch": article_refetch,
    "heat_conform": heat_conform,
    "upsert_links": upsert_links,
}
