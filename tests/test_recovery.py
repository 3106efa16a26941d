"""Model calls, positions, readers and batches under failure and repetition."""

import os
import random

import pytest
from pyspark.sql import functions as F

from newsledger.functions import model as model_functions
from newsledger.functions import numbers
from newsledger.operators import classify as cl
from newsledger.operators import incremental as inc
from newsledger.operators import reports
from newsledger.plans import run as runmod
from newsledger.plans import sinks
from newsledger.sources import config as cfgmod
from newsledger.sources import contracts
from newsledger.streaming import available_now


def test_model_runs_once_per_record(spark, tmp_path):
    calls = str(tmp_path / "calls")

    def moody(batch):
        fd = os.open(calls, os.O_APPEND | os.O_CREAT | os.O_WRONLY)
        os.write(fd, b"x" * len(batch))
        os.close(fd)
        return [random.choice(["0", "1"]) for _ in batch]
    df = spark.range(1000).select(F.concat(F.lit("u"), "id").alias("url"), F.concat(F.lit("some text number "), "id").alias("content")).repartition(4)
    s = runmod.RunSettings(fields=("a",))
    out = runmod.process(df, None, moody, lambda b: ['{"a": "x"}' for _ in b], s)
    rows = out.collect()
    assert len(rows) == 1000 and len({r.url for r in rows}) == 1000
    assert os.path.getsize(calls) == 1000
    assert all((r.outcome == "extracted") == (r.is_relevant == 1) for r in rows)


def test_one_failing_record_fails_alone(spark):
    def picky(batch):
        if "number 7" in batch[0]:
            raise RuntimeError("down")
        return ["1"] if "number 3" not in batch[0] else ["1", "1"]
    model = lambda batch: picky(batch)
    real = cl.model_udf
    try:
        cl.model_udf = lambda fn: real(fn, max_retries=2, delay=0.0)
        df = spark.range(10).select(F.concat(F.lit("some text number "), "id").alias("content"))
        got = {r.content[-1]: r for r in cl.classify(df, model, keep_response="response").collect()}
    finally:
        cl.model_udf = real
    assert got["7"].outcome == got["3"].outcome == reports.OUTCOME_CLASSIFICATION_FAILED
    assert got["7"].response.attempts == 2 and "down" in got["7"].response.error and "one reply" in got["3"].response.error
    assert all(got[k].outcome == "relevant" and got[k].response.success for k in "01245689")
    assert reports.OUTCOME_CLASSIFICATION_FAILED not in reports.FINAL_OUTCOMES


def test_positions_of_a_million_wide_rows(spark):
    n = 1_000_000
    df = spark.range(n).select((F.col("id") * 7919 % n).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    out = inc.with_row_index(df, ["k"], "pos", num_partitions=16)
    r = out.agg(F.countDistinct("pos"), F.min("pos"), F.max("pos"), F.sum((F.col("pos") != F.col("k")).cast("int"))).head()
    assert tuple(r) == (n, 0, n - 1, 0)


def test_label_update_and_article_labels(spark):
    t = spark.createDataFrame([("a", "long enough text", None, None), ("b", None, "context here", None), ("c", " ", None, None),
                               ("d", "long enough text", None, 1), ("e", "boom boom boom", None, 7)], "url string, content string, context string, is_news int")
    real = cl.model_udf
    try:
        cl.model_udf = lambda fn: real(fn, max_retries=1, delay=0.0)
        got = {r.url: (r.is_news, r.label_status) for r in cl.update_labels(t, lambda b: ["0"] if "boom" not in b[0] else [][0]).collect()}
    finally:
        cl.model_udf = real
    assert got == {"a": (0, "updated"), "b": (0, "updated"), "c": (None, "no_content"), "d": (1, "skipped"), "e": (None, "error")}
    art = spark.createDataFrame([("u", 1, "a valid article", "ok"), ("v", 2, "tiny", "ok")], "url string, pos int, content string, scrape_status string")
    urls_t = spark.createDataFrame([("u", 1, "ctx", 0), ("v", 2, "cty", 1)], "url string, pos int, context string, is_news int")
    out = {r.url: (r.context, r.is_news) for r in runmod.run_article_labels(art, urls_t, cl.RuleScorer("article")).collect()}
    assert out == {"u": ("ctx", 1), "v": ("cty", None)}


def test_refetch_does_not_multiply_rows(spark):
    articles = spark.createDataFrame([("u", None, None), ("v", "has plenty of content", "ok"), (None, None, None)], "url string, content string, scrape_status string")
    pages = spark.createDataFrame([("u", "<p>first page text</p>"), ("u", "<p>second page</p>"), ("v", "<p>x</p>"), (None, "<p>n</p>")], "url string, html string")
    got = sorted(map(tuple, runmod.refetch_missing(articles, pages).select("url", "content", "scrape_status", "had_content").collect()), key=str)
    assert got == [("u", "second page", "ok", False), ("v", "has plenty of content", "ok", True), (None, None, "error: fetch", False)]


def test_two_stage_takes_null_content(spark):
    data = spark.createDataFrame([("heat wave kills", 1.0), ("football match", 0.0)] * 10, "text string, label double")
    local = cl.text_pipeline("nb", 64).fit(data)
    rows = spark.createDataFrame([(1, None), (2, "heat wave kills"), (3, "")], "id int, content string")
    got = {r.id: r for r in cl.two_stage_classify(rows, local, cl.RuleScorer("heat")).collect()}
    assert len(got) == 3 and got[1].is_relevant == 0 and got[1].fallback_triggered and got[2].is_relevant == 1


def test_saved_classifier(spark, tmp_path):
    data = spark.createDataFrame([("heat wave", 1.0), ("football", 0.0)] * 5, "text string, label double")
    path = str(tmp_path / "model")
    cl.save_classifier(cl.text_pipeline("nb", 64).fit(data), path)
    assert cl.load_classifier(path).transform(data).where("prediction = label").count() == 10


def test_numbers(spark):
    df = spark.createDataFrame([("1e30",), ("0.25",), ("1e400",)], "v string")
    assert [r.v for r in df.select(numbers.float_result("v")["value"].alias("v")).collect()][:2] == [1e30, 0.2]
    typed = runmod.coerce_fields(spark.createDataFrame([("41.9", "36.65", "nope"), ("41.0", None, "2024-03-15")], "n string, f string, d string"),
                                 {"n": "integer", "f": "float", "d": "date"}).collect()
    assert (typed[0].n, typed[0].f, typed[0].d, typed[0].coercion_errors) == (None, 36.65, None, ["n", "d"])
    assert (typed[1].n, typed[1].f, typed[1].coercion_errors) == (41, None, []) and typed[0].raw_fields["n"] == "41.9"


def test_summary_counts_repeated_and_null_keys(spark):
    before = spark.createDataFrame([("u", None), ("u", None), (None, 1)], "url string, is_news int")
    after = spark.createDataFrame([("u", 1), ("u", 1), (None, 1)], "url string, is_news int")
    r = reports.update_summary(before, after).collect()[0]
    assert (r.processed, r.updated, r.skipped) == (2, 2, 1)


def test_readers_by_uri_glob_and_encoding(spark, tmp_path):
    (tmp_path / "a.csv").write_text("url,context\nhttp://x/ก,ข่าว\n", encoding="utf-8")
    (tmp_path / "b.csv").write_bytes("url,context\nhttp://y,café\n".encode("latin-1"))
    for path in (f"file://{tmp_path}", f"{tmp_path}/*.csv", str(tmp_path)):
        got = {r.url: r.context for r in contracts.read_url_table(spark, path).collect()}
        assert got == {"http://x/ก": "ข่าว", "http://y": "café"}
    assert contracts.read_url_table(spark, f"file://{tmp_path}/none*").count() == 0
    assert contracts.read_url_table(spark, f"{tmp_path}/a.csv", multiline=False).count() == 1


def test_replayed_batch_leaves_the_same_rows(spark, tmp_path):
    root = str(tmp_path)
    s = runmod.RunSettings(fields=("n",))
    rows = spark.createDataFrame([("u1", "text number 1 about heat"), ("u1", "text number 1 about heat"), (None, "text about heat wave"), ("u2", "x")],
                                 "url string, content string")
    handled = {}

    class Writer:
        def foreachBatch(self, f):
            handled["f"] = f
            return self

        def __getattr__(self, name):
            return lambda *a, **k: self
    stream = type("S", (), {"writeStream": Writer()})()
    reader = type("R", (), {"schema": lambda self, s: self, "format": lambda self, f: self, "load": lambda self, p: stream})()
    session = type("X", (), {"readStream": reader})()
    available_now.start(session, "in", rows.schema, root, cl.RuleScorer("heat"), cl.RuleExtractor((("n", r"number (\d+)"),)), s, checkpoint="c")
    counts = []
    for batch in (0, 0, 1):
        handled["f"](rows, batch)
        base = spark.read.option("mergeSchema", True).parquet(f"{root}/base")
        counts.append((base.count(), base.where("url = 'u1'").count()))
    # a replay leaves what was there; the next batch skips u1, which is final
    assert counts == [(3, 1), (3, 1), (5, 1)]


def test_write_is_counted(spark, tmp_path):
    with pytest.raises(IOError):
        sinks.write_version(spark.range(3), str(tmp_path), "t", expected_rows=4)
    assert sinks.write_version(spark.range(3), str(tmp_path), "t").endswith("version=2")


def test_settings_from_config(spark):
    raw = {"columns": {"schema": [{"name": "n", "enabled": True, "data_type": "integer", "extraction_hint": "n: count"}, {"name": "off", "enabled": False}]},
           "advanced": {"base_database": {"enabled": False, "deduplication_key": "link"}},
           "prompts": {"extraction": {"user_template": "{content}|{fields_description}|{example_json}"}, "classification": {"user_template": "Q {content}"}}}
    s = runmod.RunSettings.from_config(cfgmod.RunConfig(raw), run_ts="2025-01-01 00:00:00")
    assert (s.key, s.base_enabled, s.fields, s.field_types) == ("link", False, ("n",), {"n": "integer"})
    df = spark.createDataFrame([("the text",)], "content string")
    prompt = df.select(model_functions.render_template(s.extract_template, content=F.col("content"), **s.extract_slots).alias("p")).head().p
    assert prompt.startswith("the text|- n: count|{")
