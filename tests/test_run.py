"""Runs end to end: classification/extraction, sinks, two-run incremental,
available-now stream, CSV contracts and config."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from newsledger.operators.classify import (RuleExtractor, RuleScorer, call_with_retry, classify, extract,
                                           model_udf)
from newsledger.plans import run as runmod
from newsledger.plans import sinks
from newsledger.sources import config as cfgmod
from newsledger.sources import contracts


def _input(spark, n=6):
    data = [(f"u{i}", f"text number {i} about heat wave" if i % 2 else "short", None) for i in range(n)]
    return spark.createDataFrame(data, "url string, content string, scrape_status string")


def test_classify_skips_invalid_and_extracts(spark):
    df = _input(spark)
    c = classify(df, RuleScorer("heat"))
    x = extract(c, RuleExtractor((("n", r"number (\d+)"),)), ["n"])
    got = {r["url"]: (r["is_relevant"], r["outcome"], r["n"]) for r in x.collect()}
    assert got["u1"] == (1, "extracted", "1") and got["u0"] == (0, "empty_content", None)


def test_python_model_with_retry(spark):
    calls = {"n": 0}

    def flaky(batch):
        return ["1" if "heat" in t else "0" for t in batch]
    df = _input(spark)
    c = classify(df, flaky)
    assert sorted(r["is_relevant"] for r in c.collect()) == [0, 0, 0, 1, 1, 1]
    fails = lambda batch: (_ for _ in ()).throw(RuntimeError("down"))
    replies, err, attempts = call_with_retry(fails, "a", max_retries=2, delay=0.0, sleep=lambda s: None)
    assert replies is None and "down" in err and attempts == 2
    assert calls["n"] == 0


def test_two_run_incremental_and_sinks(spark):
    root = tempfile.mkdtemp(prefix="nl-run-")
    s = runmod.RunSettings(fields=("n",), field_types={"n": "integer"}, run_ts="2025-01-01 00:00:00")
    df = _input(spark)
    summary = runmod.run_incremental(spark, df, root, RuleScorer("heat"), RuleExtractor((("n", r"number (\d+)"),)), s)
    r = summary.collect()[0]
    assert r["new_records"] == 6 and r["classified_relevant"] == 3
    heat = sinks.read_latest(spark, root, "heat")
    filled = sinks.read_latest(spark, root, "filled")
    assert heat.count() == 3 and filled.count() == 6
    assert heat.join(filled, "url", "left_anti").count() == 0
    assert dict(rows(filled.select("url", "n")))["u3"] == 3
    # second run: relevant and irrelevant rows are final; empty-content rows are retried
    again = runmod.run_incremental(spark, df, root, RuleScorer("heat"), RuleExtractor((("n", r"number (\d+)"),)), s)
    assert again.collect()[0]["new_records"] == 3
    third = runmod.run_incremental(spark, df.filter(F.col("content") != "short"), root, RuleScorer("heat"),
                                   RuleExtractor((("n", r"number (\d+)"),)), s)
    assert third is None
    assert sinks.published_versions(spark, root, "filled") == [1, 2]
    sinks.truncate_table(spark, root, "filled")
    assert sinks.read_latest(spark, root, "filled").count() == 0


def test_available_now_stream(spark):
    root = tempfile.mkdtemp(prefix="nl-stream-")
    inbox = os.path.join(root, "inbox")
    df = _input(spark, 4)
    df.write.parquet(os.path.join(inbox, "f1"))
    from newsledger.streaming import available_now
    s = runmod.RunSettings(fields=("n",), run_ts="2025-01-01 00:00:00")
    q = available_now.start(spark, inbox + "/*", df.schema, root, RuleScorer("heat"),
                            RuleExtractor((("n", r"number (\d+)"),)), s,
                            checkpoint=os.path.join(root, "ckpt"))
    q.awaitTermination(120)
    base = spark.read.parquet(os.path.join(root, "base"))
    assert base.count() == 4
    # a restart with the same checkpoint reads only the new file; its URLs
    # that already reached a final outcome are skipped by the anti-join
    more = spark.createDataFrame([("u1", "text number 1 about heat wave", None),
                                  ("u9", "text number 9 about heat wave", None)],
                                 "url string, content string, scrape_status string")
    more.write.parquet(os.path.join(inbox, "f2"))
    q = available_now.start(spark, inbox + "/*", df.schema, root, RuleScorer("heat"),
                            RuleExtractor((("n", r"number (\d+)"),)), s,
                            checkpoint=os.path.join(root, "ckpt"))
    q.awaitTermination(120)
    base = spark.read.option("mergeSchema", True).parquet(os.path.join(root, "base"))
    assert sorted(r["url"] for r in base.filter(F.col("batch_id") > 0).collect()) == ["u9"]


def test_csv_contract(spark, tmp_path):
    p = tmp_path / "prepare.csv"
    p.write_text('url,content,scrape_status\nu1,"multi\nline, text",ok\nu2,,error: fetch\n', encoding="utf-8")
    df = contracts.read_article_table(spark, str(p))
    got = sorted(rows(df.select("url", "content", "is_news")), key=lambda r: r[0])
    assert got == [("u1", "multi\nline, text", None), ("u2", None, None)]
    bad = tmp_path / "bad.csv"
    bad.write_text("link,x\nu1,1\n", encoding="utf-8")
    with pytest.raises(contracts.ContractError):
        contracts.read_article_table(spark, str(bad))
    assert contracts.resolve_url_column(spark.read.option("header", True).csv(str(bad))).columns[0] == "url"
    latin = tmp_path / "latin.csv"
    latin.write_bytes("url,content,scrape_status\nu1,caf\xe9 au lait here,ok\n".encode("latin-1"))
    assert contracts.read_article_table(spark, str(latin)).collect()[0]["content"] == "café au lait here"


def test_config_switches(spark, tmp_path):
    cfg = {"llm_provider": "p", "llm_settings": {"p": {}},
           "data_paths": {k: "x" for k in cfgmod.REQUIRED_PATHS}, "prompts": {},
           "columns": {"bulk_operations": {"enable_all_basic_info": False, "enable_all_location": True},
                       "column_groups": {"basic_info": ["death_count"], "location": ["location_province"]},
                       "schema": [{"name": "death_count", "enabled": True, "data_type": "integer"},
                                  {"name": "location_province", "enabled": False, "data_type": "text"},
                                  {"name": "other", "enabled": True}]}}
    path = tmp_path / "c.json"
    path.write_text(json.dumps(cfg), encoding="utf-8")
    rc = cfgmod.load_config(str(path))
    assert [c["name"] for c in rc.enabled_columns()] == ["location_province", "other"]
    frame = dict(rows(cfgmod.columns_frame(spark, cfg).select("name", "enabled")))
    assert frame == {"death_count": False, "location_province": True, "other": True}


def test_train_and_two_stage(spark):
    from newsledger.operators.classify import train_classifier, two_stage_classify
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    lab = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    data = docs.join(lab, "doc_id").select("text", F.col("quality").alias("label"))
    model, metrics = train_classifier(data, "nb", folds=2)
    m = metrics.collect()[0]
    assert 0.0 <= m["accuracy"] <= 1.0 and m["passed_gate"] == (m["accuracy"] >= 0.7)
    out = two_stage_classify(docs.select("doc_id", F.col("text").alias("content")), model, RuleScorer("thtion"))
    assert out.count() == docs.count()
    assert set(r["method_used"] for r in out.select("method_used").distinct().collect()) <= {"local", "fallback"}


def test_collect_links_and_prompt_parts(spark):
    mails = spark.createDataFrame([
        (0, '<a href="https://www.google.com/url?url=https%3A%2F%2Fa.x%2F1%3Futm_source%3Dm&ct=ga">a</a>'
            '<a href="https://www.google.com/alerts/remove">r</a><a href="/rel">x</a>'),
        (1, '<a href="https://b.x/2">b</a><a href="https://a.x/1">dup</a>')], "msg_pos int, html string")
    existing = spark.createDataFrame([("https://old.x/0", 0), ("https://b.x/2", 1)], "url string, pos int")
    from newsledger.plans.run import collect_links
    got = [(r["url"], r["is_new"], r["pos"]) for r in collect_links(mails, existing).orderBy("pos").collect()]
    assert got == [("https://a.x/1", True, 0), ("https://old.x/0", False, 1), ("https://b.x/2", False, 2)]
    from newsledger.functions import model
    cols_ = [{"name": "incident_date", "data_type": "date", "extraction_hint": "incident_date: date"},
             {"name": "n", "data_type": "integer"}]
    assert model.fields_description(cols_) == "- incident_date: date"
    assert json.loads(model.example_json(cols_)) == {"incident_date": "15/03/2024", "n": 45}


def test_summaries(spark):
    from newsledger.operators import reports
    before = spark.createDataFrame([("u1", None), ("u2", 1), ("u3", None)], "url string, is_news int")
    after = spark.createDataFrame([("u1", 0), ("u2", 1), ("u3", None)], "url string, is_news int")
    r = reports.update_summary(before, after, batch_size=1).collect()[0]
    assert (r["processed"], r["updated"], r["skipped"], r["errors"], r["batches"]) == (2, 1, 1, 1, 2)
    arts = spark.createDataFrame([("u1", "long enough text", 1, 0.5, "fallback", None), ("u2", "", None, None, None, "x")],
                                 "url string, content string, is_news int, confidence double, method_used string, error_details string")
    c = reports.content_summary(arts).collect()[0]
    assert (c["total"], c["empty_content"], c["classified"], c["low_confidence"], c["fallback_success"], c["errors"]) == (2, 1, 1, 1, 1, 1)
