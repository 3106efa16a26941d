"""Operators: anti-join, keyed update, per-key picks, positions, reports."""

from pyspark.sql import functions as F

from conftest import rows
from newsledger.operators import incremental as inc
from newsledger.operators import reports


def test_anti_join_keeps_nulls_and_duplicates(spark):
    inp = spark.createDataFrame([("u1", 1), (None, 2), ("u2", 3), ("u2", 4)], "url string, pos int")
    base = spark.createDataFrame([("u1",), (None,)], "url string")
    got = sorted(rows(inc.new_rows(inp, base)), key=lambda r: r[1])
    assert got == [(None, 2), ("u2", 3), ("u2", 4)]
    # partition identity: new + seen = input
    seen = inp.join(inc.processed_keys(base), "url", "left_semi")
    assert inc.new_rows(inp, base).count() + seen.count() == inp.count()


def test_anti_join_pass_through(spark):
    inp = spark.createDataFrame([("u1", 1)], "url string, pos int")
    base = spark.createDataFrame([("u1",)], "url string")
    assert inc.new_rows(inp, base, mode="full").count() == 1
    assert inc.new_rows(inp, base, skip_processed=False).count() == 1
    assert inc.new_rows(inp, None).count() == 1


def test_anti_join_retries_unfinished(spark):
    inp = spark.createDataFrame([("u1", 1), ("u2", 2)], "url string, pos int")
    base = spark.createDataFrame([("u1", "extracted"), ("u2", "extraction_failed")], "url string, outcome string")
    got = rows(inc.new_rows(inp, base, outcomes=reports.FINAL_OUTCOMES))
    assert got == [("u2", 2)]


def test_last_and_first_wins(spark):
    df = spark.createDataFrame([("u1", 1, "a"), ("u1", 2, "b"), ("u2", 3, "c")], "url string, pos int, content string")
    assert sorted(rows(inc.last_per_key(df, "url", ["pos"]))) == [("u1", 2, "b"), ("u2", 3, "c")]
    assert sorted(rows(inc.first_per_key(df, "url", ["pos"]))) == [("u1", 1, "a"), ("u2", 3, "c")]


def test_keyed_update(spark):
    t = spark.createDataFrame([("u1", 1), ("u2", 0), ("u3", 1)], "url string, is_news int")
    r = spark.createDataFrame([("u1", None, 1), ("u2", 0, 1), ("u2", 1, 2)], "url string, is_news int, pos int")
    got = dict(rows(inc.keyed_update(t, r)))
    assert got == {"u1": None, "u2": 1, "u3": 1}


def test_attach_content(spark):
    art = spark.createDataFrame([("u1", 1, "first text here", "ok"), ("u1", 2, "second text here", "ok"),
                                 ("u2", 3, "short", "ok"), ("u3", 4, "failed fetch text", "error: fetch")],
                                "url string, pos int, content string, scrape_status string")
    urls_t = spark.createDataFrame([("u1", 1, 1), ("u1", 2, 0), ("u2", 3, 1), ("u4", 4, 1)],
                                   "url string, pos int, is_news int")
    inner = dict((r[0], (r[1], r[2])) for r in rows(inc.attach_content_inner(art, urls_t)))
    assert inner == {"u1": ("second text here", 1), "u2": ("short", None)}    # invalid content clears the label
    left = sorted(rows(inc.attach_content_left(urls_t, art).select("url", "pos", "is_news")), key=lambda r: r[1])
    assert left == [("u1", 1, 1), ("u1", 2, 0), ("u2", 3, None), ("u4", 4, None)]


def test_with_row_index_matches_sort(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k"))
    got = rows(inc.with_row_index(df, ["k"], "pos", num_partitions=7).orderBy("pos"))
    keys = sorted(r[0] for r in rows(df))
    assert [r[0] for r in got] == keys and [r[1] for r in got] == list(range(len(keys)))


def test_batch_progress(spark):
    df = spark.range(0, 120).withColumnRenamed("id", "event_id")
    got = {r["event_id"]: (r["batch_no"], r["progress_pct"]) for r in inc.batch_progress(df, ["event_id"], 50).collect()}
    assert got[0] == (0, 0) and got[49] == (0, 41) and got[50] == (1, 42) and got[119] == (2, 100)


def test_prepend_new(spark):
    old = spark.createDataFrame([("a", 0), ("b", 1)], "url string, pos int")
    col = spark.createDataFrame([("c", 0), ("a", 1), ("d", 2)], "url string, pos int")
    got = rows(inc.prepend_new(col, old).orderBy("pos").select("url", "is_new", "pos"))
    assert got == [("c", True, 0), ("d", True, 1), ("a", False, 2), ("b", False, 3)]


def test_upsert_newest_first(spark):
    new = spark.createDataFrame([("l2", 0), ("l3", 1)], "link string, pos int")
    old = spark.createDataFrame([("l1", 0, "x"), ("l2", 1, "y")], "link string, pos int, meta string")
    got = sorted(rows(inc.upsert_newest_first(new, old).select("link", "src", "meta")))
    assert got == [("l1", 1, "x"), ("l2", 0, None), ("l3", 0, None)]


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(2, "y")], "k int, b string")
    assert sorted(rows(inc.union_by_name(a, b))) == [(1, "x", None), (2, None, "y")]


def test_integrity_report(spark):
    df = spark.createDataFrame([("u1", 0), ("u1", 1), ("", 2), (None, None), (None, 1)], "url string, is_news int")
    r = reports.integrity_report(df).collect()[0]
    assert (r["duplicate_keys"], r["invalid_labels"], r["empty_keys"], r["passed"]) == (2, 1, 3, False)


def test_run_summary_counts(spark):
    df = spark.createDataFrame([("extracted",), ("irrelevant",), ("empty_content",), ("extraction_failed",)],
                               "outcome string")
    r = reports.run_summary(df).collect()[0]
    assert (r["classified_relevant"], r["classified_irrelevant"], r["empty_content"]) == (2, 1, 1)


def test_hot_key_picks_and_anti_join(spark):
    # one key holds a third of all rows: results stay whole and exact
    n = 3000
    df = spark.range(0, n).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("url"),
                                  F.col("id").alias("pos"), (F.col("id") * 2).alias("v"))
    last = {r["url"]: r["pos"] for r in inc.last_per_key(df, "url", ["pos"]).collect()}
    assert last["hot"] == 2997 and len(last) == 1 + 2 * n // 3
    base = spark.createDataFrame([("hot",)], "url string")
    assert inc.new_rows(df, base).count() == 2 * n // 3
    assert inc.new_rows(df, spark.createDataFrame([("1",)], "url string")).count() == n - 1
