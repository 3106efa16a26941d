"""One commit per run: stopped runs, two runs at a time, replays, the key index."""

import os

import pytest
from pyspark.sql import functions as F

from newsledger.operators import classify as cl
from newsledger.operators.key_index import KeyIndex
from newsledger.plans import ledger as led
from newsledger.plans import links
from newsledger.plans import run as runmod
from newsledger.plans import sinks
from newsledger.streaming import available_now

SCORER, FIELDS = cl.RuleScorer("heat"), cl.RuleExtractor((("n", r"number (\d+)"),))
SETTINGS = runmod.RunSettings(fields=("n",), field_types={"n": "integer"}, run_ts="2025-01-01 00:00:00")


def articles(spark, ids):
    return spark.createDataFrame([(f"u{i}", "short" if i % 5 == 0 else f"text number {i} about {'heat' if i % 2 else 'rain'}") for i in ids],
                                 "url string, content string")


def run(spark, ids, root, **more):
    return runmod.run_incremental(spark, articles(spark, ids), root, SCORER, FIELDS, SETTINGS, **more)


def seen(spark, root):
    """What readers see: urls of filled, heat and base, known keys, runs."""
    urls = lambda df: sorted(r.url for r in df.select("url").collect()) if df is not None else []
    ledger = led.Ledger(spark, root)
    runs = [b["folder"].removeprefix("run=") for b in ledger.batches("keys")]
    keys = sorted(r.key for r in runmod.key_index(spark, root).entries(runs).collect()) if runs else []
    return (urls(sinks.read_latest(spark, root, "filled")), urls(sinks.read_latest(spark, root, "heat")), urls(sinks.read_base(spark, root)),
            keys, [r["run"] for r in ledger.runs()])


STEPS = {"filled": (sinks, "write_version", 1), "heat": (sinks, "write_version", 2), "base": (sinks, "append_rows", 1),
         "keys": (KeyIndex, "append", 1), "summary": (runmod.reports, "run_summary", 1), "commit": (led.Ledger, "commit", 1)}


@pytest.mark.parametrize("step, when", [("filled", "after"), ("heat", "after"), ("base", "after"), ("keys", "after"), ("summary", "before"),
                                        ("commit", "before"), ("commit", "after")])
def test_a_stopped_run_leaves_all_or_nothing(spark, tmp_path, monkeypatch, step, when):
    root = str(tmp_path)
    run(spark, range(1, 5), root)
    first = seen(spark, root)
    assert first == (["u1", "u2", "u3", "u4"], ["u1", "u3"], ["u1", "u2", "u3", "u4"], ["u1", "u2", "u3", "u4"], [1])
    owner, name, nth = STEPS[step]
    real, calls = getattr(owner, name), []

    def stops(*a, **k):
        calls.append(1)
        if len(calls) == nth and when == "before":
            raise KeyboardInterrupt
        out = real(*a, **k)
        if len(calls) == nth:
            raise KeyboardInterrupt
        return out
    with monkeypatch.context() as m:
        m.setattr(owner, name, stops)
        with pytest.raises(KeyboardInterrupt):
            run(spark, range(1, 8), root)
    second = (["u5", "u6", "u7"], ["u7"], [f"u{i}" for i in range(1, 8)], ["u1", "u2", "u3", "u4", "u6", "u7"], [1, 2])
    assert seen(spark, root) == (second if (step, when) == ("commit", "after") else first)
    run(spark, range(1, 8), root)
    if (step, when) == ("commit", "after"):              # all of it was there: only the unfinished row is tried again
        assert seen(spark, root)[0] == ["u5"]
        return
    assert seen(spark, root) == second
    led.Ledger(spark, root).remove_orphans()
    assert seen(spark, root) == second and led.Ledger(spark, root).remove_orphans() == []


def test_of_two_runs_at_a_time_one_commits(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    real = runmod.reports.run_summary

    def other_first(*a, **k):
        monkeypatch.setattr(runmod.reports, "run_summary", real)
        run(spark, [1, 2], root)
        return real(*a, **k)
    monkeypatch.setattr(runmod.reports, "run_summary", other_first)
    with pytest.raises(led.CommitConflict):
        run(spark, [1, 3], root)
    assert seen(spark, root)[2] == ["u1", "u2"] and seen(spark, root)[4] == [1]
    run(spark, [1, 3], root)
    assert seen(spark, root)[2] == ["u1", "u2", "u3"]
    gone = led.Ledger(spark, root).remove_orphans()
    assert {g.split("/")[0] for g in gone} == {"filled", "heat", "base", "keys"}
    assert seen(spark, root)[2] == ["u1", "u2", "u3"]


def test_source_is_run_once_and_summaries_stay(spark, tmp_path):
    root = str(tmp_path)
    assert run(spark, [1, 2], root, source="mail-1") is not None
    assert run(spark, [1, 2, 3], root, source="mail-1") is None
    assert run(spark, [1, 2, 3], root, source="mail-2").first().new_records == 1
    got = led.Ledger(spark, root).summaries().orderBy("run").collect()
    assert [(r.run, r.total_input, r.new_records, r.classified_relevant) for r in got] == [(1, 2, 2, 1), (2, 3, 1, 1)]
    assert led.Ledger(spark, str(tmp_path / "none")).summaries() is None and sinks.read_base(spark, str(tmp_path / "none")) is None


def test_full_mode_and_no_base(spark, tmp_path):
    from dataclasses import replace
    root = str(tmp_path)
    run(spark, [1, 2], root)
    full = replace(SETTINGS, mode="full")
    assert runmod.run_incremental(spark, articles(spark, [1, 2]), root, SCORER, FIELDS, full).first().new_records == 2
    no_base = replace(SETTINGS, base_enabled=False)
    assert runmod.run_incremental(spark, articles(spark, [1]), str(tmp_path / "x"), SCORER, FIELDS, no_base).first().new_records == 1
    assert sinks.read_base(spark, str(tmp_path / "x")) is None


def test_key_index_moves_no_stored_key(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "k"), 8)
    rows = spark.createDataFrame([("a", 1), ("b", 0), ("b", 1), (None, 1), ("c", 0)], "url string, ok int")
    index.append(rows, "r1", "url", F.col("ok") == 1)
    index.append(spark.createDataFrame([("d", 1), ("e", None)], "url string, ok int"), "r2", "url", F.col("ok") == 1)
    index.append(spark.createDataFrame([("d", 1), ("d", 1)], "url string, ok int"), "r2", "url", F.col("ok") == 1)    # tried again
    asked = spark.createDataFrame([(k, i) for i, k in enumerate(["a", "b", "c", "d", "e", None, None, "e", "a"])], "url string, i int")
    new = lambda runs, **k: sorted(r.i for r in KeyIndex(spark, str(tmp_path / "k")).new_rows(asked, runs, **k).collect())
    assert new(["r1", "r2"]) == [2, 4, 5, 6, 7]
    assert new(["r1"]) == [2, 3, 4, 5, 6, 7] and new([]) == list(range(9))
    assert new(["r1", "r2"], only_final=False) == [4, 5, 6, 7]
    assert KeyIndex(spark, f"file:{tmp_path}/k", 99).buckets == 8
    plan = index.known(asked, ["r1", "r2"])._jdf.queryExecution().executedPlan().toString().splitlines()
    scan = next(i for i, line in enumerate(plan) if "FileScan" in line)
    sort = max(i for i, line in enumerate(plan[:scan]) if "Sort [" in line)
    assert "Bucketed: true" in plan[scan] and not any("Exchange" in line for line in plan[sort:])
    assert any("SortMergeJoin" in line for line in plan[:sort])
    index.merge(["r1", "r2"], "m")
    assert new(["m"]) == [2, 4, 5, 6, 7] and new(["m"], only_final=False) == [4, 5, 6, 7]


def test_keys_of_all_runs_are_merged_by_a_commit(spark, tmp_path):
    root = str(tmp_path)
    for ids in ([1, 2], [2, 3, 5], [6]):
        run(spark, ids, root)
    before = seen(spark, root)
    runmod.merge_keys(spark, root)
    assert seen(spark, root)[:4] == before[:4] and len(led.Ledger(spark, root).batches("keys")) == 1
    gone = led.Ledger(spark, root).remove_orphans()
    assert len(gone) == 3 and seen(spark, root)[:4] == before[:4]
    assert run(spark, [1, 2, 3, 5, 6, 7], root).first().new_records == 2         # u5 is not finished, u7 is new


def test_hot_and_repeated_keys(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "k"), 4)
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("url"))
    index.append(rows.where("url = 'hot' or int(url) < 100"), "r1")
    left = index.new_rows(rows, ["r1"])
    assert left.count() == 20_000 - 66 and left.where("url = 'hot'").count() == 0


class Streamed:
    """Hands batches to what ``start`` gave to foreachBatch."""

    def __init__(self, spark, root, checkpoint, settings=SETTINGS):
        streamed = self

        class Writer:
            def foreachBatch(self, f):
                streamed.handle = f
                return self

            def __getattr__(self, name):
                return lambda *a, **k: self
        stream = type("S", (), {"writeStream": Writer()})()
        reader = type("R", (), {"schema": lambda self, s: self, "format": lambda self, f: self, "load": lambda self, p: stream})()
        session = type("X", (), {"readStream": reader})()
        available_now.start(session, "in", None, root, SCORER, FIELDS, settings, checkpoint=checkpoint)


def test_stream_leaves_what_the_batch_run_leaves(spark, tmp_path, monkeypatch):
    batch, stream = str(tmp_path / "b"), str(tmp_path / "s")
    s = Streamed(spark, stream, "ck")
    table = lambda df: sorted(map(str, df.drop("batch_id").collect()))
    for k, ids in enumerate([range(1, 6), range(3, 9), range(3, 9)]):
        run(spark, ids, batch)
        if k == 1:                                       # fails half-way, then comes again
            with monkeypatch.context() as m:
                m.setattr(KeyIndex, "append", lambda *a, **kw: 1 / 0)
                with pytest.raises(ZeroDivisionError):
                    s.handle(articles(spark, ids), k)
        for _ in range(2):                               # every batch is replayed
            s.handle(articles(spark, ids), k)
        for name in ("filled", "heat"):
            assert table(sinks.read_latest(spark, batch, name)) == table(sinks.read_latest(spark, stream, name)), (k, name)
        assert table(sinks.read_base(spark, batch)) == table(sinks.read_base(spark, stream)), k
    rows = [led.Ledger(spark, r).summaries().orderBy("run").collect() for r in (batch, stream)]
    assert rows[0] == rows[1] and [r.new_records for r in rows[0]] == [5, 4, 1]


def test_another_checkpoint_keeps_the_batches_of_the_first(spark, tmp_path):
    root = str(tmp_path)
    Streamed(spark, root, "one").handle(articles(spark, [1, 2]), 0)
    Streamed(spark, root, "two").handle(articles(spark, [2, 3]), 0)
    assert seen(spark, root)[2] == ["u1", "u2", "u3"] and len(os.listdir(f"{root}/base/run_date=2025-01-01")) == 2


def test_links_are_only_added(spark, tmp_path):
    root = str(tmp_path)
    mail = lambda *urls: spark.createDataFrame([(i, f'<a href="https://{u}">x</a>') for i, u in enumerate(urls)], "msg_pos int, html string")
    table = lambda: [(r.url.removeprefix("https://"), r.pos, r.batch) for r in links.read_links(spark, root).orderBy("pos").collect()]
    files = lambda: {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(f"{root}/links") for f in fs}
    assert links.read_links(spark, root) is None
    assert links.run_collect_links(spark, mail("a.x/1", "b.x/2", "a.x/1"), root) == 2
    first = files()
    assert table() == [("a.x/1", 0, 0), ("b.x/2", 1, 0)]
    assert links.run_collect_links(spark, mail("c.x/3", "b.x/2", "d.x/4"), root, source="m2") == 2
    assert links.run_collect_links(spark, mail("c.x/3", "b.x/2", "d.x/4"), root, source="m2") == 0
    assert links.run_collect_links(spark, mail("a.x/1"), root) == 0
    assert table() == [("c.x/3", 0, 0), ("d.x/4", 1, 0), ("a.x/1", 2, 1), ("b.x/2", 3, 1)]
    assert {k: v for k, v in files().items() if k in first} == first          # nothing that was there was written again
    assert "Exchange hashpartitioning" not in links.read_links(spark, root)._jdf.queryExecution().executedPlan().toString()


def test_a_stopped_collection_is_unseen(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    rows = spark.createDataFrame([("https://a", 0), ("https://b", 1)], "url string, pos int")
    with monkeypatch.context() as m:
        m.setattr(led.Ledger, "commit", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            links.append_links(spark, rows, root)
    assert links.read_links(spark, root) is None
    assert links.append_links(spark, rows, root) == 2 and links.read_links(spark, root).count() == 2
