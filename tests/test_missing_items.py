"""Consistency of tables, counts by several dimensions, bytes, trained
classifiers: against brute force."""

import collections
import itertools
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from newsledger.functions import text
from newsledger.operators import classify as cl
from newsledger.operators import reports


def test_presence_against_sets(spark):
    rng = random.Random(2)
    tables = {n: [rng.choice([*range(30), None]) for _ in range(rng.randrange(5, 40))] for n in "abcd"}
    frames = {n: spark.createDataFrame([(k,) for k in ks], "url int") for n, ks in tables.items()} | {"e": spark.createDataFrame([], "url int")}
    got = {r.tables: (r.n_keys, r.n_rows) for r in reports.presence(frames).collect()}
    want = collections.defaultdict(lambda: [0, 0])
    for k in range(30):
        names = ",".join(n for n, ks in tables.items() if k in ks)
        if names:
            want[names][0] += 1
            want[names][1] += sum(ks.count(k) for ks in tables.values())
    for n, ks in tables.items():
        if None in ks:
            want[f"null key: {n}"][1] += ks.count(None)
    assert got == {k: tuple(v) for k, v in want.items()}
    rules = [("a", "b"), ("b", "a"), ("e", "a"), ("a", "e")]
    found = {r.rule: (r.n_keys, r.is_consistent) for r in reports.subset_violations(frames, rules).collect()}
    for a, b in rules:
        n = len({*tables.get(a, [])} - {*tables.get(b, [])} - {None})
        assert found[f"{a} in {b}"] == (n, n == 0)
    with pytest.raises(ValueError):
        reports.presence({})


def test_presence_is_one_aggregate_with_partial_sums(spark):
    frames = {n: spark.range(10).select(F.col("id").alias("url")) for n in "abc"}
    plan = reports.presence(frames)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 2 and "partial_bit_or" in plan


def test_counts_by_against_loops(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["p", "q", " ", None]), rng.choice(["x", "x, y", "y,z ,x", "x,x", "", ",", None]), rng.choice(["1;2", "2", None]), rng.choice([1, 2, None]))
            for _ in range(300)]
    df = spark.createDataFrame(rows, "place string, cause string, month string, deaths int")
    sets = [["place"], ["cause"], ["month"], ["place", "cause"], ["cause", "month"], ["place", "cause", "month"], []]
    got = reports.counts_by(df, ["place", "cause", "month"], sets, "deaths", {"cause": ",", "month": ";"}).collect()
    want = collections.defaultdict(lambda: [0, 0])
    for place, cause, month, deaths in rows:
        values = {"place": [(place or "").strip() or "unknown"],
                  "cause": list(dict.fromkeys(x.strip() for x in (cause or "").split(",") if x.strip())) or ["unknown"],
                  "month": list(dict.fromkeys(x for x in (month or "").split(";") if x)) or ["unknown"]}
        for s in sets:
            for found in itertools.product(*(values[d] for d in s)):
                cell = want[(",".join(s), *(dict(zip(s, found)).get(d) for d in ("place", "cause", "month")))]
                cell[0] += 1
                cell[1] += deaths or 0
    assert {(r.grouping, r.place, r.cause, r.month): [r.n, r.sum_deaths] for r in got} == dict(want)
    assert reports.counts_by(df.limit(0), ["place"], [["place"]]).count() == 0
    assert reports.counts_by(df, ["place"], [["place"]]).columns == ["grouping", "place", "n"]


def test_bytes(spark):
    whole = "aé中🎉�z".encode()
    values = [whole[:n] for n in range(len(whole) + 1)] + [whole[n:] for n in range(len(whole))] + [b"\xff\xfeab", b"a\x80b\xc3", "x�".encode() + b"\xe4", None]
    df = spark.createDataFrame([(i, None if v is None else bytearray(v)) for i, v in enumerate(values)], "i int, v binary")
    got = [r.r for r in df.select("i", text.utf8_result("v").alias("r")).orderBy("i").collect()]
    for v, r in zip(values, got):
        want = None if v is None else v.decode("utf-8", "ignore")
        assert r.value == want and (r.is_valid, r.error) == ((None, None) if v is None else (v == want.encode(), None if v == want.encode() else "invalid_utf8"))
    marked = [r.r.value for r in df.select("i", text.utf8_result("v", drop=False).alias("r")).orderBy("i").collect()]
    assert marked == [None if v is None else v.decode("utf-8", "replace") for v in values]


def _labelled(spark):
    docs, lab = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    return docs.join(lab, "doc_id").select("doc_id", "text", F.col("quality").alias("label"))


def test_trained_accuracy_is_that_of_the_held_out_rows(spark):
    data = _labelled(spark)
    model, m = cl.train_classifier(data, "nb", 2, id_col="doc_id", num_features=1 << 10)
    m = m.first()
    held = data.where(cl.id_fold(F.col("doc_id"), cl.HELD_OUT) == 0)
    rows = model.transform(held).select("label", "prediction").collect()
    assert m.n_held_out == len(rows) and m.n_train + m.n_held_out == data.count()
    assert m.accuracy == pytest.approx(sum(r.label == r.prediction for r in rows) / len(rows))
    # each fold fitted and counted by hand
    train = data.where(cl.id_fold(F.col("doc_id"), cl.HELD_OUT) != 0).withColumn("fold", cl.id_fold(F.col("doc_id"), 2, "folds")).withColumn("label", F.col("label").cast("double"))
    each = []
    for k in range(2):
        rows = cl.text_pipeline("nb", 1 << 10).fit(train.where(f"fold <> {k}")).transform(train.where(f"fold = {k}")).select("label", "prediction").collect()
        each.append(sum(r.label == r.prediction for r in rows) / len(rows))
    assert m.cv_mean == pytest.approx(sum(each) / 2)
    # the same rows whatever the partitions
    again = cl.train_classifier(data.repartition(7, "text"), "nb", 2, id_col="doc_id", num_features=1 << 10)[1].first()
    assert tuple(again) == tuple(m)


def test_word_weights_against_counts(spark):
    import math
    import re
    data = _labelled(spark)
    model = cl.fit_word_weights(data, 20, 5)
    rows = [(set(re.findall(cl.WORD, (r.text or "").lower())), r.label) for r in data.collect()]
    n1 = sum(y for _, y in rows)
    n0 = len(rows) - n1
    a, b = collections.Counter(), collections.Counter()
    for words, y in rows:
        (a if y else b).update(words)
    weights = {w: math.floor(1000 * math.log((a[w] + 1) * (n0 + 2) / ((b[w] + 1) * (n1 + 2)))) for w in {*a, *b} if a[w] + b[w] >= 5}
    best = sorted(weights.items(), key=lambda x: (-abs(x[1]), x[0]))[:20]
    assert list(model.weights) == best and model.bias == math.floor(1000 * math.log((n1 + 1) / (n0 + 1)))
    scored = data.select("text", model.scored_expr(F.col("text")).alias("s")).collect()
    for r in scored:
        margin = model.bias + sum(w for x, w in model.weights if x in set(re.findall(cl.WORD, r.text.lower())))
        assert (r.s.label, r.s.confidence) == (int(margin > 0), pytest.approx(1 / (1 + math.exp(-abs(margin) / 1000))))


def test_both_stages_stay_in_the_jvm(spark):
    model = cl.WordWeights((("heat", 3000), ("football", -3000), ("maybe", 100)))
    df = spark.createDataFrame([(1, "heat heat wave today"), (2, "football match today"), (3, "maybe wave today"), (4, None), (5, "short")], "id int, content string")
    out = cl.two_stage_classify(df, model, cl.RuleScorer("wave"))
    got = {r.id: (r.is_relevant, r.method_used) for r in out.collect()}
    assert got == {1: (1, "local"), 2: (0, "local"), 3: (1, "fallback"), 4: (0, "fallback"), 5: (0, "fallback")}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert cl.fit_word_weights(df.select(F.col("content").alias("text"), F.lit(None).cast("int").alias("label"))).weights == ()
