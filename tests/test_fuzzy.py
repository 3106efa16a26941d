"""The gram index against comparing all pairs."""

import difflib
import random

import pytest
from pyspark.sql import functions as F

from newsledger.functions.categories import close_match
from newsledger.operators import fuzzy
from newsledger.operators.categorical import with_vocabulary_table

CHARS = "aabbcdeE éกข"


def text(rng, n):
    return "".join(rng.choice(CHARS) for _ in range(n))


def edited(rng, t):
    t = list(t)
    for _ in range(rng.randrange(4)):
        at = rng.randrange(len(t) + 1)
        t[at:at + rng.randrange(2)] = rng.choice(CHARS) * rng.randrange(2)
    return "".join(t)


def words(seed, n):
    rng = random.Random(seed)
    terms = {text(rng, rng.choice([1, 2, 3, 4, 5, 6, 8, 12, 20, 39, 41, 60])) for _ in range(n)}
    values = {edited(rng, t) for t in terms} | {text(rng, rng.randrange(1, 9)) for _ in range(n)} | {"", "zzzz"}
    return sorted(values), sorted(terms)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def column(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "text string")


@pytest.mark.parametrize("kind, cutoff", [("ratio", 0.6), ("ratio", 0.9), ("edit", 0.6), ("edit", 0.75), ("edit", 1.0)])
def test_every_pair_is_found(spark, kind, cutoff):
    values, terms = words(int(cutoff * 100), 90)
    m = fuzzy.Measure(kind, cutoff)
    got = {(r.value, r.term) for r in fuzzy.matches(column(spark, values), column(spark, terms), m).collect()}
    if kind == "ratio":
        close = lambda v, t: difflib.SequenceMatcher(None, t, v).ratio() >= cutoff
    else:
        close = lambda v, t: distance(v, t) <= (1 - cutoff) * max(len(v), len(t)) + 1e-9
    assert got == {(v, t) for v in values for t in terms if v and close(v, t)}


def test_the_index_leaves_most_pairs_alone(spark):
    rng = random.Random(4)
    names = sorted({"".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(10)) for _ in range(400)})
    values = sorted({edited(rng, t) for t in names})
    m = fuzzy.Measure("edit", 0.8)
    assert fuzzy.candidates(column(spark, values), column(spark, names), m).count() < len(names) * len(values) / 50


@pytest.mark.parametrize("cutoff", [0.6, 0.8])
def test_best_term_is_that_of_a_list(spark, cutoff):
    values, terms = words(7, 120)
    ranked = spark.createDataFrame([(t, k) for k, t in enumerate(terms)], "text string, rank int")
    got = {r.value: r.term for r in fuzzy.closest_folded(column(spark, values), ranked, fuzzy.Measure("ratio", cutoff)).collect()}
    want = {v: close_match(v, terms, cutoff) for v in values}
    assert got == {v: t for v, t in want.items() if t is not None}


def test_vocabulary_table_with_similarity(spark):
    terms = spark.createDataFrame([("Paris", None, 0), ("London", None, 1), ("London", "LDN", 1), ("Berlin", None, 2)], "term string, synonym string, rank int")
    df = spark.createDataFrame([(i, v, "x") for i, v in enumerate(["paris", " ldn ", "Londn", "BERLINN", "Rome", "", None, "Londn"])], "id int, c string, value string")
    got = {r.id: tuple(r.o) for r in with_vocabulary_table(df, "c", terms, "o", "none", similar=fuzzy.Measure("ratio", 0.6)).collect()}
    assert got == {0: ("Paris", "exact"), 1: ("London", "synonym"), 2: ("London", "fuzzy"), 3: ("Berlin", "fuzzy"), 4: ("none", "none"),
                   5: ("none", "blank"), 6: ("none", "blank"), 7: ("London", "fuzzy")}
    empty = with_vocabulary_table(df, "c", terms.limit(0), "o", None, similar=fuzzy.Measure("edit", 0.6))
    assert {r.o.match_kind for r in empty.collect()} == {"none", "blank"}
    exact_case = with_vocabulary_table(df, "c", terms, "o", None, case_sensitive=True, similar=fuzzy.Measure("edit", 0.9))
    assert {r.id: r.o.match_kind for r in exact_case.collect()}[0] == "none"


def test_measures_are_checked():
    for bad in (("cosine", 0.5), ("ratio", 0), ("edit", 1.2)):
        with pytest.raises(ValueError):
            fuzzy.Measure(*bad)


def test_hot_value_is_compared_once(spark):
    values = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, F.lit("londn")).otherwise(F.concat(F.lit("v"), "id")).alias("c"))
    terms = spark.createDataFrame([("london", None, 0)], "term string, synonym string, rank int")
    out = with_vocabulary_table(values, "c", terms, "o", similar=fuzzy.Measure("edit", 0.8))
    assert out.where("o.match_kind = 'fuzzy'").count() == 6667


def test_words_of_few_syllables_have_few_candidates(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("the er on an re he in ed nd ha at en es of or".split()) for _ in range(rng.randrange(2, 5)))
    values, terms = sorted({word() for _ in range(900)}), sorted({word() for _ in range(600)})
    m = fuzzy.Measure("edit", 0.7)
    near = {(v, t) for v in values for t in terms if distance(v, t) <= (1 - 0.7) * max(len(v), len(t)) + 1e-9}
    got = {(r.value, r.term) for r in fuzzy.candidates(column(spark, values), column(spark, terms), m).collect()}
    assert near <= got and len(got) < 3 * len(near)
    rows = [(r.value, r.term) for r in fuzzy.matches(column(spark, values), column(spark, terms), m).collect()]
    assert len(rows) == len(near) and set(rows) == near


def test_short_and_long_texts_meet(spark):
    # pairs on both sides of the longest text that is indexed by its subsequences
    m = fuzzy.Measure("edit", 0.7)
    rng, n = random.Random(6), m.by_parts
    assert n == 13 and fuzzy.Measure("ratio", 0.7).by_parts == 0
    terms = sorted({text(rng, n + d) for d in range(-5, 8) for _ in range(6)})
    values = sorted({v for t in terms for v in (t[:int(len(t) * .7 + 1)], t + "aaaa", t[3:], edited(rng, t), t[1:-1])})
    got = {(r.value, r.term) for r in fuzzy.matches(column(spark, values), column(spark, terms), m).collect()}
    assert got == {(v, t) for v in values for t in terms if distance(v, t) <= (1 - 0.7) * max(len(v), len(t)) + 1e-9}


def test_second_try_in_lower_case(spark):
    terms = spark.createDataFrame([("ABCDEFGH", 1), ("abcdefgh", 2), ("XYZXYZXY", 3)], "text string, rank int")
    values = column(spark, ["ABCDEFGx", "abcdefgX", "xyzxyzx", "XyZxYzXy", "qqqqqqqq", "QQQQ"])
    got = {r.value: r.term for r in fuzzy.closest_folded(values, terms, fuzzy.Measure("edit", 0.8)).collect()}
    assert got == {"ABCDEFGx": "ABCDEFGH", "abcdefgX": "abcdefgh", "xyzxyzx": "XYZXYZXY", "XyZxYzXy": "XYZXYZXY"}
