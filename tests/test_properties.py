"""Property tests (hypothesis): each example batch is one Spark job."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsledger.functions import dates, numbers, text, times
from newsledger.operators import columns as cols
from newsledger.operators import incremental as inc

SETTINGS = dict(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def _eval(spark, fn, values, schema="v string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, " + schema)
    return [r["r"] for r in df.select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()]


@settings(**SETTINGS)
@given(st.lists(st.dates(dt.date(2020, 1, 1), dt.date(2030, 12, 31)), min_size=1, max_size=40))
def test_dates_round_trip(spark, ds):
    thai = dates.THAI_MONTHS
    texts = []
    for d in ds:
        texts += [f"{d.month}/{d.day}/{d.year + 543}", f"{d.day} {thai[d.month - 1]} {d.year + 543}",
                  d.isoformat(), f"{d.day}.{d.month}.{d.year}"]
    got = _eval(spark, lambda c: dates.date_result(c, as_of="2031-01-01")["value"], texts)
    expect = []
    for d in ds:
        dm_first = d.day <= 12   # month-first wins when both readings exist
        alt = dt.date(d.year, d.day, d.month) if dm_first else d
        expect += [d, d, d, alt]
    assert got == expect


@settings(**SETTINGS)
@given(st.lists(st.dates(dt.date(2020, 1, 1), dt.date(2030, 12, 31)), min_size=1, max_size=40))
def test_staged_dates_match_expression(spark, ds):
    texts = [f"{d.day}/{d.month}/{d.year + 543}" for d in ds] + [f"{d.day} Mar {d.year}" for d in ds]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    # with_date joins on distinct texts, so rows come back in any order
    a = [r[0] for r in df.select("i", dates.date_result("v", as_of="2031-01-01")["value"].alias("d")).orderBy("i").select("d").collect()]
    b = [r[0] for r in cols.with_date(df, F.col("v"), "r", as_of="2031-01-01").orderBy("i").select("r.value").collect()]
    assert a == b


def test_dates_of_every_shape(spark):
    """All numeric layouts, month names and odd numbers: the shapes give what
    the layouts give when tried one by one."""
    numbers_ = ("0", "1", "2", "02", "5", "12", "13", "29", "30", "31", "32", "68", "69", "99", "2020", "2024", "2567", "0000", "123")
    texts = [f"{a}{s}{b}{s}{c}" for s in "/-" for a in numbers_ for b in ("1", "02", "12", "13", "29", "30", "31", "45") for c in numbers_]
    texts += ["1/2-2024", "1.2.2567", "5 มกราคม 2567", "29 Feb 2024", "29 Feb 2023", "3 4", "a 1 b 2 c 2024", "", " ", "1/2/3/4", "31 มิ.ย. 2567", "2024 มีค 5", "Mar 5 2024"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    staged = {r.v: tuple(r.r) for r in cols.with_date(df, F.col("v"), "r", 1, 9999, as_of="9999-01-01").collect()}
    plain = {r.v: tuple(r.r) for r in df.select("v", dates.date_result("v", 1, 9999, as_of="9999-01-01").alias("r")).collect()}
    assert {t: (staged[t], plain[t]) for t in texts if staged[t] != plain[t]} == {}


@settings(**SETTINGS)
@given(st.lists(st.integers(-10 ** 6, 10 ** 6), min_size=1, max_size=40))
def test_integers_idempotent(spark, xs):
    got = _eval(spark, lambda c: numbers.integer_result(c)["value"], [str(x) for x in xs])
    assert got == xs
    again = _eval(spark, lambda c: numbers.integer_result(c)["value"], [f"{x}.0" for x in got])
    assert again == xs


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.integers(0, 23), st.integers(0, 59), st.integers(0, 59)), min_size=1, max_size=40))
def test_times_idempotent(spark, ts):
    vals = [f"{h:02d}:{m:02d}:{s:02d}" for h, m, s in ts]
    assert _eval(spark, lambda c: times.time_result(c)["value"], vals) == vals


@settings(**SETTINGS)
@given(st.lists(st.text(alphabet=st.characters(blacklist_characters="<>&", blacklist_categories=("Cs",)),
                        max_size=60), min_size=1, max_size=30))
def test_text_clean_idempotent(spark, xs):
    prof = text.TextProfile(normalize_unicode=False, max_length=10 ** 6)
    once = _eval(spark, lambda c: text.clean_text(c, prof), xs)
    twice = _eval(spark, lambda c: text.clean_text(c, prof), once)
    assert once == twice
    # whitespace collapse and strip agree with Python's split/join
    assert once == [" ".join(x.split()) if "http" not in x and "www." not in x else o for x, o in zip(xs, once)]


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 100)), min_size=1, max_size=50),
       st.lists(st.sampled_from(["a", "b", "c", None]), max_size=5))
def test_anti_join_partition(spark, inp, base):
    i = spark.createDataFrame(inp, "url string, pos int")
    b = spark.createDataFrame([(u,) for u in base], "url string")
    new = inc.new_rows(i, b).count()
    seen = i.join(inc.processed_keys(b), "url", "left_semi").count()
    assert new + seen == len(inp)
    assert new == sum(1 for u, _ in inp if u is None or u not in set(base))
