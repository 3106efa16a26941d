"""Expected values per function (FIXTURES.md §3)."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import many, one
from newsledger.functions import (booleans, categories, dates, html, model, numbers, predicates, text,
                                  times, urls)


def test_content_validity(spark):
    assert many(spark, predicates.content_is_valid, [None, "  ", "a" * 9, "a" * 10]) == [False, False, False, True]


def test_needs_content(spark):
    got = many(spark, predicates.has_content, ["a" * 10, "a" * 11, "None", None, ""])
    assert got == [False, True, False, False, False]


def test_unwrap_redirect(spark):
    got = many(spark, urls.unwrap_redirect, [
        "https://www.google.com/url?url=https%3A%2F%2Fx.y%2Fa&q=z",
        "https://www.google.com/url?q=https%3A%2F%2Fx.y",
        "https://www.google.com/url?url=&q=https%3A%2F%2Fq.z",
        "https://other.com/url?url=x",
    ])
    assert got == ["https://x.y/a", "https://x.y", "https://q.z", "https://other.com/url?url=x"]


def test_strip_tracking(spark):
    got = many(spark, urls.strip_tracking_params, [
        "http://h/p?a=1&b=&a=2&utm_x=3&ved=q#f",
        "http://h/p?UTM_Source=x&ei=1&usg=2",
        "HTTP://h/p?x=a+b%7E*&y=%zz",
        "https://h?k=v w",
    ])
    assert got == ["http://h/p?a=1#f", "http://h/p", "http://h/p?x=a+b~%2A&y=%25zz", "https://h?k=v+w"]


def test_excluded_links(spark):
    got = many(spark, urls.is_excluded_link, ["https://www.google.com/alerts/remove", "https://accounts.google.com/x",
                                              "https://news.site/a"])
    assert got == [True, True, False]


def test_extract_hrefs(spark):
    h = '<a href="http://a/b?x=1&amp;y=2">x</a><!-- <a href="http://no"> --><A class=x HREF=\'/rel\'><a href=http://bare>'
    assert one(spark, urls.extract_hrefs, h) == ["http://a/b?x=1&y=2", "/rel", "http://bare"]


def test_article_text(spark):
    h = ('<html><script>var t="</p>";</script><p><b>Hi &amp; yo<br><p>Two  words</p>'
         '<!-- <p>no</p> --><p> </p><div>x</div><p>last<div>y</div></html>')
    assert one(spark, html.article_text, h) == "Hi & yo\nTwo  words\nlast"
    assert one(spark, html.article_text, "") == ""


def test_text_clean_and_cut(spark):
    r = one(spark, lambda c: text.text_result(c, text.TextProfile(normalize_unicode=False)),
            "<b>a</b>&nbsp;&amp; http://x.y/z  b")
    assert r["value"] == "a & b"
    s = ("w" * 449 + " ") + "x" * 150
    cut = one(spark, lambda c: text.truncate_text(c, 500), s)
    assert len(cut) == 449
    hard = one(spark, lambda c: text.truncate_text(c, 500), "y" * 100 + " " + "z" * 500)
    assert len(hard) == 500


def test_nfkc(spark):
    assert one(spark, text.nfkc, "ำ") == "ํา"


def test_integers(spark):
    got = many(spark, lambda c: numbers.integer_result(c, numbers.AGE_RANGE)["value"],
               ["41.0", "41.9", "-1", "130", "abc", "สาม", "สิบสอง", "๔๑"])
    assert got == [41, 41, 0, 120, None, 3, 2, 41]


def test_floats(spark):
    got = many(spark, lambda c: numbers.float_result(c, numbers.BODY_TEMP_RANGE),
               ["38,5 °C", "46", "inf"])
    assert got[0]["value"] == 38.5 and not got[1]["is_valid"] and not got[2]["is_valid"]
    assert one(spark, lambda c: numbers.float_result(c)["value"], "0.25") == 0.2


def test_dates(spark):
    f = lambda c: dates.date_result(c, as_of="2026-01-01")["value"]
    got = many(spark, f, ["3/20/2567", "20/3/2567", "2567-3-20", "03/04/2024", "29/2/2567", "29/2/2568",
                          "15 มีนาคม 2567", "15 Mar 2024", "15 ม.ค. 2567", "๑๕/๓/๒๕๖๗", "3/20/61"])
    d = dt.date
    assert got == [d(2024, 3, 20)] * 3 + [d(2024, 3, 4), d(2024, 2, 29), None, d(2024, 3, 15), d(2024, 3, 15),
                                         d(2024, 1, 15), d(2024, 3, 15), None]


def test_month_name(spark):
    assert one(spark, dates.thai_month_name, dt.date(2024, 4, 15), "v date") == "เมษายน"


def test_times(spark):
    got = many(spark, lambda c: times.time_result(c)["value"], ["14:30", "at 9:05:07", "25:10", "14.30"])
    assert got == ["14:30:00", "09:05:07", None, "14:30:00"]


def test_booleans(spark):
    got = many(spark, lambda c: booleans.boolean_result(c), ["yes", "ไม่มี", "unknown", "-", "2",
                                                             "ไม่ใช่", "not found", "ไม่มีอาการ"])
    assert [g["value"] for g in got] == [1, 0, None, None, None, 0, 0, 0]
    assert [g["is_valid"] for g in got] == [True, True, True, True, False, True, True, True]


def test_categories(spark):
    prov = categories.vocabulary_for("จังหวัดที่เกิดเหตุ", fuzzy=False)
    got = many(spark, lambda c: categories.category_result(c, prov)["value"], [None, "Bangkok", "จ.ชลบุรี", "กรุงเทพมหานคร"])
    assert got == ["ไม่ระบุ", "กรุงเทพฯ", "ชลบุรี", "กรุงเทพฯ"]
    strict = categories.vocabulary_for("จังหวัดที่เกิดเหตุ", fuzzy=False, strict=True)
    r = one(spark, lambda c: categories.category_result(c, strict), "zzz")
    assert r["value"] is None and not r["is_valid"]


def test_fuzzy(spark):
    from newsledger.operators.categorical import with_category
    prov = categories.vocabulary_for("จังหวัดที่เกิดเหตุ")
    df = spark.createDataFrame([("เชียงไหม่",)], "v string")
    r = with_category(df, "v", prov, "r").collect()[0]["r"]
    assert r["value"] == "เชียงใหม่" and r["match_kind"] == "fuzzy"


def test_age_group(spark):
    got = many(spark, categories.age_group, [12, 13, 35, 36, 60], "v int")
    assert got == ["เด็ก", "วัยรุ่น", "ผู้ใหญ่วัยหนุ่มสาว", "ผู้ใหญ่วัยกลางคน", "ผู้สูงอายุ"]


def test_label_parse(spark):
    assert many(spark, model.label_from_reply, ["Answer: 1", "10", "yes", None]) == [1, 1, 0, 0]


def test_json_reply(spark):
    f = lambda c: model.reply_fields(c, ["a"])
    got = many(spark, f, ['```json\n{"a":[1,2]}\n```', '{"a":1', "{}", "[1]", '```\n{"a": "x"}'])
    assert got[0]["ok"] and got[0]["a"].replace(" ", "") == "[1,2]"
    assert [g["ok"] for g in got[1:]] == [False, False, False, True]
    assert got[4]["a"] == "x"


def test_render_template(spark):
    r = one(spark, lambda c: model.render_template("x {content} y {other}", content=c, other="{content}"), "C")
    assert r == "x C y {content}"


def test_repeated_json_keys(spark):
    from newsledger.functions import model
    replies = {'{"a": 1, "a": 2, "b": {"c": 1, "c": 2}}': (True, "2", '{"c":1,"c":2}'), '{"b": "x", "a": null, "b": "y"}': (True, None, "y"),
               '{"a": 1, "a": 2} trailing': (False, None, None), '{"a": 1, "a": 2': (False, None, None), '{"a": 1, "a": 2}, {"a": 3}': (False, None, None),
               "{'a': 1, 'a': 2}": (False, None, None), '```json\n{"a": 3, "a": 4}\n```': (True, "4", None), '[{"a": 1}]': (False, None, None), "{}": (False, None, None)}
    df = spark.createDataFrame([(i, r) for i, r in enumerate(replies)], "i int, r string")
    got = [tuple(x.f) for x in df.select("i", model.reply_fields("r", ["a", "b"]).alias("f")).orderBy("i").collect()]
    assert got == list(replies.values())
