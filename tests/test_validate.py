"""Spec-driven validation, reports and the 39-column form."""

from pyspark.sql import functions as F

from conftest import rows
from newsledger.operators.validate import (HEAT_COLUMNS, HEAT_SPECS, ColumnSpec, column_order_report,
                                           column_report, columns_by_type, conform, error_report, validate)


def _frame(spark):
    data = [("1", "2567", "38,5 °C", "3/20/2567", "14:30", "มี", "Bangkok", "J45.9", "<b>x</b>"),
            ("0", "2019", "abc", "garbage", "25:10", "2", "zzz", "bad", None),
            (None, None, None, None, None, None, None, None, None)]
    cols = ["ที่", "ปี", "อุณหภูมิร่างกาย(C°)", "ว/ด/ป เสียชีวิต", "เวลาที่เสียชีวิต", "เบาหวาน",
            "จังหวัดที่เกิดเหตุ", "ICD 10", "หมายเหตุ"]
    return spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in cols)).withColumn("rid", F.monotonically_increasing_id())


def test_validate_values(spark):
    df = _frame(spark)
    v = validate(df, HEAT_SPECS, keep=("rid",), as_of="2026-01-01", normalize_unicode=False).orderBy("rid")
    r = v.collect()
    assert r[0]["ที่"] == 1.0 and r[0]["ปี"] is None and r[0]["อุณหภูมิร่างกาย(C°)"] == 38.5
    assert str(r[0]["ว/ด/ป เสียชีวิต"]) == "2024-03-20" and r[0]["เวลาที่เสียชีวิต"] == "14:30:00"
    assert r[0]["เบาหวาน"] == 1 and r[0]["จังหวัดที่เกิดเหตุ"] == "กรุงเทพฯ" and r[0]["ICD 10"] == "J45.9"
    assert r[0]["หมายเหตุ"] == "x"
    assert r[1]["ICD 10"] is None and r[1]["จังหวัดที่เกิดเหตุ"] == "ไม่ระบุ"


def test_reports(spark):
    df = _frame(spark)
    v = validate(df, HEAT_SPECS, keep=("rid",), as_of="2026-01-01", normalize_unicode=False)
    errs = {(r["column"], r["error"]) for r in error_report(v).collect()}
    assert ("ปี", "out_of_range") in errs and ("ICD 10", "pattern") in errs and ("เวลาที่เสียชีวิต", "invalid_time") in errs
    rep = {r["column"]: (r["n_valid"], r["n_invalid"], r["n_null"]) for r in column_report(v).collect()}
    assert rep["ปี"] == (0, 2, 1) and rep["ICD 10"] == (1, 1, 1)
    # every cell is counted once
    assert all(sum(x) == 3 for x in rep.values())


def test_conform_and_order(spark):
    df = spark.createDataFrame([("x",)], "`หมายเหตุ` string")
    out = conform(df)
    assert tuple(out.columns) == HEAT_COLUMNS and len(HEAT_COLUMNS) == 39
    assert out.collect()[0]["สถานะ"] == "เสียชีวิต"
    assert column_order_report(list(HEAT_COLUMNS)) == []
    issues = column_order_report(["ปี", "ที่"])
    assert {i["issue"] for i in issues} >= {"count", "position", "missing"}
    types = columns_by_type()
    assert (len(types["text"]), len(types["boolean"]), len(types["multiclass"]), len(types["float"]),
            len(types["integer"]), len(types["date"]), len(types["time"])) == (21, 6, 5, 3, 2, 1, 1)


def test_custom_spec(spark):
    df = spark.createDataFrame([("5",), ("500",)], "n string")
    v = validate(df, [ColumnSpec("n", "integer", (0, 120), clamp=True)])
    assert sorted(r[0] for r in rows(v.select("n"))) == [5, 120]


def test_validate_runs_the_fuzzy_stage_and_required(spark):
    from newsledger.functions.categories import PROVINCES
    from newsledger.operators.validate import MULTICLASS, ColumnSpec, error_report, validate
    specs = (ColumnSpec("จังหวัด", MULTICLASS), ColumnSpec("ชื่อ", required=True))
    near = "เชียงไหม่"
    df = spark.createDataFrame([(near, "x"), (None, " "), ("zzz", None)], "`จังหวัด` string, `ชื่อ` string")
    v = validate(df, specs)
    assert "เชียงใหม่" in PROVINCES and sorted(r["จังหวัด"] == "เชียงใหม่" for r in v.collect()) == [False, False, True]
    assert [r["error"] for r in error_report(v).collect()] == ["required", "required"]


def test_vocabulary_table(spark):
    from newsledger.operators.categorical import with_vocabulary_table
    terms = spark.createDataFrame([(f"term{i}", None, i) for i in range(6000)] + [("term1", "alias", 0), ("term2", "ALIAS", 1), ("term3", "term4", 9)],
                                  "term string, synonym string, rank int")
    df = spark.createDataFrame([("TERM5999 ",), ("alias",), ("term4",), (None,), ("",), ("other",)] + [("term1",)] * 50, "v string")
    got = [tuple(r.c) for r in with_vocabulary_table(df, "v", terms, "c", default="?").collect()]
    assert sorted(got) == sorted([("term5999", "exact"), ("term1", "synonym"), ("term3", "synonym"), ("?", "blank"), ("?", "blank"), ("?", "none")] + [("term1", "exact")] * 50)
    strict = with_vocabulary_table(df, "v", terms, "c", case_sensitive=True).where("v = 'TERM5999 '").head()
    assert strict.c.match_kind == "none"


def test_case_options(spark):
    from newsledger.functions import booleans, categories
    from newsledger.operators.categorical import with_category
    v = categories.Vocabulary(("North", "South"), (("N.", "North"),), default="?", case_sensitive=True)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["North", "north", "N.", "n.", "Norht", "NORTHERN", "Northern"])], "i int, c string")
    got = [tuple(r.r)[::3] for r in with_category(df, "c", v, "r").orderBy("i").collect()]
    assert got == [("North", "exact"), ("North", "fuzzy"), ("North", "synonym"), ("?", "none"), ("North", "fuzzy"), ("?", "none"), ("North", "fuzzy")]
    loose = categories.Vocabulary(("North", "South"), (("N.", "North"),), default="?")
    assert [r.r.value for r in with_category(df, "c", loose, "r").orderBy("i").collect()] == ["North"] * 7
    words = spark.createDataFrame([(i, t) for i, t in enumerate(["Ja", "ja", "NEIN", "Nein"])], "i int, c string")
    strict = [r.v for r in words.select("i", booleans.boolean_result("c", ("Ja",), ("Nein",), case_sensitive=True)["value"].alias("v")).orderBy("i").collect()]
    assert strict == [1, None, None, 0]
    assert [r.v for r in words.select("i", booleans.boolean_result("c", ("Ja",), ("Nein",))["value"].alias("v")).orderBy("i").collect()] == [1, 1, 0, 0]


def test_patterns_encoding_and_schema(spark):
    from newsledger.operators import validate as V
    specs = [s for s in V.HEAT_SPECS if s.name in ("ว/ด/ป เสียชีวิต", "เวลาที่เสียชีวิต", "หมายเหตุ")]
    rows = [(0, "5/3/2567", "10:30", "fine text"), (1, "5 มีนาคม 2567", "10.30 น.", "x"), (2, None, "", None), (3, "nothing", "99:99", "y")]
    df = spark.createDataFrame(rows, ["id", *(s.name for s in specs)])
    loose = {(r.id, r.column): r.error for r in V.error_report(V.validate(df, specs, ["id"], as_of="2030-01-01"), ["id"]).collect()}
    strict_rows = V.validate(df, specs, ["id"], as_of="2030-01-01", strict_patterns=True)
    strict = {(r.id, r.column): r.error for r in V.error_report(strict_rows, ["id"]).collect()}
    date, time, note = (s.name for s in specs)
    assert (1, date) not in loose and (1, time) not in loose and (3, date) in loose
    assert strict == loose | {(1, date): "pattern", (1, time): "pattern"}
    assert {r.id: r[date] is None for r in strict_rows.collect()} == {0: False, 1: True, 2: True, 3: True}
    broken = spark.createDataFrame([(bytearray("ok é".encode() + b"\xff end"),)], "b binary").select(F.col("b").cast("string").alias(note))
    cell = V.validate(broken, [s for s in specs if s.name == note]).head()
    assert cell[note] == "ok é end" and cell["_cells"][0].is_valid
    schema = V.output_schema([V.ColumnSpec("a", V.INTEGER, required=True), V.ColumnSpec("b", V.DATE)])
    assert schema.simpleString() == "struct<a:bigint,b:date>" and [f.nullable for f in schema] == [False, True]
    assert V.required_columns([V.ColumnSpec("a", required=True), V.ColumnSpec("b")]) == ["a"]
