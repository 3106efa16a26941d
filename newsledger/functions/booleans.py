"""Yes/no mapping to 1 / 0 / null.

Order (negation-safe): exact unknown -> null; exact false -> 0; exact true -> 1;
a false term (longer than 2 chars) inside the value -> 0; a true term inside
the value -> 1; negative phrase patterns -> 0; positive patterns -> 1; first
number 0/1; otherwise an error. Matching is on the lower-cased, stripped value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import any_contained, col_of, is_blank, let, py_strip, str_array

# True terms.
TRUE_VALUES = (
    "มี", "ใช่", "จริง", "ได้", "เป็น", "ผิด", "มีอาการ", "มีประวัติ",
    "มีการสัมผัส", "มีอาการแสดง", "เป็นโรค", "ป่วย", "เป็นผู้ป่วย",
    "true", "yes", "positive", "present", "affected", "confirmed",
    "diagnosed", "existing", "found", "detected",
    "1", "1.0", "T", "Y", "+", "✓", "v",
    "พบ", "ตรวจพบ", "ได้รับการวินิจฉัย", "มีการรักษา", "ระบุ",
    "มีโรคประจำตัว", "ป่วยเป็น", "เป็นโรคเรื้อรัง",
    "ความดันสูง", "เบาหวาน", "หัวใจ", "หอบหืด", "ตับ",
    "ไต", "ปอด", "เลือด", "ประสาท",
)
# False terms.
FALSE_VALUES = (
    "ไม่มี", "ไม่ใช่", "ไม่จริง", "ไม่ได้", "ไม่เป็น", "ไม่", "ไม่พบ",
    "ไม่มีอาการ", "ไม่มีประวัติ", "ไม่มีการสัมผัส", "ไม่เป็นโรค",
    "ไม่ป่วย", "สุขภาพดี", "ปกติ", "ไม่ได้รับการวินิจฉัย",
    "false", "no", "negative", "absent", "normal", "none", "nil",
    "not found", "not present", "not affected", "not confirmed",
    "not diagnosed", "healthy", "clear",
    "0", "0.0", "F", "N", "-", "✗", "x",
    "ไม่พบ", "ไม่ตรวจพบ", "ไม่มีโรคประจำตัว", "ไม่เป็นโรค",
    "ไม่มีอาการแสดง", "ไม่มีความผิดปกติ",
)
# Unknown terms (mapped to null).
NULL_VALUES = (
    "ไม่ระบุ", "ไม่ทราบ", "ไม่แน่ใจ", "ไม่ชัดเจน", "ไม่มีข้อมูล",
    "ไม่ได้บันทึก", "ไม่ปรากฏ", "รอตรวจสอบ", "อยู่ระหว่างตรวจ",
    "unknown", "unclear", "unspecified", "pending", "not recorded",
    "not available", "not applicable", "na", "n/a", "null", "none",
    "empty", "missing", "tbd", "to be determined",
    "", "-", "_", "?", "??", "...", "xxx", "n.a.",
)
# Phrase patterns (searched in the original text).
POSITIVE_PATTERNS = (
    r"(ป่วย|เป็น|มี).*(?:โรค|อาการ|ความดัน|เบาหวาน|หัวใจ)",
    r"(?:ได้รับ|มี).*(?:การวินิจฉัย|การรักษา|การดูแล)",
    r"(?:ระดับ|ค่า).*(?:สูง|ต่ำ|ผิดปกติ)",
    r"(?:ประวัติ|ได้รับ).*(?:การรักษา|การผ่าตัด)",
)
NEGATIVE_PATTERNS = (
    r"(?:ไม่|ไม่มี|ไม่เป็น|ไม่ป่วย).*(?:โรค|อาการ|ความดัน)",
    r"(?:สุขภาพ|ร่างกาย).*(?:ดี|ปกติ|แข็งแรง)",
    r"(?:ไม่ได้|ไม่มี).*(?:การรักษา|การดูแล|ประวัติ)",
)
# Extra terms by column (keyword in the column name -> true, false).
COLUMN_TERMS = (
    (("ความดันโลหิตสูง", "hypertension"),
     ("ความดันสูง", "bp สูง", "htn", "hypertensive"),
     ("ความดันปกติ", "bp ปกติ", "normotensive")),
    (("เบาหวาน", "diabetes"),
     ("dm", "diabetic", "น้ำตาลในเลือดสูง", "เบาหวานชนิดที่ 1", "เบาหวานชนิดที่ 2"),
     ("ไม่เป็นเบาหวาน", "น้ำตาลในเลือดปกติ", "non-diabetic")),
    (("หัวใจ", "cardiovascular", "cardiac"),
     ("โรคหัวใจ", "cardiac", "cvd", "หัวใจล้มเหลว", "heart failure"),
     ("หัวใจปกติ", "cardiac normal", "no cvd")),
    (("หอบหืด", "asthma"),
     ("asthmatic", "มีอาการหอบหืด", "ระบบทางเดินหายใจผิดปกติ"),
     ("ไม่หอบหืด", "ระบบทางเดินหายใจปกติ", "no asthma")),
    (("โรคตับ", "liver"),
     ("liver disease", "ตับแข็ง", "ตับอักเสบ", "hepatitis"),
     ("ตับปกติ", "liver normal", "no liver disease")),
)
# The live coercion of extracted booleans.
LIVE_TRUE = ("1", "มี", "true", "True")
LIVE_FALSE = ("0", "ไม่มี", "false", "False")


def column_terms(column_name: str):
    """(true terms, false terms) extended by the first matching column rule."""
    low = column_name.lower()
    for keys, extra_true, extra_false in COLUMN_TERMS:
        if any(k in column_name or k in low for k in keys):
            return TRUE_VALUES + extra_true, FALSE_VALUES + extra_false
    return TRUE_VALUES, FALSE_VALUES


def _unique(values, case_sensitive: bool):
    seen, out = set(), []
    for v in values:
        lv = v if case_sensitive else v.lower()
        if lv not in seen:
            seen.add(lv)
            out.append(lv)
    return out


def boolean_result(c, true_values=TRUE_VALUES, false_values=FALSE_VALUES,
                   null_values=NULL_VALUES, numeric_output: bool = True, case_sensitive: bool = False) -> Column:
    """STRUCT<value INT, is_valid BOOLEAN, error STRING, rule STRING>. With
    ``case_sensitive`` the terms match as they are written; the phrase patterns
    have their own rule."""
    raw = col_of(c).cast("string")
    tv, fv, nv = (_unique(values, case_sensitive) for values in (true_values, false_values, null_values))

    def body(s):
        v = s if case_sensitive else F.lower(s)
        first_num = F.regexp_extract(s, r"(\d+(?:\.\d+)?)", 1).try_cast("double")
        neg = F.lit(False)
        for p in NEGATIVE_PATTERNS:
            neg = neg | s.rlike(p)
        pos = F.lit(False)
        for p in POSITIVE_PATTERNS:
            pos = pos | s.rlike(p)
        rule = (F.when(s.isNull() | (s == ""), F.lit("blank"))
                .when(v.isin(*nv), F.lit("unknown"))
                .when(v.isin(*fv), F.lit("false_exact"))
                .when(v.isin(*tv), F.lit("true_exact"))
                .when(any_contained(v, fv, 2), F.lit("false_contains"))
                .when(any_contained(v, tv, 2), F.lit("true_contains"))
                .when(neg, F.lit("false_pattern"))
                .when(pos, F.lit("true_pattern"))
                .when(first_num == 0, F.lit("false_number"))
                .when(first_num == 1, F.lit("true_number"))
                .otherwise(F.lit("unmapped")))

        def out(rule):
            t, f = (F.lit(1), F.lit(0)) if numeric_output else (F.lit("True"), F.lit("False"))
            value = F.when(rule.startswith("true"), t).when(rule.startswith("false"), f)
            error = F.when(rule == "unmapped", F.lit("not_boolean"))
            return F.struct(value.alias("value"), error.isNull().alias("is_valid"), error.alias("error"),
                            rule.alias("rule"))
        return let(rule, out)
    return let(py_strip(raw), body)


def live_boolean(c) -> Column:
    """1 / 0 / null coercion used right after extraction."""
    s = col_of(c).cast("string")
    return F.when(s.isin(*LIVE_TRUE), F.lit(1)).when(s.isin(*LIVE_FALSE), F.lit(0)).otherwise(F.lit(None).cast("int"))
