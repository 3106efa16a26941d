"""Controlled-vocabulary cleaning.

Cascade per value: blank -> default; synonym (on the cleaned value) ->
exact (case-insensitive) -> [fuzzy, an operator: see operators.categorical]
-> partial containment -> default (or an error in strict mode).
Vocabularies are small fixed lists, so every stage is an expression over
array/map literals: no join, no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WS_U, col_of, collapse_ws, is_blank, let, py_strip, str_array

# Provinces.
PROVINCES = (
    "กรุงเทพฯ", "กรุงเทพมหานคร", "กระบี่", "กาญจนบุรี", "กาฬสินธุ์", "กำแพงเพชร",
    "ขอนแก่น", "จันทบุรี", "ฉะเชิงเทรา", "ชลบุรี", "ชัยนาท", "ชัยภูมิ", "ชุมพร",
    "เชียงราย", "เชียงใหม่", "ตรัง", "ตราด", "ตาก", "นครนายก", "นครปฐม", "นครพนม",
    "นครราชสีมา", "นครศรีธรรมราช", "นครสวรรค์", "นนทบุรี", "นราธิวาส", "น่าน",
    "บึงกาฬ", "บุรีรัมย์", "ปทุมธานี", "ประจวบคีรีขันธ์", "ปราจีนบุรี", "ปัตตานี",
    "พระนครศรีอยุธยา", "พะเยา", "พังงา", "พัทลุง", "พิจิตร", "พิษณุโลก", "เพชรบุรี",
    "เพชรบูรณ์", "แพร่", "ภูเก็ต", "มหาสารคาม", "มุกดาหาร", "แม่ฮ่องสอน", "ยะลา",
    "ยโสธร", "ร้อยเอ็ด", "ระนอง", "ระยอง", "ราชบุรี", "ลพบุรี", "ลำปาง", "ลำพูน",
    "เลย", "ศรีสะเกษ", "สกลนคร", "สงขลา", "สตูล", "สมุทรปราการ", "สมุทรสงคราม",
    "สมุทรสาคร", "สระแก้ว", "สระบุรี", "สิงห์บุรี", "สุโขทัย", "สุพรรณบุรี", "สุราษฎร์ธานี",
    "สุรินทร์", "หนองคาย", "หนองบัวลำภู", "อ่างทอง", "อำนาจเจริญ", "อุดรธานี",
    "อุตรดิตถ์", "อุทัยธานี", "อุบลราชธานี",
)
# Regions, genders, statuses, months, occupations.
REGIONS = ("ภาคเหนือ", "ภาคกลางและตะวันตก", "ภาคตะวันออกเฉียงเหนือ",
           "ภาคตะวันออก", "ภาคใต้", "ภาคกลาง", "ภาคตะวันตก")
GENDERS = ("ชาย", "หญิง", "ไม่ระบุ")
STATUSES = ("เสียชีวิต", "รอดชีวิต", "ไม่ระบุ", "รักษาอยู่")
MONTHS = ("มกราคม", "กุมภาพันธ์", "มีนาคม", "เมษายน", "พฤษภาคม", "มิถุนายน",
          "กรกฎาคม", "สิงหาคม", "กันยายน", "ตุลาคม", "พฤศจิกายน", "ธันวาคม")
OCCUPATIONS = (
    "เกษตรกร", "รับจ้าง", "พนักงานบริษัท", "ข้าราชการ", "ค้าขาย", "แม่บ้าน",
    "นักเรียน", "นักศึกษา", "พนักงานร้านอาหาร", "ช่างซ่อม", "คนขับรถ",
    "แรงงาน", "ผู้ประกอบการ", "วิศวกร", "ครู", "แพทย์", "พยาบาล",
    "ไม่ระบุ", "เร่ร่อน", "ว่างงาน", "เกษียณอายุ",
)
# Synonyms.
PROVINCE_SYNONYMS = (
    ("กรุงเทพ", "กรุงเทพฯ"), ("กรุงเทพมหานคร", "กรุงเทพฯ"), ("bangkok", "กรุงเทพฯ"),
    ("bkk", "กรุงเทพฯ"), ("chonburi", "ชลบุรี"), ("chiangmai", "เชียงใหม่"),
    ("chiang mai", "เชียงใหม่"), ("phuket", "ภูเก็ต"), ("khon kaen", "ขอนแก่น"),
    ("korat", "นครราชสีมา"), ("nakhon ratchasima", "นครราชสีมา"),
    ("ubon ratchathani", "อุบลราชธานี"), ("ubon", "อุบลราชธานี"),
    ("udon thani", "อุดรธานี"), ("udon", "อุดรธานี"),
)
REGION_SYNONYMS = (
    ("เหนือ", "ภาคเหนือ"), ("ใต้", "ภาคใต้"), ("อีสาน", "ภาคตะวันออกเฉียงเหนือ"),
    ("ตะวันออกเฉียงเหนือ", "ภาคตะวันออกเฉียงเหนือ"), ("กลาง", "ภาคกลางและตะวันตก"),
    ("ตะวันตก", "ภาคกลางและตะวันตก"), ("ตะวันออก", "ภาคตะวันออก"),
)
GENDER_SYNONYMS = (
    ("male", "ชาย"), ("female", "หญิง"), ("man", "ชาย"), ("woman", "หญิง"),
    ("m", "ชาย"), ("f", "หญิง"), ("ผู้ชาย", "ชาย"), ("ผู้หญิง", "หญิง"),
    ("unknown", "ไม่ระบุ"), ("n/a", "ไม่ระบุ"), ("not specified", "ไม่ระบุ"),
)
STATUS_SYNONYMS = (
    ("dead", "เสียชีวิต"), ("died", "เสียชีวิต"), ("deceased", "เสียชีวิต"),
    ("death", "เสียชีวิต"), ("alive", "รอดชีวิต"), ("survived", "รอดชีวิต"),
    ("living", "รอดชีวิต"), ("unknown", "ไม่ระบุ"),
)
DEFAULT_VALUE = "ไม่ระบุ"
# Administrative prefixes removed before matching.
PROVINCE_PREFIX = rf"(?U)^(จ\.|จังหวัด){WS_U}*"
DISTRICT_PREFIX = rf"(?U)^(อ\.|อำเภอ){WS_U}*"
SUBDISTRICT_PREFIX = rf"(?U)^(ต\.|ตำบล){WS_U}*"

FUZZY_CUTOFF = 0.6
PARTIAL_MIN_CHARS = 3
PARTIAL_MIN_SCORE = 0.3


@dataclass(frozen=True)
class Vocabulary:
    terms: tuple
    synonyms: tuple = ()
    prefixes: tuple = ()
    default: str | None = DEFAULT_VALUE
    strict: bool = False
    fuzzy: bool = True
    partial: bool = True
    cutoff: float = FUZZY_CUTOFF
    case_sensitive: bool = False
    extra_terms: tuple = field(default_factory=tuple)

    def fold(self, x):
        """A text or column as it is compared."""
        return x if self.case_sensitive else F.lower(x) if isinstance(x, Column) else x.lower()

    @property
    def sorted_terms(self) -> list:
        return sorted(self.all_terms)

    @property
    def all_terms(self) -> tuple:
        seen, out = set(), []
        for t in self.terms + self.extra_terms:
            if t not in seen:
                seen.add(t)
                out.append(t)
        return tuple(out)


def vocabulary_for(column_name: str, **overrides) -> Vocabulary:
    """Vocabulary chosen by column name (first matching rule)."""
    low = column_name.lower()
    prefixes = tuple(p for key, p in (("จังหวัด", PROVINCE_PREFIX), ("อำเภอ", DISTRICT_PREFIX),
                                      ("ตำบล", SUBDISTRICT_PREFIX)) if key in column_name)
    if "จังหวัด" in column_name:
        v = Vocabulary(PROVINCES, PROVINCE_SYNONYMS, prefixes)
    elif "ภาค" in column_name:
        v = Vocabulary(REGIONS, REGION_SYNONYMS, prefixes)
    elif "เพศ" in column_name or "gender" in low:
        v = Vocabulary(GENDERS, GENDER_SYNONYMS, prefixes)
    elif "สถานะ" in column_name or "status" in low:
        v = Vocabulary(STATUSES, STATUS_SYNONYMS, prefixes)
    elif "เดือน" in column_name or "month" in low:
        v = Vocabulary(MONTHS, (), prefixes)
    elif "อาชีพ" in column_name or "occupation" in low:
        v = Vocabulary(OCCUPATIONS, (), prefixes)
    else:
        v = Vocabulary((), (), prefixes)
    if overrides:
        v = Vocabulary(**{**v.__dict__, **overrides})
    return v


def clean_value(c, vocab: Vocabulary) -> Column:
    s = py_strip(col_of(c))
    for p in vocab.prefixes:
        s = F.regexp_replace(s, p, "")
    return collapse_ws(s)


def _first_wins_map(pairs) -> Column:
    seen, flat = set(), []
    for k, v in pairs:
        if k not in seen:
            seen.add(k)
            flat += [F.lit(k), F.lit(v)]
    if not flat:
        return F.create_map().cast("map<string,string>")
    return F.create_map(*flat)


def synonym_match(cleaned: Column, vocab: Vocabulary) -> Column:
    terms = set(vocab.all_terms)
    pairs = [(vocab.fold(k), v) for k, v in vocab.synonyms if v in terms]
    k = vocab.fold(cleaned)
    return F.when(k.isNotNull(), F.element_at(_first_wins_map(pairs), k)) if pairs else F.lit(None).cast("string")


def exact_match(value: Column, vocab: Vocabulary) -> Column:
    pairs = [(vocab.fold(t), t) for t in vocab.all_terms]
    k = vocab.fold(value)
    return F.when(k.isNotNull(), F.element_at(_first_wins_map(pairs), k)) if pairs else F.lit(None).cast("string")


def partial_match(cleaned: Column, vocab: Vocabulary) -> Column:
    """Best containment match (either direction); score = shorter/longer
    length, must exceed 0.3; ties go to the smaller term."""
    if not vocab.all_terms:
        return F.lit(None).cast("string")
    cv = vocab.fold(cleaned)
    n = F.length(cv)
    scored = F.transform(
        str_array(vocab.all_terms),
        lambda t: F.struct(
            (-F.when(F.contains(vocab.fold(t), cv), n / F.length(t))
             .when(F.contains(cv, vocab.fold(t)), F.length(t) / n)
             .otherwise(F.lit(0.0))).alias("neg_score"),
            t.alias("term")),
    )
    best = F.array_min(F.filter(scored, lambda x: x["neg_score"] < -PARTIAL_MIN_SCORE))
    return F.when(n >= PARTIAL_MIN_CHARS, best["term"])


def category_result(c, vocab: Vocabulary, fuzzy_col: Column | None = None) -> Column:
    """STRUCT<value STRING, is_valid BOOLEAN, error STRING, match_kind STRING>.

    ``fuzzy_col`` carries the fuzzy stage's answer when the caller computed it
    (see ``operators.categorical.with_category``)."""
    raw = col_of(c).cast("string")

    def body(vals):
        stripped, cleaned = vals["stripped"], vals["cleaned"]
        stages = [("synonym", synonym_match(cleaned, vocab)), ("exact", exact_match(stripped, vocab))]
        if fuzzy_col is not None and vocab.fuzzy:
            stages.append(("fuzzy", fuzzy_col))
        if vocab.partial:
            stages.append(("partial", partial_match(cleaned, vocab)))
        found = F.lit(None)
        for name, expr in reversed(stages):
            found = F.when(expr.isNotNull(), F.struct(expr.alias("v"), F.lit(name).alias("k"))).otherwise(found)

        def out(hit):
            blank = stripped == ""
            matched = hit.isNotNull()
            default = F.lit(vocab.default).cast("string")
            out_value = F.when(blank, default).when(matched, hit["v"]).otherwise(
                F.lit(None).cast("string") if vocab.strict else default)
            out_kind = F.when(blank, F.lit("blank")).when(matched, hit["k"]).otherwise(F.lit("none"))
            error = F.when(~blank & ~matched & F.lit(vocab.strict), F.lit("not_in_vocabulary"))
            return F.struct(out_value.alias("value"), error.isNull().alias("is_valid"), error.alias("error"),
                            out_kind.alias("match_kind"))
        return let(found, out)
    vals = F.struct(F.coalesce(py_strip(raw), F.lit("")).alias("stripped"),
                    F.coalesce(clean_value(raw, vocab), F.lit("")).alias("cleaned"))
    return let(vals, body)


def close_match(value: str, terms, cutoff: float, case_sensitive: bool = False) -> str | None:
    """Best ratio >= cutoff (ties: the larger term); retried lower-cased
    unless case matters."""
    return _close_match_fn(case_sensitive)(value, tuple(terms), cutoff)


def _close_match_fn(case_sensitive: bool = False):
    # Built inside a function so the UDF ships it by value (executors need
    # only the standard library, not this package).
    import difflib as _difflib

    def close(value, terms, cutoff):
        if not value:
            return None
        got = _difflib.get_close_matches(value, list(terms), n=1, cutoff=cutoff)
        if got or case_sensitive:
            return got[0] if got else None
        lowered = [t.lower() for t in terms]
        got = _difflib.get_close_matches(value.lower(), lowered, n=1, cutoff=cutoff)
        if got:
            return terms[lowered.index(got[0])]
        return None
    return close


def fuzzy_udf(vocab: Vocabulary):
    """Vectorised helper: best fuzzy term per value (the vocabulary is a list in
    the code or config and is shipped with the function; a vocabulary that is a
    table is matched by ``operators.categorical.with_vocabulary_table``)."""
    terms = tuple(vocab.all_terms)
    cutoff = vocab.cutoff
    close = _close_match_fn(vocab.case_sensitive)

    @F.pandas_udf(T.StringType())
    def best(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else close(v, terms, cutoff))

    return best


# Age-group labels for 0-12, 13-19, 20-35, 36-59, 60 and over.
AGE_GROUPS = ((12, "เด็ก"), (19, "วัยรุ่น"), (35, "ผู้ใหญ่วัยหนุ่มสาว"), (59, "ผู้ใหญ่วัยกลางคน"))
ELDER_LABEL = "ผู้สูงอายุ"


def age_group(age) -> Column:
    a = col_of(age)
    out = F.when(a.isNull() | (a < 0), F.lit(None).cast("string"))
    for upper, label in AGE_GROUPS:
        out = out.when(a <= upper, F.lit(label))
    return out.otherwise(F.lit(ELDER_LABEL))


# Allowed death causes.
DEATH_CAUSES = ("ช็อก", "ขาดน้ำ", "อากาศร้อน", "ลมแดด", "ฮีทสโตรก", "โรคประจำตัว",
                "ลมชัก", "หัวใจล้มเหลว", "หัวใจวาย", "ดื่มเหล้า", "โรคชรา", "โควิด-19")


def split_multi(c) -> Column:
    """Comma-separated list -> ARRAY<STRING> of stripped, non-empty items."""
    items = F.transform(F.split(col_of(c), ","), lambda x: py_strip(x))
    return F.filter(items, lambda x: x != "")


def multi_category_result(c, allowed) -> Column:
    """STRUCT<items ARRAY<STRING>, invalid ARRAY<STRING>, is_valid BOOLEAN>."""
    items = split_multi(c)
    invalid = F.filter(items, lambda x: ~F.array_contains(str_array(allowed), x))
    return F.struct(items.alias("items"), invalid.alias("invalid"),
                    (F.coalesce(F.size(invalid), F.lit(0)) == 0).alias("is_valid"))
