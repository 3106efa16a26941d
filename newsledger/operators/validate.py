"""Spec-driven column validation.

A spec list says, per column, its type and rules. ``validate`` turns every
column into its typed clean value plus a result struct in ONE projection (no
per-column passes), and ``error_report`` / ``column_report`` turn the result
structs into a long error table and per-column counts.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import booleans, categories, dates, numbers, text, times
from ..functions.common import py_strip

INTEGER, FLOAT, DATE, TIME, BOOLEAN, MULTICLASS, TEXT = (
    "integer", "float", "date", "time", "boolean", "multiclass", "text")


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    data_type: str = TEXT
    value_range: tuple | None = None
    clamp: bool = False
    pattern: str | None = None
    vocabulary: tuple | None = None
    max_length: int | None = None
    default: str | None = None
    required: bool = False
    encoding: str | None = None        # of a text; what is not valid in it is removed
    case_sensitive: bool = False       # of a vocabulary or of yes/no terms


def _vocab_text(values):
    return tuple(values)


# The 39-column output form, in order, with each column's type and rules.
HEAT_TRUE_TERMS = ("มี", "1", "True", "true", "YES", "Yes", "yes", "ใช่", "มีการสัมผัส")
HEAT_FALSE_TERMS = ("ไม่มี", "0", "False", "false", "NO", "No", "no", "ไม่ใช่", "ไม่มีการสัมผัส")
HEAT_SPECS = (
    ColumnSpec("ที่", FLOAT, (1, 99999)),
    ColumnSpec("จังหวัดที่เกิดเหตุ", MULTICLASS, vocabulary=categories.PROVINCES),
    ColumnSpec("อำเภอ", TEXT, max_length=100),
    ColumnSpec("ตำบล", TEXT, max_length=100),
    ColumnSpec("ภาค", MULTICLASS, vocabulary=categories.REGIONS[:5]),
    ColumnSpec("สคร.", TEXT, max_length=50, pattern=r"^สคร\.\s*\d{1,2}$"),
    ColumnSpec("ปี", INTEGER, (2020, 2030)),
    ColumnSpec("สถานะ", MULTICLASS, vocabulary=("เสียชีวิต", "รอดชีวิต", "ไม่ระบุ"), default="เสียชีวิต"),
    ColumnSpec("ว/ด/ป เสียชีวิต", DATE, pattern=r"\d{1,2}/\d{1,2}/\d{4}"),
    ColumnSpec("เดือน ที่เสียชีวิต", MULTICLASS, vocabulary=categories.MONTHS),
    ColumnSpec("เวลาที่เสียชีวิต", TIME, pattern=r"^([0-1]?[0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9])?$"),
    ColumnSpec("เพศ", MULTICLASS, vocabulary=categories.GENDERS),
    ColumnSpec("อายุ(ปี)", INTEGER, (0, 120), clamp=True),
    ColumnSpec("เชื้อชาติ", TEXT, max_length=50),
    ColumnSpec("สัญชาติ", TEXT, max_length=50),
    ColumnSpec("อาชีพ", TEXT, max_length=100),
    ColumnSpec("ลักษณะงาน", TEXT, max_length=200),
    ColumnSpec("โรคประจำตัว", TEXT, max_length=200),
    ColumnSpec("โรคประจำตัว(รายละเอียด)", TEXT, max_length=500),
    ColumnSpec("ความดันโลหิตสูง", BOOLEAN),
    ColumnSpec("เบาหวาน", BOOLEAN),
    ColumnSpec("หัวใจและหลอดเลือด", BOOLEAN),
    ColumnSpec("หอบหืด", BOOLEAN),
    ColumnSpec("โรคตับ", BOOLEAN),
    ColumnSpec("โรคอื่นๆ", TEXT, max_length=200),
    ColumnSpec("พฤติกรรมเสี่ยง", TEXT, max_length=300),
    ColumnSpec("สถานที่ป่วย/หรือเสียชีวิต", TEXT, max_length=200),
    ColumnSpec("ลักษณะพื้นที่", TEXT, max_length=300),
    ColumnSpec("อุณหภูมิ สวล.(C°)", FLOAT, (-10.0, 60.0)),
    ColumnSpec("ลักษณะอาการ", TEXT, max_length=300),
    ColumnSpec("กิจกรรม/พฤติกรรมเสี่ยงก่อนเกิดเหตุ", TEXT, max_length=400),
    ColumnSpec("อุณหภูมิร่างกาย(C°)", FLOAT, (30.0, 45.0)),
    ColumnSpec("ประวัติการสัมผัสความร้อนก่อนเสียชีวิต", BOOLEAN),
    ColumnSpec("ICD 10", TEXT, max_length=20, pattern=r"^[A-Z]\d{2}(\.\d{1,2})?$"),
    ColumnSpec("ผลการวินิจฉัย", TEXT, max_length=300),
    ColumnSpec("Unnamed: 35", TEXT, max_length=200),
    ColumnSpec("ข้อมูลอื่นๆ", TEXT, max_length=500),
    ColumnSpec("หมายเหตุ", TEXT, max_length=500),
    ColumnSpec("ที่มาสื่อออนไลน์", TEXT, max_length=300),
)
HEAT_SPECS = tuple(replace(x, encoding="utf-8") if x.data_type == TEXT else x for x in HEAT_SPECS)
HEAT_COLUMNS = tuple(s.name for s in HEAT_SPECS)
SPARK_TYPES = {INTEGER: "bigint", FLOAT: "double", DATE: "date", TIME: "string", BOOLEAN: "int",
               MULTICLASS: "string", TEXT: "string"}
_TYPES = {INTEGER: T.LongType(), FLOAT: T.DoubleType(), DATE: T.DateType(), TIME: T.StringType(), BOOLEAN: T.IntegerType(),
          MULTICLASS: T.StringType(), TEXT: T.StringType()}


def vocabulary_of(spec: ColumnSpec) -> categories.Vocabulary:
    """The vocabulary of a multiclass column."""
    kw = {"case_sensitive": spec.case_sensitive}
    if spec.vocabulary is not None:
        kw["terms"] = tuple(spec.vocabulary)
    if spec.default is not None:
        kw["default"] = spec.default
    return categories.vocabulary_for(spec.name, **kw)


def result_expr(spec: ColumnSpec, c, as_of=None, normalize_unicode: bool = True):
    """Result struct (value, is_valid, error, ...) for one column."""
    rng = spec.value_range
    if spec.data_type == INTEGER:
        return numbers.integer_result(c, numbers.NumberRange(*(rng or (None, None)), clamp=spec.clamp))
    if spec.data_type == FLOAT:
        return numbers.float_result(c, numbers.NumberRange(*(rng or (None, None)), clamp=spec.clamp))
    if spec.data_type == DATE:
        lo, hi = rng or (2020, 2030)
        return dates.date_result(c, lo, hi, as_of=as_of)
    if spec.data_type == TIME:
        return times.time_result(c)
    if spec.data_type == BOOLEAN:
        tv, fv = booleans.column_terms(spec.name)
        return booleans.boolean_result(c, tv + HEAT_TRUE_TERMS, fv + HEAT_FALSE_TERMS, case_sensitive=spec.case_sensitive)
    if spec.data_type == MULTICLASS:
        # one expression, so without the fuzzy stage, which is an operator: validate runs it
        return categories.category_result(c, vocabulary_of(spec))
    if spec.encoding:
        if spec.encoding.lower() not in ("utf-8", "utf8"):
            raise ValueError(f"{spec.name}: strings are UTF-8; read other encodings with the contract readers")
        c = text.utf8_result(c)["value"]
    prof = text.profile_for(spec.name, normalize_unicode=normalize_unicode,
                            **({"max_length": spec.max_length} if spec.max_length else {}))
    res = text.text_result(c, prof)
    if spec.pattern:
        bad = res["value"].isNotNull() & ~res["value"].rlike(spec.pattern)
        res = F.struct(F.when(bad, F.lit(None)).otherwise(res["value"]).alias("value"),
                       (res["is_valid"] & ~bad).alias("is_valid"),
                       F.when(bad, F.lit("pattern")).otherwise(res["error"]).alias("error"))
    return res


def validate(df: DataFrame, specs, keep=(), as_of=None, normalize_unicode: bool = True, strict_patterns: bool = False) -> DataFrame:
    """``keep`` columns, each spec column's clean value, and an ``_cells``
    array of (column, raw, error, is_valid, is_null) per spec column. Texts must
    have their spec's pattern when clean. The patterns of dates and times describe
    one way of writing what the parsers take in many; with ``strict_patterns`` the
    raw text must be written that way (error ``pattern``).
    Numbers and dates are parsed in stages (operators.columns); the other
    types are single expressions; the output is one final projection."""
    from . import columns as staged_ops
    specs = [s for s in specs if s.name in df.columns]
    staged = df.select(*[F.col(f"`{k}`") for k in keep],
                       *[F.col(f"`{s.name}`").cast("string").alias(f"_raw{i}") for i, s in enumerate(specs)])
    for i, s in enumerate(specs):
        raw = F.col(f"_raw{i}")
        rng = s.value_range
        if s.data_type == INTEGER:
            staged = staged_ops.with_integer(staged, raw, f"_res{i}",
                                             numbers.NumberRange(*(rng or (None, None)), clamp=s.clamp))
        elif s.data_type == FLOAT:
            staged = staged_ops.with_float(staged, raw, f"_res{i}",
                                           numbers.NumberRange(*(rng or (None, None)), clamp=s.clamp))
        elif s.data_type == DATE:
            lo, hi = rng or (2020, 2030)
            staged = staged_ops.with_date(staged, raw, f"_res{i}", lo, hi, as_of=as_of)
        elif s.data_type == MULTICLASS:
            from .categorical import with_category
            staged = with_category(staged, f"_raw{i}", vocabulary_of(s), f"_res{i}")
        else:
            staged = staged.withColumn(f"_res{i}", result_expr(s, raw, as_of, normalize_unicode))
    def error_of(i: int, s: ColumnSpec):
        error = F.col(f"_res{i}.error")
        if strict_patterns and s.pattern and s.data_type in (DATE, TIME):
            written = py_strip(F.col(f"_raw{i}"))
            error = F.coalesce(error, F.when((written != "") & ~written.rlike(s.pattern), F.lit("pattern")))
        missing = error.isNull() & F.col(f"_res{i}.value").isNull()
        return F.when(missing, F.lit("required")).otherwise(error) if s.required else error

    errors = F.array(*[F.struct(F.lit(s.name).alias("column"), F.col(f"_raw{i}").alias("raw"),
                                error_of(i, s).alias("error"),
                                (F.col(f"_res{i}.is_valid") & error_of(i, s).isNull()).alias("is_valid"),
                                F.col(f"_res{i}.value").isNull().alias("is_null"))
                       for i, s in enumerate(specs)]) if specs else F.array()
    return staged.select(
        *[F.col(f"`{k}`") for k in keep],
        *[(F.when(F.coalesce(error_of(i, s) != "pattern", F.lit(True)), F.col(f"_res{i}.value")) if strict_patterns else F.col(f"_res{i}.value"))
          .cast(SPARK_TYPES[s.data_type]).alias(s.name) for i, s in enumerate(specs)],
        errors.alias("_cells", metadata={"n_cells": len(specs)}),
    )


def error_report(validated: DataFrame, keep=(), materialize: bool = True) -> DataFrame:
    """Long form: one row per failing cell (kept columns, column, raw, error).

    The validated rows are materialised first (a reliable checkpoint in the
    shared checkpoint folder, or pass a DataFrame read from the written
    table with ``materialize=False``): exploding the cells directly over the
    cleaning projection makes the optimizer re-plan every cleaning
    expression under the generator."""
    if materialize:
        from ..session import ensure_checkpoint_dir
        ensure_checkpoint_dir(validated.sparkSession)
        validated = validated.select(*[F.col(f"`{k}`") for k in keep], "_cells").checkpoint(eager=True)
    cells = validated.select(*[F.col(f"`{k}`") for k in keep], F.explode("_cells").alias("c"))
    return cells.filter(~F.col("c.is_valid")).select(
        *[F.col(f"`{k}`") for k in keep], F.col("c.column").alias("column"),
        F.col("c.raw").alias("raw"), F.col("c.error").alias("error"))


def column_report(validated: DataFrame) -> DataFrame:
    """Per column: valid, invalid and null counts. One aggregate over the
    table (partial aggregation on every partition), then the single result
    row is unpivoted - the data itself is never exploded."""
    cells = F.col("_cells")
    k = _cell_count(validated)
    aggs = []
    for i in range(k):
        c = cells[i]
        aggs += [F.first(c["column"], ignorenulls=True).alias(f"c{i}"),
                 F.sum(F.when(c["is_valid"] & ~c["is_null"], 1).otherwise(0)).cast("long").alias(f"v{i}"),
                 F.sum(F.when(~c["is_valid"], 1).otherwise(0)).cast("long").alias(f"i{i}"),
                 F.sum(F.when(c["is_valid"] & c["is_null"], 1).otherwise(0)).cast("long").alias(f"n{i}")]
    one = validated.agg(*aggs)
    rows = F.array(*[F.struct(F.col(f"c{i}").alias("column"), F.col(f"v{i}").alias("n_valid"),
                              F.col(f"i{i}").alias("n_invalid"), F.col(f"n{i}").alias("n_null"))
                     for i in range(k)])
    return one.select(F.inline(rows)).filter(F.col("column").isNotNull())


def _cell_count(validated: DataFrame) -> int:
    """Number of validated columns (from the schema, no data read)."""
    meta = validated.schema["_cells"].metadata
    return int(meta.get("n_cells", 0))


def conform(df: DataFrame, specs=HEAT_SPECS) -> DataFrame:
    """Select the spec columns in order; absent and null ones take their
    default value (null without one)."""
    cols = []
    for s in specs:
        if s.name in df.columns:
            given = F.col(f"`{s.name}`").cast(SPARK_TYPES[s.data_type])
            cols.append((given if s.default is None else F.coalesce(given, F.lit(s.default).cast(SPARK_TYPES[s.data_type]))).alias(s.name))
        else:
            cols.append(F.lit(s.default).cast(SPARK_TYPES[s.data_type]).alias(s.name))
    return df.select(*cols)


def column_order_report(columns, specs=HEAT_SPECS) -> list[dict]:
    """Driver-side check of a column list against the spec order (the list
    is metadata, not data): count, position mismatches, missing, extra."""
    expected = [s.name for s in specs]
    issues = []
    if len(columns) != len(expected):
        issues.append({"issue": "count", "detail": f"{len(columns)} != {len(expected)}"})
    for i, (got, want) in enumerate(zip(columns, expected)):
        if got != want:
            issues.append({"issue": "position", "detail": f"{i}: {got} != {want}"})
    for m in [c for c in expected if c not in columns]:
        issues.append({"issue": "missing", "detail": m})
    for x in [c for c in columns if c not in expected]:
        issues.append({"issue": "extra", "detail": x})
    return issues


def columns_by_type(specs=HEAT_SPECS) -> dict:
    out: dict = {}
    for s in specs:
        out.setdefault(s.data_type, []).append(s.name)
    return out


def required_columns(specs=HEAT_SPECS) -> list[str]:
    return [s.name for s in specs if s.required]


def output_schema(specs=HEAT_SPECS) -> T.StructType:
    """Spark types of the spec columns, in order; required ones are not nullable."""
    return T.StructType([T.StructField(s.name, _TYPES[s.data_type], not s.required)
                         for s in specs])


def strip_all(df: DataFrame) -> DataFrame:
    return df.select(*[py_strip(F.col(f"`{c}`")).alias(c) for c in df.columns])
