"""Integer and float cleaning.

A value is parsed only when it has the shape of a decimal number (so Spark's
looser casts - '1.0d', 'nan', 'Infinity' - never leak through), then range
checked and optionally clamped. Thai digits count as digits.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import col_of, is_blank, let, py_strip, thai_digits_to_ascii

NUMBER_SHAPE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

# Thai number words one..ten in order with their values, and the
# English words that only flag a value as containing a number word.
THAI_NUMBER_WORDS = (("หนึ่ง", 1), ("สอง", 2), ("สาม", 3), ("สี่", 4), ("ห้า", 5),
                     ("หก", 6), ("เจ็ด", 7), ("แปด", 8), ("เก้า", 9), ("สิบ", 10))
ENGLISH_NUMBER_WORDS = ("one", "two", "three", "four", "five")

# Unit marks removed from float input, in order.
FLOAT_UNITS = ("°C", "°F", "C°", "F°", "องศา", "เซลเซียส", "ฟาเรนไฮต์", "度")


@dataclass(frozen=True)
class NumberRange:
    min_value: float | None = None
    max_value: float | None = None
    clamp: bool = False


# Ranges by column role.
AGE_RANGE = NumberRange(0, 120, clamp=True)
YEAR_RANGE = NumberRange(2020, 2030)
ID_RANGE = NumberRange(1, 99999)
ENV_TEMP_RANGE = NumberRange(-10.0, 60.0)
BODY_TEMP_RANGE = NumberRange(30.0, 45.0)


def _range_checks(x: Column, rng: NumberRange):
    ok = F.lit(True)
    if rng.min_value is not None:
        ok = ok & (x >= F.lit(rng.min_value))
    if rng.max_value is not None:
        ok = ok & (x <= F.lit(rng.max_value))
    clamped = x
    if rng.min_value is not None:
        clamped = F.greatest(clamped, F.lit(float(rng.min_value)))
    if rng.max_value is not None:
        clamped = F.least(clamped, F.lit(float(rng.max_value)))
    return ok, clamped


def number_word_text(s: Column) -> Column:
    """If the text holds a number word: first digit run, else the value of the
    first Thai word in the fixed order, else the text itself. Plain numbers
    skip the word search (a cheap guard), the rest binds the text once."""
    def body(s):
        has_word = F.lit(False)
        for w, _ in THAI_NUMBER_WORDS:
            has_word = has_word | F.contains(s, F.lit(w))
        low = F.lower(s)
        for w in ENGLISH_NUMBER_WORDS:
            has_word = has_word | F.contains(low, F.lit(w))
        thai_value = F.lit(None).cast("string")
        for w, v in reversed(THAI_NUMBER_WORDS):
            thai_value = F.when(F.contains(s, F.lit(w)), F.lit(str(v))).otherwise(thai_value)
        digits = F.regexp_extract(s, r"(\d+)", 1)
        extracted = F.when(digits != "", digits).otherwise(F.coalesce(thai_value, s))
        return F.when(has_word, extracted).otherwise(s)
    return F.when(s.rlike(r"[^0-9\s.,+\-eE]"), let(s, body)).otherwise(s)


def _parse_double(s: Column) -> Column:
    return F.when(s.rlike(NUMBER_SHAPE), s.try_cast("double"))


def integer_result(c, rng: NumberRange = NumberRange(), words: bool = True) -> Column:
    """STRUCT<value BIGINT, is_valid BOOLEAN, error STRING>.

    '41.0' and '41.9' give 41 (truncation toward zero). Plain expressions:
    the repeated parts are shared by Spark's subexpression elimination."""
    raw = col_of(c).cast("string")
    s = thai_digits_to_ascii(py_strip(raw))
    if words:
        s = number_word_text(s)
    d = _parse_double(s)
    v = F.when(F.abs(d) < F.lit(9.2e18), d).cast("long")  # truncates toward zero
    ok_range, clamped = _range_checks(v.cast("double"), rng)
    blank = is_blank(raw)
    error = (F.when(blank, F.lit(None))
             .when(v.isNull(), F.lit("not_integer"))
             .when(~ok_range & F.lit(not rng.clamp), F.lit("out_of_range")))
    value = F.when(blank | error.isNotNull(), F.lit(None).cast("long")) \
        .otherwise(clamped.cast("long") if rng.clamp else v)
    return F.struct(value.alias("value"), error.isNull().alias("is_valid"), error.alias("error"))


def clean_float_text(c: Column) -> Column:
    s = py_strip(c)
    for u in FLOAT_UNITS:
        s = F.replace(s, F.lit(u), F.lit(""))
    return F.replace(py_strip(s), F.lit(","), F.lit("."))


def round_half_even(x: Column, places: int) -> Column:
    """Half-even rounding on the shortest decimal form of the double. Doubles
    too large for it have no fraction and stay as they are."""
    small = F.when(F.abs(x) < 1e15, x)
    return F.coalesce(F.bround(small.cast("decimal(38,12)"), places).cast("double"), x)


def parsed_number(c) -> Column:
    """The number a text spells (unit and digits handled), unrounded, or null."""
    return _parse_double(thai_digits_to_ascii(clean_float_text(col_of(c).cast("string"))))


def float_result(c, rng: NumberRange = NumberRange(), places: int = 1) -> Column:
    """STRUCT<value DOUBLE, is_valid BOOLEAN, error STRING>; value rounded to
    ``places`` decimals (half-even)."""
    raw = col_of(c).cast("string")
    d = _parse_double(thai_digits_to_ascii(clean_float_text(raw)))
    ok_range, clamped = _range_checks(d, rng)
    blank = is_blank(raw)
    error = (F.when(blank, F.lit(None))
             .when(d.isNull(), F.lit("not_float"))
             .when(~ok_range & F.lit(not rng.clamp), F.lit("out_of_range")))
    v = clamped if rng.clamp else d
    value = F.when(blank | error.isNotNull(), F.lit(None).cast("double")).otherwise(round_half_even(v, places))
    return F.struct(value.alias("value"), error.isNull().alias("is_valid"), error.alias("error"))


def outlier_flag(c, kind: str = "generic", rng: NumberRange = NumberRange()) -> Column:
    """Outlier test on the raw parsed value: environment <-20/>70, body <25/>50,
    otherwise 10% of the range beyond either end."""
    d = _parse_double(thai_digits_to_ascii(clean_float_text(col_of(c).cast("string"))))
    if kind == "environment":
        return (d < -20) | (d > 70)
    if kind == "body":
        return (d < 25) | (d > 50)
    if rng.min_value is None or rng.max_value is None:
        return F.lit(False)
    margin = (rng.max_value - rng.min_value) * 0.1
    return (d < rng.min_value - margin) | (d > rng.max_value + margin)
