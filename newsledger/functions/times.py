"""Time of day: HH:MM[:SS] or HH.MM anywhere in the text -> 'HH:MM:SS'."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import col_of, is_blank, py_strip, thai_digits_to_ascii

COLON_TIME = r"(\d{1,2}):(\d{2})(?::(\d{2}))?"
DOT_TIME = r"(\d{1,2})\.(\d{2})"


def _candidate(s: Column, pattern: str, with_seconds: bool) -> Column:
    found = F.regexp_extract(s, pattern, 0) != ""
    h = F.regexp_extract(s, pattern, 1).try_cast("int")
    m = F.regexp_extract(s, pattern, 2).try_cast("int")
    sec = F.lit(0)
    if with_seconds:
        g = F.regexp_extract(s, pattern, 3)
        sec = F.when(g == "", F.lit(0)).otherwise(g.try_cast("int"))
    ok = found & h.between(0, 23) & m.between(0, 59) & sec.between(0, 59)
    return F.when(ok, F.format_string("%02d:%02d:%02d", h, m, sec))


def parse_time(c) -> Column:
    s = thai_digits_to_ascii(py_strip(col_of(c).cast("string")))
    return F.coalesce(_candidate(s, COLON_TIME, True), _candidate(s, DOT_TIME, False))


def time_result(c) -> Column:
    """STRUCT<value STRING, is_valid BOOLEAN, error STRING, raw STRING>."""
    raw = col_of(c).cast("string")
    t = parse_time(raw)
    blank = is_blank(raw)
    error = F.when(blank, F.lit(None)).when(t.isNull(), F.lit("invalid_time"))
    return F.struct(F.when(~blank, t).alias("value"), error.isNull().alias("is_valid"),
                    error.alias("error"), py_strip(raw).alias("raw"))
