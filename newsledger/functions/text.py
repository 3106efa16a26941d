"""Free-text cleaning: tags and entities, URLs, custom patterns, character
filter, whitespace, length handling; Unicode NFKC as the one vectorised
helper. Column profiles pick lengths and rules by column name."""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import PY_WS, WS_U, col_of, let, py_strip

# Entity decoding order of the text cleaner (&amp; first).
TEXT_ENTITIES = (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'),
                 ("&#39;", "'"), ("&nbsp;", " "))
TAG_PATTERN = r"<[^>]+>"
# URL patterns removed from text.
HTTP_URL_PATTERN = r"http[s]?://(?:[a-zA-Z]|[0-9]|[$-_@.&+]|[!*\\(\\),]|(?:%[0-9a-fA-F][0-9a-fA-F]))+"
WWW_URL_PATTERN = r"www\.(?:[a-zA-Z]|[0-9]|[$-_@.&+]|[!*\\(\\),]|(?:%[0-9a-fA-F][0-9a-fA-F]))+"
# Characters kept by the optional character filter: whitespace, Thai block,
# ASCII letters, digits, and the safe punctuation .,;:!?()-[]{}"'
CHAR_FILTER_PATTERN = f"[^\\s\\x{{0E00}}-\\x{{0E7F}}a-zA-Z\\p{{Nd}}.,;:!?()\\-\\[\\]{{}}\"'" + PY_WS[1:-1] + "]"


@dataclass(frozen=True)
class TextProfile:
    max_length: int = 500
    min_length: int = 0
    remove_html: bool = True
    remove_urls: bool = True
    normalize_whitespace: bool = True
    allow_special_chars: bool = True
    truncate: bool = True
    normalize_unicode: bool = True
    patterns: tuple = field(default_factory=tuple)   # ((regex, replacement), ...)


# Column-name rules (first matching rule wins).
MEDICAL_PATTERNS = ((r"(?m)^\d+\.\s*", ""), (r"(?m)^[-•]\s*", ""))
REGION_PATTERNS = ((r"[^\d\sสคร\.]", ""),)


def profile_for(column_name: str, **overrides) -> TextProfile:
    low = column_name.lower()
    if "ที่มาสื่อ" in column_name or "source" in low or "url" in low:
        p = TextProfile(remove_urls=False, max_length=300)
    elif "โรค" in column_name or "อาการ" in column_name or "medical" in low:
        p = TextProfile(max_length=500, patterns=MEDICAL_PATTERNS)
    elif any(k in column_name for k in ("อำเภอ", "ตำบล", "district", "subdistrict")):
        p = TextProfile(max_length=100)
    elif "หมายเหตุ" in column_name or "ข้อมูลอื่น" in column_name or "remark" in low:
        p = TextProfile(max_length=1000)
    elif "สคร." in column_name:
        p = TextProfile(max_length=50, patterns=REGION_PATTERNS)
    else:
        p = TextProfile()
    if overrides:
        p = TextProfile(**{**p.__dict__, **overrides})
    return p


def remove_html(c: Column) -> Column:
    c = F.regexp_replace(c, TAG_PATTERN, "")
    for ent, ch in TEXT_ENTITIES:
        c = F.replace(c, F.lit(ent), F.lit(ch))
    return c


def remove_urls(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, HTTP_URL_PATTERN, ""), WWW_URL_PATTERN, "")


def filter_characters(c: Column) -> Column:
    return F.regexp_replace(c, CHAR_FILTER_PATTERN, " ")


def normalize_whitespace(c: Column) -> Column:
    return py_strip(F.regexp_replace(c, f"(?U){WS_U}+", " "))


def clean_text(c, profile: TextProfile = TextProfile()) -> Column:
    """Cleaning order: html, urls, custom patterns, characters, whitespace."""
    c = col_of(c)
    if profile.remove_html:
        c = remove_html(c)
    if profile.remove_urls:
        c = remove_urls(c)
    for pat, rep in profile.patterns:
        c = F.regexp_replace(c, pat, rep)
    if not profile.allow_special_chars:
        c = filter_characters(c)
    if profile.normalize_whitespace:
        c = normalize_whitespace(c)
    return c


def truncate_text(c: Column, max_length: int) -> Column:
    """Cut to ``max_length``; move back to the last space when that keeps more
    than 80% of the limit."""
    head = F.substring(c, 1, max_length)
    pos_from_end = F.locate(" ", F.reverse(head))          # 1-based, 0 = none
    last_space = F.length(head) - pos_from_end               # 0-based index
    cut = F.when((pos_from_end > 0) & (last_space > F.lit(max_length * 0.8)),
                 F.substring(head, 1, last_space)).otherwise(head)
    return F.when(F.length(c) > max_length, cut).otherwise(c)


@F.pandas_udf(T.StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """Unicode NFKC (no JVM built-in exists). ASCII values pass through."""
    def norm(v):
        if v is None or v.isascii():
            return v
        return unicodedata.normalize("NFKC", v)
    return s.map(norm)


def text_result(c, profile: TextProfile = TextProfile(), unicode_fn=None) -> Column:
    """STRUCT<value STRING, is_valid BOOLEAN, error STRING> for a text column.

    ``unicode_fn`` is applied when ``profile.normalize_unicode`` is on
    (defaults to the vectorised NFKC helper)."""
    raw = col_of(c)
    t = raw
    if profile.normalize_unicode:
        t = (unicode_fn or nfkc)(t)

    def body(t):
        n = F.length(t)
        too_short = n < profile.min_length
        too_long = n > profile.max_length
        value = truncate_text(t, profile.max_length) if profile.truncate else t
        is_null = raw.isNull() | (py_strip(raw) == "")
        error = (F.when(is_null, F.lit(None))
                 .when(too_short, F.lit("too_short"))
                 .when(too_long & F.lit(not profile.truncate), F.lit("too_long")))
        ok = error.isNull()
        return F.struct(
            F.when(is_null | ~ok, F.lit(None).cast("string")).otherwise(value).alias("value"),
            ok.alias("is_valid"),
            error.alias("error"),
        )
    # the cleaned text is bound once: it is long and used several times
    return let(clean_text(t, profile), body)


def utf8_result(c, drop: bool = True) -> Column:
    """STRUCT<value STRING, is_valid BOOLEAN, error STRING> of bytes (or of a
    string), per value: the text without the pieces that are not UTF-8 (with
    ``drop=False`` U+FFFD stands for each), and whether there was one. A U+FFFD that
    the bytes hold themselves stays."""
    raw = col_of(c).cast("string")                     # bytes are taken as they are
    valid = F.is_valid_utf8(raw)
    kept = F.make_valid_utf8(raw)
    if drop:
        own = "\uFDD0"                                 # no character: stands for U+FFFD meanwhile
        kept = F.replace(F.replace(F.make_valid_utf8(F.replace(raw, F.lit("\uFFFD"), F.lit(own))), F.lit("\uFFFD"), F.lit("")), F.lit(own), F.lit("\uFFFD"))
    return F.struct(F.when(valid, raw).otherwise(kept).alias("value"), valid.alias("is_valid"),
                    F.when(~valid, F.lit("invalid_utf8")).alias("error"))
