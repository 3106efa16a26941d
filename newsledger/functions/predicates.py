"""Row predicates of the pipeline (content validity, fetch status, labels,
domain rules)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import col_of, py_strip

MIN_CONTENT_CHARS = 10
# Platforms that are flagged and not fetched, and the excluded domain.
PLATFORM_PATTERN = r"(?i)youtube|facebook|docs\.google"
EXCLUDED_DOMAIN_PATTERN = r"(?i)ebs-ddce\.ddc\.moph\.go\.th"


def content_is_valid(c, min_chars: int = MIN_CONTENT_CHARS) -> Column:
    """Not null and at least ``min_chars`` characters after stripping."""
    c = col_of(c)
    return F.coalesce(F.length(py_strip(c)) >= min_chars, F.lit(False))


def has_content(c, min_chars: int = MIN_CONTENT_CHARS) -> Column:
    """Content already present: not null, not '', not 'None', longer than
    ``min_chars`` (no stripping: exactly ``min_chars`` characters needs a fetch)."""
    c = col_of(c)
    return F.coalesce((c != "") & (c != "None") & (F.length(c) > min_chars), F.lit(False))


def is_nonblank(c) -> Column:
    c = col_of(c)
    return F.coalesce(py_strip(c) != "", F.lit(False))


def status_ok(c, accepted=("ok",), default: str | None = None) -> Column:
    """Fetch status in the accepted set (a missing status counts as ``default``)."""
    c = col_of(c)
    if default is not None:
        c = F.coalesce(c, F.lit(default))
    return F.coalesce(c.isin(*accepted), F.lit(False))


def is_labelled(c) -> Column:
    """Already classified: label is 0 or 1."""
    return F.coalesce(col_of(c).isin(0, 1), F.lit(False))


def is_invalid_label(c) -> Column:
    c = col_of(c)
    return c.isNotNull() & ~c.isin(0, 1)


def is_platform(url) -> Column:
    return F.coalesce(col_of(url).rlike(PLATFORM_PATTERN), F.lit(False))


def is_excluded_domain(url, pattern: str = EXCLUDED_DOMAIN_PATTERN) -> Column:
    return F.coalesce(col_of(url).rlike(pattern), F.lit(False))
