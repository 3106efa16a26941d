"""URL builders: split, redirect unwrap, tracking-parameter strip, link
extraction from HTML, host exclusion.

URLs are split with one regular expression that follows the standard
``scheme://netloc/path?query#fragment`` grammar, so malformed input degrades to
the same pieces on every engine instead of raising (Java's URI parser rejects
many URLs a browser accepts).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import col_of, let, str_array

URL_SPLIT = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"

# Query keys dropped besides any key starting with utm_.
TRACKING_KEYS = ("ved", "usg", "ei")
# host+path prefixes whose links are excluded.
EXCLUDE_PREFIXES = ("accounts.google.com", "support.google.com", "www.google.com/alerts")
# The redirect wrapper host and path, and its target keys in order.
REDIRECT_HOST = "www.google.com"
REDIRECT_PATH = "/url"
REDIRECT_KEYS = ("url", "q")


def _part(c: Column, idx: int) -> Column:
    return F.regexp_extract(c, URL_SPLIT, idx)


def url_scheme(c) -> Column:
    return F.lower(_part(col_of(c), 1))


def url_netloc(c) -> Column:
    """Authority as written (host, optional user info and port)."""
    return _part(col_of(c), 2)


def url_path(c) -> Column:
    return _part(col_of(c), 3)


def url_query(c) -> Column:
    return _part(col_of(c), 4)


def url_fragment(c) -> Column:
    return _part(col_of(c), 5)


def host_path(c) -> Column:
    c = col_of(c)
    return F.concat(url_netloc(c), url_path(c))


def form_decode(c: Column) -> Column:
    """Query-string decoding: ``+`` is a space, ``%XX`` UTF-8 escapes.
    Malformed escapes keep the text (with ``+`` as space) instead of failing."""
    return F.coalesce(F.try_url_decode(c), F.replace(c, F.lit("+"), F.lit(" ")))


def percent_decode(c: Column) -> Column:
    """Plain percent decoding; ``+`` stays ``+``."""
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def form_encode(c: Column) -> Column:
    """Query-string encoding: letters, digits and ``_.-~`` stay, space is ``+``,
    everything else ``%XX`` of its UTF-8 bytes."""
    enc = F.url_encode(c)
    return F.replace(F.replace(enc, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _query_param(query: Column, key: str) -> Column:
    """First non-blank raw value of ``key`` in a query string ('' if none)."""
    return F.regexp_extract(query, r"(?:^|&)" + key + r"=([^&]+)", 1)


def unwrap_redirect(c) -> Column:
    """Return the target of a redirect-wrapper link, else the link itself."""
    href = col_of(c)

    def body(p):
        q = p["q"]
        target = F.coalesce(*[F.nullif(_query_param(q, k), F.lit("")) for k in REDIRECT_KEYS])
        is_wrapper = (p["netloc"] == REDIRECT_HOST) & (p["path"] == REDIRECT_PATH)
        return F.when(is_wrapper & target.isNotNull(), percent_decode(form_decode(target))).otherwise(href)
    return let(_parts(href), body)


def _parts(href: Column) -> Column:
    return F.struct(url_scheme(href).alias("scheme"), url_netloc(href).alias("netloc"),
                    url_path(href).alias("path"), url_query(href).alias("q"),
                    url_fragment(href).alias("frag"))


def _tracking_key(k: Column) -> Column:
    lk = F.lower(k)
    return lk.startswith("utm_") | lk.isin(*TRACKING_KEYS)


def strip_tracking_params(c) -> Column:
    """Drop utm_* / ved / usg / ei, drop blank values, keep the first value of
    each remaining key (first-occurrence order), re-encode; keep fragment."""
    href = col_of(c)

    def body(p):
        scheme, netloc, path, query, frag = p["scheme"], p["netloc"], p["path"], p["q"], p["frag"]
        pairs = F.transform(
            F.split(query, "&"),
            lambda x: F.struct(
                form_decode(F.substring_index(x, "=", 1)).alias("k"),
                form_decode(F.substring(x, F.instr(x, "=") + 1, F.length(x))).alias("v"),
                (F.instr(x, "=") > 0).alias("has_eq"),
            ),
        )
        kept = F.filter(pairs, lambda x: x["has_eq"] & (x["v"] != "") & ~_tracking_key(x["k"]))

        def encode(kept):
            keys = F.array_distinct(F.transform(kept, lambda x: x["k"]))
            return F.array_join(
                F.transform(keys, lambda k: F.concat(
                    form_encode(k), F.lit("="),
                    form_encode(F.get(F.filter(kept, lambda x: x["k"] == k), 0)["v"]))),
                "&")
        encoded = let(kept, encode)
        rest = F.when(netloc != "",
                      F.concat(F.lit("//"), netloc,
                               F.when((path != "") & ~path.startswith("/"), F.concat(F.lit("/"), path))
                               .otherwise(path))
                      ).otherwise(path)
        out = F.when(scheme != "", F.concat(scheme, F.lit(":"), rest)).otherwise(rest)
        return let(encoded, lambda e: F.concat(
            out,
            F.when(e != "", F.concat(F.lit("?"), e)).otherwise(F.lit("")),
            F.when(frag != "", F.concat(F.lit("#"), frag)).otherwise(F.lit(""))))
    return let(_parts(href), body)


def is_excluded_link(c, prefixes=EXCLUDE_PREFIXES) -> Column:
    hp = host_path(col_of(c))
    return F.exists(str_array(prefixes), lambda p: hp.startswith(p))


# Anchor start tag with an href attribute; the value is quoted or bare.
HREF_PATTERN = r"""(?is)<a\s[^>]*?\bhref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
NOISE_PATTERN = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"


def extract_hrefs(html) -> Column:
    """All anchor href values in document order (comments/scripts removed,
    entities in the value decoded). Returns ARRAY<STRING>."""
    from .html import unescape_entities

    clean = F.regexp_replace(col_of(html), NOISE_PATTERN, "<s>")
    raw = F.regexp_extract_all(clean, F.lit(HREF_PATTERN), F.lit(1))
    return F.transform(raw, lambda v: unescape_entities(F.regexp_replace(v, r"""^["']|["']$""", "")))


def canonical_link(c) -> Column:
    """unwrap redirect, then strip tracking parameters."""
    return strip_tracking_params(unwrap_redirect(col_of(c)))
