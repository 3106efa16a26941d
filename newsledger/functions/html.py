"""Article text from HTML: paragraph rule.

Each ``<p>`` paragraph's text nodes are stripped and joined with one space,
blank paragraphs are dropped, paragraphs are joined with a newline. A paragraph
ends at ``</p>``, at the start of a block element, or at the end of its
container (an unclosed ``<p>`` is closed implicitly, as HTML parsers do).
Script, style and comment content is never text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import col_of, py_strip
from .urls import NOISE_PATTERN

# Entities decoded in text, '&amp;' last so '&amp;lt;' stays '&lt;'.
ENTITIES = (
    ("&ndash;", "–"), ("&mdash;", "—"), ("&hellip;", "…"), ("&lsquo;", "‘"), ("&rsquo;", "’"), ("&ldquo;", "“"),
    ("&rdquo;", "”"), ("&bull;", "•"), ("&deg;", "°"), ("&reg;", "®"), ("&trade;", "™"), ("&euro;", "€"), ("&laquo;", "«"), ("&raquo;", "»"),
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
    ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"),
)

PARA_SPLIT = r"(?i)<p\b"
PARA_START_REST = r"^[^>]*>"
BLOCKS = ("div|ul|ol|dl|table|h[1-6]|pre|blockquote|form|hr|address|section|article|header|"
          "footer|nav|aside|li|figure|main|fieldset|details|menu")
CONTAINERS = ("div|article|section|body|html|td|th|li|main|header|footer|aside|nav|blockquote|"
              "form|ul|ol|table|details|figure")
PARA_END = rf"(?is)(?:</p\s*>|<(?:{BLOCKS})\b|</(?:{CONTAINERS})\s*>).*$"
TAG = r"<[^>]*>"


def unescape_numeric(c: Column) -> Column:
    """Decimal and hex character references. Texts without any pass untouched;
    a reference to no character is left as it is."""
    pieces = F.split(c, "&#")

    def decode(p: Column) -> Column:
        code = F.coalesce(F.regexp_extract(p, "^([0-9]{1,7});", 1).try_cast("int"),
                          F.conv(F.nullif(F.regexp_extract(p, "^[xX]([0-9a-fA-F]{1,6});", 1), F.lit("")), 16, 10).cast("int"))
        # a code point as big-endian UTF-32
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        usable = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        return F.when(usable, F.concat(char, F.regexp_replace(p, "^[0-9a-zA-Z]+;", ""))).otherwise(F.concat(F.lit("&#"), p))

    rest = F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), decode)
    return F.when(F.contains(c, F.lit("&#")), F.concat(F.get(pieces, F.lit(0)), F.array_join(rest, ""))).otherwise(c)


def unescape_entities(c: Column) -> Column:
    c = unescape_numeric(c)
    for ent, ch in ENTITIES:
        c = F.replace(c, F.lit(ent), F.lit(ch))
    return c


def paragraph_texts(html) -> Column:
    """ARRAY<STRING> of non-blank paragraph texts in document order."""
    clean = F.regexp_replace(col_of(html), NOISE_PATTERN, "<s>")
    pieces = F.split(clean, PARA_SPLIT)
    paras = F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))

    def para_text(p: Column) -> Column:
        body = F.regexp_replace(F.regexp_replace(p, PARA_START_REST, ""), PARA_END, "")
        nodes = F.transform(F.split(body, TAG), lambda t: py_strip(unescape_entities(t)))
        return F.array_join(F.filter(nodes, lambda t: t != ""), " ")

    return F.filter(F.transform(paras, para_text), lambda t: t != "")


def article_text(html) -> Column:
    """Paragraph text joined with newlines; '' for null/empty HTML."""
    h = col_of(html)
    return F.when(h.isNull() | (h == ""), F.lit("")).otherwise(F.array_join(paragraph_texts(h), "\n"))


def fetch_status(skip: Column, html: Column, text: Column) -> Column:
    """Per-URL fetch outcome."""
    return (F.when(skip, F.lit("skipped: platform"))
            .when(html.isNull() | (html == ""), F.lit("error: fetch"))
            .when(text != "", F.lit("ok"))
            .otherwise(F.lit("error: extract")))
