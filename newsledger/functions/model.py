"""Parsing model replies and rendering prompts (all built-in expressions)."""

from __future__ import annotations

import json
import string

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import col_of, py_strip

FENCE = "```"


def label_from_reply(reply) -> Column:
    """First '0' or '1' character of the reply; anything else (or a failed
    call, i.e. null) is 0."""
    ch = F.regexp_extract(col_of(reply), "[01]", 0)
    return F.coalesce(F.when(ch != "", ch.cast("int")), F.lit(0))


def strip_fence(reply) -> Column:
    """Remove a leading code-fence line and, only when present, the closing
    fence line."""
    s = py_strip(col_of(reply))
    b = F.regexp_replace(s, r"^[^\n]*(\n|$)", "")
    b = F.regexp_replace(b, r"\n?[ \t]*```[^\n]*$", "")
    return F.when(s.startswith(FENCE), b).otherwise(s)


def reply_is_object(body: Column) -> Column:
    """Valid JSON whose top level is a non-empty object (an object is empty
    exactly when its text is braces around blanks). Keys may repeat, which the
    variant parser does not take: put into an array, such a text is one element."""
    t = py_strip(body)
    elements = F.from_json(F.concat(F.lit("["), body, F.lit("]")), "array<string>", {"allowSingleQuotes": "false"})
    repeated = F.coalesce(F.size(F.json_object_keys(body)) > F.size(F.array_distinct(F.json_object_keys(body))), F.lit(False))
    return F.coalesce((F.try_parse_json(body).isNotNull() | (repeated & (F.size(elements) == 1))) & t.startswith("{") & ~t.rlike(r"^\{\s*\}$"),
                      F.lit(False))


def reply_fields(reply, names) -> Column:
    """STRUCT<ok BOOLEAN, <name> STRING ...>: each requested key of the JSON
    object as text (nested lists/objects stay JSON text; of a repeated key the
    last counts); all null when the reply is not a usable object. Written so the
    shared sub-expressions (the stripped reply, the parsed row) are computed once
    per row by Spark's common-subexpression elimination, inside generated code."""
    body = strip_fence(reply)
    ok = reply_is_object(body)
    if not names:
        return F.struct(ok.alias("ok"))
    quoted = {n: "`" + n.replace("`", "``") + "`" for n in names}
    row = F.from_json(F.when(ok, body), "struct<" + ", ".join(f"{x}: string" for x in quoted.values()) + ">")
    return F.struct(ok.alias("ok"), *[row.getField(n).alias(n) for n in names])


def render_template(template: str, **slots) -> Column:
    """Fill ``{slot}`` placeholders in one pass (text inserted for one slot is
    never re-scanned); values are Columns or strings."""
    parts = []
    for literal, name, _spec, _conv in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            val = slots[name]
            v = val if isinstance(val, Column) else F.lit(str(val))
            parts.append(F.coalesce(v.cast("string"), F.lit("")))
    return F.concat(*parts) if parts else F.lit("")


def example_json(columns) -> str:
    """Example object for the extraction prompt from enabled column specs."""
    sample = {"integer": 45, "float": 37.5, "boolean": 1, "date": "15/03/2024", "time": "14:30"}
    return json.dumps({c["name"]: sample.get(c.get("data_type", "text"), "ตัวอย่าง") for c in columns},
                      ensure_ascii=False, indent=2)


def fields_description(columns) -> str:
    return "\n".join(f"- {c['extraction_hint']}" for c in columns if c.get("extraction_hint"))
