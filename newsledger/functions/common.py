"""Shared expression helpers.

Python's ``str.strip`` / ``str.split`` / regex ``\\s`` treat every Unicode
whitespace character as blank. Java's ``\\s`` and RE2's ``\\s`` are ASCII only,
so the class is spelled out once here and used by every builder (and by the
oracle SQL, where RE2 reads the same class).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.isspace() accepts.
PY_WS = (r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
         r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")

# The same set for Java regexes: (?U) makes \s the Unicode White_Space class,
# which is Python's set minus the four separators U+001C..U+001F. (?U) must
# lead the whole pattern; it is noticeably faster than the spelled-out class.
WS_U = r"[\s\x1C-\x1F]"
# The same set as literal characters, for trim().
WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
            + "\u2028\u2029\u202f\u205f\u3000")

# Thai digits 0..9 in order, and their ASCII counterparts.
THAI_DIGITS = "๐๑๒๓๔๕๖๗๘๙"
ASCII_DIGITS = "0123456789"


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: Column | str) -> Column:
    """``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.trim(col_of(c), F.lit(WS_CHARS))


def collapse_ws(c: Column | str) -> Column:
    """``' '.join(s.split())``: collapse whitespace runs and strip."""
    return py_strip(F.regexp_replace(col_of(c), f"(?U){WS_U}+", " "))


def is_blank(c: Column | str) -> Column:
    """Null, or only whitespace."""
    c = col_of(c)
    return c.isNull() | (py_strip(c) == F.lit(""))


def thai_digits_to_ascii(c: Column | str) -> Column:
    return F.translate(col_of(c), THAI_DIGITS, ASCII_DIGITS)


def str_array(values) -> Column:
    """Array literal of strings (bounded, fixed-size vocabularies only)."""
    return F.array(*[F.lit(v) for v in values])


def any_contained(value: Column, terms, min_len: int = 0) -> Column:
    """True when any term (longer than ``min_len``) occurs inside ``value``."""
    usable = [t for t in terms if len(t) > min_len]
    if not usable:
        return F.lit(False)
    return F.exists(str_array(usable), lambda t: F.contains(value, t))


def sql_str(s: str) -> str:
    """Quote a Python string as an SQL literal (single quotes doubled)."""
    return "'" + s.replace("'", "''") + "'"


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable.

    Builders that use an intermediate result several times would otherwise
    copy its whole expression tree into every use; binding it keeps the plan
    linear in size (and the value is computed once per row)."""
    return F.get(F.transform(F.array(value), body), 0)
