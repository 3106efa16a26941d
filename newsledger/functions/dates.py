"""Date cleaning: Thai/English month names, Buddhist years, eight numeric
layouts tried in a fixed order, a three-number fallback, range and
no-future checks. Output is a DATE; the Buddhist shift happens before the
calendar check, so 29/2/2567 (= 2024-02-29) is valid and 29/2/2568 is not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import WS_U, col_of, is_blank, let, py_strip, thai_digits_to_ascii

BUDDHIST_CUTOFF = 2100
BUDDHIST_OFFSET = 543

# Thai month names, January..December.
THAI_MONTHS = ("มกราคม", "กุมภาพันธ์", "มีนาคม", "เมษายน", "พฤษภาคม", "มิถุนายน",
               "กรกฎาคม", "สิงหาคม", "กันยายน", "ตุลาคม", "พฤศจิกายน", "ธันวาคม")
# Abbreviations and English names, matched case-insensitively in this order.
MONTH_VARIATIONS = (
    ("ม.ค.", 1), ("มค", 1), ("Jan", 1), ("January", 1),
    ("ก.พ.", 2), ("กพ", 2), ("Feb", 2), ("February", 2),
    ("มี.ค.", 3), ("มีค", 3), ("Mar", 3), ("March", 3),
    ("เม.ย.", 4), ("เมย", 4), ("Apr", 4), ("April", 4),
    ("พ.ค.", 5), ("พค", 5), ("May", 5),
    ("มิ.ย.", 6), ("มิย", 6), ("Jun", 6), ("June", 6),
    ("ก.ค.", 7), ("กค", 7), ("Jul", 7), ("July", 7),
    ("ส.ค.", 8), ("สค", 8), ("Aug", 8), ("August", 8),
    ("ก.ย.", 9), ("กย", 9), ("Sep", 9), ("September", 9),
    ("ต.ค.", 10), ("ตค", 10), ("Oct", 10), ("October", 10),
    ("พ.ย.", 11), ("พย", 11), ("Nov", 11), ("November", 11),
    ("ธ.ค.", 12), ("ธค", 12), ("Dec", 12), ("December", 12),
)
# Words removed before parsing.
DATE_PREFIX_PATTERN = r"(วันที่|ว/ด/ป|เมื่อ)"

_M = r"(0?[1-9]|1[0-2])"
_D = r"(0?[1-9]|[12]\d|3[01])"
_Y4 = r"(\d{4})"
_Y2 = r"(\d{2})"
# Numeric layouts in the order they are tried: (pattern, month group,
# day group, year group, two-digit year). Month-first comes before day-first.
NUMERIC_LAYOUTS = (
    (f"^{_M}/{_D}/{_Y4}$", 1, 2, 3, False),
    (f"^{_D}/{_M}/{_Y4}$", 2, 1, 3, False),
    (f"^{_Y4}/{_M}/{_D}$", 2, 3, 1, False),
    (f"^{_M}-{_D}-{_Y4}$", 1, 2, 3, False),
    (f"^{_D}-{_M}-{_Y4}$", 2, 1, 3, False),
    (f"^{_Y4}-{_M}-{_D}$", 2, 3, 1, False),
    (f"^{_M}/{_D}/{_Y2}$", 1, 2, 3, True),
    (f"^{_D}/{_M}/{_Y2}$", 2, 1, 3, True),
)


def safe_date(y: Column, m: Column, d: Column) -> Column:
    """DATE or null when the calendar date does not exist (never raises)."""
    ok = y.between(1, 9999) & m.between(1, 12) & d.between(1, 31)
    txt = F.format_string("%04d-%02d-%02d", y.cast("int"), m.cast("int"), d.cast("int"))
    return F.when(ok, F.try_to_date(txt, "yyyy-MM-dd"))


def valid_ymd(y: Column, m: Column, d: Column) -> Column:
    """True when (y, m, d) is a calendar date in years 1..9999 (proleptic
    Gregorian, as Python's date). Arithmetic only: cheap in generated code."""
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    dim = (F.when(m == 2, F.when(leap, F.lit(29)).otherwise(F.lit(28)))
           .when(m.isin(4, 6, 9, 11), F.lit(30)).otherwise(F.lit(31)))
    return F.coalesce(y.between(1, 9999) & m.between(1, 12) & d.between(1, 31) & (d <= dim), F.lit(False))


def valid_shifted(y: Column, m: Column, d: Column, cutoff: int = BUDDHIST_CUTOFF) -> Column:
    """valid_ymd as written AND after the Buddhist shift, in one test: the
    two differ only for 29 February, which then needs a leap year in both."""
    ys = _shift(y, cutoff)
    leap_y = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    return valid_ymd(ys, m, d) & y.between(1, 9999) & (~((m == 2) & (d == 29)) | leap_y)


def ymd_date(t: Column) -> Column:
    """DATE from a validated STRUCT<y, m, d> (null struct -> null)."""
    return F.when(t.isNotNull(), F.make_date(t["y"].cast("int"), t["m"].cast("int"), t["d"].cast("int")))


def _shift(y: Column, cutoff: int) -> Column:
    return F.when(y > cutoff, y - BUDDHIST_OFFSET).otherwise(y)


def _int(s: Column) -> Column:
    return s.try_cast("long")


def _first(cands: Column, keep) -> Column:
    """First element of an array of candidate structs that passes ``keep``."""
    return F.get(F.filter(cands, keep), 0)


def _month_name_parse(s: Column, cutoff: int) -> Column:
    # Thai full names (exact case) first, then the variations (any case).
    terms = [(name, name, i + 1, False) for i, name in enumerate(THAI_MONTHS)]
    terms += [(abbrev, abbrev.lower(), num, True) for abbrev, num in MONTH_VARIATIONS]
    arr = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(lt).alias("lt"), F.lit(n).alias("m"),
                             F.lit(ci).alias("ci")) for t, lt, n, ci in terms])

    def parse(s):
        low = F.lower(s)
        found = _first(arr, lambda x: F.when(x["ci"], F.contains(low, x["lt"])).otherwise(F.contains(s, x["t"])))

        def with_hit(hit):
            nums = F.regexp_extract_all(F.replace(s, hit["t"], F.lit("")), F.lit(r"(\d+)"), F.lit(1))
            return let(nums, lambda nums: F.when(
                hit.isNotNull() & (F.size(nums) >= 2),
                _date_from(_shift(_int(F.get(nums, 1)), cutoff), hit["m"], _int(F.get(nums, 0)))))
        return let(found, with_hit)
    return let(s, parse)


def _date_from(y: Column, m: Column, d: Column) -> Column:
    return let(F.struct(y.alias("y"), m.alias("m"), d.alias("d")),
               lambda t: safe_date(t["y"], t["m"], t["d"]))


def normalize_separators(s: Column) -> Column:
    s = F.regexp_replace(s, r"(?U)[." + WS_U[1:-1] + r"]+", "/")
    s = F.regexp_replace(s, r",+", "/")
    return py_strip(s)


_IS_M = r"^(0?[1-9]|1[0-2])$"
_IS_D = r"^(0?[1-9]|[12]\d|3[01])$"
_IS_Y4 = r"^\d{4}$"
_IS_Y2 = r"^\d{2}$"


def _layout_parse(s: Column, cutoff: int) -> Column:
    """The eight numeric layouts (see NUMERIC_LAYOUTS), tried in order. A
    layout applies when the text has its shape and the date exists both as
    written and after the Buddhist shift."""
    def parse(s):
        slash = s.rlike(r"^\d+/\d+/\d+$")
        dash = s.rlike(r"^\d+-\d+-\d+$")

        def with_parts(parts):
            a, b, c = F.get(parts, 0), F.get(parts, 1), F.get(parts, 2)
            ai, bi, ci = _int(a), _int(b), _int(c)
            y2 = F.when(ci <= 68, ci + 2000).otherwise(ci + 1900)

            def cand(sep, cond, m, d, y):
                return F.struct((sep & cond).alias("ok"), m.alias("m"), d.alias("d"), y.alias("y"))

            ma, mb, da, db, dc = a.rlike(_IS_M), b.rlike(_IS_M), a.rlike(_IS_D), b.rlike(_IS_D), c.rlike(_IS_D)
            y4a, y4c, y2c = a.rlike(_IS_Y4), c.rlike(_IS_Y4), c.rlike(_IS_Y2)
            cands = F.array(
                cand(slash, ma & db & y4c, ai, bi, ci),
                cand(slash, da & mb & y4c, bi, ai, ci),
                cand(slash, y4a & mb & dc, bi, ci, ai),
                cand(dash, ma & db & y4c, ai, bi, ci),
                cand(dash, da & mb & y4c, bi, ai, ci),
                cand(dash, y4a & mb & dc, bi, ci, ai),
                cand(slash, ma & db & y2c, ai, bi, y2),
                cand(slash, da & mb & y2c, bi, ai, y2),
            )
            hit = _first(cands, lambda x: x["ok"] & safe_date(x["y"], x["m"], x["d"]).isNotNull()
                         & safe_date(_shift(x["y"], cutoff), x["m"], x["d"]).isNotNull())
            return let(hit, lambda h: _date_from(_shift(h["y"], cutoff), h["m"], h["d"]))
        return let(F.split(s, "[/-]"), with_parts)
    return let(s, parse)


def _three_number_parse(s: Column, cutoff: int) -> Column:
    """Any three numbers: (month, day, year), (day, month, year), then
    (year, day, month); two-digit years pivot at 50."""
    def with_nums(nums):
        n0, n1, n2 = _int(F.get(nums, 0)), _int(F.get(nums, 1)), _int(F.get(nums, 2))

        def cand(m, d, y):
            yy = (F.when(y > cutoff, y - BUDDHIST_OFFSET)
                  .when(y < 100, F.when(y < 50, y + 2000).otherwise(y + 1900))
                  .otherwise(y))
            return F.struct(m.alias("m"), d.alias("d"), yy.alias("y"))

        cands = F.array(cand(n0, n1, n2), cand(n1, n0, n2), cand(n2, n1, n0))
        hit = _first(cands, lambda x: safe_date(x["y"], x["m"], x["d"]).isNotNull())
        return F.when(F.size(nums) == 3, let(hit, lambda h: safe_date(h["y"], h["m"], h["d"])))
    return let(F.regexp_extract_all(s, F.lit(r"(\d+)"), F.lit(1)), with_nums)


def parse_date(c, cutoff: int = BUDDHIST_CUTOFF) -> Column:
    """DATE parsed from free text, or null."""
    s = thai_digits_to_ascii(F.regexp_replace(py_strip(col_of(c).cast("string")), DATE_PREFIX_PATTERN, ""))
    def body(s):
        # month names need a letter; the cheap guard skips the name search otherwise
        named = F.when(s.rlike(r"[^0-9\s/.,\-]"), _month_name_parse(s, cutoff))
        numeric = let(normalize_separators(s), lambda n: F.coalesce(
            F.when(n.rlike(r"^\d+[/-]\d+[/-]\d+$"), _layout_parse(n, cutoff)), _three_number_parse(n, cutoff)))
        return F.coalesce(named, numeric)
    return let(s, body)


def date_result(c, min_year: int = 2020, max_year: int = 2030, as_of=None,
                allow_future: bool = False, cutoff: int = BUDDHIST_CUTOFF) -> Column:
    """STRUCT<value DATE, is_valid BOOLEAN, error STRING>.

    ``as_of`` (a date string or Column) is the 'today' of the no-future rule;
    pass it explicitly for reproducible runs."""
    raw = col_of(c).cast("string")
    today = F.current_date() if as_of is None else (F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of)

    def build(d):
        blank = is_blank(raw)
        error = (F.when(blank, F.lit(None))
                 .when(d.isNull(), F.lit("unparsable"))
                 .when(~F.year(d).between(min_year, max_year), F.lit("out_of_range"))
                 .when(F.lit(not allow_future) & (d > today), F.lit("future")))
        return let(error, lambda e: F.struct(F.when(e.isNull() & ~blank, d).alias("value"),
                                             e.isNull().alias("is_valid"), e.alias("error")))
    return let(parse_date(raw, cutoff), build)


def thai_month_name(d) -> Column:
    """Thai month name of a DATE."""
    m = F.month(col_of(d))
    return F.when(m.isNotNull(), F.element_at(F.array(*[F.lit(x) for x in THAI_MONTHS]), m))
