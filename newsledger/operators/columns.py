"""Staged column cleaning for wide tables.

The one-expression builders in ``functions`` are convenient inside one
``select``; for the costly parsers (numbers, dates) these operators compute
the intermediate values as their own columns first. Each stage is a separate
projection that Catalyst keeps separate (the intermediate is not cheap and is
read several times), so every value is computed once per row inside generated
code — no expression-tree copies and no interpreted lambdas.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, numbers
from ..functions.common import is_blank, py_strip, sql_str, thai_digits_to_ascii


def _tmp(out: str, k: str) -> str:
    return f"__{out}_{k}"


def _result(value: Column, error: Column) -> Column:
    return F.struct(value.alias("value"), error.isNull().alias("is_valid"), error.alias("error"))


def with_integer(df: DataFrame, raw: Column, out: str, rng: numbers.NumberRange = numbers.NumberRange(),
                 words: bool = True) -> DataFrame:
    """Add ``out`` = STRUCT<value BIGINT, is_valid, error> (same rules as
    ``functions.numbers.integer_result``)."""
    s_, d_ = _tmp(out, "s"), _tmp(out, "d")
    s = thai_digits_to_ascii(py_strip(raw.cast("string")))
    df = df.withColumn(s_, numbers.number_word_text(s) if words else s).withColumn(_tmp(out, "blank"), is_blank(raw.cast("string")))
    df = df.withColumn(d_, numbers._parse_double(F.col(s_)))
    d = F.col(d_)
    v = F.when(F.abs(d) < F.lit(9.2e18), d).cast("long")
    ok_range, clamped = numbers._range_checks(v.cast("double"), rng)
    blank = F.col(_tmp(out, "blank"))
    error = (F.when(blank, F.lit(None)).when(v.isNull(), F.lit("not_integer"))
             .when(~ok_range & F.lit(not rng.clamp), F.lit("out_of_range")))
    value = F.when(blank | error.isNotNull(), F.lit(None).cast("long")).otherwise(
        clamped.cast("long") if rng.clamp else v)
    return df.withColumn(out, _result(value, error)).drop(s_, d_, _tmp(out, "blank"))


def with_float(df: DataFrame, raw: Column, out: str, rng: numbers.NumberRange = numbers.NumberRange(),
               places: int = 1) -> DataFrame:
    """Add ``out`` = STRUCT<value DOUBLE, is_valid, error> (same rules as
    ``functions.numbers.float_result``)."""
    d_, b_ = _tmp(out, "d"), _tmp(out, "blank")
    df = df.withColumn(d_, numbers._parse_double(thai_digits_to_ascii(numbers.clean_float_text(raw.cast("string"))))) \
        .withColumn(b_, is_blank(raw.cast("string")))
    d, blank = F.col(d_), F.col(b_)
    ok_range, clamped = numbers._range_checks(d, rng)
    error = (F.when(blank, F.lit(None)).when(d.isNull(), F.lit("not_float"))
             .when(~ok_range & F.lit(not rng.clamp), F.lit("out_of_range")))
    v = clamped if rng.clamp else d
    value = F.when(blank | error.isNotNull(), F.lit(None).cast("double")).otherwise(numbers.round_half_even(v, places))
    return df.withColumn(out, _result(value, error)).drop(d_, b_)


#: Month terms in the order they are looked for: Thai full names in exact case, then the variations in any case.
MONTH_TERMS = ([(n, n, i + 1, False) for i, n in enumerate(dates.THAI_MONTHS)]
               + [(a, a.lower(), m, True) for a, m in dates.MONTH_VARIATIONS])


def _sql_terms() -> str:
    """MONTH_TERMS as a SQL array."""
    return "array(%s)" % ", ".join(f"struct({sql_str(t)} AS t, {sql_str(low)} AS low, {m} AS m, {str(ci).lower()} AS ci)" for t, low, m, ci in MONTH_TERMS)


#: What a number (text t) may be, by its length and value: m and M a month (one digit, two digits; so also a day), d and
#: D a day, 2 two other digits, 4 four digits, x nothing.
NUMBER_CLASS = """CASE WHEN length(t) = 4 THEN '4' WHEN length(t) > 2 THEN 'x' WHEN int(t) BETWEEN 1 AND 12 THEN if(length(t) = 2, 'M', 'm')
    WHEN int(t) BETWEEN 1 AND 31 THEN if(length(t) = 2, 'D', 'd') WHEN length(t) = 2 THEN '2' ELSE 'x' END"""


def layout_orders() -> dict[str, str]:
    """Shape -> where year, month and day are, by the eight numeric layouts in
    their order. A shape is the separator and the classes of the three numbers; it
    has one order at most, as month-first fits whenever both fit."""
    month, day, last = "mM", "mMdD", {"/": "4MD2", "-": "4"}
    out = {}
    for sep in "/-":
        for a in "mMdD24":
            for b in day:
                for c in "mMdD24":
                    if a in day and c in last[sep]:
                        order = "201" if a in month else "210" if b in month else None
                    else:
                        order = "012" if a == "4" and b in month and c in day else None
                    if order:
                        out[sep + a + b + c] = order
    return out


def with_date(df: DataFrame, raw: Column, out: str, *rules, **named_rules) -> DataFrame:
    """Add ``out`` = STRUCT<value DATE, is_valid, error> (same rules as
    ``functions.dates.date_result``). Each distinct text is parsed once and
    joined back: there are far fewer spellings of dates than rows."""
    text, key = _tmp(out, "text"), _tmp(out, "key")
    given = df.withColumn(text, raw.cast("string"))
    parsed = date_stages(given.select(F.col(text).alias(key)).where(F.col(key).isNotNull()).distinct(), F.col(key), out, *rules, **named_rules)
    none = _result(F.lit(None).cast("date"), F.lit(None).cast("string"))
    # null texts match nothing and are spread over the tasks
    spread = F.concat(F.lit("\u0000"), (F.monotonically_increasing_id() % 1024).cast("string"))
    given = given.withColumn(text, F.coalesce(text, spread))
    found = _tmp(out, "found")
    joined = given.join(parsed.select(key, F.col(out).alias(found)), F.col(text) == F.col(key), "left")
    return joined.withColumn(out, F.coalesce(found, none)).drop(text, key, found)


def date_stages(df: DataFrame, raw: Column, out: str, min_year: int = 2020, max_year: int = 2030,
                as_of=None, allow_future: bool = False, cutoff: int = dates.BUDDHIST_CUTOFF) -> DataFrame:
    """The parse itself for every row of ``df``, in stages: the text is reduced
    to its numbers and their shape, the shape's field order is looked up, and of
    the few (year, month, day) that come into question the first that exists is
    taken by one test."""
    T = lambda k: _tmp(out, k)
    col = lambda k: F.col(T(k))

    def stage(df: DataFrame, **exprs: str) -> DataFrame:
        """Columns by SQL text, in which $name is a column of an earlier stage."""
        return df.withColumns({T(k): F.expr(re.sub(r"\$(\w+)", lambda m: f"`{T(m[1])}`", e)) for k, e in exprs.items()})
    df = df.withColumn(T("raw"), raw.cast("string"))
    df = df.withColumn(T("s"), thai_digits_to_ascii(F.regexp_replace(py_strip(col("raw")), dates.DATE_PREFIX_PATTERN, "")))
    df = df.withColumn(T("n"), dates.normalize_separators(col("s")))
    df = stage(df, term=rf"""CASE WHEN $s RLIKE r'[^0-9\s/.,\-]' THEN get(filter({_sql_terms()}, x ->
                             CASE WHEN x.ci THEN contains(lower($s), x.low) ELSE contains($s, x.t) END), 0) END""",
               x=r"regexp_extract_all($n, r'(\d+)', 1)")
    df = stage(df, named=r"CASE WHEN $term IS NOT NULL THEN transform(regexp_extract_all(replace($s, $term.t, ''), r'(\d+)', 1), t -> try_cast(t AS BIGINT)) END",
               v="transform($x, t -> try_cast(t AS BIGINT))",
               shape=rf"""CASE WHEN size($x) = 3 THEN CASE WHEN $n RLIKE r'^\d+/\d+/\d+$' THEN '/' WHEN $n RLIKE r'^\d+-\d+-\d+$' THEN '-' END
                          || array_join(transform($x, t -> {NUMBER_CLASS}), '') END""")
    orders = ", ".join(f"{sql_str(k)}, {sql_str(o)}" for k, o in layout_orders().items())
    df = stage(df, order=f"CASE WHEN $shape IS NOT NULL THEN element_at(map({orders}), $shape) END")
    shift = lambda y: f"if({y} > {cutoff}, {y} - {dates.BUDDHIST_OFFSET}, {y})"
    pivot = lambda y, top: f"CASE WHEN {y} >= 100 THEN {y} WHEN {y} < {top} THEN {y} + 2000 ELSE {y} + 1900 END"
    at = lambda k: f"get($v, int(substring($order, {k}, 1)))"
    df = stage(df, year=f"CASE WHEN substring($shape, 2) LIKE '%4%' THEN {at(1)} ELSE {pivot(at(1), 69)} END",
               years=f"transform($v, y -> if(y > {cutoff}, y - {dates.BUDDHIST_OFFSET}, {pivot('y', 50)}))", named_year=shift("get($named, 1)"))
    # the dates that come into question: the year as written (w) and as meant (y)
    date = lambda w, y, m, d: f"struct(bigint({w}) AS w, bigint({y}) AS y, bigint({m}) AS m, bigint({d}) AS d)"
    questions = [f"CASE WHEN size($named) >= 2 THEN {date('$named_year', '$named_year', '$term.m', 'get($named, 0)')} END",
                 f"CASE WHEN $order IS NOT NULL THEN {date('$year', shift('$year'), at(2), at(3))} END",
                 *[f"CASE WHEN size($v) = 3 THEN {date(f'$years[{y}]', f'$years[{y}]', f'$v[{m}]', f'$v[{d}]')} END"
                   for m, d, y in ((0, 1, 2), (1, 0, 2), (2, 1, 0))]]
    leap = lambda y: f"({y} % 4 = 0 AND {y} % 100 <> 0 OR {y} % 400 = 0)"
    exists = (f"q.y BETWEEN 1 AND 9999 AND q.w BETWEEN 1 AND 9999 AND q.m BETWEEN 1 AND 12 AND q.d BETWEEN 1 AND 31 AND "
              f"CASE WHEN q.m = 2 THEN q.d <= 28 OR q.d = 29 AND {leap('q.y')} AND {leap('q.w')} WHEN q.m IN (4, 6, 9, 11) THEN q.d <= 30 ELSE true END")
    df = stage(df, q=f"get(filter(array({', '.join(questions)}), q -> coalesce({exists}, false)), 0)")
    df = stage(df, d="CASE WHEN $q IS NOT NULL THEN make_date(int($q.y), int($q.m), int($q.d)) END")
    d = col("d")
    today = F.current_date() if as_of is None else (F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of)
    blank = is_blank(col("raw"))
    error = (F.when(blank, F.lit(None)).when(d.isNull(), F.lit("unparsable"))
             .when(~F.year(d).between(min_year, max_year), F.lit("out_of_range"))
             .when(F.lit(not allow_future) & (d > today), F.lit("future")))
    df = df.withColumn(out, _result(F.when(error.isNull() & ~blank, d), error))
    return df.drop(*[T(k) for k in ("raw", "s", "n", "term", "x", "named", "v", "shape", "order", "year", "years", "named_year", "q", "d")])


def with_nfkc(df: DataFrame, column: str, out: str) -> DataFrame:
    """Add ``out`` = Unicode NFKC of ``column``. Texts of ASCII characters are in
    NFKC already and are sent to the Python helper as nulls; the input is read once."""
    from ..functions.text import nfkc
    c = F.col(column)
    sent = F.when(F.octet_length(c) != F.char_length(c), c)
    return df.withColumn(out, F.coalesce(nfkc(sent), c))
