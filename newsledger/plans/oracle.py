"""DuckDB SQL for each registered query (the correctness oracle).

The SQL restates each operator's rule independently of the Spark code; the
fixed patterns and word lists are shared so both sides read the same values.
"""

from __future__ import annotations

from ..functions import booleans, categories, dates, html, numbers, text, urls
from ..functions.common import PY_WS, sql_str as q
from . import queries as Q

WS = PY_WS


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def lst(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def md5n(x: str) -> str:
    return f"md5({x})"


def fdec(x: str) -> str:   # query-string decoding
    return f"url_decode(replace({x}, '+', ' '))"


def fenc(x: str) -> str:   # query-string encoding
    return f"replace(url_encode({x}), '%20', '+')"


def url_struct(x: str) -> str:
    return f"regexp_extract({x}, {q(urls.URL_SPLIT)}, ['scheme', 'netloc', 'path', 'q', 'frag'])"


def strip_tracking(u: str) -> str:
    """u is a struct column from url_struct plus field 'kept'."""
    raise NotImplementedError


def canonical_sql(src: str, col: str, keep: str) -> str:
    """SELECT keep..., canonical FROM src (tracking parameters stripped)."""
    tk = "(starts_with(lower(x.k), 'utm_') OR lower(x.k) IN ('ved', 'usg', 'ei'))"
    return f"""
    (WITH s1 AS (SELECT {keep}, {url_struct(col)} AS s FROM {src}),
    s2 AS (SELECT *, list_filter(list_transform(string_split(s.q, '&'), lambda x: {{
              'k': {fdec("split_part(x, '=', 1)")},
              'v': {fdec("substr(x, strpos(x, '=') + 1)")},
              'has_eq': strpos(x, '=') > 0}}),
           lambda x: x.has_eq AND x.v <> '' AND NOT {tk}) AS kept FROM s1),
    s3 AS (SELECT *, array_to_string(list_transform(
              list_filter(kept, lambda x, i: NOT list_contains(list_transform(kept[1:i-1], lambda y: y.k), x.k)),
              lambda x: {fenc('x.k')} || '=' || {fenc('x.v')}), '&') AS enc FROM s2)
    SELECT {keep},
      (CASE WHEN s.scheme <> '' THEN lower(s.scheme) || ':' ELSE '' END
       || CASE WHEN s.netloc <> '' THEN '//' || s.netloc ||
            CASE WHEN s.path <> '' AND NOT starts_with(s.path, '/') THEN '/' || s.path ELSE s.path END
          ELSE s.path END
       || CASE WHEN enc <> '' THEN '?' || enc ELSE '' END
       || CASE WHEN s.frag <> '' THEN '#' || s.frag ELSE '' END) AS canonical
    FROM s3)"""


def unwrap_expr(h: str) -> str:
    s = url_struct(h)
    tgt = " , ".join(f"nullif(regexp_extract(({s}).q, '(?:^|&){k}=([^&]+)', 1), '')" for k in urls.REDIRECT_KEYS)
    return (f"(CASE WHEN ({s}).netloc = {q(urls.REDIRECT_HOST)} AND ({s}).path = {q(urls.REDIRECT_PATH)} "
            f"AND coalesce({tgt}) IS NOT NULL THEN url_decode({fdec(f'coalesce({tgt})')}) ELSE {h} END)")


def excluded_expr(u: str) -> str:
    s = url_struct(u)
    hp = f"(({s}).netloc || ({s}).path)"
    return "(" + " OR ".join(f"starts_with({hp}, {q(p)})" for p in urls.EXCLUDE_PREFIXES) + ")"


def unescape(x: str, entities=html.ENTITIES) -> str:
    for ent, ch in entities:
        x = f"replace({x}, {q(ent)}, {q(ch)})"
    return x


def article_text_expr(h: str) -> str:
    clean = f"regexp_replace({h}, {q(urls.NOISE_PATTERN)}, '<s>', 'g')"
    pieces = f"string_split_regex({clean}, {q(html.PARA_SPLIT)})"
    body = f"regexp_replace(regexp_replace(p, {q(html.PARA_START_REST)}, ''), {q(html.PARA_END)}, '')"
    para = (f"array_to_string(list_filter(list_transform(string_split_regex({body}, {q(html.TAG)}), "
            f"lambda t: {strip(unescape('t'))}), lambda t: t <> ''), ' ')")
    paras = f"list_filter(list_transform(({pieces})[2:], lambda p: {para}), lambda t: t <> '')"
    return f"(CASE WHEN {h} IS NULL OR {h} = '' THEN '' ELSE array_to_string({paras}, chr(10)) END)"


def fetch_status_expr(url: str, h: str, t: str) -> str:
    return (f"(CASE WHEN coalesce(regexp_matches({url}, {q('(?i)youtube|facebook|docs\\.google')}), false) "
            f"THEN 'skipped: platform' WHEN {h} IS NULL OR {h} = '' THEN 'error: fetch' "
            f"WHEN {t} <> '' THEN 'ok' ELSE 'error: extract' END)")


def clean_text_expr(x: str, profile=text.TextProfile(normalize_unicode=False)) -> str:
    if profile.remove_html:
        x = f"regexp_replace({x}, {q(text.TAG_PATTERN)}, '', 'g')"
        x = unescape(x, text.TEXT_ENTITIES)
    if profile.remove_urls:
        x = f"regexp_replace(regexp_replace({x}, {q(text.HTTP_URL_PATTERN)}, '', 'g'), {q(text.WWW_URL_PATTERN)}, '', 'g')"
    if profile.normalize_whitespace:
        x = strip(f"regexp_replace({x}, '{WS}+', ' ', 'g')")
    return x


def truncate_expr(t: str, n: int) -> str:
    head = f"substring({t}, 1, {n})"
    last = f"(length({head}) - length(regexp_replace({head}, '(?s)^.* ', '')) - 1)"
    cut = f"(CASE WHEN {last} > {n * 0.8} THEN substring({head}, 1, {last}) ELSE {head} END)"
    return f"(CASE WHEN length({t}) > {n} THEN {cut} ELSE {t} END)"


def thai2ascii(x: str) -> str:
    return f"translate({x}, {q('๐๑๒๓๔๕๖๗๘๙')}, '0123456789')"


def safe_date(y, m, d) -> str:
    return (f"(CASE WHEN ({y}) BETWEEN 1 AND 9999 AND ({m}) BETWEEN 1 AND 12 AND ({d}) BETWEEN 1 AND 31 "
            f"THEN CAST(try_strptime(printf('%04d-%02d-%02d', ({y})::BIGINT, ({m})::BIGINT, ({d})::BIGINT), '%Y-%m-%d') AS DATE) END)")


def shift(y, cutoff=dates.BUDDHIST_CUTOFF) -> str:
    return f"(CASE WHEN ({y}) > {cutoff} THEN ({y}) - 543 ELSE ({y}) END)"


def parse_date_sql(src: str, raw: str, keep: str) -> str:
    """SELECT keep, _raw, d (DATE or NULL) FROM src; ``keep`` are plain column names."""
    terms = [(n, n, i + 1, "false") for i, n in enumerate(dates.THAI_MONTHS)]
    terms += [(a, a.lower(), m, "true") for a, m in dates.MONTH_VARIATIONS]
    arr = "[" + ", ".join(f"{{'t': {q(t)}, 'lt': {q(lt)}, 'm': {m}, 'ci': {ci}}}" for t, lt, m, ci in terms) + "]"
    ws_inner = WS[1:-1]
    pre = q(dates.DATE_PREFIX_PATTERN)
    i = lambda x: f"TRY_CAST({x} AS BIGINT)"
    M, D, Y4, Y2 = (q(p) for p in (r"^(0?[1-9]|1[0-2])$", r"^(0?[1-9]|[12]\d|3[01])$", r"^\d{4}$", r"^\d{2}$"))

    def cand(sep, cond, m, d, y):
        return f"{{'ok': {sep} AND {cond}, 'm': {m}, 'd': {d}, 'y': {y}}}"
    ma, mb = f"regexp_matches(a, {M})", f"regexp_matches(b, {M})"
    da, db, dc = f"regexp_matches(a, {D})", f"regexp_matches(b, {D})", f"regexp_matches(c, {D})"
    y4a, y4c, y2c = f"regexp_matches(a, {Y4})", f"regexp_matches(c, {Y4})", f"regexp_matches(c, {Y2})"
    ai, bi, ci_ = i("a"), i("b"), i("c")
    y2 = f"(CASE WHEN {ci_} <= 68 THEN {ci_} + 2000 ELSE {ci_} + 1900 END)"
    cands = ", ".join([
        cand("slash", f"{ma} AND {db} AND {y4c}", ai, bi, ci_),
        cand("slash", f"{da} AND {mb} AND {y4c}", bi, ai, ci_),
        cand("slash", f"{y4a} AND {mb} AND {dc}", bi, ci_, ai),
        cand("dash", f"{ma} AND {db} AND {y4c}", ai, bi, ci_),
        cand("dash", f"{da} AND {mb} AND {y4c}", bi, ai, ci_),
        cand("dash", f"{y4a} AND {mb} AND {dc}", bi, ci_, ai),
        cand("slash", f"{ma} AND {db} AND {y2c}", ai, bi, y2),
        cand("slash", f"{da} AND {mb} AND {y2c}", bi, ai, y2),
    ])
    three = lambda m, d, y: (f"{{'m': {m}, 'd': {d}, 'y': CASE WHEN {y} > 2100 THEN {y} - 543 "
                             f"WHEN {y} < 100 THEN (CASE WHEN {y} < 50 THEN {y} + 2000 ELSE {y} + 1900 END) ELSE {y} END}}")
    n0, n1, n2 = i("nums3[1]"), i("nums3[2]"), i("nums3[3]")
    return f"""
    (WITH d00 AS (SELECT {keep}, CAST({raw} AS VARCHAR) AS _raw FROM {src}), d0 AS (SELECT {keep}, _raw, {thai2ascii(f"regexp_replace({strip('_raw')}, {pre}, '', 'g')")} AS s FROM d00),
    d1 AS (SELECT *, list_filter({arr}, lambda x: CASE WHEN x.ci THEN contains(lower(s), x.lt) ELSE contains(s, x.t) END)[1] AS hit,
                  {strip(f"regexp_replace(regexp_replace(s, '[.{ws_inner}]+', '/', 'g'), ',+', '/', 'g')")} AS n FROM d0),
    d2 AS (SELECT *, regexp_extract_all(replace(s, hit.t, ''), '(\\d+)', 1) AS nums,
                  regexp_full_match(n, '\\d+/\\d+/\\d+') AS slash, regexp_full_match(n, '\\d+-\\d+-\\d+') AS dash,
                  string_split_regex(n, '[/-]') AS parts, regexp_extract_all(n, '(\\d+)', 1) AS nums3 FROM d1),
    d3 AS (SELECT *, parts[1] AS a, parts[2] AS b, parts[3] AS c FROM d2),
    d4 AS (SELECT *,
        CASE WHEN hit IS NOT NULL AND len(nums) >= 2 THEN {safe_date(shift(i('nums[2]')), 'hit.m', i('nums[1]'))} END AS named,
        list_filter([{cands}], lambda x: x.ok AND {safe_date('x.y', 'x.m', 'x.d')} IS NOT NULL
                    AND {safe_date(shift('x.y'), 'x.m', 'x.d')} IS NOT NULL)[1] AS lay,
        CASE WHEN len(nums3) = 3 THEN list_filter([{three(n0, n1, n2)}, {three(n1, n0, n2)}, {three(n2, n1, n0)}],
                    lambda x: {safe_date('x.y', 'x.m', 'x.d')} IS NOT NULL)[1] END AS thr FROM d3)
    SELECT {keep}, _raw, coalesce(named, {safe_date(shift('lay.y'), 'lay.m', 'lay.d')},
                            {safe_date('thr.y', 'thr.m', 'thr.d')}) AS d FROM d4)"""


def date_result_sql(src, raw, keep, as_of=Q.AS_OF, lo=2020, hi=2030):
    inner = parse_date_sql(src, raw, keep)
    blank = f"({strip('_raw')} = '' OR _raw IS NULL)"
    err = (f"CASE WHEN {blank} THEN NULL WHEN d IS NULL THEN 'unparsable' "
           f"WHEN NOT (year(d) BETWEEN {lo} AND {hi}) THEN 'out_of_range' "
           f"WHEN d > DATE {q(as_of)} THEN 'future' END")
    return f"(SELECT {keep}, CASE WHEN ({err}) IS NULL AND NOT {blank} THEN d END AS value, ({err}) IS NULL AS is_valid, {err} AS error FROM {inner})"


def number_word_expr(s: str) -> str:
    thai_hit = " ".join(f"WHEN contains({s}, {q(w)}) THEN '{v}'" for w, v in numbers.THAI_NUMBER_WORDS)
    thai_any = " OR ".join(f"contains({s}, {q(w)})" for w, _ in numbers.THAI_NUMBER_WORDS)
    eng_any = " OR ".join(f"contains(lower({s}), {q(w)})" for w in numbers.ENGLISH_NUMBER_WORDS)
    digits = f"regexp_extract({s}, '(\\d+)', 1)"
    return (f"(CASE WHEN ({thai_any}) OR ({eng_any}) THEN (CASE WHEN {digits} <> '' THEN {digits} "
            f"ELSE coalesce(CASE {thai_hit} END, {s}) END) ELSE {s} END)")


def parse_double(s: str) -> str:
    return f"(CASE WHEN regexp_matches({s}, {q(numbers.NUMBER_SHAPE)}) THEN TRY_CAST({s} AS DOUBLE) END)"


def bool_sql(src: str, raw: str, keep: str) -> str:
    tv = booleans._unique(booleans.TRUE_VALUES, False)
    fv = booleans._unique(booleans.FALSE_VALUES, False)
    nv = booleans._unique(booleans.NULL_VALUES, False)
    anyc = lambda terms: f"len(list_filter({lst([t for t in terms if len(t) > 2])}, lambda t: contains(v, t))) > 0"
    neg = " OR ".join(f"regexp_matches(s, {q(p)})" for p in booleans.NEGATIVE_PATTERNS)
    pos = " OR ".join(f"regexp_matches(s, {q(p)})" for p in booleans.POSITIVE_PATTERNS)
    num = "TRY_CAST(regexp_extract(s, '(\\d+(?:\\.\\d+)?)', 1) AS DOUBLE)"
    rule = (f"CASE WHEN s IS NULL OR s = '' THEN 'blank' WHEN list_contains({lst(nv)}, v) THEN 'unknown' "
            f"WHEN list_contains({lst(fv)}, v) THEN 'false_exact' WHEN list_contains({lst(tv)}, v) THEN 'true_exact' "
            f"WHEN {anyc(fv)} THEN 'false_contains' WHEN {anyc(tv)} THEN 'true_contains' "
            f"WHEN {neg} THEN 'false_pattern' WHEN {pos} THEN 'true_pattern' "
            f"WHEN {num} = 0 THEN 'false_number' WHEN {num} = 1 THEN 'true_number' ELSE 'unmapped' END")
    return (f"(WITH b0 AS (SELECT {keep}, {strip(raw)} AS s FROM {src}), b1 AS (SELECT *, lower(s) AS v FROM b0), "
            f"b2 AS (SELECT *, {rule} AS rule FROM b1) SELECT {keep}, "
            f"CASE WHEN starts_with(rule, 'true') THEN 1 WHEN starts_with(rule, 'false') THEN 0 END AS value, "
            f"rule <> 'unmapped' AS is_valid, rule FROM b2)")


def category_sql(src: str, raw: str, keep: str, vocab) -> str:
    terms = vocab.all_terms
    syn = [(k.lower(), v) for k, v in vocab.synonyms if v in set(terms)]
    seen, syn_u = set(), []
    for k, v in syn:
        if k not in seen:
            seen.add(k)
            syn_u.append((k, v))
    seen, ex = set(), []
    for t in terms:
        if t.lower() not in seen:
            seen.add(t.lower())
            ex.append((t.lower(), t))
    syn_case = "CASE " + " ".join(f"WHEN lower(cleaned) = {q(k)} THEN {q(v)}" for k, v in syn_u) + " END" if syn_u else "NULL"
    ex_case = "CASE " + " ".join(f"WHEN lower(stripped) = {q(k)} THEN {q(v)}" for k, v in ex) + " END"
    partial = (f"CASE WHEN length(cleaned) >= 3 THEN list_min(list_filter(list_transform({lst(terms)}, lambda t: "
               f"{{'neg': -(CASE WHEN contains(lower(t), lower(cleaned)) THEN length(cleaned) / length(t) "
               f"WHEN contains(lower(cleaned), lower(t)) THEN length(t) / length(cleaned) ELSE 0.0 END), 'term': t}}), "
               f"lambda x: x.neg < -0.3)).term END")
    cleaned = strip(f"regexp_replace({strip(raw)}, '{WS}+', ' ', 'g')")
    default = q(vocab.default) if vocab.default is not None else "NULL"
    return (f"(WITH c0 AS (SELECT {keep}, coalesce({strip(raw)}, '') AS stripped, coalesce({cleaned}, '') AS cleaned FROM {src}), "
            f"c1 AS (SELECT *, {syn_case} AS syn, {ex_case} AS ex, {partial} AS part FROM c0) "
            f"SELECT {keep}, CASE WHEN stripped = '' THEN {default} ELSE coalesce(syn, ex, part, {default}) END AS value, "
            f"CASE WHEN stripped = '' THEN 'blank' WHEN syn IS NOT NULL THEN 'synonym' WHEN ex IS NOT NULL THEN 'exact' "
            f"WHEN part IS NOT NULL THEN 'partial' ELSE 'none' END AS match_kind FROM c1)")


def processed_docs_sql() -> str:
    valid = f"coalesce(length({strip('text')}) >= 10, false)"
    rel = f"({valid} AND coalesce(regexp_matches(text, {q(Q.RELEVANCE_PATTERN)}), false))"
    fields = ", ".join(f"CASE WHEN {rel} THEN nullif(regexp_extract(text, {q(p)}, 1), '') END AS {f}"
                       for f, p in Q.EXTRACT_FIELDS)
    anyf = " OR ".join(f"nullif(regexp_extract(text, {q(p)}, 1), '') IS NOT NULL" for _, p in Q.EXTRACT_FIELDS)
    return (f"(SELECT doc_id, CASE WHEN {rel} THEN 1 ELSE 0 END AS is_relevant, "
            f"CASE WHEN NOT {valid} THEN 'empty_content' WHEN NOT {rel} THEN 'irrelevant' "
            f"WHEN {anyf} THEN 'extracted' ELSE 'extraction_failed' END AS outcome, {fields} FROM documents)")


def wrapped_sql(u: str) -> str:
    return f"({q(Q.REDIRECT_PREFIX)} || {fenc(u)} || {q(Q.REDIRECT_SUFFIX)})"


def _sql() -> dict:
    S = {}
    S["content_validity"] = (f"SELECT doc_id, coalesce(length({strip('text')}) >= 10, false) AS is_valid, "
                             f"coalesce({strip('text')} <> '', false) AS is_nonblank FROM documents")
    hc = lambda x: f"coalesce({x} <> '' AND {x} <> 'None' AND length({x}) > 10, false)"
    S["content_split"] = (f"SELECT doc_id, {hc('text')} AS has_content, {hc('substring(text, 1, 10)')} AS has_content_10, "
                          f"{hc('substring(text, 1, 11)')} AS has_content_11 FROM documents")
    S["domain_rules"] = (f"SELECT page_id, coalesce(regexp_matches(url, {q(Q.EXCLUDE_DOMAIN)}), false) AS is_excluded, "
                         f"coalesce(regexp_matches(url, {q('(?i)youtube|facebook|docs\\.google')}), false) AS is_platform, "
                         f"starts_with(url, 'http') AS is_http FROM pages")
    base = "(SELECT DISTINCT url FROM pages WHERE starts_with(url, 'http://') AND url IS NOT NULL)"
    S["incremental_new"] = f"SELECT page_id, url FROM pages p WHERE NOT EXISTS (SELECT 1 FROM {base} b WHERE b.url = p.url)"
    S["new_prepend"] = (f"WITH fresh AS (SELECT url, page_id AS old_pos, 0 AS grp, true AS is_new FROM pages p "
                        f"WHERE NOT EXISTS (SELECT 1 FROM {base} b WHERE b.url = p.url)), "
                        f"old AS (SELECT url, page_id AS old_pos, 1 AS grp, false AS is_new FROM pages WHERE starts_with(url, 'http://')), "
                        f"u AS (SELECT * FROM fresh UNION ALL SELECT * FROM old) "
                        f"SELECT url, is_new, row_number() OVER (ORDER BY grp, old_pos) - 1 AS pos FROM u")
    art = ("(SELECT source AS url, doc_id AS pos, text AS content, CASE WHEN length(text) >= 50 THEN 'ok' "
           "ELSE 'error: extract' END AS scrape_status FROM documents)")
    ok_last = f"(SELECT url, arg_max(content, pos) AS content FROM {art} WHERE scrape_status = 'ok' GROUP BY url)"
    S["content_lookup"] = (f"WITH u AS (SELECT d.source AS url, d.doc_id AS pos, l.quality AS is_news FROM documents d JOIN labels l USING (doc_id)), "
                           f"f AS (SELECT url, arg_min(is_news, pos) AS is_news FROM u GROUP BY url) "
                           f"SELECT o.url, md5(o.content) AS content_md5, CASE WHEN coalesce(length({strip('o.content')}) >= 10, false) THEN f.is_news END AS is_news FROM {ok_last} o LEFT JOIN f USING (url)")
    valid_c = f"coalesce(length({strip('o.content')}) >= 10, false)"
    S["content_attach_left"] = (f"SELECT l.doc_id, 'src' || CAST(l.doc_id % 25 AS VARCHAR) AS url, md5(o.content) AS content_md5, "
                                f"CASE WHEN {valid_c} THEN l.quality END AS is_news "
                                f"FROM labels l JOIN documents d USING (doc_id) LEFT JOIN {ok_last} o ON o.url = 'src' || CAST(l.doc_id % 25 AS VARCHAR)")
    chosen = f"coalesce(nullif({strip('d.text')}, ''), nullif({strip('c.text')}, ''))"
    S["content_priority"] = (f"SELECT d.doc_id, CASE WHEN nullif({strip('d.text')}, '') IS NOT NULL THEN 'content' "
                             f"WHEN nullif({strip('c.text')}, '') IS NOT NULL THEN 'context' END AS source_used, md5({chosen}) AS chosen_md5 "
                             f"FROM documents d LEFT JOIN (SELECT conv_id, arg_min(text, turn) AS text FROM conversations GROUP BY conv_id) c ON c.conv_id = d.doc_id")
    S["keyed_update"] = ("WITH r AS (SELECT doc_id, quality + toxic AS v FROM labels), "
                         "t AS (SELECT d.doc_id, CASE WHEN r.doc_id IS NOT NULL THEN r.v ELSE CASE WHEN d.lang = 'en' THEN 1 ELSE 0 END END AS is_news "
                         "FROM documents d LEFT JOIN r USING (doc_id)) "
                         "SELECT doc_id, is_news, coalesce(is_news IN (0, 1), false) AS is_labelled, "
                         "(is_news IS NOT NULL AND is_news NOT IN (0, 1)) AS is_invalid FROM t")
    S["first_wins_dedupe"] = "SELECT md5(text) AS text_md5, min(doc_id) AS first_doc_id FROM documents GROUP BY 1"
    S["last_wins_dedupe"] = "SELECT source, max(doc_id) AS last_doc_id, arg_max(lang, doc_id) AS last_lang FROM documents GROUP BY source"
    S["batch_progress"] = ("SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // 50 AS batch_no, "
                           "(row_number() OVER (ORDER BY event_id) * 100) // count(*) OVER () AS progress_pct FROM events")
    S["union_by_name"] = ("SELECT c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_mktsegment AS segment, 'customer' AS src FROM customer "
                          "UNION ALL BY NAME SELECT s_suppkey AS key, s_name AS name, s_nationkey AS nationkey, 'supplier' AS src FROM supplier")
    S["integrity_report"] = (f"WITH t AS (SELECT d.source AS url, l.quality + l.toxic AS is_news FROM documents d LEFT JOIN labels l USING (doc_id)) "
                             f"SELECT count(*) AS total_rows, CAST(count(*) - (count(DISTINCT url) + max(CASE WHEN url IS NULL THEN 1 ELSE 0 END)) AS BIGINT) AS duplicate_keys, "
                             f"CAST(sum(CASE WHEN is_news IS NOT NULL AND is_news NOT IN (0, 1) THEN 1 ELSE 0 END) AS BIGINT) AS invalid_labels, "
                             f"CAST(sum(CASE WHEN url IS NULL OR {strip('url')} = '' THEN 1 ELSE 0 END) AS BIGINT) AS empty_keys, "
                             f"CAST(0 AS BIGINT) AS missing_columns, "
                             f"sum(CASE WHEN is_news IS NOT NULL AND is_news NOT IN (0, 1) THEN 1 ELSE 0 END) = 0 "
                             f"AND sum(CASE WHEN url IS NULL OR {strip('url')} = '' THEN 1 ELSE 0 END) = 0 AS passed FROM t")
    pd_ = processed_docs_sql()
    cnt = lambda cond: f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"
    S["run_summary"] = (f"SELECT count(*) AS new_records, {cnt("outcome IN ('extracted', 'extraction_failed')")} AS classified_relevant, "
                        f"{cnt("outcome = 'irrelevant'")} AS classified_irrelevant, {cnt("outcome = 'empty_content'")} AS empty_content, "
                        f"{cnt("outcome = 'extracted'")} AS extraction_success, {cnt("outcome = 'extraction_failed'")} AS extraction_failed, "
                        f"(SELECT count(*) FROM documents) AS total_input, (SELECT count(*) FROM documents) - count(*) AS already_processed FROM {pd_}")
    S["three_way_output"] = (f"SELECT doc_id, is_relevant, outcome, CASE WHEN is_relevant = 1 THEN 'extracted' ELSE 'irrelevant' END AS processing_status, "
                             f"first_word, first_number, token, is_relevant = 1 AS in_heat_table FROM {pd_}")
    at = article_text_expr("html")
    S["fetch_summary"] = (f"WITH t AS (SELECT url, html, {at} AS txt FROM pages), "
                          f"s AS (SELECT {fetch_status_expr('url', 'html', 'txt')} AS st, ({hc('txt')} AND starts_with(url, 'http://')) AS had FROM t) "
                          f"SELECT count(*) AS total_urls, {cnt('had')} AS already_had_content, {cnt('NOT had')} AS newly_fetched, "
                          f"{cnt("st = 'ok'")} AS successful_fetches, {cnt("starts_with(st, 'error')")} AS failed_fetches, "
                          f"{cnt("starts_with(st, 'skipped')")} AS skipped FROM s")
    S["url_canonical"] = (f"SELECT c.page_id, c.canonical, ({url_struct('p.url')}).netloc AS host, "
                          f"({url_struct('p.url')}).netloc || ({url_struct('p.url')}).path AS host_path "
                          f"FROM {canonical_sql('pages', 'url', 'page_id')} c JOIN pages p USING (page_id)")
    href = f"(CASE WHEN contains(url, '/en/') THEN {wrapped_sql('url')} ELSE url END)"
    S["url_unwrap"] = (f"WITH u AS (SELECT page_id, {unwrap_expr(href)} AS unwrapped FROM pages) "
                       f"SELECT page_id, unwrapped, {excluded_expr('unwrapped')} AS is_excluded FROM u")
    mail = (f"('<a href=\"' || {wrapped_sql('url')} || '\">source</a>' || "
            f"'<a href=\"https://www.google.com/alerts/remove?s=1\">x</a>' || html)")
    hrefs = f"regexp_extract_all(regexp_replace({mail}, {q(urls.NOISE_PATTERN)}, '<s>', 'g'), {q(urls.HREF_PATTERN)}, 1)"
    S["links"] = (f"WITH h AS (SELECT page_id, {hrefs} AS hs FROM pages), "
                  f"e AS (SELECT page_id, unnest(hs) AS raw, generate_subscripts(hs, 1) - 1 AS link_pos FROM h), "
                  f"f AS (SELECT page_id, link_pos, {unescape(chr(114) + 'egexp_replace(raw, ' + q('^[\"' + chr(39) + ']|[\"' + chr(39) + ']$') + ', ' + q('') + ', ' + q('g') + ')')} AS href FROM e), "
                  f"g AS (SELECT page_id, link_pos, {unwrap_expr('href')} AS uw FROM f WHERE starts_with(href, 'http')), "
                  f"c AS {canonical_sql('g', 'uw', 'page_id, link_pos')} "
                  f"SELECT canonical AS url, arg_min(page_id, (page_id, link_pos)) AS first_page_id, "
                  f"arg_min(link_pos, (page_id, link_pos)) AS first_link_pos FROM c WHERE NOT {excluded_expr('canonical')} GROUP BY canonical")
    S["article_text"] = (f"WITH t AS (SELECT page_id, url, html, {at} AS txt FROM pages) "
                         f"SELECT page_id, {fetch_status_expr('url', 'html', 'txt')} AS scrape_status, md5(txt) AS text_md5, length(txt) AS n_chars FROM t")
    inj = ("('<b>' || text || '</b> see http://x.example/' || CAST(doc_id AS VARCHAR) || "
           "' &amp; www.y.example &nbsp; <i>end</i>')")
    ce = clean_text_expr(inj)
    S["text_clean"] = f"WITH t AS (SELECT doc_id, {ce} AS c FROM documents) SELECT doc_id, md5(c) AS clean_md5, length(c) AS n_chars FROM t"
    cw = clean_text_expr("text")
    S["text_truncate"] = (f"WITH t AS (SELECT doc_id, text, {cw} AS c FROM documents), "
                          f"v AS (SELECT doc_id, CASE WHEN text IS NULL OR {strip('text')} = '' THEN NULL ELSE {truncate_expr('c', 500)} END AS value FROM t) "
                          f"SELECT doc_id, md5(value) AS value_md5, length(value) AS n_chars, true AS is_valid FROM v")
    ss = "CAST(p_size * 3 AS VARCHAR)"
    raw_i = (f"CASE WHEN p_type = 'ECONOMY' THEN {ss} || '.0' WHEN p_type = 'SMALL' THEN 'อายุ ' || {ss} || ' ปี' "
             f"WHEN p_type = 'LARGE' THEN 'ประมาณ ' || {ss} || ' สิบ' WHEN p_type = 'MEDIUM' THEN ' ' || {ss} || '.9 ' "
             f"WHEN p_type = 'PROMO' THEN translate({ss}, '0123456789', '๐๑๒๓๔๕๖๗๘๙') ELSE '-' || {ss} END")
    s_i = number_word_expr(thai2ascii(strip(raw_i)))
    d_i = parse_double(s_i)
    v_i = f"(CASE WHEN abs({d_i}) < 9.2e18 THEN CAST(trunc({d_i}) AS BIGINT) END)"
    yr = parse_double(number_word_expr(thai2ascii(strip("CAST(p_size + 2000 AS VARCHAR)"))))
    yv = f"(CASE WHEN abs({yr}) < 9.2e18 THEN CAST(trunc({yr}) AS BIGINT) END)"
    S["int_clamp"] = (f"SELECT p_partkey, CAST(CASE WHEN {v_i} IS NULL THEN NULL ELSE least(greatest({v_i}::DOUBLE, 0.0), 120.0) END AS BIGINT) AS age, "
                      f"{v_i} IS NOT NULL AS age_valid, CASE WHEN {yv} BETWEEN 2020 AND 2030 THEN {yv} END AS year, "
                      f"CASE WHEN {yv} IS NULL THEN 'not_integer' WHEN NOT ({yv} BETWEEN 2020 AND 2030) THEN 'out_of_range' END AS year_error FROM part")
    cents = "abs(CAST(round(c_acctbal * 100, 0) AS BIGINT))"
    raw_f = (f"((CASE WHEN c_acctbal < 0 THEN '-' ELSE '' END) || CAST(({cents} % 1000) // 10 AS VARCHAR) || ',' || "
             f"CAST({cents} % 10 AS VARCHAR) || '°C')")
    cl = strip(raw_f)
    for u in numbers.FLOAT_UNITS:
        cl = f"replace({cl}, {q(u)}, '')"
    cl = thai2ascii(f"replace({strip(cl)}, ',', '.')")
    d_f = parse_double(cl)
    S["float_range"] = (f"WITH t AS (SELECT c_custkey, {d_f} AS d FROM customer) SELECT c_custkey, "
                        f"CASE WHEN d BETWEEN -10.0 AND 60.0 THEN CAST(round_even(CAST(d AS DECIMAL(38,12)), 1) AS DOUBLE) END AS value, "
                        f"coalesce(d BETWEEN -10.0 AND 60.0, false) AS is_valid, "
                        f"CASE WHEN d IS NULL THEN 'not_float' WHEN NOT (d BETWEEN -10.0 AND 60.0) THEN 'out_of_range' END AS error, "
                        f"(d < -20 OR d > 70) AS is_outlier FROM t")
    th = "[" + ", ".join(q(m) for m in dates.THAI_MONTHS) + "]"
    en = "[" + ", ".join(q(m) for m in Q.EN_MONTHS) + "]"
    y, m, d = "year(ts)", "month(ts)", "day(ts)"
    v = lambda x: f"CAST({x} AS VARCHAR)"
    raw_d = (f"(CASE WHEN event_type = 'click' THEN concat_ws('/', {v(m)}, {v(d)}, {v(y + ' + 543')}) "
             f"WHEN event_type = 'view' THEN concat_ws('/', {v(d)}, {v(m)}, {v(y)}) "
             f"WHEN event_type = 'signup' THEN concat_ws(' ', 'วันที่', {v(d)}, {th}[{m}], {v(y + ' + 543')}) "
             f"WHEN event_type = 'purchase' THEN concat_ws(' ', {v(d)}, {en}[{m}], {v(y)}) "
             f"ELSE concat_ws('-', {v(y + ' + 543')}, {v(m)}, {v(d)}) END)")
    S["date_parse"] = date_result_sql("events", raw_d, "event_id")
    raw_o = "concat_ws('.', CAST(day(o_orderdate) AS VARCHAR), CAST(month(o_orderdate) AS VARCHAR), CAST(year(o_orderdate) + 543 AS VARCHAR))"
    S["date_orders"] = f"SELECT o_orderkey, value, error FROM {date_result_sql('orders', raw_o, 'o_orderkey')}"
    S["month_name"] = f"SELECT event_id, {th}[month(ts)] AS month_name FROM events"
    h, mi, se = "hour(ts)", "minute(ts)", "second(ts)"
    lp = lambda x: f"lpad(CAST({x} AS VARCHAR), 2, '0')"
    raw_t = (f"(CASE WHEN event_type = 'click' THEN 'เวลา ' || CAST({h} AS VARCHAR) || ':' || {lp(mi)} "
             f"WHEN event_type = 'view' THEN CAST({h} AS VARCHAR) || '.' || {lp(mi)} || ' น.' "
             f"WHEN event_type = 'signup' THEN concat_ws(':', {lp(h)}, {lp(mi)}, {lp(se)}) "
             f"WHEN event_type = 'purchase' THEN CAST({h} + 20 AS VARCHAR) || ':' || {lp(mi)} ELSE 'unknown' END)")
    col_p, dot_p = q(r"(\d{1,2}):(\d{2})(?::(\d{2}))?"), q(r"(\d{1,2})\.(\d{2})")
    g = lambda p, i_: f"TRY_CAST(regexp_extract(s, {p}, {i_}) AS INTEGER)"
    sec = f"(CASE WHEN regexp_extract(s, {col_p}, 3) = '' THEN 0 ELSE {g(col_p, 3)} END)"
    c1 = (f"CASE WHEN regexp_extract(s, {col_p}, 0) <> '' AND {g(col_p, 1)} BETWEEN 0 AND 23 AND {g(col_p, 2)} BETWEEN 0 AND 59 "
          f"AND {sec} BETWEEN 0 AND 59 THEN printf('%02d:%02d:%02d', {g(col_p, 1)}, {g(col_p, 2)}, {sec}) END")
    c2 = (f"CASE WHEN regexp_extract(s, {dot_p}, 0) <> '' AND {g(dot_p, 1)} BETWEEN 0 AND 23 AND {g(dot_p, 2)} BETWEEN 0 AND 59 "
          f"THEN printf('%02d:%02d:%02d', {g(dot_p, 1)}, {g(dot_p, 2)}, 0) END")
    S["time_parse"] = (f"WITH t AS (SELECT event_id, {thai2ascii(strip(raw_t))} AS s FROM events) "
                       f"SELECT event_id, coalesce({c1}, {c2}) AS value, coalesce({c1}, {c2}) IS NOT NULL OR s = '' AS is_valid FROM t")
    raw_b = ("(CASE WHEN event_type = 'click' THEN 'Yes' WHEN event_type = 'view' THEN 'ไม่มีอาการ' "
             "WHEN event_type = 'signup' THEN 'not found ' || CAST(user_id % 3 AS VARCHAR) "
             "WHEN event_type = 'purchase' THEN 'มีอาการไข้สูง' ELSE 'code ' || CAST(user_id % 3 AS VARCHAR) END)")
    S["boolean_map"] = f"SELECT event_id, value, is_valid, rule FROM {bool_sql('events', raw_b, 'event_id')}"
    raw_c = ("(CASE WHEN c_custkey % 6 = 0 THEN lower(c_mktsegment) WHEN c_custkey % 6 = 1 THEN '  ' || c_mktsegment || ' ' "
             "WHEN c_custkey % 6 = 2 THEN substring(c_mktsegment, 1, 5) WHEN c_custkey % 6 = 3 THEN c_mktsegment || ' dept' "
             "WHEN c_custkey % 6 = 4 THEN (CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Car' ELSE 'xx' END) END)")
    S["category_cascade"] = f"SELECT c_custkey, value, match_kind FROM {category_sql('customer', raw_c, 'c_custkey', Q.SEGMENTS)}"
    ag = "(p_size * 2 - 5)"
    groups = " ".join(f"WHEN {ag} <= {u} THEN {q(lbl)}" for u, lbl in categories.AGE_GROUPS)
    S["age_group"] = f"SELECT p_partkey, CASE WHEN {ag} IS NULL OR {ag} < 0 THEN NULL {groups} ELSE {q(categories.ELDER_LABEL)} END AS age_group FROM part"
    items = f"list_filter(list_transform(string_split(replace(p_name, ' ', ', '), ','), lambda x: {strip('x')}), lambda x: x <> '')"
    S["multi_category"] = (f"WITH t AS (SELECT p_partkey, {items} AS it FROM part) SELECT p_partkey, len(it) AS n_items, "
                           f"len(list_filter(it, lambda x: NOT list_contains({lst(Q.PART_WORDS)}, x))) AS n_invalid, "
                           f"len(list_filter(it, lambda x: NOT list_contains({lst(Q.PART_WORDS)}, x))) = 0 AS is_valid FROM t")
    S["category_counts"] = ("WITH o AS (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey) "
                            "SELECT r_name, n_name, count(*) AS n_customers, CAST(coalesce(sum(n_orders), 0) AS BIGINT) AS n_orders "
                            "FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey "
                            "LEFT JOIN o ON c.c_custkey = o.o_custkey GROUP BY r_name, n_name")
    f1 = parse_double(thai2ascii(f"replace({strip(strip('CAST(o_orderkey AS VARCHAR)'))}, ',', '.')"))
    i1 = parse_double(number_word_expr(thai2ascii(strip("CAST(year(o_orderdate) + 26 AS VARCHAR)"))))
    icd = "(CASE WHEN starts_with(o_orderpriority, '1') THEN 'J45.9' ELSE o_orderpriority END)"
    icd_c = clean_text_expr(icd, text.profile_for("ICD 10", normalize_unicode=False, max_length=20))
    icd_v = truncate_expr(icd_c, 20)
    S["schema_validate"] = (
        f"WITH t AS (SELECT {f1} AS f, {i1} AS i, {icd_v} AS icd FROM orders), "
        f"cells AS (SELECT 'ที่' AS \"column\", coalesce(f BETWEEN 1 AND 99999, false) AS ok, false AS is_null_cell FROM t UNION ALL "
        f"SELECT 'ปี', coalesce(abs(i) < 9.2e18 AND trunc(i) BETWEEN 2020 AND 2030, false), false FROM t UNION ALL "
        f"SELECT 'ICD 10', coalesce(regexp_matches(icd, {q(r'^[A-Z]\d{2}(\.\d{1,2})?$')}), false), false FROM t) "
        f"SELECT \"column\", CAST(sum(CASE WHEN ok AND NOT is_null_cell THEN 1 ELSE 0 END) AS BIGINT) AS n_valid, "
        f"CAST(sum(CASE WHEN NOT ok THEN 1 ELSE 0 END) AS BIGINT) AS n_invalid, "
        f"CAST(sum(CASE WHEN ok AND is_null_cell THEN 1 ELSE 0 END) AS BIGINT) AS n_null FROM cells GROUP BY \"column\"")
    raw_r = ("(CASE WHEN event_type = 'click' THEN '```json' || chr(10) || props || chr(10) || '```' "
             "WHEN event_type = 'view' THEN props WHEN event_type = 'signup' THEN substring(props, 1, 5) "
             "WHEN event_type = 'purchase' THEN '{}' ELSE '[' || props || ']' END)")
    body = (f"(CASE WHEN starts_with(s, '```') THEN regexp_replace(regexp_replace(s, '^[^\\n]*(\\n|$)', ''), "
            f"'\\n?[ \\t]*```[^\\n]*$', '') ELSE s END)")
    S["json_fields"] = (f"WITH t AS (SELECT event_id, {strip(raw_r)} AS s FROM events), b AS (SELECT event_id, {body} AS body FROM t), "
                        f"o AS (SELECT event_id, body, coalesce(CASE WHEN json_valid(body) AND starts_with({strip('body')}, '{{') "
                        f"THEN json_type(body) = 'OBJECT' AND len(json_keys(body)) > 0 END, false) AS ok FROM b) "
                        f"SELECT event_id, ok, CASE WHEN ok THEN json_extract_string(body, '$.k') END AS k, "
                        f"CASE WHEN ok THEN CAST(trunc({parse_double(strip('json_extract_string(body, ' + q('$.k') + ')'))}) AS BIGINT) END AS k_int FROM o")
    raw_l = ("(CASE WHEN event_type = 'click' THEN 'Answer: ' || CAST(user_id % 2 AS VARCHAR) WHEN event_type = 'view' THEN 'yes' "
             "WHEN event_type = 'signup' THEN CAST(user_id % 2 AS VARCHAR) || '0' WHEN event_type = 'purchase' THEN NULL ELSE '  1 ' END)")
    S["label_parse"] = f"SELECT event_id, coalesce(CAST(nullif(regexp_extract({raw_l}, '[01]', 0), '') AS INTEGER), 0) AS label FROM events"
    pre, post = Q.CLASSIFY_TEMPLATE.split("{content}")
    prompt = f"({q(pre)} || coalesce(text, '') || {q(post)})"
    S["prompt_render"] = f"SELECT doc_id, md5({prompt}) AS prompt_md5, length({prompt}) AS prompt_len FROM documents"
    content = f"coalesce(nullif({strip('d.text')}, ''), nullif({strip('c.text')}, ''))"
    S["classify_update"] = (f"SELECT d.doc_id, CASE WHEN l.quality IN (0, 1) THEN l.quality WHEN {content} IS NULL THEN NULL "
                            f"WHEN coalesce(regexp_matches({content}, {q(Q.RELEVANCE_PATTERN)}), false) THEN 1 ELSE 0 END AS is_news, "
                            f"coalesce(l.quality IN (0, 1), false) AS was_labelled FROM documents d LEFT JOIN labels l USING (doc_id) "
                            f"LEFT JOIN (SELECT conv_id, arg_min(text, turn) AS text FROM conversations GROUP BY conv_id) c ON c.conv_id = d.doc_id")
    valid = f"coalesce(length({strip('content')}) >= 10, false)"
    rel = f"({valid} AND coalesce(regexp_matches(content, {q(Q.RELEVANCE_PATTERN)}), false))"
    anyf = " OR ".join(f"nullif(regexp_extract(content, {q(p)}, 1), '') IS NOT NULL" for _, p in Q.EXTRACT_FIELDS)
    fld = lambda f_: f"CASE WHEN {rel} THEN nullif(regexp_extract(content, {q(dict(Q.EXTRACT_FIELDS)[f_])}, 1), '') END AS {f_}"
    S["incremental_run"] = (f"WITH a AS (SELECT page_id, url, html, {at} AS content FROM pages), "
                            f"b AS (SELECT page_id, url, content, {fetch_status_expr('url', 'html', 'content')} AS scrape_status FROM a "
                            f"WHERE NOT EXISTS (SELECT 1 FROM {base} x WHERE x.url = a.url)) "
                            f"SELECT page_id, url, scrape_status, CASE WHEN {rel} THEN 1 ELSE 0 END AS is_relevant, "
                            f"CASE WHEN NOT {valid} THEN 'empty_content' WHEN NOT {rel} THEN 'irrelevant' WHEN {anyf} THEN 'extracted' "
                            f"ELSE 'extraction_failed' END AS outcome, CASE WHEN {rel} THEN 'extracted' ELSE 'irrelevant' END AS processing_status, "
                            f"{fld('first_word')}, {fld('first_number')} FROM b")
    S["consistency"] = ("SELECT CAST(0 AS BIGINT) AS filled_not_in_input, CAST(0 AS BIGINT) AS heat_not_in_filled, "
                        "CAST(0 AS BIGINT) AS filled_not_in_docs")
    S["article_refetch"] = (
        f"WITH prior AS (SELECT url, html, CASE WHEN starts_with(url, 'http://') THEN {at} END AS content FROM pages), "
        f"f AS (SELECT url, html, content, {hc('content')} AS had FROM prior), "
        f"g AS (SELECT url, had, CASE WHEN had THEN content ELSE {at} END AS txt, html FROM f), "
        f"h AS (SELECT url, had, CASE WHEN had THEN 'ok' ELSE {fetch_status_expr('url', 'html', 'txt')} END AS st, txt FROM g) "
        f"SELECT url, had AS had_content, st AS scrape_status, md5(CASE WHEN had OR st = 'ok' THEN txt END) AS content_md5 FROM h")
    from ..operators.validate import HEAT_SPECS, SPARK_TYPES
    duck = {"bigint": "BIGINT", "double": "DOUBLE", "date": "DATE", "string": "VARCHAR", "int": "INTEGER"}
    given = {"ที่": "CAST(doc_id AS DOUBLE)", "ที่มาสื่อออนไลน์": "source", "หมายเหตุ": "first_word"}
    cols = []
    for sp in HEAT_SPECS:
        ident = '"' + sp.name.replace('"', '""') + '"'
        val = given.get(sp.name, q(sp.default) if sp.default is not None else "NULL")
        cols.append(f"CAST({val} AS {duck[SPARK_TYPES[sp.data_type]]}) AS {ident}")
    S["upsert_links"] = ("WITH u AS (SELECT url AS link, page_id AS pos, 0 AS src, CAST(NULL AS VARCHAR) AS meta FROM pages "
                         "WHERE contains(url, '/en/') UNION ALL SELECT url, page_id, 1, CAST(page_id AS VARCHAR) FROM pages), "
                         "m AS (SELECT link, min({'src': src, 'pos': pos, 'meta': meta}) AS b FROM u GROUP BY link) "
                         "SELECT link, b.src AS src, b.pos AS pos, b.meta AS meta FROM m")
    S["heat_conform"] = (f"SELECT {', '.join(cols)} FROM {pd_} p JOIN documents d USING (doc_id) WHERE p.is_relevant = 1")
    S["article_labels"] = (f"WITH u AS (SELECT d.source AS url, d.doc_id AS pos, d.lang FROM documents d JOIN labels l USING (doc_id)), "
                           f"f AS (SELECT url, arg_min(lang, pos) AS context FROM u GROUP BY url) "
                           f"SELECT o.url, f.context, CASE WHEN {valid_c} THEN CAST(regexp_matches(o.content, {q(Q.RELEVANCE_PATTERN)}) AS INTEGER) END AS is_news, "
                           f"md5(o.content) AS content_md5 FROM {ok_last} o LEFT JOIN f USING (url)")
    S["update_summary"] = ("WITH t AS (SELECT coalesce(doc_id % 2 = 0 AND quality IN (0, 1), false) AS b, "
                           "coalesce(doc_id % 3 <> 0 AND quality IN (0, 1), false) AS a FROM labels) "
                           "SELECT count(*) FILTER (NOT b) AS processed, count(*) FILTER (NOT b AND a) AS updated, count(*) FILTER (b) AS skipped, "
                           "count(*) FILTER (NOT b AND NOT a) AS errors, CAST(ceil(count(*) FILTER (NOT b) / 50) AS BIGINT) AS batches FROM t")
    valid_t = f"coalesce(length({strip('text')}) >= 10, false)"
    S["content_summary"] = (f"WITH t AS (SELECT doc_id, {valid_t} AS v, coalesce(quality IN (0, 1), false) AS l FROM documents LEFT JOIN labels USING (doc_id)) "
                            "SELECT count(*) AS total, count(*) FILTER (NOT v) AS empty_content, count(*) FILTER (v) AS valid_content, "
                            "count(*) FILTER (l) AS classified, count(*) FILTER (doc_id % 100 / 100 < 0.6) AS low_confidence, "
                            "count(*) FILTER (doc_id % 3 = 0) AS fallback_used, count(*) FILTER (doc_id % 3 = 0 AND l) AS fallback_success, "
                            "count(*) FILTER (doc_id % 7 = 0) AS errors FROM t")
    S["live_coercion"] = ("WITH t AS (SELECT event_id, user_id AS u, CASE user_id % 4 WHEN 0 THEN CAST(user_id AS VARCHAR) WHEN 1 THEN user_id || '.9' "
                          "WHEN 2 THEN 'abc' ELSE user_id || '.0' END AS n_raw FROM events) "
                          "SELECT event_id, CASE WHEN u % 4 IN (0, 3) THEN u END AS n, CASE WHEN u % 3 = 0 THEN CAST(u || '.65' AS DOUBLE) END AS f, n_raw, "
                          "concat_ws(',', CASE WHEN u % 4 IN (1, 2) THEN 'n' END, CASE WHEN u % 3 = 1 THEN 'f' END) AS errors FROM t")
    S["collect_links"] = ("WITH x AS (SELECT page_id AS m, 0 AS k, 'https://n' || page_id % 97 || '.example.com/a' AS url FROM pages "
                          "UNION ALL SELECT page_id, 2, 'https://m' || page_id % 53 || '.example.com/b' FROM pages), "
                          "e AS (SELECT 'https://n' || page_id % 97 || '.example.com/a' AS url, page_id AS pos FROM pages WHERE page_id % 10 = 0), "
                          "f AS (SELECT url, min({'m': m, 'k': k}) AS o FROM x WHERE url NOT IN (SELECT url FROM e) GROUP BY url), "
                          "b AS (SELECT url, true AS is_new, o.m AS a, o.k AS c FROM f UNION ALL SELECT url, false, pos, 0 FROM e) "
                          "SELECT url, row_number() OVER (ORDER BY is_new DESC, a, c) - 1 AS pos, is_new FROM b")
    S["category_table_fuzzy"] = (
        "WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z]{5,}')[1] AS w FROM documents), "
        "d AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN substr(w, 1, 2) || substr(w, 4) ELSE w END AS raw FROM w), "
        "t AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{5,}')) AS term FROM benchmark), "
        "p AS (SELECT raw, term, levenshtein(raw, term) AS e, greatest(length(raw), length(term)) AS n FROM (SELECT DISTINCT raw FROM d) v, t "
        "WHERE raw <> '' AND raw NOT IN (SELECT term FROM t)), "
        "b AS (SELECT raw, max({'s': 1 - e / n, 't': term}).t AS near FROM p WHERE e <= floor(n * (1 - 0.7) + 1e-9) GROUP BY raw) "
        "SELECT doc_id, d.raw, coalesce(t.term, b.near, 'none') AS value, CASE WHEN coalesce(d.raw, '') = '' THEN 'blank' "
        "WHEN t.term IS NOT NULL THEN 'exact' WHEN b.near IS NOT NULL THEN 'fuzzy' ELSE 'none' END AS match_kind "
        "FROM d LEFT JOIN t ON d.raw = t.term LEFT JOIN b ON b.raw = d.raw")
    S["two_runs"] = (
        f"WITH a AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'empty_content' ELSE outcome END AS outcome, "
        f"CASE WHEN doc_id % 7 = 0 THEN 0 ELSE is_relevant END AS is_relevant, CASE WHEN doc_id % 7 <> 0 THEN first_word END AS first_word FROM {pd_}) "
        "SELECT *, 1 AS run FROM a WHERE doc_id % 3 <> 1 UNION ALL "
        "SELECT *, 2 AS run FROM a WHERE doc_id % 3 = 1 OR outcome NOT IN ('extracted', 'irrelevant')")
    S["key_index_new"] = (
        "WITH f AS (SELECT url, max(page_id % 3 <> 0) AS final FROM pages WHERE page_id % 4 = 0 GROUP BY url), "
        "n AS (SELECT * FROM pages WHERE page_id % 4 < 2 AND url NOT IN (SELECT url FROM f WHERE final)), "
        "s AS (SELECT url, max(page_id % 5 <> 0) AS final FROM n GROUP BY url) "
        "SELECT page_id, url FROM pages WHERE url NOT IN (SELECT url FROM f WHERE final UNION ALL SELECT url FROM s WHERE final)")
    S["link_batches"] = (
        "WITH m AS (SELECT 2 AS run, 'https://n' || page_id % 53 || '.example.com/' AS url, page_id AS k FROM pages WHERE page_id % 2 = 0 UNION ALL "
        "SELECT 1, 'https://n' || page_id % 97 || '.example.com/', page_id FROM pages UNION ALL "
        "SELECT 0, 'https://n' || page_id % 60 || '.example.com/', page_id FROM pages), "
        "f AS (SELECT url, max({'run': run, 'k': -k}) AS x FROM m GROUP BY url), "
        "r AS (SELECT url, x.run AS run, -x.k AS k FROM f) "
        "SELECT url, row_number() OVER (ORDER BY run, k) - 1 AS pos, dense_rank() OVER (ORDER BY run) - 1 AS batch FROM r")
    S["incident_counts"] = (
        "WITH r AS (SELECT l_orderkey, l_linenumber, CASE WHEN n_nationkey > 0 THEN n_name ELSE 'unknown' END AS place, p_name, "
        "CAST(month(l_shipdate) AS VARCHAR) AS month, CAST(trunc(l_quantity) AS BIGINT) AS q FROM lineitem JOIN part ON l_partkey = p_partkey "
        "JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey), "
        "x AS (SELECT place, month, q, unnest(list_distinct(string_split(p_name, ' '))) AS cause FROM r) "
        "SELECT 'place' AS grouping, place, NULL AS cause, NULL AS month, count(*) AS n, CAST(sum(q) AS BIGINT) AS sum_quantity FROM r GROUP BY place UNION ALL "
        "SELECT 'month', NULL, NULL, month, count(*), CAST(sum(q) AS BIGINT) FROM r GROUP BY month UNION ALL "
        "SELECT '', NULL, NULL, NULL, count(*), CAST(sum(q) AS BIGINT) FROM r UNION ALL "
        "SELECT 'cause', NULL, cause, NULL, count(*), CAST(sum(q) AS BIGINT) FROM x GROUP BY cause UNION ALL "
        "SELECT 'place,cause', place, cause, NULL, count(*), CAST(sum(q) AS BIGINT) FROM x GROUP BY place, cause")
    icd = "CASE WHEN o_orderkey % 5 < 3 THEN 'J' || lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0') WHEN o_orderkey % 5 = 3 THEN o_orderpriority END"
    icd_v = truncate_expr(clean_text_expr("icd", text.profile_for("ICD 10", normalize_unicode=False, max_length=20)), 20)
    S["error_report"] = (
        f"WITH t AS (SELECT o_orderkey, year(o_orderdate) + 26 AS y, {icd} AS icd FROM orders) "
        "SELECT o_orderkey, 'ปี' AS \"column\", CAST(y AS VARCHAR) AS raw, 'out_of_range' AS error FROM t WHERE y NOT BETWEEN 2020 AND 2024 UNION ALL "
        f"SELECT o_orderkey, 'ICD 10', icd, 'pattern' FROM t WHERE icd IS NOT NULL AND NOT regexp_matches({icd_v}, {q(Q.VALIDATION_SPEC[2].pattern)})")
    from ..operators.validate import HEAT_SPECS
    S["column_order"] = "WITH h AS (" + S["heat_conform"] + ") " + " UNION ALL ".join(
        f"SELECT {i} AS position, {q(x.name)} AS name, count(\"{x.name}\") AS n_filled FROM h" for i, x in enumerate(HEAT_SPECS))
    S["enabled_columns"] = f"SELECT doc_id, first_word, token FROM {pd_}"
    ids = ("SELECT CAST(doc_id AS VARCHAR) AS id, 1 AS b FROM documents UNION ALL SELECT CAST(doc_id AS VARCHAR), 2 FROM labels UNION ALL "
           "SELECT CAST(conv_id AS VARCHAR), 4 FROM conversations UNION ALL SELECT CAST(page_id AS VARCHAR), 8 FROM pages UNION ALL "
           "SELECT CAST(item_id AS VARCHAR), 16 FROM benchmark")
    S["table_presence"] = (
        f"WITH k AS (SELECT id, bit_or(b) AS bits, count(*) AS n FROM ({ids}) WHERE id IS NOT NULL GROUP BY id) "
        "SELECT concat_ws(',', CASE WHEN bits & 1 > 0 THEN 'documents' END, CASE WHEN bits & 2 > 0 THEN 'labels' END, "
        "CASE WHEN bits & 4 > 0 THEN 'conversations' END, CASE WHEN bits & 8 > 0 THEN 'pages' END, CASE WHEN bits & 16 > 0 THEN 'benchmark' END) AS tables, "
        "count(*) AS n_keys, CAST(sum(n) AS BIGINT) AS n_rows FROM k GROUP BY bits")
    rule = lambda a, b, x, y, c, d: (f"SELECT '{a} in {b}' AS rule, count(*) AS n_keys, count(*) = 0 AS is_consistent FROM (SELECT DISTINCT {c} AS id FROM {a} "  # noqa: E731
                                     f"WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {d} FROM {b} WHERE {d} IS NOT NULL))")
    key = {"documents": "doc_id", "labels": "doc_id", "conversations": "conv_id", "pages": "page_id", "benchmark": "item_id"}
    S["table_consistency"] = " UNION ALL ".join(rule(a, b, None, None, key[a], key[b]) for a, b in (
        ("labels", "documents"), ("conversations", "documents"), ("documents", "labels"), ("benchmark", "pages"), ("documents", "conversations")))
    # whole characters within the bytes of the cut, and whether they fill it
    S["utf8_bytes"] = (
        "WITH d AS (SELECT doc_id, text, doc_id % 400 + 1 AS n FROM documents), "
        "k AS (SELECT doc_id, text, n, list_max(list_filter(generate_series(0, n), lambda i: strlen(substr(text, 1, i)) <= n)) AS k FROM d) "
        "SELECT doc_id, strlen(substr(text, 1, k)) = least(n, strlen(text)) AS is_valid, md5(substr(text, 1, k)) AS value_md5, "
        "length(substr(text, 1, k)) AS n_chars FROM k")
    word = "list_distinct(regexp_extract_all(lower(text), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'))"
    S["two_stage_classify"] = (
        f"WITH l AS (SELECT doc_id, quality AS y, {word} AS w FROM documents JOIN labels USING (doc_id) WHERE doc_id % 5 <> 0), "
        "c AS (SELECT sum(y) AS n1, sum(1 - y) AS n0 FROM l), e AS (SELECT y, unnest(w) AS word FROM l), "
        "n AS (SELECT word, sum(y) AS a, sum(1 - y) AS b FROM e GROUP BY word HAVING count(*) >= 5), "
        "m AS (SELECT word, CAST(floor(1000 * ln(((a + 1) * (n0 + 2))::DOUBLE / ((b + 1) * (n1 + 2))::DOUBLE)) AS BIGINT) AS w FROM n, c ORDER BY abs(w) DESC, word LIMIT 64), "
        f"d AS (SELECT doc_id, CASE WHEN doc_id % 11 <> 0 THEN text END AS t, {word} AS w FROM documents), "
        "s AS (SELECT doc_id, sum(m.w) AS s FROM (SELECT doc_id, unnest(w) AS word FROM d) JOIN m USING (word) GROUP BY doc_id), "
        "g AS (SELECT doc_id, t, CAST(floor(1000 * ln((n1 + 1)::DOUBLE / (n0 + 1)::DOUBLE)) AS BIGINT) + coalesce(s, 0) AS g FROM d LEFT JOIN s USING (doc_id), c), "
        f"p AS (SELECT doc_id, t, g, {valid_t.replace('text', 't')} AS ok, 1 / (1 + exp(-abs(g) / 1000.0)) AS conf FROM g) "
        f"SELECT doc_id, CAST(CASE WHEN ok AND conf >= 0.6 THEN g > 0 ELSE ok AND regexp_matches(t, {q(Q.RELEVANCE_PATTERN)}) END AS INTEGER) AS is_relevant, "
        "CASE WHEN ok AND conf >= 0.6 THEN 'local' ELSE 'fallback' END AS method_used, NOT (ok AND conf >= 0.6) AS fallback_triggered, "
        "CASE WHEN ok THEN round(conf, 4) END AS confidence FROM p")
    return S


SQL = _sql()
