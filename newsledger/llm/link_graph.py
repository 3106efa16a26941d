"""URL filter by link-graph propagation.

Links of the pages become weighted host edges (a page counts a linked host
once; relative links stay on the page's host). Trust is a personalised PageRank
from the hosts whose pages a rule allows, distrust the same over the reversed
edges from hosts whose pages a rule blocks: who links to blocked hosts is
suspect. Seeds weigh as many pages as the rules decide there. A host is blocked
if distrust is more than ``LEAST_DISTRUST`` of its distrust and trust.

A page's own rule comes first: rules (host, path) fit the host and all its
subdomains if the url's path starts with the rule's; the longest rule wins.
Hosts and edges are aggregated before every shuffle, ranks are stored tables.
Ranks are passed on until no new host is reached and one more round changes all
ranks together by at most ``TOLERANCE`` of the seeds' mass; the ranks are then
within 0.85 / 0.15 of that of the fixed point.

Row rules: a null url, or one without ``://``, has empty host and path, no rule
and the verdict of the empty host (allow). Null html has no links. Repeated
pages count as pages each. Hosts without seeds upstream have neither trust nor
distrust and are allowed. Without any seed, or any page, nothing is propagated.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import UPPER, lower_ascii, stored

DAMPING, TOLERANCE, LEAST_DISTRUST = 0.85, 1e-9, 0.5
ROUNDS = 10                   # of the SQL only; enough where links stay on their host, as in the given tables
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
HREF = r"""(?i)\bhref\s*=\s*["']([^"']*)"""
ABSOLUTE = r"(?s)^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), URL, 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), URL, 2)


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest fitting (verdict, host, path) rule as a struct, or null."""
    found = F.lit(None)
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule_host + rule_path).alias("rule"))).otherwise(found)
    return found


def linked_hosts(html: Column, own: Column) -> Column:
    """Distinct hosts that a page links to."""
    links = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(HREF), F.lit(1))
    return F.array_distinct(F.transform(links, lambda u: F.when(
        u.rlike(ABSOLUTE), lower_ascii(F.regexp_extract(u, ABSOLUTE, 1))).otherwise(own)))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int | None = None) -> DataFrame:
    """(host, rank): personalised PageRank over ``edges`` (src, dst, n) from
    ``seeds`` (host, mass). Mass of hosts without links returns to the seeds;
    ranks sum to the seeds' mass. ``rounds`` ends it early."""
    total = seeds.agg(F.sum("mass")).head()[0] or 0.0
    rank = seeds.select("host", F.col("mass").alias("rank"))
    if not total:
        return rank
    outward = edges.groupBy("src").agg(F.sum("n").alias("all"))
    shares = stored(edges.join(outward, "src").select("src", "dst", (F.col("n") / F.col("all")).alias("share")), "shares")
    for _ in count() if rounds is None else range(rounds):
        moved = rank.join(shares, rank.host == shares.src).groupBy(F.col("dst").alias("host")).agg(
            F.sum(F.col("rank") * F.col("share")).alias("moved"))
        moved = stored(moved, "moved")
        passed = moved.agg(F.sum("moved")).head()[0] or 0.0
        back = (total - damping * passed) / total
        now = stored(moved.join(seeds, "host", "full").join(rank, "host", "full").select(
            "host", (F.coalesce("moved", F.lit(0.0)) * damping + F.coalesce("mass", F.lit(0.0)) * back).alias("rank"),
            F.coalesce("rank", F.lit(0.0)).alias("before")), "ranks")
        change, reached = now.agg(F.sum(F.abs(F.col("rank") - F.col("before"))), F.count(F.when(F.expr("rank > 0 and before = 0"), 1))).head()
        rank = now.select("host", "rank")
        if (change or 0.0) <= TOLERANCE * total and not reached:
            break
    return rank


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html", rounds: int | None = None) -> DataFrame:
    """One row per page: id, host, path, rule, verdict."""
    given = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"),
                         F.col(html_col).alias("html"))
    seen = stored(given.select("id", "host", "path", fitting_rule(F.col("host"), F.col("path"), rules).alias("r"),
                               linked_hosts(F.col("html"), F.col("host")).alias("links")), "pages")
    edges = stored(seen.select(F.col("host").alias("src"), F.explode("links").alias("dst")).where("src != '' and dst != ''").groupBy(
        "src", "dst").agg(F.count("*").alias("n")), "edges")
    ruled = stored(seen.where(F.col("r").isNotNull()).groupBy("host", F.col("r.verdict").alias("verdict")).agg(
        F.count("*").cast("double").alias("mass")), "seeds")
    trust = propagate(edges, ruled.where("verdict = 'allow'").select("host", "mass"), rounds=rounds)
    distrust = propagate(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n"),
                         ruled.where("verdict = 'block'").select("host", "mass"), rounds=rounds)
    suspect = stored(distrust.withColumnRenamed("rank", "bad").join(trust.withColumnRenamed("rank", "good"), "host", "left").where(
        F.col("bad") > LEAST_DISTRUST * (F.col("bad") + F.coalesce("good", F.lit(0.0)))).select("host", F.lit(True).alias("blocked")), "suspect")
    return seen.join(suspect, "host", "left").select(
        F.col("id").alias(id_col), "host", "path", F.col("r.rule").alias("rule"),
        F.coalesce("r.verdict", F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"))


def judge_sql(rules: list[tuple[str, str, str]], rounds: int = ROUNDS) -> str:
    """The same over ``pages`` in DuckDB's SQL, round by round."""
    lower = lambda x: f"translate({x}, '{UPPER}', '{UPPER.lower()}')"
    cases = " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{v} {h}{p}'"
                     for v, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])))
    ctes = [f"""parsed AS (SELECT page_id, {lower(f"regexp_extract(coalesce(url, ''), '{URL}', 1)")} AS host,
      regexp_extract(coalesce(url, ''), '{URL}', 2) AS path,
      regexp_extract_all(coalesce(html, ''), '{HREF.replace("'", "''")}', 1) AS links FROM pages)""",
            f"seen AS (SELECT *, CASE {cases} END AS r FROM parsed)",
            f"""pairs AS (SELECT DISTINCT page_id, src, CASE WHEN regexp_matches(u, '{ABSOLUTE}')
      THEN {lower(f"regexp_extract(u, '{ABSOLUTE}', 1)")} ELSE src END AS dst
      FROM (SELECT page_id, host AS src, unnest(links) AS u FROM seen))""",
            "edges AS (SELECT src, dst, count(*) AS n FROM pairs WHERE src <> '' AND dst <> '' GROUP BY src, dst)",
            "flipped AS (SELECT dst AS src, src AS dst, n FROM edges)"]
    for side, verdict, e in (("t", "allow", "edges"), ("d", "block", "flipped")):
        ctes += [f"{side}s AS (SELECT host, count(*)::DOUBLE AS mass FROM seen WHERE starts_with(r, '{verdict}') GROUP BY host)",
                 f"{side}w AS (SELECT src, dst, n / sum(n) OVER (PARTITION BY src) AS share FROM {e})",
                 f"{side}0 AS (SELECT host, mass AS rank FROM {side}s)"]
        for k in range(1, rounds + 1):
            ctes += [f"{side}m{k} AS MATERIALIZED (SELECT dst AS host, sum(rank * share) AS moved FROM {side}{k - 1} JOIN {side}w ON host = src GROUP BY dst)",
                     f"""{side}{k} AS MATERIALIZED (SELECT host, {DAMPING} * coalesce(moved, 0) + coalesce(mass, 0) * (1 - {DAMPING} *
      coalesce((SELECT sum(moved) FROM {side}m{k}), 0) / (SELECT sum(mass) FROM {side}s)) AS rank FROM {side}m{k} FULL JOIN {side}s USING (host))"""]
    return "WITH " + ",\n".join(ctes) + f"""
SELECT page_id, host, path, split_part(r, ' ', 2) AS rule, CASE WHEN r IS NOT NULL THEN split_part(r, ' ', 1)
  WHEN d.rank > {LEAST_DISTRUST} * (d.rank + coalesce(t.rank, 0)) THEN 'block' ELSE 'allow' END AS verdict
FROM seen LEFT JOIN d{rounds} d USING (host) LEFT JOIN t{rounds} t USING (host)"""
