"""Similarity match of values against a vocabulary table of any size.

Comparing every value with every term is a cross join. Instead both sides are
put into an inverted index of character grams, and only what the index brings
together is compared:

* A gram is a character with its occurrence number in the text ("a" for the
  second time is another gram), so the grams two texts share are as many as the
  characters they have in common, and no measure below can match more than those.
* A measure at least ``cutoff`` needs a number of shared grams that follows
  from the two lengths (``Measure.shared``), and one that follows from a single
  length whatever the other is (``Measure.least``).
* Grams are put in one fixed order, rare ones first. Two texts that share t grams
  also share k of them within each one's first (length - least + k) grams: that
  is what is indexed. Pairs of grams (k = 2) are indexed where two shared grams are
  certain and the text is not long, single grams (k = 1) otherwise.
* Candidates are counted out by the shared grams that their lengths ask for, in
  the JVM, before the measure itself is computed.
* Single letters say little about words of one language. For ``edit``, short texts
  are indexed by what is left after deleting characters instead: two texts with
  at most k edits, the longer one of n characters, have a subsequence of n - k
  characters in common. A text is short as long as it has at most ``PARTS`` such
  subsequences; a pair is met by them if both texts are short, else by grams.

Nothing is dropped: the result is that of comparing all pairs (the tests do).
"""

from __future__ import annotations

import difflib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged

LONG = 40                # characters; longer texts are indexed by single grams
COMMON_GRAMS = 256       # the most frequent grams of the vocabulary, by which grams are ordered
PARTS = 400              # subsequences of a text that is indexed by them, at most
EPS = 1e-9


@dataclass(frozen=True)
class Measure:
    """``ratio``: twice the matched characters over both lengths, as difflib
    counts them. ``edit``: 1 - edits / the longer length."""
    kind: str
    cutoff: float

    def __post_init__(self):
        if self.kind not in ("ratio", "edit") or not 0 < self.cutoff <= 1:
            raise ValueError("a measure is 'ratio' or 'edit' with a cutoff in (0, 1]")

    @property
    def share(self) -> float:
        """Least shared grams per character of one text, whatever the other."""
        return self.cutoff / (2 - self.cutoff) if self.kind == "ratio" else self.cutoff

    def least(self, n: Column) -> Column:
        return F.ceil(n * self.share - EPS).cast("int")

    def shared(self, a: Column, b: Column) -> Column:
        total = (a + b) / 2 if self.kind == "ratio" else F.greatest(a, b)
        return F.ceil(total * self.cutoff - EPS).cast("int")

    @property
    def short(self) -> int:
        """Longest text of which only one shared gram is certain."""
        return int(1 / self.share + EPS)

    def edits(self, a: Column, b: Column) -> Column:
        """Most edits that keep the measure at the cutoff."""
        return F.floor(F.greatest(a, b) * (1 - self.cutoff) + EPS).cast("int")

    def deleted(self, n: int) -> int:
        """Most edits of texts of which the longer one has n characters."""
        return math.floor(n * (1 - self.cutoff) + EPS)

    @property
    def by_parts(self) -> int:
        """Longest text that is indexed by its subsequences."""
        n = 0
        while self.kind == "edit" and n < LONG and sum(math.comb(n + 1, k) for k in range(self.deleted(n + 1) + 1)) <= PARTS:
            n += 1
        return n


def characters(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit("(?s)."), F.lit(0))


def grams(c: Column) -> Column:
    """Characters with their occurrence numbers."""
    def numbered(sorted_: Column) -> Column:
        return F.transform(sorted_, lambda x, i: F.concat(x, (i + 2 - F.array_position(sorted_, x).cast("int")).cast("string")))
    return F.get(F.transform(F.array(F.array_sort(characters(c))), numbered), F.lit(0))


def gram_order(terms: DataFrame) -> Column:
    """The order number of a gram as a function of the gram: how common it is
    among the terms, 0 for all but the ``COMMON_GRAMS`` most common ones. Any
    order gives the same matches; this one gives few candidates."""
    common = terms.select(F.explode(grams(F.col("text"))).alias("g")).groupBy("g").count().orderBy(F.desc("count"), "g").limit(COMMON_GRAMS)
    ranks = [(r.g, k) for k, r in enumerate(reversed(common.collect()), 1)]
    return F.create_map(*[F.lit(x) for r in ranks for x in r]) if ranks else F.create_map().cast("map<string,int>")


def indexed(side: DataFrame, order: Column, m: Measure) -> DataFrame:
    """(text, n, by, key): the index entries of every text; ``by`` is the
    number of grams in a key."""
    n = F.col("n")
    df = side.select("text", F.char_length("text").alias("n"), grams(F.col("text")).alias("g"))
    ranked = F.array_sort(F.transform("g", lambda g: F.struct(F.coalesce(F.element_at(order, g), F.lit(0)).alias("r"), g.alias("g"))))
    df = df.select("text", "n", F.transform(ranked, lambda x: x["g"]).alias("g"))
    middle = _middle(n, m)
    single = F.slice("g", 1, F.greatest(n - m.least(n) + 1, F.lit(1)))
    double = F.slice("g", 1, F.greatest(n - m.least(n) + 2, F.lit(1)))
    pairs = F.flatten(F.transform(double, lambda x, i: F.transform(F.slice(double, i + 2, F.greatest(F.size(double) - i - 1, F.lit(0))),
                                                                     lambda y: F.concat(x, F.lit("\u0001"), y))))
    none = F.array().cast("array<string>")
    # single grams for what is not in the middle, and for what may match such a text
    alone = ~middle | (n <= int(m.short / m.share + EPS)) | (n >= int((LONG + 1) * m.share))
    one = lambda by, keys: F.transform(keys, lambda k: F.struct(F.lit(by).alias("by"), F.xxhash64(k).alias("key")))
    return df.select("text", "n", F.inline(F.concat(one(2, F.when(middle, pairs).otherwise(none)), one(1, F.when(alone, single).otherwise(none)))))


def _middle(n: Column, m: Measure) -> Column:
    return (n > m.short) & (n <= LONG)


def parts(side: DataFrame, m: Measure) -> DataFrame:
    """(text, n, key): every short text by each of its subsequences that lack as
    many characters as it may have edits, or fewer."""
    def without_one(texts: Column) -> Column:
        one = lambda t: F.transform(F.sequence(F.lit(1), F.char_length(t)),
                                    lambda i: F.concat(t.substr(F.lit(1), i - 1), t.substr(i + 1, F.char_length(t))))
        return F.array_distinct(F.flatten(F.transform(texts, one)))

    most = m.deleted(m.by_parts)
    df = side.select("text", F.char_length("text").alias("n")).where(F.col("n") <= m.by_parts).withColumn("p0", F.array("text"))
    for k in range(1, most + 1):
        least = next(n for n in range(1, m.by_parts + 1) if m.deleted(n) >= k)
        df = df.withColumn(f"p{k}", F.when(F.col("n") >= least, without_one(F.col(f"p{k - 1}"))).otherwise(F.array().cast("array<string>")))
    return df.select("text", "n", F.explode(F.concat(*[F.col(f"p{k}") for k in range(most + 1)])).alias("part")).select(
        "text", "n", F.char_length("part").alias("left"), F.xxhash64("part").alias("key"))


def _met(values: DataFrame, terms: DataFrame, m: Measure) -> DataFrame:
    """(value, term): all pairs that may reach the cutoff, some more than once."""
    a, b, longer = F.col("a"), F.col("b"), F.greatest("a", "b")
    found = None
    if m.by_parts:
        left = parts(values, m).select(F.col("text").alias("value"), F.col("n").alias("a"), "left", "key")
        right = parts(terms, m).select(F.col("text").alias("term"), F.col("n").alias("b"), F.col("left").alias("of"), "key")
        found = left.join(right, "key").where((F.col("left") == F.col("of")) & (F.col("left") == longer - m.edits(a, b))).select("value", "term")
        over = m.by_parts + 1
        values, terms = (x.where(F.char_length("text") >= over - m.deleted(over)) for x in (values, terms))
    order = gram_order(terms)
    left = indexed(values, order, m).select(F.col("text").alias("value"), F.col("n").alias("a"), "by", "key")
    right = indexed(terms, order, m).select(F.col("text").alias("term"), F.col("n").alias("b"), "by", "key")
    need = m.shared(a, b)
    met = left.join(right, ["by", "key"]).where((need <= F.least(a, b)) & ((F.col("by") == 2) | ~_middle(a, m) | ~_middle(b, m)))
    met = met.where(longer > m.by_parts).select("value", "term")
    return met if found is None else found.unionByName(met)


def candidates(values: DataFrame, terms: DataFrame, m: Measure) -> DataFrame:
    """(value, term): all pairs that may reach the cutoff, each once."""
    pairs = _met(values, terms, m).distinct()
    common = F.size(F.array_intersect(grams(F.col("value")), grams(F.col("term"))))
    return pairs.where(common >= m.shared(F.char_length("value"), F.char_length("term")))


def _ratio_udf(cutoff: float):
    matcher = difflib.SequenceMatcher            # shipped by reference: the standard library

    @F.pandas_udf("double")
    def ratio(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        s = matcher()
        for values, terms in batches:
            out, last = [], None
            for v, t in zip(values, terms):
                if v != last:                    # what the matcher knows of a value is kept over its terms
                    s.set_seq2(v)
                    last = v
                s.set_seq1(t)
                out.append(s.ratio() if s.real_quick_ratio() >= cutoff and s.quick_ratio() >= cutoff else None)
            yield pd.Series(out, dtype="float64")
    return ratio


def _scored(values: DataFrame, terms: DataFrame, m: Measure) -> DataFrame:
    """As ``matches``, some pairs more than once."""
    values, terms = (df.where(F.char_length("text") > 0) for df in (values, terms))
    if m.kind == "ratio":
        by_value = candidates(values, terms, m).repartition("value", "term").sortWithinPartitions("value")
        return by_value.withColumn("score", _ratio_udf(m.cutoff)("value", "term")).where(F.col("score") >= m.cutoff)
    a, b = F.char_length("value"), F.char_length("term")
    # the distance of two short texts costs less than bringing equal pairs together
    return _met(values, terms, m).withColumn("edits", F.levenshtein("value", "term")).where(F.col("edits") <= m.edits(a, b)).select(
        "value", "term", (1 - F.col("edits") / F.greatest(a, b)).alias("score"))


def matches(values: DataFrame, terms: DataFrame, m: Measure) -> DataFrame:
    """(value, term, score) of every pair at the cutoff or above. ``values``
    and ``terms`` have one column ``text`` of distinct texts; empty ones match
    nothing."""
    return _scored(values, terms, m).distinct()


def closest(values: DataFrame, terms: DataFrame, m: Measure) -> DataFrame:
    """(value, term, score): the best term of each value that has one; of equal
    scores the larger term."""
    best = _scored(values, terms, m).groupBy("value").agg(F.max(F.struct("score", "term")).alias("best"))
    return best.select("value", F.col("best.term").alias("term"), F.col("best.score").alias("score"))


def closest_folded(values: DataFrame, terms: DataFrame, m: Measure) -> DataFrame:
    """As ``closest``, and values without a match are tried once more in lower
    case against the terms in lower case; of terms that are equal then, the one
    of lowest ``rank`` counts. ``terms``: (text, rank)."""
    distinct = staged(terms.select("text").distinct(), "terms")
    values = staged(values.select("text").distinct(), "values")
    exact = staged(closest(values, distinct, m), "closest")
    rest = staged(values.join(exact, values.text == exact.value, "left_anti").withColumn("low", F.lower("text")), "rest")
    low_terms = terms.groupBy(F.lower("text").alias("low")).agg(F.min(F.struct("rank", "text")).alias("first"))
    lows, folded = rest.select(F.col("low").alias("text")).distinct(), low_terms.select(F.col("low").alias("text"))
    # a text that was itself without a match has met all terms that are lower case as they stand
    tried = rest.select("text")
    low = closest(lows.join(tried, "text", "left_anti"), folded, m).unionByName(
        closest(lows.join(tried, "text", "left_semi"), folded.join(distinct, "text", "left_anti"), m))
    low = low.join(low_terms, low.term == low_terms.low).select(F.col("value").alias("v"), F.col("first.text").alias("term"), "score")
    folded = rest.join(low, rest.low == low.v).select(F.col("text").alias("value"), "term", "score")
    return exact.unionByName(folded)
