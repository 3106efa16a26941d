"""License scan: MinHash bands over overlapping windows retrieve templates,
exact shingle containment verifies them.

Words are runs of ASCII letters and digits, lower-cased; shingles are five
consecutive words. For a template of m words every window of m consecutive
document words is a window of its own (a shorter document is one window). Windows
and templates have ``BANDS`` bands of one minimum each, every one under an order
of its own: a bit flip that begins with other leading bits. A window that holds a
share c of a template's shingles is similar to it by c / (2 - c) at least, so at
0.8 it shares a band with 1 - (1/3)^16, all but one in 43 million. Only windows
that hold a shingle of the template are given bands, as no other can share one.
What shares a band is kept if at least ``LEAST`` of the template's distinct
shingles are in the window, by their hashes and then compared as words.

Documents without any shingle of a template need no windows; the test is exact.
Templates are a fixed table of the library, not data.

Row rules: null text has no words and no license. Each row is scanned by itself,
so repeated rows, further columns and empty tables are plain cases.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, stored, text_or_empty
from .decontaminate import at_each, gram_hashes

SHINGLE, LEAST, BANDS = 5, 0.8, 16
WORD = "[a-z0-9]+"

# Usual license notices (identifier, whether terms are restrictive, text).
TEMPLATES = [
    ("MIT", False, "Released under the MIT License."),
    ("MIT", False, "Licensed under the MIT License."),
    ("MIT", False, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", False, "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", False, "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", True, "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", True, "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("LGPL", True, "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("AGPL", True, "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("CC-BY-NC-4.0", True, "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", False, "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", False, "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", True, "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("BSD", False, "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", False, "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", False, "This is free and unencumbered software released into the public domain."),
]


def words(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0))


def shingles(w: Column) -> Column:
    """Distinct shingles as texts."""
    return F.array_distinct(at_each(F.size(w) - (SHINGLE - 1), lambda i: F.array_join(F.slice(w, i, SHINGLE), " ")))


def masks(n: int) -> list[int]:
    """Bit flips whose leading bits spread evenly."""
    return [int.from_bytes(bytes((k * 256 // n if p == 0 else (k * 101 + p * 57 + 13) % 256) for p in range(8)), "big", signed=True)
            for k in range(n)]


def bands(grams: Column) -> Column:
    """One minimum per band of an array of shingle hashes."""
    return F.array(*[F.array_min(F.transform(grams, lambda h: h.bitwiseXOR(F.lit(m)))) for m in masks(BANDS)])


def signatures(templates: DataFrame) -> DataFrame:
    """(template, license, restrictive, m words, shingles, grams: their hashes,
    bands, h: each hash) from (license, restrictive, text), one row per hash;
    null for notices of fewer than five words."""
    known = templates.select(F.xxhash64("license", "text").alias("template"), "license", "restrictive", words(F.col("text")).alias("w"))
    known = known.select("*", F.size("w").alias("m"), F.array_sort(F.array_distinct(gram_hashes(F.col("w"), SHINGLE))).alias("grams"))
    return known.select("template", "license", "restrictive", "m", shingles(F.col("w")).alias("shingles"), "grams", bands(F.col("grams")).alias("bands"),
                        F.explode_outer("grams").alias("h"))


def matches(docs: DataFrame, templates: DataFrame, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(all rows with a row number and n_words, matches: row, license,
    restrictive, first word, words, containment)."""
    signs = stored(signatures(templates), "templates")
    found = signs.select("m", "h").collect()                      # a few rows per template
    if any(r.m < SHINGLE for r in found):
        raise ValueError("a template needs at least five words")
    keys = sorted({r.h for r in found})
    rest = [c for c in docs.columns if c != text_col]
    split = docs.select(*rest, words(text_or_empty(text_col)).alias("w")).withColumn("g", gram_hashes(F.col("w"), SHINGLE))
    possible = F.arrays_overlap("g", F.lit(keys).cast("array<bigint>"))
    rows = stored(split.select(*rest, F.size("w").cast("long").alias("n_words"), F.when(possible, F.col("w")).alias("w"),
                               F.monotonically_increasing_id().alias("row")), "scanned")
    some = stored(rows.where(F.col("w").isNotNull()).select("row", "w", gram_hashes(F.col("w"), SHINGLE).alias("g")), "possible")
    # windows that hold a shingle of the template, each once
    spots = some.select("row", F.posexplode("g").alias("at", "h")).join(signs.select("template", "m", "h"), "h").drop("h")
    sized = spots.join(some.select("row", "g"), "row").withColumn("size", F.size("g") + SHINGLE - 1)
    first = F.greatest(F.col("at") - F.col("m") + SHINGLE, F.lit(0))
    last = F.least(F.col("at"), F.greatest(F.col("size") - F.col("m"), F.lit(0)))
    windows = sized.where(first <= last).select("row", "template", F.explode(F.sequence(first, last)).alias("first")).distinct()
    windows = windows.join(some.select("row", "g"), "row").join(
        signs.select("template", "m", "grams", F.col("bands").alias("own")).dropDuplicates(["template"]), "template").select(
        "row", "template", "first", "grams", "own", F.slice("g", F.col("first") + 1, F.col("m") - SHINGLE + 1).alias("g"))
    shared = windows.where(F.exists(F.zip_with(bands(F.col("g")), "own", lambda x, y: x == y), lambda x: x))
    held = F.size(F.array_intersect("grams", "g")) / F.size("grams")
    hit = shared.where(held >= LEAST).select("row", "template", "first")
    known = signs.drop("h", "grams", "bands").dropDuplicates(["template"])
    checked = hit.join(known, "template").join(rows.select("row", "w"), "row").select(
        "row", "license", "restrictive", "first", F.least("m", F.size("w") - F.col("first")).alias("words"),
        (F.size(F.array_intersect("shingles", shingles(F.slice("w", F.col("first") + 1, F.col("m"))))) / F.size("shingles")).alias("containment"))
    return rows.drop("w"), stored(checked.where(F.col("containment") >= LEAST), "matches")


def scan(docs: DataFrame, templates: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, licenses (sorted, comma-joined),
    n_licenses, containment (best, 0 if none), restrictive (any of them)."""
    rows, found = matches(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), templates, "text")
    per_row = found.groupBy("row").agg(F.sort_array(F.collect_set("license")).alias("names"), F.max("containment").alias("best"),
                                       F.max("restrictive").alias("restrictive"))
    return rows.join(per_row, "row", "left").select(
        F.col("id").alias(id_col), "n_words", F.coalesce(F.array_join("names", ","), F.lit("")).alias("licenses"),
        F.coalesce(F.size("names"), F.lit(0)).cast("long").alias("n_licenses"),
        F.coalesce("best", F.lit(0.0)).alias("containment"), F.coalesce("restrictive", F.lit(False)).alias("restrictive"))


def template_table(spark) -> DataFrame:
    return spark.createDataFrame(TEMPLATES, "license string, restrictive boolean, text string")


def scan_sql() -> str:
    """All windows of every template's length, without any hashing."""
    values = ", ".join(f"('{n}', {r}, '{t}')" for n, r, t in TEMPLATES)
    take = lambda c: f"regexp_extract_all(translate(coalesce({c}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}')"
    return f"""
WITH t AS (SELECT row_number() OVER () AS t, license, restrictive, {take('text')} AS w FROM (VALUES {values}) v(license, restrictive, text)),
ts AS (SELECT DISTINCT t, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT t, w, unnest(generate_series(1, len(w) - 4)) AS i FROM t)),
tn AS (SELECT t, license, restrictive, len(w) AS m, (SELECT count(*) FROM ts WHERE ts.t = t.t) AS n FROM t),
d AS (SELECT doc_id, {take('text')} AS w FROM documents),
ds AS (SELECT doc_id, i, len(w) AS size, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 4)) AS i FROM d)),
hit AS (SELECT doc_id, t, i, s, m, n, size FROM ds JOIN ts USING (s) JOIN tn USING (t)),
win AS (SELECT DISTINCT doc_id, t, m, n, unnest(generate_series(greatest(1, i - m + 5), least(i, greatest(size - m + 1, 1)))) AS f FROM hit),
got AS (SELECT win.doc_id, win.t, f, count(DISTINCT s) / any_value(win.n) AS containment
        FROM win JOIN hit ON hit.doc_id = win.doc_id AND hit.t = win.t AND i BETWEEN f AND f + win.m - 5 GROUP BY win.doc_id, win.t, f),
best AS (SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses, count(DISTINCT license) AS n_licenses,
                max(containment) AS containment, bool_or(restrictive) AS restrictive
         FROM got JOIN tn USING (t) WHERE containment >= {LEAST} GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(licenses, '') AS licenses, coalesce(n_licenses, 0) AS n_licenses,
       coalesce(containment, 0) AS containment, coalesce(restrictive, false) AS restrictive
FROM d LEFT JOIN best USING (doc_id)"""
