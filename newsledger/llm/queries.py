"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, context_mixing, decontaminate, exact_dedup, license_scan, line_dedup, link_graph, quality, simhash_dedup, squares, surrogates, treap, wavelet
from .common import hashed_id, read


TOKENIZER = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
QUALITY_FOLDS, QUALITY_LEAST = 5, 0.3


def op1_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    _, learn, tune = context_mixing.folds("id", 7, 2)
    held_out = context_mixing.folds("doc_id", 7, 2)[0]
    scored = context_mixing.score(docs, learn, tune)
    return scored.select("doc_id", held_out.alias("held_out"), *[c for c in scored.columns if c != "doc_id"])


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.cleaned(docs).select("doc_id", "n_lines", F.size("copies").cast("long").alias("n_dropped"), "kept",
                                           F.sha2("text", 256).alias("text_sha256"), "copies")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read(spark, sf_dir, "documents"), *TOKENIZER)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(read(spark, sf_dir, "documents"))


#: Of the registered query; a run on real data passes its own secret.
SURROGATE_KEY = "newsledger"


def op6_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replace(docs, SURROGATE_KEY)


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.groups(read(spark, sf_dir, "documents"))


#: (verdict, host, path)
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op8_link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_graph.judge(read(spark, sf_dir, "pages"), URL_RULES)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read(spark, sf_dir, "documents"), license_scan.template_table(spark))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = hashed_id("doc_id") % QUALITY_FOLDS == 0
    model = quality.train(docs, read(spark, sf_dir, "labels"), "quality", ~held_out)
    scored = quality.score(docs, model, carry=["doc_id"])
    return scored.select("doc_id", held_out.alias("held_out"), "score",
                         F.when(F.col("score") >= QUALITY_LEAST, 1).otherwise(0).alias("predicted"))


#: The end id that the contract appends to every text.
WORD_TOKENIZER, END_ID = public_tokenizers.path("word_bpe_49k.json"), 2


def op11_wavelet_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return wavelet.spans(wavelet.write(docs, WORD_TOKENIZER, END_ID), docs.schema["doc_id"].dataType.simpleString())


LISTED = 50


def op12_k2_treap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treap.search(treap.build(read(spark, sf_dir, "documents")), read(spark, sf_dir, "benchmark"), LISTED)


def op13_square_catching(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return squares.report(docs, text_col=squares.planted("doc_id", "text"))


QUERIES = {f.__name__: f for f in (op1_context_mixing, op2_line_dedup, op3_decontaminate, op4_byte_bpe, op5_exact_dedup, op6_surrogates, op7_simhash_dedup, op8_link_graph,
                                  op9_license_scan, op10_quality_classifier, op11_wavelet_matrix, op12_k2_treap, op13_square_catching)}

SQL = {
    "op8_link_graph": link_graph.judge_sql(URL_RULES),
    "op9_license_scan": license_scan.scan_sql(),
    "op3_decontaminate": r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(coalesce(text, ''),
       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
sized AS (SELECT item, w, least(13, len(w)) AS l FROM iw WHERE len(w) > 0),
ig AS (SELECT DISTINCT item, l, array_to_string(w[i:i + l - 1], ' ') AS g
       FROM (SELECT item, w, l, unnest(generate_series(1, len(w) - l + 1)) AS i FROM sized)),
dg AS (SELECT doc_id, l, p, array_to_string(w[p:p + l - 1], ' ') AS g
       FROM (SELECT doc_id, w, l, unnest(generate_series(1, len(w) - l + 1)) AS p FROM dw, (SELECT DISTINCT l FROM sized) WHERE len(w) >= l)),
hit AS (SELECT DISTINCT doc_id, item, l, p FROM dg JOIN ig USING (l, g)),
covered AS (SELECT doc_id, count(DISTINCT x) AS n_hit
            FROM (SELECT doc_id, unnest(generate_series(p, p + l - 1)) AS x FROM hit) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)""",
    "op5_exact_dedup": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS raw,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256
FROM d WINDOW w AS (PARTITION BY norm ORDER BY length(raw) DESC, doc_id)""",
    "op12_k2_treap": r"""
WITH dt AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
it AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
len AS (SELECT doc_id, count(*) AS n FROM dt GROUP BY doc_id),
total AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM len),
m AS (SELECT doc_id, 100 - 50 + ((50 * n * nn) // ll) AS m FROM len, total),
tf AS (SELECT doc_id, term, count(*) AS tf FROM dt WHERE term IN (SELECT term FROM it) GROUP BY doc_id, term),
w AS (SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
      FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total),
scored AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
           FROM it JOIN tf USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 50""",
}
