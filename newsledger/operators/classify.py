"""Relevance classification and field extraction with a pluggable model.

A model is either
* an expression model (``reply_expr(text) -> Column``): runs inside the JVM,
  e.g. the deterministic ``RuleScorer`` used for checkable runs; or
* a Python callable ``f(list[str]) -> list[str]`` (a hosted or local model
  client): run over Arrow batches on the partitions, one record per call, with
  retry and exponential backoff per record.

A Python model gets the prompt and a flag; records without the flag (invalid
content, irrelevant rows) are not sent. The answers are stored in the shared
folder before the next stage, so no record is sent twice and none is lost.
"""

from __future__ import annotations

import math
import time
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.model import label_from_reply, render_template, reply_fields
from ..functions.predicates import content_is_valid, is_labelled
from ..session import staged
from .incremental import content_for_classification
from .reports import OUTCOME_CLASSIFICATION_FAILED, OUTCOME_EMPTY, OUTCOME_EXTRACTED, OUTCOME_FAILED, OUTCOME_IRRELEVANT

REPLY_SCHEMA = T.StructType([
    T.StructField("reply", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("attempts", T.IntegerType()),
    T.StructField("success", T.BooleanType()),
    T.StructField("response_ms", T.LongType()),
])


@dataclass(frozen=True)
class RuleScorer:
    """Deterministic classifier: replies '1' when the text matches the
    pattern, else '0'."""
    pattern: str

    def reply_expr(self, text: Column) -> Column:
        return F.when(F.coalesce(text.rlike(self.pattern), F.lit(False)), F.lit("1")).otherwise(F.lit("0"))


@dataclass(frozen=True)
class RuleExtractor:
    """Deterministic extractor: replies with a JSON object whose fields are
    the first match of a regex per field (group 1) in the text."""
    field_patterns: tuple   # ((field, regex), ...)

    def reply_expr(self, text: Column) -> Column:
        return F.to_json(F.struct(*[F.nullif(F.regexp_extract(text, p, 1), F.lit("")).alias(f)
                                    for f, p in self.field_patterns]))


def call_with_retry(fn, record: str, max_retries: int = 3, delay: float = 1.0, sleep=time.sleep):
    """Call ``fn([record])`` up to ``max_retries`` times, waiting ``delay * 2**attempt``
    in between. Returns (reply or None, error or None, attempts). Never raises:
    a raising model and an answer that is not one reply are both errors."""
    return _retrying_caller()(fn, record, max_retries, delay, sleep)


def _retrying_caller():
    # Built inside a function so UDFs ship it by value (executors need only
    # the standard library, not this package).
    def call(fn, record, max_retries, delay, sleep):
        err = None
        for attempt in range(max(1, max_retries)):
            try:
                replies = list(fn([record]))
                if len(replies) == 1:
                    return (None if replies[0] is None else str(replies[0])), None, attempt + 1
                err = f"expected one reply, got {len(replies)}"
            except Exception as e:  # the model client's failure is data, not a task failure
                err = f"{type(e).__name__}: {e}"
            if attempt + 1 < max_retries:
                sleep(delay * (2 ** attempt))
        return None, err, max(1, max_retries)
    return call


def model_udf(fn, max_retries: int = 3, delay: float = 1.0):
    """Wrapper of a Python model callable over (prompt, needed): the model sees
    one record per call and only records that are needed; the others get a null
    response. One failing record fails alone."""
    caller = _retrying_caller()

    def call(prompts: pd.Series, needed: pd.Series) -> pd.DataFrame:
        import time as _time
        rows = []
        for prompt, need in zip(prompts, needed):
            if not need:
                rows.append((None, None, None, None, None))
                continue
            t0 = _time.monotonic()
            reply, err, attempts = caller(fn, prompt, max_retries, delay, _time.sleep)
            rows.append((reply, err, attempts, err is None and reply is not None, int((_time.monotonic() - t0) * 1000)))
        out = pd.DataFrame(rows, columns=["reply", "error", "attempts", "success", "response_ms"])
        return out.astype({"attempts": "Int32", "success": "boolean", "response_ms": "Int64"})
    return F.pandas_udf(call, REPLY_SCHEMA).asNondeterministic()


def responses(df: DataFrame, model, prompt: Column, needed: Column, out: str) -> DataFrame:
    """Add the response record ``out`` (reply, error, attempts, success,
    response_ms). A Python model runs once: its answers are stored before
    anything reads them, and no row is split off or joined back."""
    if hasattr(model, "reply_expr"):
        reply = F.when(needed, model.reply_expr(prompt))
        none = F.lit(None)
        return df.withColumn("_reply", reply).withColumn(out, F.struct(
            F.col("_reply").alias("reply"), none.cast("string").alias("error"), F.when(needed, F.lit(1)).alias("attempts"),
            F.when(needed, F.col("_reply").isNotNull()).alias("success"), none.cast("long").alias("response_ms"))).drop("_reply")
    return staged(df.withColumn(out, model_udf(model)(prompt, needed)), out)


def _prompt(template: str | None, text_col: str, slots: dict | None) -> Column:
    return render_template(template, content=F.col(text_col), **(slots or {})) if template else F.col(text_col)


def classify(df: DataFrame, model, text_col: str = "content", template: str | None = None,
             out: str = "is_relevant", keep_response: str | None = None) -> DataFrame:
    """Add ``out`` (0/1) and ``outcome``. Invalid content gets 0 without a
    model call; an unparsable reply is 0; a failed call is 0 with outcome
    ``classification_failed``, which the next run retries. ``keep_response``
    names a column for the response record."""
    rec = unused_name(df, keep_response or "_response")
    valid = content_is_valid(text_col)
    called = responses(df.withColumn("_valid", valid), model, _prompt(template, text_col, None), F.col("_valid"), rec)
    ok = F.col("_valid") & F.coalesce(F.col(rec)["success"], F.lit(False))
    out_df = called.withColumn(out, F.when(ok, label_from_reply(F.col(rec)["reply"])).otherwise(F.lit(0))).withColumn(
        "outcome", F.when(~F.col("_valid"), F.lit(OUTCOME_EMPTY))
        .when(~ok, F.lit(OUTCOME_CLASSIFICATION_FAILED))
        .when(F.col(out) == 1, F.lit("relevant"))
        .otherwise(F.lit(OUTCOME_IRRELEVANT)))
    return out_df.drop("_valid", *([] if keep_response else [rec]))


def extract(df: DataFrame, model, fields, text_col: str = "content", template: str | None = None,
            relevant: str = "is_relevant", slots: dict | None = None, keep_response: str | None = None) -> DataFrame:
    """Extract ``fields`` (text) for relevant rows only; outcome becomes
    'extracted' or 'extraction_failed' for them. Other rows get null fields.
    ``slots`` fills the template's further placeholders."""
    rec = unused_name(df, keep_response or "_response")
    is_rel = F.coalesce(F.col(relevant) == 1, F.lit(False))
    called = responses(df.withColumn("_need", is_rel & F.col(text_col).isNotNull()), model,
                       _prompt(template, text_col, slots), F.col("_need"), rec)
    out = called.withColumn("_x", reply_fields(F.col(rec)["reply"], fields))
    out = out.select(*[F.col(f"`{c}`") for c in out.columns if c not in fields and c not in ("_x", "_need")],
                     *[F.col("_x")[f].alias(f) for f in fields], F.coalesce(F.col("_x.ok"), F.lit(False)).alias("_ok"))
    return out.withColumn("outcome", F.when(is_rel & F.col("_ok"), F.lit(OUTCOME_EXTRACTED))
                          .when(is_rel, F.lit(OUTCOME_FAILED))
                          .otherwise(F.col("outcome"))).drop("_ok", *([] if keep_response else [rec]))


def unused_name(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name


def update_labels(table: DataFrame, model, text_col: str = "content", context_col: str = "context",
                  label: str = "is_news", template: str | None = None) -> DataFrame:
    """Label the rows without a 0/1 label: from the content, else the context.
    Labelled rows keep theirs and are never sent; no text or a failed call give
    a null label. Adds ``label_status``: skipped, updated, no_content or error."""
    labelled = is_labelled(label)
    content = content_for_classification(F.col(text_col), F.col(context_col))
    rows = table.withColumn("_text", content).withColumn("_need", ~labelled & F.col("_text").isNotNull())
    called = responses(rows, model, _prompt(template, "_text", None), F.col("_need"), "_response")
    ok = F.col("_need") & F.coalesce(F.col("_response.success"), F.lit(False))
    status = (F.when(labelled, "skipped").when(ok, "updated").when(F.col("_need"), "error").otherwise("no_content"))
    new = F.when(labelled, F.col(label)).when(ok, label_from_reply(F.col("_response.reply")))
    return called.withColumn("label_status", status).withColumn(label, new).drop("_text", "_need", "_response")


def processing_status(relevant: Column) -> Column:
    return F.when(relevant == 1, F.lit("extracted")).otherwise(F.lit("irrelevant"))


# --------------------------------------------------------------------------
# trained local classifier and the two-stage (local, then fallback) classify
# --------------------------------------------------------------------------
def text_pipeline(model_type: str = "nb", num_features: int = 1 << 16):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression, NaiveBayes
    from pyspark.ml.feature import HashingTF, IDF, Tokenizer

    tok = Tokenizer(inputCol="text", outputCol="_tokens")
    tf = HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=num_features)
    idf = IDF(inputCol="_tf", outputCol="features")
    clf = NaiveBayes(labelCol="label") if model_type == "nb" else LogisticRegression(labelCol="label", maxIter=50)
    return Pipeline(stages=[tok, tf, idf, clf])


HELD_OUT = 5           # one in so many ids is held out


def id_fold(id_col: Column, n: int, salt: str = "") -> Column:
    """Fold 0 to n - 1 of a row by its id: the same on every run, however the
    rows are partitioned."""
    return F.pmod(F.xxhash64(F.lit(salt), id_col.cast("string")), F.lit(n)).cast("int")


def train_classifier(labelled: DataFrame, model_type: str = "nb", folds: int = 3, gate: float = 0.70,
                     id_col: str | None = None, num_features: int = 1 << 16):
    """Fit on (text, label); report accuracy on held-out rows, the
    cross-validated mean/std accuracy and whether the 0.70 gate passes. Held-out
    rows and folds go by the hash of ``id_col`` (without one, of the text, so that
    copies stay together). Rows without text or label are left out.
    Returns (PipelineModel, metrics DataFrame)."""
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    by = F.col(id_col or "text")
    data = labelled.where(F.col("text").isNotNull() & F.col("label").isNotNull()).select(
        "text", F.col("label").cast("double").alias("label"),
        (id_fold(by, HELD_OUT) == 0).alias("held_out"), id_fold(by, folds, "folds").alias("fold"))
    data = staged(data, "labelled")
    train, test = data.where("NOT held_out").drop("held_out"), data.where("held_out")
    ev = MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy")
    cv = CrossValidator(estimator=text_pipeline(model_type, num_features), estimatorParamMaps=ParamGridBuilder().build(), evaluator=ev,
                        numFolds=folds, foldCol="fold", collectSubModels=False)
    cv_model = cv.fit(train)
    acc = ev.evaluate(cv_model.transform(test))
    metrics = labelled.sparkSession.createDataFrame(
        [(model_type, train.count(), test.count(), float(acc), float(cv_model.avgMetrics[0]), float(cv_model.stdMetrics[0]), bool(acc >= gate))],
        "model_type string, n_train long, n_held_out long, accuracy double, cv_mean double, cv_std double, passed_gate boolean")
    return cv_model.bestModel, metrics


@dataclass(frozen=True)
class WordWeights:
    """Expression model: label and confidence of a text from the weights of its
    different words, all inside the JVM. Weights are thousandths of log odds."""
    weights: tuple         # ((word, weight), ...)
    bias: int = 0

    def margin(self, text: Column) -> Column:
        known = F.create_map(*[F.lit(x) for pair in self.weights for x in pair]) if self.weights else F.create_map().cast("map<string,int>")
        words = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)))
        return F.aggregate(words, F.lit(self.bias).cast("long"), lambda s, w: s + F.coalesce(F.element_at(known, w), F.lit(0)))

    def scored_expr(self, text: Column) -> Column:
        """STRUCT<label INT, confidence DOUBLE>."""
        return F.get(F.transform(F.array(self.margin(text)), lambda m: F.struct(
            (m > 0).cast("int").alias("label"), (1 / (1 + F.exp(-F.abs(m) / 1000.0))).alias("confidence"))), 0)


WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def fit_word_weights(labelled: DataFrame, words: int = 64, least_rows: int = 5) -> WordWeights:
    """Word weights of (text, label 0/1): log odds of a word's rows in both
    classes, add-one smoothed, of the ``words`` words with the greatest ones that
    occur in ``least_rows`` rows at least. One aggregate over the words of all rows;
    the model, its size a parameter, is what comes to the driver."""
    data = labelled.where(F.col("text").isNotNull() & F.col("label").isin(0, 1)).select("text", F.col("label").cast("int").alias("label"))
    ones, zeros = data.agg(F.coalesce(F.sum("label"), F.lit(0)), F.coalesce(F.sum(1 - F.col("label")), F.lit(0))).first()
    each = data.select("label", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)))).alias("word"))
    n = each.groupBy("word").agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b")).where(F.col("a") + F.col("b") >= least_rows)
    weight = F.floor(1000 * F.log((F.col("a") + 1) * (zeros + 2) / ((F.col("b") + 1) * (ones + 2)))).cast("int")
    best = n.select("word", weight.alias("w")).orderBy(F.desc(F.abs("w")), "word").limit(words).collect()
    return WordWeights(tuple((r.word, r.w) for r in best), math.floor(1000 * math.log((ones + 1) / (zeros + 1))))


def two_stage_classify(df: DataFrame, local_model, fallback, text_col: str = "content",
                       threshold: float = 0.6, out: str = "is_relevant") -> DataFrame:
    """Local model first; rows whose confidence (max class probability) is
    below ``threshold`` go to the fallback model. The local model is a fitted
    pipeline or an expression model that gives label and confidence
    (``scored_expr``); with an expression fallback no row leaves the JVM. Adds
    confidence, method_used and fallback_triggered."""
    # the local model needs a text; rows without valid content are unsure by definition
    text = unused_name(df, "text") if text_col != "text" else "text"
    given = df if text_col == "text" else df.withColumn("text", F.col(text_col)) if text == "text" else \
        df.withColumnRenamed("text", text).withColumn("text", F.col(text_col))
    filled = given.withColumn("_raw", F.col("text")).withColumn("text", F.coalesce(F.col("text"), F.lit("")))
    if hasattr(local_model, "scored_expr"):
        scored = filled.withColumn("_scored", local_model.scored_expr(F.col("text"))).withColumn(
            "confidence", F.when(content_is_valid("_raw"), F.col("_scored.confidence"))).withColumn("_local", F.col("_scored.label")).drop("_scored")
    else:
        from pyspark.ml.functions import vector_to_array
        scored = local_model.transform(filled).withColumn("confidence", F.when(
            content_is_valid("_raw"), F.array_max(vector_to_array(F.col("probability")))))
        scored = scored.withColumn("_local", F.col("prediction").cast("int")).drop(
            "_tokens", "_tf", "features", "rawPrediction", "probability", "prediction")
    unsure = F.coalesce(F.col("confidence") < threshold, F.lit(True))
    called = responses(scored.withColumn("_unsure", unsure).withColumn("_need", F.col("_unsure") & content_is_valid("_raw")),
                       fallback, F.col("_raw"), F.col("_need"), "_response")
    ok = F.col("_need") & F.coalesce(F.col("_response.success"), F.lit(False))
    out_df = called.withColumn(out, F.when(~F.col("_unsure"), F.col("_local")).when(
        ok, label_from_reply(F.col("_response.reply"))).otherwise(F.lit(0))).withColumn(
        "method_used", F.when(F.col("_unsure"), "fallback").otherwise("local")).withColumn("fallback_triggered", F.col("_unsure")).withColumn(
        "error_details", F.col("_response.error"))
    drop = ["_raw", "_local", "_unsure", "_need", "_response"]
    if text_col != "text":
        out_df = out_df.drop("text")
        out_df = out_df.withColumnRenamed(text, "text") if text != "text" else out_df
    else:
        out_df = out_df.withColumn("text", F.col("_raw"))
    return out_df.drop(*drop)


def save_classifier(model, path: str) -> None:
    """Write a trained pipeline (overwriting) to shared storage."""
    model.write().overwrite().save(path)


def load_classifier(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)
