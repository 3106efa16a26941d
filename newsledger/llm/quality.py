"""Quality classifier: supervised subword embeddings.

A document is the average of the vectors of its words and character n-grams
(hashed into ``buckets`` rows; a word that repeats the one before it counts as
one and the same token, whatever the word); a softmax layer on the average gives the class
probabilities. Vectors and layer are learned together by stochastic gradient
descent in numpy.

Spark hashes the features of the labelled documents in parallel; at most
``sample_docs`` of them (those with the smallest hash of the id, a documented
bound) are used to fit, as sparse counts of at most ``buckets`` entries each,
in one task. The fitted model has a fixed size and is broadcast. Scoring reads
every whole text in its own task, in slices of bounded size, without a shuffle.

White space is [\\x20\\x09-\\x0D]. An n-gram has no white space inside, but may
begin or end with the space beside its word.

Row rules: null text counts as empty; a text without words scores 0.5. Rows with a null label are not learned from; a repeated
label counts once, and of repeated ids the smallest text is learned from. With no labelled row, or labels of one kind only, scores are that
kind's constant (0.5 without any). Ties have no meaning here; repeated rows are
scored each. Only id and text are read for a score, so other columns (also of
the same names as labels') never matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS_LOG2, DIM, EPOCHS, RATE = 18, 8, 10, 0.5
SAMPLE_DOCS = 4000
NGRAMS = (3, 4, 5)
SLICE = 1 << 16               # characters looked at at once
PRIME = np.uint32(0x01000193)
SPREAD = np.uint32(0x9E3779B1)
AGAIN = np.uint32(0x5BD1E995)  # stands for a word that repeats the one before


def codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts with a space around each, and where each
    begins. White space becomes a space."""
    joined = " " + " ".join(t + " " for t in texts)
    c = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").copy()
    c[(c >= 9) & (c <= 13)] = 32
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 2
    return c, np.cumsum(lengths) - lengths


def features(c: np.ndarray, log2: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, buckets) of the words and of the n-grams of each length."""
    shift = np.uint32(32 - log2)
    space = c == 32
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    first, last = edge[0::2], edge[1::2]               # c begins and ends with a space
    if len(first):
        # hash of a word: sum of its mixed (code point, place in word) pairs
        place = (np.arange(len(c)) - np.repeat(np.concatenate([[0], first]), np.diff(np.concatenate([[0], first, [len(c)]])))).astype(np.uint32)
        mixed = (c + np.uint32(1)) * SPREAD ^ (place * PRIME)
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0x85EBCA6B)
        mixed[space] = 0
        words = np.add.reduceat(mixed, first, dtype=np.uint32) * SPREAD
        words[1:][words[1:] == words[:-1]] = AGAIN
        yield first, (words >> shift).astype(np.int64)
    spaces = np.concatenate([[0], np.cumsum(space, dtype=np.int32)])
    h = c.copy()
    for n in range(2, max(NGRAMS) + 1):
        if len(c) < n:
            return
        h = h[:-1] * PRIME + c[n - 1:]
        if n in NGRAMS:
            at = np.flatnonzero(spaces[n - 1:len(c)] == spaces[1:len(c) - n + 2])
            g = h[at]
            g = (g ^ (g >> np.uint32(13))) * SPREAD + np.uint32(n)
            yield at, ((g * SPREAD) >> shift).astype(np.int64)


def slices(texts: list[str]) -> Iterator[list[tuple[int, str]]]:
    """(row, part of its text) in groups of about ``SLICE`` characters. A text
    that is longer is cut at white space; without any it stays whole."""
    group: list[tuple[int, str]] = []
    held = 0
    for row, t in enumerate(texts):
        at = 0
        while True:
            end = len(t)
            if end - at > SLICE:
                end = next((i for i in range(at + SLICE, len(t)) if t[i] in " \t\n\x0b\x0c\r"), len(t))
            group.append((row, t[at:end]))
            held += end - at
            if held >= SLICE:
                yield group
                group, held = [], 0
            if end == len(t):
                break
            at = end
    if group:
        yield group


def counts(text: str, log2: int) -> tuple[np.ndarray, np.ndarray]:
    total = np.zeros(1 << log2, np.int64)
    for group in slices([text]):
        c, _ = codes([t for _, t in group])
        for _, b in features(c, log2):
            total += np.bincount(b, minlength=1 << log2)
    found = np.flatnonzero(total)
    return found, total[found]


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], classes: int = 2, log2: int = BUCKETS_LOG2, dim: int = DIM,
        epochs: int = EPOCHS, rate: float = RATE, seed: int = 1) -> np.ndarray:
    """What each bucket adds to the classes' logits, less that of class 0."""
    rng = np.random.default_rng(seed)
    vectors = (rng.random((1 << log2, dim), np.float32) - 0.5) / dim
    layer = np.zeros((dim, classes), np.float32)
    steps, done = epochs * max(len(rows), 1), 0
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            label, at, n = rows[k]
            now = np.float32(rate * (1 - done / steps))
            done += 1
            share = (n / max(n.sum(), 1)).astype(np.float32)
            average = share @ vectors[at]
            logits = average @ layer
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            back = layer @ p
            layer -= now * np.outer(average, p)
            vectors[at] -= now * len(at) ** 0.5 * np.outer(share, back)
    weights = layer - layer[:, :1]
    return (vectors @ weights)[:, 1:].astype(np.float32)


@dataclass
class Model:
    """A fitted classifier; ``constant`` where there was nothing to tell apart."""

    table: np.ndarray | None
    log2: int = BUCKETS_LOG2
    constant: float | None = None

    def scores(self, texts: list[str]) -> np.ndarray:
        """Probability of class 1 of each text."""
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        total, n = np.zeros(len(texts)), np.zeros(len(texts))
        for group in slices(texts):
            c, starts = codes([t for _, t in group])
            rows = np.array([r for r, _ in group])
            for at, b in features(c, self.log2):
                values = np.concatenate([[0.0], np.cumsum(self.table[b, 0], dtype=np.float64)])
                cut = np.concatenate([np.searchsorted(at, starts), [len(at)]])
                np.add.at(total, rows, np.diff(values[cut]))
                np.add.at(n, rows, np.diff(cut))
        return 1 / (1 + np.exp(-(total / np.maximum(n, 1))))


def train(docs: DataFrame, labels: DataFrame, label_col: str, learn: Column, id_col: str = "doc_id", text_col: str = "text",
          sample_docs: int = SAMPLE_DOCS, log2: int = BUCKETS_LOG2) -> Model:
    """Fit on labelled rows for which ``learn`` (over the id) holds."""
    some = labels.where(learn & F.col(label_col).isin(0, 1)).select(
        F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).orderBy(
        F.xxhash64("id"), "id", "label").limit(sample_docs).distinct()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                at, n = counts(b.column(2)[row].as_py(), log2)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(row, 1), b.column(1).slice(row, 1), pa.array([at], pa.list_(pa.int32())),
                                                  pa.array([n], pa.list_(pa.int32()))], ["id", "label", "at", "n"])

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(b.column(1)[i].as_py(), b.column(2)[i].values.to_numpy(), b.column(3)[i].values.to_numpy(), b.column(0)[i].as_py())
                for b in batches for i in range(b.num_rows)]
        rows.sort(key=lambda r: (r[3], r[0], len(r[1]), r[2].sum()))   # whatever order tasks ended in
        kinds = {r[0] for r in rows}
        if len(kinds) < 2:
            yield pa.RecordBatch.from_pydict({"table": [None], "constant": [float(kinds.pop()) if kinds else 0.5]},
                                             pa.schema([("table", pa.binary()), ("constant", pa.float64())]))
            return
        table = fit([r[:3] for r in rows], log2=log2)
        yield pa.RecordBatch.from_pydict({"table": [table.tobytes()], "constant": [None]},
                                         pa.schema([("table", pa.binary()), ("constant", pa.float64())]))

    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    sample = texts.join(F.broadcast(some), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
    rows = sample.mapInArrow(hashed, f"id {kind}, label int, at array<int>, n array<int>")
    found = rows.repartition(1).mapInArrow(fitted, "table binary, constant double").head()
    if found is None or found.table is None:
        return Model(None, log2, 0.5 if found is None else found.constant)
    return Model(np.frombuffer(bytes(found.table), np.float32).reshape(-1, 1), log2)


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score", carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns (all by default) with the probability of class 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    carry = docs.columns if carry is None else carry

    given = docs.select(*carry, *([] if text_col in carry else [text_col]))
    at = given.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = shared.value.scores([t or "" for t in b.column(at).to_pylist()])
            yield pa.RecordBatch.from_arrays([*b.columns[:len(carry)], pa.array(p)], [*carry, out])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields[:len(carry)])
    return given.mapInArrow(run, f"{schema}, `{out}` double")
