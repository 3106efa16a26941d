"""Language-model scoring by logistic context mixing over bits.

A text is predicted byte by byte, each byte as eight bits from the top, and an
end byte closes it. For every bit five hashed contexts (the last 2, 3, 4 and 6
bytes and the bytes of the current word so far) look up how often the bit was
1 and 0 after them; the logits of these counts are inputs of a mixer whose
weights are the sum of two gated sets: one chosen by the bit's place and how
often the two longest contexts were seen, one by the byte's bits known so far. A refinement table (same gate, 33 steps of the mixed probability) maps
the result to the share of ones that really followed; the mean of both is coded.

Learning, all from the training documents:

1. Word counts for the base score: counted per task, summed by word in Spark.
2. Bit counts of 31 in 32 training documents: every task counts its
   windows of seven bytes, fills the hashed tables and hands them on in chunks,
   which are summed chunk by chunk while they stream in. The tables have a
   fixed size, as in any hashed model; what is summed grows with the corpus.
3. The 32nd part tunes: in each task the weights learn online from the coding
   error, the refinement table gathers what followed; Spark averages them.

Windows repeat, so each distinct window is evaluated once per task and block
(scoring keeps values of recent windows in a fixed-size table). Texts are read
in slices, so a very long one needs no more memory than many short ones.

The base score joins words with their counts: words with at least one in
``FREQUENT`` of all training tokens (so at most ``FREQUENT`` words) are
broadcast, the others are joined in Spark, one row per document and word.

Row rules: null text is empty: one end token, one end byte. Repeated rows are
scored and learned from each. Without training rows all counts are zero, the
base score is 0 and every bit has probability 1/2. A null id is hashed as the
empty text. Only id and text are read.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hashed_id, stored

ORDERS = (2, 3, 4, 6, 0)                  # 0: the current word
LOG2 = (18, 20, 21, 22, 22)               # slots of each table
DEPTH = 6                                 # bytes of context
CHUNK = 2048                              # slots that travel together
STEPS = 33
GATES = 128                               # 8 places of the bit x how often the two longest contexts were seen
NODES = 256                               # a second gate: the bits of the byte already known
GATING = (3, 4)                           # their tables
FREQUENT = 2_000_000
SLICE = 1 << 22                           # bytes looked at at once
CACHE = 22                                # log2 of remembered windows (12 bytes each)
BLOCK = 1 << 15                           # windows evaluated at once
BATCH, EPOCHS, RATE = 1 << 11, 1, 0.3
PRIME, MIX, NODE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
STARTS = np.concatenate([[0], np.cumsum([1 << n for n in LOG2])])


def slices(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, where parts begin, rows of the parts) for about ``SLICE`` bytes:
    every part has ``DEPTH`` bytes of context in front, the last of a text an end byte."""
    held, parts, rows = 0, [], []
    for row, t in enumerate(texts):
        for at in range(0, max(len(t), 1), SLICE):
            front = t[max(0, at - DEPTH):at].rjust(DEPTH, b"\0")
            part = front + t[at:at + SLICE] + (b"\0" if at + SLICE >= len(t) else b"")
            parts.append(part)
            rows.append(row)
            held += len(part)
            if held >= SLICE:
                yield _joined(parts, rows)
                held, parts, rows = 0, [], []
    if parts:
        yield _joined(parts, rows)


def _joined(parts: list[bytes], rows: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum(sizes) - sizes, np.array(rows)


def windows(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each predicted byte the byte (lowest) under the ``DEPTH`` bytes before it."""
    x = data.astype(np.uint64)
    key = x.copy()
    for j in range(1, DEPTH + 1):
        key[j:] |= x[:-j] << np.uint64(8 * j)
    real = np.ones(len(x), bool)
    for j in range(DEPTH):
        real[starts + j] = False
    return key[real]


def tally(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct windows and how often they occur."""
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    n = np.diff(np.concatenate([first, [len(keys)]])) if counts is None else (np.add.reduceat(counts, first) if len(first) else counts)
    return keys[first], n


def tallies(texts: Iterator[list[bytes]], most: int = 1 << 22) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Tallied windows of many texts, at most about ``most`` at once."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for group in texts:
        for data, starts, _ in slices(group):
            held.append(tally(windows(data, starts)))
            if sum(len(k) for k, _ in held) > most:
                merged = tally(*map(np.concatenate, zip(*held)))
                held = [merged]
                if len(merged[0]) > most // 2:
                    yield merged
                    held = []
    if held:
        yield tally(*map(np.concatenate, zip(*held)))


def contexts(keys: np.ndarray) -> list[np.ndarray]:
    """Hash of each of the contexts."""
    before = keys >> np.uint64(8)
    word = np.zeros_like(before)
    open_ = np.ones(len(keys), bool)
    for j in range(DEPTH):
        byte = (before >> np.uint64(8 * j)) & np.uint64(255)
        open_ = open_ & (byte > 32)
        word |= np.where(open_, byte << np.uint64(8 * j), np.uint64(0))
    out = []
    for k, o in enumerate(ORDERS):
        c = before & np.uint64((1 << 8 * o) - 1) if o else word
        h = (c + np.uint64(k + 1)) * PRIME
        out.append((h ^ (h >> np.uint64(29))) * MIX)
    return out


def bits(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(place, bits above with a leading 1, bit) of the predicted byte."""
    byte = keys & np.uint64(255)
    for place in range(8):
        yield place, (np.uint64(1 << place) | (byte >> np.uint64(8 - place))), ((byte >> np.uint64(7 - place)) & np.uint64(1)).astype(np.int64)


def slots(hashes: list[np.ndarray], node: np.ndarray) -> list[np.ndarray]:
    salt = node * NODE
    return [(((h ^ salt) * PRIME) >> np.uint64(64 - n)).astype(np.int64) + s for h, n, s in zip(hashes, LOG2, STARTS)]


def packed(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """What a slot holds: the logit of its counts and how often it was seen
    (never, up to 3, up to 31 times, more)."""
    logit = np.rint(np.log((ones + 0.4) / (zeros + 0.4)) * 512)
    return (np.clip(logit, -4095, 4095).astype(np.int16) << 2) | np.searchsorted([1, 4, 32], zeros + ones, side="right").astype(np.int16)


@dataclass
class Mixer:
    logits: np.ndarray                    # of all tables: in 1/512, times 4, plus 0..3 for how often seen
    weights: np.ndarray                   # gate x inputs, and below them bits above x inputs; a bit uses the sum of two rows
    refined: np.ndarray                   # gate x steps: probability of a one

    @staticmethod
    def fresh(logits: np.ndarray) -> "Mixer":
        steps = 1 / (1 + np.exp(-np.linspace(-8, 8, STEPS)))
        weights = np.concatenate([np.full((GATES, len(ORDERS)), 0.3), np.zeros((NODES, len(ORDERS)))])
        return Mixer(logits, weights, np.tile(steps, (GATES, 1)))

    def inputs(self, hashes: list[np.ndarray], place: int, node: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        raw = [self.logits.take(s) for s in slots(hashes, node)]
        gate = place + 8 * (raw[GATING[0]] & 3).astype(np.int64) + 32 * (raw[GATING[1]] & 3)
        return [(r >> 2).astype(np.float32) for r in raw], gate

    def mixed(self, x: list[np.ndarray], gate: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Mixed logit, within the refinement table's range."""
        z = np.zeros(len(gate), np.float32)
        for logit, w in zip(x, (self.weights.T / 512).astype(np.float32)):
            z += logit * (w[:GATES].take(gate) + w[GATES:].take(node))
        return np.clip(z, -7.999, 7.999)

    @staticmethod
    def step(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = (z + 8) * ((STEPS - 1) / 16)
        low = at.astype(np.int64)
        return low, at - low

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """log10 probability of each window's byte after its context."""
        return np.concatenate([self._log10(keys[lo:lo + BLOCK]) for lo in range(0, len(keys), BLOCK)] or [np.zeros(0)])

    def _log10(self, keys: np.ndarray) -> np.ndarray:
        all_bits = np.ones(len(keys))                      # at least 0.0001 each
        hashes, flat = contexts(keys), self.refined.astype(np.float32).ravel()
        for place, node, bit in bits(keys):
            x, gate = self.inputs(hashes, place, node)
            z = self.mixed(x, gate, node.astype(np.int64))
            at = (z + np.float32(8)) * np.float32((STEPS - 1) / 16)
            low = at.astype(np.int32)
            part, cell = at - low, gate * STEPS + low
            left = flat.take(cell)
            p = (1 / (1 + np.exp(-z)) + left + (flat.take(cell + 1) - left) * part) * np.float32(0.5)
            all_bits *= np.where(bit == 1, p, 1 - p)
        return np.log10(all_bits)

    def learn(self, keys: np.ndarray, counts: np.ndarray, seed: int = 1) -> np.ndarray:
        """Weights by online gradient steps on the coding error; returns what
        followed each refinement step: gate x steps x (zeros, ones)."""
        rng = np.random.default_rng(seed)
        follow = np.zeros((GATES * STEPS, 2))
        self.weights = self.weights.copy()
        for epoch in range(EPOCHS + 1):
            order, rate = rng.permutation(len(keys)), RATE / (1 + epoch)
            for lo in range(0, len(keys), BATCH):
                k, n = keys[order[lo:lo + BATCH]], counts[order[lo:lo + BATCH]].astype(np.float64)
                hashes = contexts(k)
                for place, node, bit in bits(k):
                    x, gate = self.inputs(hashes, place, node)
                    z = self.mixed(x, gate, node.astype(np.int64))
                    if epoch < EPOCHS:
                        error = (bit - 1 / (1 + np.exp(-z))) * n
                        for at, sets, low in ((gate, GATES, 0), (node.astype(np.int64), NODES, GATES)):
                            seen = np.maximum(np.bincount(at, n, sets), n.mean() * 8)
                            for j in range(len(ORDERS)):
                                self.weights[low:low + sets, j] += rate * np.bincount(at, error * x[j], sets) / (512 * seen)
                    else:
                        low, part = self.step(z)
                        for cell, share in ((low, 1 - part), (low + 1, part)):
                            np.add.at(follow, (gate * STEPS + cell, bit), n * share)
        return follow


def tokens(text: bytes) -> Counter:
    """Lower-cased words and their counts, slice by slice."""
    if len(text) <= SLICE:
        return Counter(text.lower().split())
    out: Counter = Counter()
    at = 0
    while at < len(text):
        end = at + SLICE
        while end < len(text) and text[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        out.update(text[at:end].lower().split())
        at = end
    return out


def _bytes(column) -> list[bytes]:
    return [t.encode() for t in column.to_pylist()]


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def token_counts(texts: DataFrame, most: int = 1 << 18) -> DataFrame:
    """(token, c): the end of a text is the empty token."""
    schema = pa.schema([("token", pa.binary()), ("n", pa.int64())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out():
            yield pa.RecordBatch.from_pydict({"token": list(held.keys()), "n": list(held.values())}, schema)
            held.clear()
        for b in batches:
            for t in b.column(0):
                text = t.as_py().encode()
                held.update(text.lower().split() if len(text) <= SLICE else tokens(text))
                held[b""] += 1
                if len(held) > most:
                    yield from out()
        yield from out()
    return texts.select("text").mapInArrow(counted, "token binary, n long").groupBy("token").agg(F.sum("n").alias("c"))


def bit_tables(texts: DataFrame) -> np.ndarray:
    """Logits of all slots after the counts of every task are summed."""
    chunks = int(STARTS[-1]) // CHUNK

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(2 * int(STARTS[-1]), np.uint32)
        for keys, n in tallies(_bytes(b.column(0)) for b in batches):
            for lo in range(0, len(keys), 1 << 18):
                k, m = keys[lo:lo + (1 << 18)], n[lo:lo + (1 << 18)].astype(np.uint32)
                hashes = contexts(k)
                for _, node, bit in bits(k):
                    for s in slots(hashes, node):
                        np.add.at(table, 2 * s + bit, m)
        table = table.reshape(chunks, 2 * CHUNK)
        for lo in range(0, chunks, 256):
            for shift in (0, 8, 16, 24):                   # counts travel byte by byte; higher bytes are mostly empty
                part = ((table[lo:lo + 256] >> np.uint32(shift)) & np.uint32(0xFF)).astype(np.uint8)
                some = np.flatnonzero(part.any(axis=1))
                if len(some):
                    yield pa.RecordBatch.from_pydict({
                        "chunk": pa.array(some + lo, pa.int32()), "shift": pa.array(np.full(len(some), shift), pa.int32()),
                        "digits": pa.array([r.tobytes() for r in part[some]], pa.binary())})

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for c, s, d in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                part = np.frombuffer(d.as_buffer(), np.uint8).astype(np.int64) << s
                held[c] = held[c] + part if c in held else part
        for c, t in held.items():
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([c], pa.int32()), "logits": pa.array([packed(t[0::2], t[1::2]).tobytes()], pa.binary())})

    width = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = texts.select("text").mapInArrow(counted, "chunk int, shift int, digits binary").repartition(width, "chunk").mapInArrow(
        summed, "chunk int, logits binary")
    logits = np.zeros(int(STARTS[-1]), np.int16)
    for r in rows.collect():                               # 4 KB a chunk, 24 MB in all, whatever the corpus
        logits[r.chunk * CHUNK:(r.chunk + 1) * CHUNK] = np.frombuffer(bytes(r.logits), np.int16)
    return logits


def tuned(texts: DataFrame, logits: np.ndarray) -> Mixer:
    """Weights and refinement, averaged over tasks by the bytes they saw."""
    shared = texts.sparkSession.sparkContext.broadcast(logits)
    n_weights = (GATES + NODES) * len(ORDERS)

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, n in tallies(_bytes(b.column(0)) for b in batches):
            mixer = Mixer.fresh(shared.value)
            follow = mixer.learn(keys, n)
            size = float(n.sum())
            value = np.concatenate([mixer.weights.ravel() * size, follow.ravel()])
            yield pa.RecordBatch.from_pydict({"at": pa.array(np.arange(len(value)), pa.int32()), "value": pa.array(value),
                                              "size": pa.array(np.full(len(value), size))})

    mixer = Mixer.fresh(logits)
    sums = texts.select("text").mapInArrow(learned, "at int, value double, size double").groupBy("at").agg(
        F.sum("value").alias("value"), F.sum("size").alias("size")).orderBy("at").collect()     # a fixed number of rows
    if sums:
        value = np.array([r.value for r in sums])
        mixer.weights = (value[:n_weights] / sums[0].size).reshape(GATES + NODES, -1)
        follow = value[n_weights:].reshape(GATES, STEPS, 2)
        prior = mixer.refined * 8
        mixer.refined = (follow[:, :, 1] + prior) / (follow.sum(axis=2) + 8)
    return mixer


class Scorer:
    """Scores texts; values of recent windows are remembered by place."""

    def __init__(self, mixer: Mixer):
        self.mixer = mixer
        self.keys = np.full(1 << CACHE, np.uint64((1 << 64) - 1))
        self.values = np.zeros(1 << CACHE, np.float32)

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        total = np.zeros(len(texts))
        for data, starts, rows in slices(texts):
            key = windows(data, starts)
            value = np.empty(len(key))
            for lo in range(0, len(key), 1 << 18):
                value[lo:lo + (1 << 18)] = self.look(key[lo:lo + (1 << 18)])
            first = starts - DEPTH * np.arange(len(starts))          # places after the context bytes are left out
            sums = np.concatenate([[0.0], np.cumsum(value)])
            np.add.at(total, rows, np.diff(np.concatenate([sums[first], sums[-1:]])))
        return total

    def look(self, key: np.ndarray) -> np.ndarray:
        at = ((key * PRIME) >> np.uint64(64 - CACHE)).astype(np.int64)
        value = self.values[at]
        new = np.flatnonzero(self.keys[at] != key)
        if len(new):
            distinct, back = np.unique(key[new], return_inverse=True)
            found = self.mixer.log10(distinct)[back]
            value[new] = found
            self.keys[at[new]], self.values[at[new]] = key[new], found
        return value


_scorers: dict[str, Scorer] = {}


def scorer_of(name: str, mixer: Mixer) -> Scorer:
    """The worker's scorer for a model: what it remembers serves all its tasks."""
    if name not in _scorers:
        _scorers.clear()
        _scorers[name] = Scorer(mixer)
    return _scorers[name]


def score(docs: DataFrame, learn: Column, tune: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_tokens, n_known, train_tokens, base_score,
    score (log10 probability of the text), n_bytes, bits_per_byte. ``learn`` and
    ``tune`` are conditions over the id column ``id``."""
    spark = docs.sparkSession
    texts = _texts(docs, id_col, text_col)
    train = texts.where(learn)
    counts = stored(token_counts(train), "token-counts")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).head()
    floor = n + v + 1
    often = (F.col("c") * FREQUENT) >= n
    frequent = dict(counts.where(often).toPandas().itertuples(index=False, name=None)) if n else {}    # at most FREQUENT words
    mixer = tuned(train.where(tune), bit_tables(train.where(~tune)))
    model = spark.sparkContext.broadcast((uuid.uuid4().hex, mixer, {bytes(k): float(np.log10((c + 1) / floor)) for k, c in frequent.items()}))

    kind = texts.schema["id"].dataType
    rare_type = pa.list_(pa.struct([("token", pa.binary()), ("tf", pa.int64())]))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, mixer, known = model.value
        scorer = scorer_of(name, mixer)
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                raw = _bytes(part.column(1))
                rows, rare, times, ends = [], [], [], [0]
                for t in raw:
                    held = tokens(t)
                    held[b""] += 1
                    base, hit = 0.0, 0
                    for word, tf in held.items():
                        x = known.get(word)
                        if x is None:
                            rare.append(word)
                            times.append(tf)
                        else:
                            base += tf * x
                            hit += tf
                    rows.append((held.total(), hit, base))
                    ends.append(len(rare))
                words = pa.StructArray.from_arrays([pa.array(rare, pa.binary()), pa.array(times, pa.int64())], fields=list(rare_type.value_type))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), *(pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.float64()))),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words, type=rare_type),
                    pa.array(scorer(raw)), pa.array([len(t) for t in raw], pa.int64())],
                    ["id", "n_tokens", "hit", "base", "rare", "score", "n_bytes"])

    got = texts.mapInArrow(scored, f"id {kind.simpleString()}, n_tokens long, hit long, base double, "
                                   "rare array<struct<token: binary, tf: bigint>>, score double, n_bytes long")
    got = stored(got.withColumn("row", F.monotonically_increasing_id()), "scored")
    # frequent words have been counted already; unseen words have no count
    words = got.select("row", F.inline("rare")).join(counts.where(~often), "token", "left").groupBy("row").agg(
        F.sum(F.when(F.col("c").isNotNull(), F.col("tf")).otherwise(0)).alias("more"),
        F.sum(F.col("tf") * F.log10((F.coalesce("c", F.lit(0)) + 1) / F.lit(float(floor)))).alias("rest"))
    return got.drop("rare").join(words, "row", "left").select(
        F.col("id").alias(id_col), "n_tokens", (F.col("hit") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("rest", F.lit(0.0))).alias("base_score"), "score", "n_bytes",
        (-F.col("score") * F.lit(float(np.log2(10))) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"))


def folds(id_col: str, parts: int, held_out: int) -> tuple[Column, Column, Column]:
    """(held out, learn, tune): of the learned rows one in 32 tunes."""
    out = hashed_id(id_col) % parts == held_out
    return out, ~out, F.shiftright(hashed_id(id_col), 16) % 32 == 0
