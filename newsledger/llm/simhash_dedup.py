"""SimHash near-dedup by anchor points of a covering code.

Fingerprint: bit i of 64 is 1 if it is set in over half of the XXH64 (seed 42)
hashes of the text's word shingles, repeats included.

Anchors: the code whose words are pairs of binary Golay codewords on bits 0-22
and 23-45 (2^24 anchors, covering radius 3 + 3; the other 18 bits are free).
A fingerprint's home is its nearest anchor. If y differs from x in at most
``max_bits`` bits, e1 of them in the first block and e2 in the second, then
home(x) lies within 3 + e1 and 3 + e2 of y's blocks. So y is replicated to all
such anchors (about 70 for 2 bits), x only to its home, and comparing per
anchor finds every pair. Rows per anchor stay few: distinct fingerprints only.

Linked fingerprints go through the distributed union-find; equal fingerprints
are one node, so copies are never paired with each other.

Row rules: null text counts as empty; no words give fingerprint zero, linked
like any other. Very long texts are hashed in slices of bounded size. Repeated
rows stay rows of their own; a null id never becomes a component id unless the
whole component has none. An empty table gives an empty result. Only id and
text are read; in ``near_dedup`` all other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_side, stored, unused
from .graph import components

SHINGLE_WORDS, MAX_BITS, SEED = 3, 2, 42
SLICE = 1 << 16               # shingles hashed at once
GENERATOR = 0xC75             # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1, of the (23, 12) Golay code
BLOCK = (1 << 23) - 1
BROADCAST_ROWS = 1_000_000    # 8 bytes each


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    words = (text or "").encode().lower().split()        # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle_words + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, SLICE):
        part = words[at:min(at + SLICE, n) + shingle_words - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(shingle_words)))) if len(part) >= shingle_words else [b" ".join(part)]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(id, fp) for every row; fp is the fingerprint as a signed 64-bit number."""
    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [signed(fingerprint(t.as_py(), shingle_words)) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], ["id", "fp"])
    kind = docs.select(F.col(id_col).alias("id")).schema["id"].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        per_batch, f"id {kind}, fp long")


def _remainder(words: np.ndarray) -> np.ndarray:
    """Of 23-bit polynomials, modulo the generator: the syndrome."""
    r = words.astype(np.int64)
    for bit in range(22, 10, -1):
        r = np.where((r >> bit) & 1, r ^ (GENERATOR << (bit - 11)), r)
    return r


@lru_cache(maxsize=4)
def golay(max_bits: int) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """(syndrome of each low half, leader of each syndrome, codewords near each
    leader). The last holds for e = 0.. ``max_bits`` the codewords c with
    |leader ^ c| <= 3 + e as (start, flat list) by syndrome."""
    bits = 1 << np.arange(23)
    errors = np.concatenate([[0], bits,
                             [a | b for i, a in enumerate(bits) for b in bits[i + 1:]],
                             [a | b | c for i, a in enumerate(bits) for j, b in enumerate(bits[i + 1:], i + 1) for c in bits[j + 1:]]])
    leaders = np.zeros(2048, np.int64)
    leaders[_remainder(errors)] = errors
    messages = np.arange(4096) << 11
    code = messages | _remainder(messages)
    far = np.bitwise_count(leaders[:, None] ^ code[None, :])
    near = []
    for e in range(max_bits + 1):
        s, c = np.nonzero(far <= 3 + e)
        near.append((np.searchsorted(s, np.arange(2049)), code[c]))
    # the syndrome is linear: two lookups instead of twelve steps
    low, high = _remainder(np.arange(4096)), _remainder(np.arange(2048) << 12)
    return np.concatenate([low, high]), leaders, near


def _expand(start: np.ndarray, flat: np.ndarray, rows: np.ndarray, syn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row with each listed codeword of its syndrome."""
    n = start[syn + 1] - start[syn]
    at = np.repeat(np.arange(len(rows)), n)
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return at, flat[start[syn[at]] + inner]


def anchors(fps: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(home of each fingerprint, row numbers, anchors): all anchors to which
    each row is replicated, its home included, each once."""
    table, leaders, near = golay(max_bits)
    syndrome = lambda w: table[w & 4095] ^ table[4096 + (w >> 12)]
    one, two = fps & BLOCK, (fps >> 23) & BLOCK
    s1, s2 = syndrome(one), syndrome(two)
    base1, base2 = one ^ leaders[s1], two ^ leaders[s2]
    home = base1 | (base2 << 23)
    out_rows, out = [], []
    for e1 in range(max_bits + 1):                  # codewords that need e1 flips exactly in block one
        r1, c1 = _expand(*near[e1], fps, s1)
        if e1:
            keep = np.bitwise_count(leaders[s1[r1]] ^ c1) > 3 + e1 - 1
            r1, c1 = r1[keep], c1[keep]
        r2, c2 = _expand(*near[max_bits - e1], r1, s2[r1])
        rows = r1[r2]
        out_rows.append(rows)
        out.append((base1[rows] ^ c1[r2]) | ((base2[rows] ^ c2) << 23))
    return home, np.concatenate(out_rows), np.concatenate(out)


def links(unique: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b), a < b: every pair of distinct fingerprints ``fp`` that differ in
    at most ``max_bits`` bits. A pair may occur twice."""
    def replicas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                fps = b.column(0).slice(at, 4096).to_numpy(zero_copy_only=False)
                home, rows, to = anchors(fps, max_bits)
                for lo in range(0, len(rows), 1 << 17):
                    r, t = rows[lo:lo + (1 << 17)], to[lo:lo + (1 << 17)]
                    yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(fps[r]), pa.array(t == home[r])], ["anchor", "fp", "home"])
    spread = unique.select("fp").mapInArrow(replicas, "anchor long, fp long, home boolean")
    copies = spread.select("anchor", F.col("fp").alias("y"))
    homes = spread.where("home").select("anchor", F.col("fp").alias("x"))
    near = (F.col("x") != F.col("y")) & (F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= max_bits)
    # Spark sizes both by the fingerprints they are made from, not by the replicas: neither may be broadcast
    return homes.hint("merge").join(copies.hint("merge"), (homes.anchor == copies.anchor) & near).select(
        F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(id, fingerprint in hex, component_id: the smallest id reachable)."""
    fps = stored(fingerprints(docs, id_col, text_col, shingle_words), "fingerprints")
    unique = stored(fps.groupBy("fp").agg(F.min("id").alias("id")), "unique")
    linked = components(links(unique, max_bits))
    nodes = unique.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp"))
    least = nodes.groupBy("component").agg(F.min("id").alias("component_id"))
    named = nodes.join(least, "component").select("fp", "component_id")
    return fps.join(named, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row per group: that of the smallest id (null ids last);
    of repeated ids the first stored row."""
    row, key = unused(docs, "row"), unused(docs, "key")
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    keyed = rows.select(text_col, F.struct(F.col(id_col).isNull().alias("last"), F.col(id_col).alias("id"),
                                           F.col(row).alias("row")).alias(key))
    marked = groups(keyed, key, text_col, shingle_words, max_bits)
    gone = stored(marked.where(F.col(key) != F.col("component_id")).select(F.col(f"{key}.row").alias(row)), "gone")
    return rows.join(small_side(gone, gone.count(), BROADCAST_ROWS), row, "left_anti").drop(row)
