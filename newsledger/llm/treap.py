"""Ranked lexical search over K2-treaps.

A shard of documents is a grid: rows are its terms, the most frequent first,
columns its documents by ascending id; the cell of a term in a document holds
the term's impact there. The grid is cut in four again and again. A level keeps
four bits for every cell of the level above (which quarters are not empty) and,
for each of those, how much its greatest impact falls short of the cell's above.
Both are compressed per level. Rare terms lie together in nearly empty quarters.

A search descends for all terms of an item at once: a state is a range of
documents (2^j columns) and, per term, the cell of 2^j rows that its path passes
there. Sum of weight x cell maximum bounds every score in the range. The ranges
of highest bound are halved first; a range of one document has its score. Ranges
bounded below the item's 50th score so far (of all shards that the task has
seen) are never opened, and equal bounds are, so ties are whole.

Impacts depend on the number and lengths of all documents, which one aggregate
gives first; weights depend on document frequencies, which the shards' term
tables sum up for the terms asked for. Items are handed to the tasks in blocks
of at most ``BLOCK_BYTES`` of terms, one pass over the shards a block. A task
returns at most k rows an item; these are ranked per item by Spark.

Row rules: null text counts as empty; such a document or one without terms is in
no list, an item without known terms has none. Very long texts are read whole;
a shard ends with the text that fills it. Equal scores go by ascending id (null
ids last, then the order of the table); repeated rows are rows of their own, of
items too. Empty tables give empty results. Only the columns named are read, so
other columns never clash.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_side, stored, unused

SHARD_WORDS = 1 << 21         # words of a shard
BLOCK_BYTES = 1 << 22         # terms of the items that are sought in one pass
BROADCAST_TERMS = 1_000_000
OPENED = 64                   # ranges halved at once
BASE, SLOPE = 50, 50          # a document's m: BASE + SLOPE x its length over the average, rounded down

#: ASCII capitals become small letters, other ASCII characters that are no letter or digit white space.
TO_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or b >= 97 and b not in range(0x7B, 0x80) else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TO_TERMS).split()


def damping(n: int, documents: int, words: int) -> int:
    """m of a document of n terms."""
    return BASE + SLOPE * n * documents // words


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def weight(df: int, documents: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


# ---- the grid

def interleaved(rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Bits of both numbers in turn, the row's bit above the column's."""
    def spread(x: np.ndarray) -> np.ndarray:
        x = x.astype(np.int64)
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            x = (x | x << shift) & mask
        return x
    return spread(rows) << 1 | spread(cols)


def packed(a: np.ndarray) -> bytes:
    raw = a.tobytes()
    return struct.pack("<qq", len(raw), len(small := pa.compress(raw, "zstd", asbytes=True))) + small


class Treap:
    """Cells of all levels, the whole grid first. Children of cell i of a level
    begin at ``first[level][i]``, one for each bit set in ``bits[level][i]``."""

    @staticmethod
    def build(rows: np.ndarray, cols: np.ndarray, values: np.ndarray) -> bytes:
        height = max(1, int(max(rows.max(initial=0), cols.max(initial=0))).bit_length())
        at = interleaved(rows, cols)
        order = np.argsort(at, kind="stable")
        at, top, levels = at[order], values[order].astype(np.int64), []
        for _ in range(height):
            start = np.flatnonzero(np.diff(at >> 2, prepend=-1))
            sizes = np.diff(np.append(start, len(at)))
            above = np.maximum.reduceat(top, start) if len(at) else top
            bits = np.zeros((len(start), 4), bool)
            bits[np.repeat(np.arange(len(start)), sizes), at & 3] = True
            levels.append((np.packbits(bits.ravel(), bitorder="little"), (np.repeat(above, sizes) - top).astype(np.uint32)))
            at, top = at[start] >> 2, above
        head = struct.pack("<qqq", height, len(values), int(top[0]) if len(top) else 0)
        return head + b"".join(packed(x) for level in reversed(levels) for x in level)

    def __init__(self, raw: bytes):
        self.height, self.n, peak = struct.unpack_from("<qqq", raw)
        at = 24

        def take(kind: type) -> np.ndarray:
            nonlocal at
            size, small = struct.unpack_from("<qq", raw, at)
            out = np.frombuffer(pa.decompress(raw[at + 16:at + 16 + small], size, "zstd", asbytes=True), kind)
            at += 16 + small
            return out
        ones = np.array([bin(x).count("1") for x in range(16)], np.int64)
        self.top, self.bits, self.first = [np.array([peak], np.int64)], [], []
        for _ in range(self.height):
            cells = len(self.top[-1])
            bits = take(np.uint8)
            bits = np.stack([bits & 15, bits >> 4], axis=1).ravel()[:cells]
            sizes = ones[bits]
            self.bits.append(bits)
            self.first.append(np.cumsum(sizes) - sizes)
            self.top.append(np.repeat(self.top[-1], sizes) - take(np.uint32))
        #: children before quarter q under bits b
        self.before = np.array([[bin(b & ((1 << q) - 1)).count("1") for q in range(4)] for b in range(16)], np.int64)

    def children(self, level: int, cells: np.ndarray, quarter: np.ndarray) -> np.ndarray:
        """Cell of the next level in that quarter of each cell; -1 if empty."""
        bits = self.bits[level][cells]
        there = (cells >= 0) & (bits >> quarter & 1 == 1)
        return np.where(there, self.first[level][cells] + self.before[bits, quarter], -1)

    def search(self, rows: np.ndarray, weights: np.ndarray, k: int, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """(columns, scores) of the k highest scores of at least ``least``;
        equal scores by ascending column."""
        best_cols, best = np.empty(0, np.int64), np.empty(0, np.int64)
        if not self.n or not len(rows):
            return best_cols, best
        bound = lambda level, cells: (np.where(cells >= 0, self.top[level][cells], 0) * weights).sum(axis=1)
        #: by level: bounds, columns and cells (a row per range) of what is not opened yet
        open_ = {0: (np.array([np.iinfo(np.int64).max]), np.zeros(1, np.int64), np.zeros((1, len(rows)), np.int64))}
        while open_:
            level = max(open_, key=lambda j: open_[j][0].max())
            bounds, cols, cells = open_.pop(level)
            keep = bounds >= least
            if len(bounds) > OPENED and np.count_nonzero(keep) > OPENED:
                first = np.zeros(len(bounds), bool)
                first[np.argpartition(-bounds, OPENED)[:OPENED]] = True
                open_[level] = tuple(x[keep & ~first] for x in (bounds, cols, cells))
                keep = first
            cols, cells = cols[keep], cells[keep]
            if not len(cols):
                continue
            shift = self.height - 1 - level
            half = (rows >> shift & 1) * 2
            cols = np.concatenate([2 * cols, 2 * cols + 1])
            cells = np.concatenate([self.children(level, cells, half), self.children(level, cells, half + 1)])
            bounds = bound(level + 1, cells)
            keep = bounds >= least
            bounds, cols, cells = bounds[keep], cols[keep], cells[keep]
            if not len(bounds):
                continue
            if shift:
                more = open_.get(level + 1)
                open_[level + 1] = tuple(np.concatenate(x) for x in zip(more, (bounds, cols, cells))) if more else (bounds, cols, cells)
                continue
            best_cols, best = np.concatenate([best_cols, cols]), np.concatenate([best, bounds])
            order = np.lexsort((best_cols, -best))[:k]
            best_cols, best = best_cols[order], best[order]
            if len(best) == k:
                least = max(least, int(best[-1]))
        return best_cols, best


# ---- index

def _ids(df: DataFrame) -> str:
    return df.schema["id"].dataType.simpleString()


def statistics(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """(documents with a term, terms of all documents), summed per batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = [len(terms_of(t.as_py())) for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([sum(n > 0 for n in sizes)], pa.int64()), pa.array([sum(sizes)], pa.int64())], ["n", "l"])
    row = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "n long, l long").agg(F.sum("n"), F.sum("l")).first()
    return row[0] or 0, row[1] or 0


def shard(ids: pa.Array, texts: list[list[bytes]], documents: int, words: int) -> tuple[pa.Array, pa.Array, np.ndarray, bytes]:
    """(ids by column, terms by row, documents of each row, treap)."""
    order = pc.sort_indices(ids)                                         # stable; nulls last
    texts = [texts[i] for i in order.to_pylist()]
    sizes = np.array([len(t) for t in texts], np.int64)
    codes = pa.array([w for t in texts for w in t], pa.binary()).dictionary_encode()
    n_terms = len(codes.dictionary)
    cells, tf = np.unique(np.repeat(np.arange(len(texts)), sizes) * n_terms + codes.indices.to_numpy(), return_counts=True)
    cols, term = np.divmod(cells, n_terms)
    df = np.bincount(term, minlength=n_terms)
    by_df = np.argsort(-df, kind="stable")
    row = np.empty(n_terms, np.int64)
    row[by_df] = np.arange(n_terms)
    m = np.array([damping(n, documents, words) for n in sizes.tolist()], np.int64)
    treap = Treap.build(row[term], cols, impact(tf.astype(np.int64), m[cols]))
    return ids.take(order), codes.dictionary.take(pa.array(by_df)), df[by_df].astype(np.int32), treap


class Index:
    """Shards of treaps as a stored table (ids, terms, df, treap), with the
    statistics that they were made with."""

    def __init__(self, shards: DataFrame, documents: int, words: int):
        self.shards, self.documents, self.words = shards, documents, words


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_words: int = SHARD_WORDS) -> Index:
    documents, words = statistics(docs, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal ids, texts, size
            doc, term, df, treap = shard(pa.concat_arrays(ids), texts, documents, words)
            ids, texts, size = [], [], 0
            one = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
            return pa.RecordBatch.from_arrays([one(doc), one(term), one(pa.array(df)), pa.array([treap], pa.binary())], ["ids", "terms", "df", "treap"])
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                split = [terms_of(t.as_py()) for t in part.column(1)]
                some = [i for i, t in enumerate(split) if t]
                if not some:
                    continue
                ids.append(part.column(0).take(pa.array(some)))
                texts += [split[i] for i in some]
                size += sum(map(len, split))
                if size >= shard_words:
                    yield close()
        if texts:
            yield close()
    df = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"ids array<{_ids(df)}>, terms array<binary>, df array<int>, treap binary"
    return Index(stored(df.mapInArrow(run, schema), "treaps"), documents, words)


# ---- search

def _items(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, item, terms): distinct terms of every item, stored so that keys
    stay as they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [sorted(set(terms_of(t.as_py()))) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.list_(pa.binary())),
                                              pa.array([sum(len(w) + 16 for w in t) + 64 for t in found], pa.int64())], ["key", "id", "terms", "size"])
    df = items.select(F.monotonically_increasing_id().alias("key"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return stored(df.mapInArrow(run, f"key long, id {_ids(df)}, terms array<binary>, size long"), "items")


def _top(index: Index, block: list[tuple[int, list[tuple[bytes, int]]]], k: int) -> DataFrame:
    """(key, id, score): per task and item of the block, the k best."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[int, int, pa.Array]]] = {}            # key: (score, order of arrival) and id, best first
        wanted = pa.array(sorted({t for _, terms in block for t, _ in terms}), pa.binary())
        id_type, arrived = None, 0
        for b in batches:
            for r in range(b.num_rows):
                ids, names = b.column(0)[r].values, b.column(1)[r].values
                id_type = ids.type
                at = pc.index_in(wanted, value_set=names)
                row = {t: i for t, i in zip(wanted.to_pylist(), at.to_pylist()) if i is not None}
                if not row:
                    continue
                treap = Treap(b.column(3)[r].as_py())
                for key, terms in block:
                    here = [(row[t], w) for t, w in terms if t in row]
                    if not here:
                        continue
                    had = best.get(key, [])
                    least = max(1, had[-1][0]) if len(had) == k else 1
                    cols, scores = treap.search(*(np.array(x, np.int64) for x in zip(*here)), k, least)
                    if not len(cols):
                        continue
                    new = list(zip(scores.tolist(), range(arrived, arrived + len(cols)), ids.take(pa.array(cols)).to_pylist()))
                    arrived += len(cols)
                    best[key] = sorted(had + new, key=lambda x: (-x[0], x[2] is None, x[2] if x[2] is not None else 0, x[1]))[:k]
        rows = [(key, i, s) for key, found in best.items() for s, _, i in found]
        if rows:
            keys, found, scores = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(found, id_type), pa.array(scores, pa.int64())], ["key", "id", "score"])
    kind = index.shards.schema["ids"].dataType.elementType.simpleString()
    return index.shards.mapInArrow(run, f"key long, id {kind}, score long")


def search(index: Index, items: DataFrame, k: int = 50, id_col: str = "item_id", text_col: str = "text",
           doc_col: str = "doc_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item, rank, document, score) of each item's k highest scores above 0."""
    asked = _items(items, id_col, text_col)
    terms = asked.select(F.explode("terms").alias("term")).distinct()
    n = terms.count()
    df = stored(index.shards.select(F.explode(F.arrays_zip("terms", "df")).alias("t")).select("t.terms", "t.df").join(
        small_side(terms, n, BROADCAST_TERMS), F.col("terms") == F.col("term"), "left_semi").groupBy("terms").agg(
        F.sum("df").alias("df")), "frequencies")
    blocks = max(1, math.ceil((asked.agg(F.sum("size")).first()[0] or 0) / block_bytes))
    found = None
    for b in range(blocks):
        part = asked.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == b)
        known = part.select("key", F.explode("terms").alias("terms")).join(df, "terms").groupBy("key").agg(
            F.collect_list(F.struct("terms", "df")).alias("terms")).orderBy("key").collect()     # a block of bounded size
        block = [(r.key, sorted((bytes(t.terms), weight(t.df, index.documents)) for t in r.terms)) for r in known]
        top = _top(index, block, k)
        found = top if found is None else found.unionByName(top)
    order = Window.partitionBy("key").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(asked.select("key", F.col("id").alias("item")), "key").select(
        F.col("item").alias(id_col), "rank", F.col("id").alias(doc_col if doc_col != id_col else f"{doc_col}_"), "score")
