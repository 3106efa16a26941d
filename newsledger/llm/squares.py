"""Periodic runs of words by online dyadic square catching.

A run is a maximal stretch of words with smallest period q (words q apart are
equal) of at least ``min_exponent`` periods.

``Catchers`` reads words as they are appended. Whenever a block of 2^k words
that starts at a multiple of 2^k is complete, a catcher is set up for it: it
waits for the block's next copy at a distance q of 2 * 2^k - 1 to 4 * 2^k - 2
words. The first half of a square of period q holds a whole block of the level
k of q, wherever the square lies, and its second half holds the copy; every
period belongs to one level. So each appended word is compared, as the end of a
suffix of 2^k words, with exactly two waiting blocks per level. Suffixes are
compared by their hashes, made by doubling (the suffix of 2^k words from two of
2^(k-1)).

Copies caught at one distance by neighbouring blocks are links of one chain; a
chain that is as long as its distance is a new square, reported by ``append``,
and goes on growing into a run. What lies inside a run whose period divides the
distance is left out at once: it is that run again. ``runs`` extends each chain
word by word to both ends (less than a block, or the next block were a link),
keeps the smallest period of equal stretches and compares every stretch word
by word. Should a hash have lied, the words are read again under another seed.
Work is O(n log n) words, memory O(n log n) hashes of one slice of texts.

Texts are read in slices of at most ``SLICE`` words (a longer text is a slice
of its own); a word that occurs once ends each text, so no run crosses it.

Row rules: null text counts as empty; texts without words have no run; very
long texts are read whole. Repeated rows and ties are plain cases, as the work
is row by row; an empty table gives an empty result. Only the columns named are
read, so other columns never clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, hashed_id

MIN_EXPONENT, MIN_LENGTH = 4, 6
SLICE = 1 << 18               # words appended at once
SHORT = 1 << 11               # longer texts share no slice with shorter ones, which need fewer levels


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """64-bit mixing, in place: multiply and fold, twice."""
    x += np.uint64((0x9E3779B97F4A7C15 * (2 * seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(29)
    return x


def grown(a: np.ndarray, more: np.ndarray) -> np.ndarray:
    return np.concatenate([a, more]) if len(a) else more


class Catchers:
    """Online state over one stream of word numbers.

    ``longest`` bounds the periods asked for (a text of n words has none above
    n / min_exponent); None: no bound.
    """

    def __init__(self, min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH, longest: int | None = None, seed: int = 0):
        if min_exponent < 2:
            raise ValueError("a run has two periods at least")
        self.min_exponent, self.min_length, self.longest, self.seed = min_exponent, min_length, longest, seed
        self.words = np.empty(0, np.int64)
        self.suffix: list[np.ndarray] = []          # by level: hash of the 2^k words that end at each place
        self.chains: list[np.ndarray] = []          # by level: rows (q, first block, last block), sorted

    def append(self, words: np.ndarray) -> np.ndarray:
        """Read more words. Rows (start, period) of the squares first caught
        now: stretches of twice the period at least."""
        old = len(self.words)
        self.words = grown(self.words, np.asarray(words, np.int64))
        caught, level = [], 0
        while (size := 1 << level) * 3 - 1 <= len(self.words) and (self.longest is None or 2 * size - 1 <= self.longest):
            if level == len(self.suffix):
                self.suffix.append(np.empty(0, np.uint64))
                self.chains.append(np.empty((0, 3), np.int64))
            self._hash(level)
            caught.append(self._catch(level, old))
            level += 1
        return np.concatenate(caught) if caught else np.empty((0, 2), np.int64)

    def _hash(self, level: int) -> None:
        done = len(self.suffix[level])
        if level == 0:
            new = mixed(self.words[done:].astype(np.uint64), self.seed)
        else:
            half, shorter = 1 << (level - 1), self.suffix[level - 1]
            new = shorter[done:].copy()
            lead = max(0, half - done)              # no suffix of full length ends there
            new[lead:] += np.uint64(3) * shorter[done + lead - half:len(shorter) - half]
            mixed(new, self.seed + level)
            new[:lead] = 0
        self.suffix[level] = grown(self.suffix[level], new)

    def _catch(self, level: int, old: int) -> np.ndarray:
        """Compare the suffixes that end at the words from ``old`` on with the
        two blocks that wait for each; put the copies on their chains."""
        size, hashes, n = 1 << level, self.suffix[level], len(self.words)
        at = np.arange(max(old, 3 * size - 2), n)   # before these no block waits
        copy = at - (size - 1)                      # where the suffix starts
        near = (copy - (2 * size - 1)) // size * size
        links = []
        for block in (near, near - size):
            hit = np.flatnonzero((hashes[block + size - 1] == hashes[at]) & (block >= 0))
            if len(hit):
                links.append(np.stack([copy[hit] - block[hit], block[hit], block[hit]], axis=1))
        if not links:
            return np.empty((0, 2), np.int64)
        new = self._not_implied(np.concatenate(links), level)
        if self.longest is not None:
            new = new[new[:, 0] <= self.longest]
        before = self.chains[level]
        rows = np.concatenate([before, new])
        rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
        if not len(rows):
            return np.empty((0, 2), np.int64)
        start = np.flatnonzero(np.concatenate([[True], (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 2] + size)]))
        last = np.append(start[1:], len(rows)) - 1
        chains = np.stack([rows[start, 0], rows[start, 1], rows[last, 2]], axis=1)
        # a chain that cannot grow any more and is too short for a run goes
        open_ = chains[:, 2] + size + chains[:, 0] + size > n
        chains = chains[open_ | (self._links(chains, size) >= self._least(chains[:, 0], size))]
        self.chains[level] = chains
        square = chains[chains[:, 2] + size - chains[:, 1] >= chains[:, 0]]
        had = {(int(q), int(a)) for q, a, b in before if b + size - a >= q} if len(before) else set()
        return np.array([(a, q) for q, a, _ in square.tolist() if (q, a) not in had], np.int64).reshape(-1, 2)

    @staticmethod
    def _links(chains: np.ndarray, size: int) -> np.ndarray:
        return (chains[:, 2] - chains[:, 1]) // size + 1

    def _least(self, q: np.ndarray, size: int) -> np.ndarray:
        """Whole blocks within the equal stretch of the shortest run asked for."""
        stretch = np.maximum((self.min_exponent - 1) * q, self.min_length - q)
        return np.maximum(1, (stretch + 1) // size - 1)

    def _not_implied(self, links: np.ndarray, level: int) -> np.ndarray:
        """Without the links inside a stretch of smaller period that divides
        theirs: they belong to that stretch."""
        size = 1 << level
        links = links[np.argsort(links[:, 1], kind="stable")]
        drop = np.zeros(len(links), bool)
        for k, chains in enumerate(self.chains[:level]):
            ends = chains[:, 2] + (1 << k) + chains[:, 0]
            for (p, a, _), e in zip(chains[ends - chains[:, 1] >= 3 * size - 1].tolist(), ends[ends - chains[:, 1] >= 3 * size - 1].tolist()):
                lo, hi = np.searchsorted(links[:, 1], [a, e])
                part = links[lo:hi]
                drop[lo:hi] |= (part[:, 0] % p == 0) & (part[:, 1] + size + part[:, 0] <= e)
        return links[~drop]

    def runs(self) -> np.ndarray:
        """Rows (start, length, period), sorted, of all runs of the words so
        far. Raises ``Collision`` if a hash made words equal that are not."""
        w, n, found = self.words, len(self.words), {}
        for level, chains in enumerate(self.chains):
            size = 1 << level
            for q, a, b in chains[self._links(chains, size) >= self._least(chains[:, 0], size)].tolist():
                end = b + size                      # words a..end equal those q later
                left = w[max(0, a - size):a]
                other = np.flatnonzero(left != w[max(0, a - size) + q:a + q])
                if not len(other) and len(left) == size:
                    continue                        # the block before is a link left out: a run of smaller period
                start = a - (len(left) - 1 - other[-1] if len(other) else len(left))
                right = w[end + q:end + q + size]
                other = np.flatnonzero(right != w[end:end + len(right)])
                if not len(other) and len(right) == size:
                    continue
                end += other[0] if len(other) else len(right)
                length = int(end + q - start)
                if length >= max(self.min_length, self.min_exponent * q):
                    key = (int(start), length)
                    found[key] = min(q, found.get(key, q))
        out = sorted((s, length, q) for (s, length), q in found.items())
        for s, length, q in out:
            if not np.array_equal(w[s:s + length - q], w[s + q:s + length]):
                raise Collision
            if (s and s + q <= n and w[s - 1] == w[s + q - 1]) or (s + length < n and w[s + length] == w[s + length - q]):
                raise Collision
        return np.array(out, np.int64).reshape(-1, 3)


class Collision(Exception):
    """Two different stretches of words had one hash."""


def caught(words: np.ndarray, min_exponent: int, min_length: int, longest: int) -> np.ndarray:
    for seed in range(0, 1 << 20, 64):
        catchers = Catchers(min_exponent, min_length, longest, seed)
        for at in range(0, len(words), SLICE):
            catchers.append(words[at:at + SLICE])
        try:
            return catchers.runs()
        except Collision:
            continue
    raise Collision


def slices(texts: list[list[bytes]]) -> Iterator[list[int]]:
    """Numbers of the texts of each slice; texts too short for a run are in
    none."""
    short, size = [], 0
    for i, words in enumerate(texts):
        if len(words) > SHORT:
            yield [i]
        elif len(words) > 1:
            if size + len(words) > SLICE:
                yield short
                short, size = [], 0
            short.append(i)
            size += len(words) + 1
    if short:
        yield short


def runs_of(texts: list[list[bytes]], min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run of each text, given as words."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for part in slices(texts):
        sizes = [len(texts[i]) for i in part]
        codes = pa.array([w for i in part for w in texts[i]], pa.binary()).dictionary_encode()
        words = np.empty(len(codes) + len(part), np.int64)
        ends = np.cumsum(np.array(sizes) + 1) - 1
        inside = np.ones(len(words), bool)
        inside[ends] = False
        words[inside] = codes.indices.to_numpy()
        words[ends] = len(codes.dictionary) + np.arange(len(part))       # a word that occurs once
        found = caught(words, min_exponent, min_length, max(sizes) // min_exponent)
        if len(found):
            of = np.searchsorted(ends, found[:, 0], side="right")
            starts = ends - np.array(sizes)
            for k, (s, length, q) in zip(of.tolist(), found.tolist()):
                out[part[k]].append((s - int(starts[k]), length, q))
    return out


def repeats(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """True for the words of a text that some run holds after its first
    period."""
    depth = np.zeros(n + 1, np.int64)
    for s, length, q in runs:
        depth[s + q] += 1
        depth[s + length] -= 1
    return np.cumsum(depth[:-1]) > 0


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().split()                                 # bytes: ASCII white space only


def _texts(docs: DataFrame, id_col: str, text_col: str | Column) -> tuple[DataFrame, str]:
    text = F.col(text_col) if isinstance(text_col, str) else text_col
    df = docs.select(F.col(id_col).alias("id"), text.cast("string").alias("text"))
    return df, df.schema["id"].dataType.simpleString()


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[tuple[pa.Array, list[list[bytes]]]]:
    for b in batches:
        for at in range(0, b.num_rows, rows):
            part = b.slice(at, rows)
            yield part.column(0), [words_of(t.as_py()) for t in part.column(1)]


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_exponent: int = MIN_EXPONENT,
         min_length: int = MIN_LENGTH) -> DataFrame:
    """(id, start, length, period), one row per run; words count from 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _parts(batches):
            rows = [(i, *r) for i, rs in enumerate(runs_of(texts, min_exponent, min_length)) for r in rs]
            cols = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(cols[0], pa.int64())), *(pa.array(c, pa.int64()) for c in cols[1:])],
                                             [id_col, "start", "length", "period"])
    df, kind = _texts(docs, id_col, text_col)
    return df.mapInArrow(run, f"`{id_col}` {kind}, start long, length long, period long")


def collapse(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_exponent: int = MIN_EXPONENT,
             min_length: int = MIN_LENGTH) -> DataFrame:
    """(id, n_words, n_dropped, text): every run cut down to its first period;
    the words that stay are joined by one space."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _parts(batches):
            kept = [kept_words(t, r) for t, r in zip(texts, runs_of(texts, min_exponent, min_length))]
            yield pa.RecordBatch.from_arrays([
                ids, pa.array(map(len, texts), pa.int64()), pa.array([len(t) - len(k) for t, k in zip(texts, kept)], pa.int64()),
                pa.array([b" ".join(k).decode() for k in kept], pa.string())], [id_col, "n_words", "n_dropped", "text"])
    df, kind = _texts(docs, id_col, text_col)
    return df.mapInArrow(run, f"`{id_col}` {kind}, n_words long, n_dropped long, text string")


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    return [w for w, gone in zip(words, repeats(len(words), runs).tolist()) if not gone] if runs else words


def _digest(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    sha = lambda b: hashlib.sha256(b).hexdigest()
    best = None
    for s, length, q in runs:                                            # sorted by start, then period
        if best is None or length * best[2] > best[1] * q:
            best = (s, length, q)
    return (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()), sha(b" ".join(kept_words(words, runs))))


REPORT = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str | Column = "text", min_exponent: int = MIN_EXPONENT,
           min_length: int = MIN_LENGTH) -> DataFrame:
    """Per row: number of runs, the run of greatest length / period (ties: the
    first, then the shorter period), digests of all runs and of the text
    collapsed to first periods."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _parts(batches):
            found = [sorted(r, key=lambda x: (x[0], x[2])) for r in runs_of(texts, min_exponent, min_length)]
            cols = list(zip(*map(_digest, texts, found)))
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array(c, pa.int64()) for c in cols[:5]), *(pa.array(c, pa.string()) for c in cols[5:])], [id_col, *REPORT])
    df, kind = _texts(docs, id_col, text_col)
    return df.mapInArrow(run, f"`{id_col}` {kind}, n_runs long, start long, length long, period long, exponent_milli long, "
                              "runs_sha256 string, collapsed_sha256 string")


def planted(id_col: str, text_col: str) -> Column:
    """The text with a period planted in about one text in ten, by its id: with
    h the id's crc32, g = h div 10 and n words, if h mod 10 = 0, each word i from
    a = g mod n on becomes word a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8)."""
    h = hashed_id(id_col)
    words = F.filter(F.split(F.coalesce(F.col(text_col), F.lit("")), f"{SPACE}+"), lambda x: x != "")

    def moved(w: Column) -> Column:
        g, n = F.floor(h / 10), F.size(w)
        a = F.when(n > 0, F.pmod(g, F.greatest(n, F.lit(1)))).otherwise(0)
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8))))
        return F.array_join(F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, (a + F.pmod(i - a, p)).cast("int")))), " ")
    bound = F.transform(F.array(words), moved)                           # the words are split once
    return F.when(h % 10 == 0, F.get(bound, F.lit(0))).otherwise(F.col(text_col))
