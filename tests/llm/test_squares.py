"""Square catching against all periods by brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from newsledger.llm import queries, squares

DOCS = "doc_id long, text string, n_runs string, start int, words string"


def slow_runs(w, min_exponent=4, min_length=6):
    out = {}
    for q in range(1, len(w) // min_exponent + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i - s + q >= max(min_length, min_exponent * q):
                out.setdefault((s, i - s + q), q)
            i += 1
    return sorted((s, length, q) for (s, length), q in out.items())


def planted(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str("" if doc_id is None else doc_id).encode()), len(w)
    g = h // 10
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % p] for i in range(a, n)]


def slow_report(w):
    runs = sorted(slow_runs(w), key=lambda r: (r[0], r[2]))
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def some_words(rng):
    n = rng.randrange(130)
    w = [b"%d" % rng.randrange(rng.choice([1, 2, 2, 3, 30])) for _ in range(n)]
    if n > 4 and rng.random() < .6:
        a = rng.randrange(n)
        p = 1 + rng.randrange(max(1, (n - a) // 2))
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
        if rng.random() < .5:
            w[rng.randrange(n)] = b"z"
    return w


@pytest.mark.parametrize("least", [(4, 6), (2, 2), (3, 5)])
def test_runs_of_all_shapes(least):
    rng = random.Random(least[0])
    texts = [some_words(rng) for _ in range(400)]
    assert [sorted(r) for r in squares.runs_of(texts, *least)] == [slow_runs(w, *least) for w in texts]


def test_words_appended_in_pieces():
    rng = random.Random(9)
    for _ in range(200):
        w = some_words(rng)
        codes = {}
        ids = np.array([codes.setdefault(x, len(codes)) for x in w], np.int64)
        c, at, squares_seen = squares.Catchers(2, 2), 0, set()
        while at < len(w):
            step = rng.randint(1, 9)
            for s, q in c.append(ids[at:at + step]).tolist():
                squares_seen.add((s, q))
                assert w[s:s + q] == w[s + q:s + 2 * q]          # a square, reported once its words are there
            at += step
        assert [tuple(r) for r in c.runs().tolist()] == slow_runs(w, 2, 2)


def test_a_lying_hash_is_found_out(monkeypatch):
    w = [b"%d" % i for i in range(200)] + [b"x", b"y"] * 8
    want = slow_runs(w)
    honest, calls = squares.mixed, []

    def lying(x, seed):
        calls.append(seed)
        return honest(x, seed) & np.uint64(1 if seed < 64 else 0xFFFFFFFFFFFFFFFF)
    monkeypatch.setattr(squares, "mixed", lying)
    monkeypatch.setattr(squares.Catchers, "_hash", _wrapped_hash(lying))
    assert squares.runs_of([w])[0] == want and max(calls) >= 64


def _wrapped_hash(fold):
    def _hash(self, level):
        done, half = len(self.suffix[level]), 1 << level >> 1
        if level == 0:
            new = fold(self.words[done:].astype(np.uint64), self.seed)
        else:
            shorter = self.suffix[level - 1]
            new = shorter[done:].copy()
            lead = max(0, half - done)
            new[lead:] += np.uint64(3) * shorter[done + lead - half:len(shorter) - half]
            new = fold(new, self.seed + level)
        self.suffix[level] = squares.grown(self.suffix[level], new)
    return _hash


def test_long_periodic_texts_stay_near_linear():
    for w, q in (([b"a"] * 300_000, 1), ([b"a", b"b"] * 100_000, 2), (([b"a"] * 30 + [b"b"]) * 3000, 31)):
        assert (0, len(w), q) in squares.runs_of([w])[0]


def test_rows_of_every_kind(spark):
    texts = [None, "", " \n\t", "a", "a " * 5, "a " * 6, "A a " * 20, "é è " * 40 + "x", "u v w " * 900, "a " * 6, "x " * 3000 + "y z " * 3000]
    rows = [(i, t, "n", 1, None) for i, t in enumerate(texts)] + [(4, "q " * 9, "n", 1, None), (None, "r s " * 9, None, None, None)]
    got = squares.report(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, tuple(r)[1:]) for r in got) == sorted(
        (i is None, i or 0, slow_report((t or "").split())) for i, t, *_ in rows)
    found = squares.find(spark.createDataFrame(rows, DOCS)).where("doc_id = 8").collect()
    assert [tuple(r) for r in found] == [(8, 0, 2700, 3)]
    kept = {r.doc_id: (r.n_words, r.n_dropped, r.text) for r in squares.collapse(spark.createDataFrame(rows, DOCS)).collect()}
    assert kept[8] == (2700, 2697, "u v w") and kept[7] == (81, 78, "é è x") and kept[0] == (0, 0, "")
    none = spark.createDataFrame([], DOCS)
    assert squares.report(none).count() == squares.find(none).count() == squares.collapse(none).count() == 0


def test_query_against_all_periods(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r.doc_id: tuple(r)[1:] for r in queries.op13_square_catching(spark, sf).collect()}
    assert got == {d.doc_id: slow_report(planted(d.doc_id, d.text)) for d in docs}
    assert sum(r[0] > 0 for r in got.values()) > 10
