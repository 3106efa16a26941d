"""K2-treaps against all documents by brute force."""

import collections
import math
import re

import numpy as np
import pytest

from newsledger.llm import queries, treap

DOCS = "doc_id long, text string, terms string, df int, score long"
ITEMS = "item_id long, text string, rank int, key string"


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def slow(docs, items, k=50):
    """(item, rank, document, score) for lists of (id, text)."""
    split = [(i, terms(t)) for i, t in docs]
    split = [(i, t, collections.Counter(t)) for i, t in split if t]
    n_docs, n_words = len(split), sum(len(t) for _, t, _ in split)
    df = collections.Counter(w for *_, c in split for w in c)
    out = []
    for item, text in items:
        scored = []
        for place, (i, t, c) in enumerate(split):
            m = 100 - 50 + 50 * len(t) * n_docs // n_words
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (1_000_000_000 * c[w] // (1000 * c[w] + 20 * m)) for w in set(terms(text)))
            if s > 0:
                scored.append((-s, i is None, i or 0, place, i))
        out += [(item, r, x[4], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return out


def order(rows):
    return sorted(rows, key=lambda r: [(x is None, x or 0) for x in r])


def test_grid_against_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(150):
        n_rows, n_cols, n = int(rng.integers(1, 60)), int(rng.integers(1, 300)), int(rng.integers(1, 900))
        top = int(rng.choice([3, 1000]))
        grid = {(int(rng.integers(n_rows)), int(rng.integers(n_cols))): int(rng.integers(1, top)) for _ in range(n)}
        t = treap.Treap(treap.Treap.build(*(np.array(x) for x in ([r for r, _ in grid], [c for _, c in grid], list(grid.values())))))
        rows = rng.choice(n_rows, min(n_rows, 5), replace=False)
        weights, k, least = rng.integers(0, 9, len(rows)), int(rng.integers(1, 20)), int(rng.integers(1, 50))
        scores = [(-sum(int(w) * grid.get((int(r), c), 0) for r, w in zip(rows, weights)), c) for c in range(n_cols)]
        cols, found = t.search(rows, weights, k, least)
        assert list(zip((-found).tolist(), cols.tolist())) == sorted(x for x in scores if x[0] <= -least)[:k]


def test_cells_hold_the_maxima_of_their_quarters():
    rng = np.random.default_rng(1)
    cells = np.unique(rng.integers(0, 64 * 64, 500))
    values = rng.integers(1, 10**6, len(cells))
    t = treap.Treap(treap.Treap.build(cells // 64, cells % 64, values))
    assert t.height == 6 and len(t.top[-1]) == len(cells)
    for level in range(7):
        side = 64 >> level
        blocks = collections.defaultdict(int)
        for c, v in zip(cells.tolist(), values.tolist()):
            at = (c // 64 // side, c % 64 // side)
            blocks[at] = max(blocks[at], v)
        assert sorted(blocks.values()) == sorted(t.top[level].tolist())


def test_ranges_below_the_list_stay_closed(monkeypatch):
    n = 4096
    values = np.where(np.arange(n) == 1234, 10**6, np.arange(n) % 7 + 1)
    t = treap.Treap(treap.Treap.build(np.zeros(n, int), np.arange(n), values))
    opened, children = [], t.children
    monkeypatch.setattr(t, "children", lambda level, cells, q: opened.append(len(cells)) or children(level, cells, q))
    monkeypatch.setattr(treap, "OPENED", 1)
    assert t.search(np.array([0]), np.array([2]), 1)[0].tolist() == [1234] and sum(opened) <= 2 * t.height


WORDS = [f"w{i}" for i in range(60)]


def some_texts(rng, n):
    return [" ".join(rng.choice(WORDS, int(rng.integers(0, 40)), p=np.arange(60, 0, -1) / 1830)) for _ in range(n)]


@pytest.mark.parametrize("shard_words, block_bytes", [(100, 1 << 22), (3000, 1500), (1 << 21, 1 << 22)])
def test_search_against_brute_force(spark, shard_words, block_bytes):
    rng = np.random.default_rng(shard_words)
    texts = some_texts(rng, 400) + ["w1 w2 w3"] * 90 + [None, "", "!?", "É é W1", "zz " * 30_000 + "w5", "Ünï-cödé x\x7fy", "w2"]
    docs = [(i, t) for i, t in enumerate(texts)] + [(3, "w1 w9"), (None, "w1 w7 w8")]
    items = [(i, t) for i, t in enumerate([*some_texts(rng, 25), None, "", "unknown", "w1 W1 w1", "É", "w1 w2 w3", "cödé x y zz"])] + [(None, "w4")]
    index = treap.build(spark.createDataFrame([(*d, "t", 1, 2) for d in docs], DOCS).repartition(3), shard_words=shard_words)
    got = treap.search(index, spark.createDataFrame([(*i, 5, "k") for i in items], ITEMS), 50, block_bytes=block_bytes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert order(map(tuple, got.collect())) == order(slow(docs, items))


def test_repeated_rows(spark):
    docs = [(7, "a b"), (7, "a b"), (8, "a")]
    index = treap.build(spark.createDataFrame([(*d, "t", 1, 2) for d in docs], DOCS))
    got = treap.search(index, spark.createDataFrame([(1, "a b", 5, "k"), (1, "a b", 5, "k")], ITEMS), 2)
    assert sorted((r.item_id, r["rank"], r.doc_id) for r in got.collect()) == [(1, 1, 7), (1, 1, 7), (1, 2, 7), (1, 2, 7)]


def test_text_ids(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y"), ("c", "x"), (None, "x y")], "name string, body string")
    got = treap.search(treap.build(docs, "name", "body"), spark.createDataFrame([("q", "x y")], "item_id string, text string"))
    assert [r.doc_id for r in got.orderBy("rank").collect()] == ["a", "b", None, "c"]


def test_empty_tables(spark):
    docs, none = spark.createDataFrame([(1, "a", "", 0, 0)], DOCS), spark.createDataFrame([], DOCS)
    items = spark.createDataFrame([(1, "a", 0, "")], ITEMS)
    assert treap.search(treap.build(none), items).count() == 0
    assert treap.search(treap.build(spark.createDataFrame([(1, None, "", 0, 0)], DOCS)), items).count() == 0
    assert treap.search(treap.build(docs), items.limit(0)).count() == 0


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs, items = ([tuple(r) for r in spark.read.parquet(f"{sf}/{n}.parquet").select(c, "text").collect()] for n, c in (("documents", "doc_id"), ("benchmark", "item_id")))
    assert order(map(tuple, queries.op12_k2_treap(spark, sf).collect())) == order(slow(docs, items))
