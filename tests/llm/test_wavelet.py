"""Token files: round trips, rank and select against plain arrays, the library's own ids."""

import os
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from newsledger.llm import queries, wavelet

DOCS = "doc_id long, text string, start string, place int, token string"
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("n, top", [(0, 1), (1, 1), (3, 40_000), (70_000, 2), (70_000, 1), (100_000, 50_000), (40_000, 100_000)])
def test_file_against_plain_array(tmp_path, n, top):
    rng = np.random.default_rng(n + top)
    tokens = np.minimum(rng.zipf(1.4, n), top - 1 or 1).astype(np.uint32) if top > 2 else rng.integers(0, top, n).astype(np.uint32)
    starts = np.arange(0, n, 97)
    wavelet.Writer.write(f"file:{tmp_path}/x.wm", tokens, starts, pa.array(starts))
    r = wavelet.Reader(f"{tmp_path}/x.wm")
    assert np.array_equal(r.decode(), tokens) and r.starts.tolist() == starts.tolist() == r.ids.to_pylist()
    for i in rng.integers(0, n, 40 if n else 0).tolist():
        token = int(tokens[i])
        lo, hi = sorted(rng.integers(0, n + 1, 2).tolist())
        assert r.access(i) == token
        assert r.count(token, lo, hi) == int((tokens[lo:hi] == token).sum())
        places = lo + np.flatnonzero(tokens[lo:hi] == token)
        assert [p for p, _ in zip(r.occurrences(token, lo, hi), range(50))] == places[:50].tolist()
    assert r.count(top + 12345) == 0 and list(r.occurrences(-1)) == []
    with pytest.raises(IndexError):
        r.access(n)


def test_reads_single_blocks(tmp_path, monkeypatch):
    tokens = np.random.default_rng(0).integers(0, 30_000, 500_000).astype(np.uint32)
    size = wavelet.Writer.write(f"{tmp_path}/x.wm", tokens, np.array([0]), pa.array([0]))
    r = wavelet.Reader(f"{tmp_path}/x.wm")
    seen, block = [], r._block
    r.block = lambda k, b: seen.append((k, b)) or block(k, b)
    assert r.access(123_456) == tokens[123_456] and size < 2 * len(tokens)
    assert len(set(seen)) <= 2 * r.width


def library(texts):
    t = Tokenizer.from_file(PATH)
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


TEXTS = ["Hello, world! It's 3.5 o'clock.", None, "", " \n\t ", "a\x1cb c", "ÉCOLE École. école, ŒUF; Σας ΣΑΣ. да, Да!", "x" * 5000, "<|endoftext|> a <|ENDOFTEXT|>",
         "don't DON'T we'll. ...?! a.b a,b. (c) 12, 1,2", "中文。 日本語, مرحبا، ok", "a b　c d", "wo" + "rd " * 20_000, "̸ < ̸", "e ́ x.́ y"]


def test_ids_are_those_of_the_library():
    coder = wavelet.Coder(PATH)
    for _ in range(2):
        assert encoded(coder, TEXTS) == library(TEXTS)
    coder.chunks, coder.parts = wavelet.Remembered(6), wavelet.Remembered(4)
    for t, ids in zip(TEXTS * 2, library(TEXTS) * 2):
        assert encoded(coder, [t]) == [ids]
    assert encoded(coder, []) == [] and encoded(coder, ["", None]) == [[], []]


def encoded(coder, texts):
    ids, sizes = coder.encode(pa.array(["skipped", *(t or "" for t in texts)], pa.string()).slice(1))
    return [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] if len(texts) else []


def test_every_letter_and_its_neighbours_as_the_library_has_them():
    letters = [chr(c) for c in range(0x20, 0x600)] + ["\u0130x", "a\u0307", "\u1e9e", "\u01c5", "\u0345", "\u2126"]
    texts = [a + b for a in letters for b in ("", ".", "x", "s\u0301.")]
    assert encoded(wavelet.Coder(PATH), texts) == library(texts)


def test_shards_of_a_table(spark):
    rows = [(i, t, "s", 1, "t") for i, t in enumerate(TEXTS)] + [(3, "again", None, None, None), (None, "no id", None, None, None)] + [(100 + i, f"row {i}", "", 0, "") for i in range(300)]
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, k))
    ids = library([r[1] for r in rows])
    docs = spark.createDataFrame(rows, DOCS).coalesce(1)
    manifest = wavelet.write(docs, PATH, 2, shard_tokens=500, tasks=3)
    shards = sorted(tuple(r) for r in manifest.collect())
    assert [s[0] for s in shards] == list(range(len(shards))) and len(shards) > 3
    assert [s[2] for s in shards] == np.cumsum([0] + [s[3] for s in shards[:-1]]).tolist()
    assert all(s[5] == os.path.getsize(wavelet.file_system(s[1])[1]) for s in shards)
    whole, want = [], []
    for k in order:
        own = [*ids[k], 2]
        want.append((rows[k][0], len(whole), len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        whole += own
    key = lambda r: r[1]
    assert sorted((tuple(r) for r in wavelet.spans(manifest, "bigint").collect()), key=key) == want
    assert sorted(r.ids for r in wavelet.tokens(manifest, "bigint").collect()) == sorted([*i, 2] for i in ids)
    some = [whole[5], 2, 49_407, 60_000]
    assert {r.token: r.n for r in wavelet.counts(manifest, some).collect()} == {t: whole.count(t) for t in some}
    assert sorted(r.position for r in wavelet.occurrences(manifest, 49_407).collect()) == [i for i, t in enumerate(whole) if t == 49_407]
    places = spark.createDataFrame([(p, "x", 1) for p in [0, 5, 5, len(whole) - 1, len(whole), -1, *range(7, len(whole), 1999)]] + [(None, "x", 1)], "position long, token string, place int")
    got = wavelet.at(manifest, places)
    assert got.columns == ["position", "token", "place", "token_"] and got.count() == places.count()
    assert all(r.token_ == (whole[r.position] if r.position is not None and 0 <= r.position < len(whole) else None) for r in got.collect())


def test_what_no_manifest_names_is_not_read(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i}", "", 0, "") for i in range(20)], DOCS)
    one, two = (wavelet.write(docs, PATH, 2, folder=str(tmp_path), tasks=2) for _ in range(2))     # as a task tried twice
    assert len(os.listdir(tmp_path)) == one.count() + two.count()
    assert wavelet.spans(one, "bigint").count() == wavelet.spans(two, "bigint").count() == 20


def test_empty_table(spark):
    manifest = wavelet.write(spark.createDataFrame([], DOCS), PATH, 2)
    assert manifest.count() == wavelet.spans(manifest, "bigint").count() == wavelet.occurrences(manifest, 2).count() == 0
    assert wavelet.at(manifest, spark.createDataFrame([(1,)], "position long")).collect() == [(1, None)]


def test_query_against_the_library(spark):
    sf = "/root/testdata/sf0.001"
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    at, want = 0, []
    for (i, _), ids in zip(docs, library([t for _, t in docs])):
        own = np.array([*ids, 2], "<u4")
        want.append((i, at, len(own), zlib.crc32(own.tobytes())))
        at += len(own)
    assert sorted(tuple(r) for r in queries.op11_wavelet_matrix(spark, sf).collect()) == want
