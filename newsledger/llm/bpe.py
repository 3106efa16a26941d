"""Byte-level BPE: encoding and decoding with the tokenizers library over
Arrow batches.

The tokenizer is built in each Python worker from a rank file: bytes become
the characters of the byte-to-character map, and the merge that makes each
token is found by merging its bytes with lower ranks only. Texts are split by
the pattern; each match is merged by itself. Special tokens do not exist.
Matches repeat a lot, so a worker remembers the tokens of up to ``REMEMBERED``
matches and sends only new ones to the library, one call per block of matches.
A text is split and encoded block by block, however long it is.

Decoding looks each id up in the reversed byte table and joins bytes, so a
character that is split over tokens comes out right; text is made from the
joined bytes and only then what is not UTF-8 is replaced.

Row rules: null text counts as empty; empty text has no tokens (the hash of
nothing). Offsets are character positions of the whole text; tokens that share
a character all cover it. Repeated rows, an empty table and further columns are
plain cases: the work is row by row and only the id and text columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain, islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 1 << 16               # matches encoded at once
SHORT = 1 << 18               # characters of a text that is split in one go
REMEMBERED = 1 << 18          # matches kept by a worker (about 60 MB)


def byte_chars() -> list[str]:
    """The character that stands for each byte: itself if visible, else one
    from U+0100 on, in byte order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def last_merge(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The pair that makes ``token`` when its bytes are merged by lower ranks."""
    parts = [token[i:i + 1] for i in range(len(token))]
    top = ranks[token]
    while len(parts) > 2:
        best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], top))
        if ranks.get(parts[best] + parts[best + 1], top) >= top:
            return None
        parts[best:best + 2] = [parts[best] + parts[best + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else None


class Coder:
    """Tokens of matches and bytes of tokens, for one rank file and pattern."""

    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer, models, pre_tokenizers

        ranks, chars = read_ranks(path), byte_chars()
        shown = lambda b: "".join(chars[x] for x in b)
        pairs = (last_merge(t, ranks) for t, _ in sorted(ranks.items(), key=lambda x: x[1]) if len(t) > 1)
        merges = [(shown(a), shown(b)) for a, b in filter(None, pairs)]
        self.tokenizer = Tokenizer(models.BPE({shown(t): r for t, r in ranks.items()}, merges, ignore_merges=True))
        self.tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.pattern = regex.compile(f"(?:{pattern})")
        size = max(ranks.values(), default=-1) + 1
        self.bytes: list[bytes] = [b""] * size          # the reversed byte table
        for t, r in ranks.items():
            self.bytes[r] = t
        self.names = [str(i) for i in range(size)]
        self.numbers = list(range(size))                # one object per id, shared by all remembered matches
        self.known: dict[str, tuple[int, ...]] = {}

    def blocks(self, text: str) -> Iterator[list[str]]:
        """The matches of a text, at most ``BLOCK`` at a time if it is long."""
        if len(text) <= SHORT:
            yield self.pattern.findall(text)
            return
        found = self.pattern.finditer(text)
        while block := [m.group() for m in islice(found, BLOCK)]:
            yield block

    def encode(self, matches: list[str]) -> Iterator[int]:
        new = [m for m in set(matches) if m not in self.known]
        if new:
            if len(self.known) + len(new) > REMEMBERED:
                self.known.clear()
                new = list(set(matches))
            coded = self.tokenizer.encode_batch(new, add_special_tokens=False)
            self.known.update(zip(new, (tuple([self.numbers[i] for i in e.ids]) for e in coded)))
        return chain.from_iterable(map(self.known.__getitem__, matches))

    def ids(self, text: str) -> list[int]:
        return [i for block in self.blocks(text) for i in self.encode(block)]

    def offsets(self, text: str) -> tuple[list[int], list[int], list[int]]:
        """(ids, first characters, characters after the last) of the tokens."""
        ids, starts, ends = [], [], []
        for block in self._spans(text):
            for (at, _), e in zip(block, self.tokenizer.encode_batch([m for _, m in block], add_special_tokens=False)):
                ids += e.ids
                starts += [at + a for a, _ in e.offsets]
                ends += [at + b for _, b in e.offsets]
        return ids, starts, ends

    def _spans(self, text: str) -> Iterator[list[tuple[int, str]]]:
        found = self.pattern.finditer(text)
        while block := [(m.start(), m.group()) for m in islice(found, BLOCK)]:
            yield block

    def decode(self, ids: Sequence[int]) -> bytes:
        return b"".join([self.bytes[i] for i in ids])

    def digest(self, text: str) -> tuple[int, str, str]:
        """(number of tokens, SHA-256 of the ids, SHA-256 of what they decode
        to), block by block."""
        n, listed, decoded = 0, hashlib.sha256(), hashlib.sha256()
        for block in self.blocks(text):
            ids = list(self.encode(block))
            listed.update(((" " if n and ids else "") + " ".join([self.names[i] for i in ids])).encode())
            decoded.update(self.decode(ids))
            n += len(ids)
        return n, listed.hexdigest(), decoded.hexdigest()


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> Coder:
    return Coder(path, pattern)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    df = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return df, df.schema["id"].dataType.simpleString()


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, starts, ends): tokens with the characters that they cover."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = load(path, pattern)
        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                rows = [coder.offsets(t.as_py()) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), *(
                    pa.array([r[k] for r in rows], pa.list_(pa.int32())) for k in range(3))], [id_col, "ids", "starts", "ends"])
    df, kind = _texts(docs, id_col, text_col)
    return df.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, starts array<int>, ends array<int>")


def decode(tokens: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded bytes, text). Null ids decode to nothing; an id outside the
    vocabulary is an error."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = load(path, pattern)
        for b in batches:
            raw = [coder.decode(ids.as_py() or []) for ids in b.column(1)]
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array(raw, pa.binary()), pa.array([r.decode("utf-8", "replace") for r in raw], pa.string())],
                [id_col, "decoded", "text"])
    df = tokens.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return df.mapInArrow(run, f"`{id_col}` {df.schema['id'].dataType.simpleString()}, decoded binary, text string")


def digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) without moving the tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = load(path, pattern)
        for b in batches:
            rows = [coder.digest(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([
                b.column(0), *(pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.string(), pa.string())))],
                [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])
    df, kind = _texts(docs, id_col, text_col)
    return df.mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
