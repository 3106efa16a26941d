"""Token ids in one compressed file per shard: a wavelet matrix.

Texts are dealt to tasks by ranges of their id, encoded there in ascending
order, and every ``SHARD_TOKENS`` tokens (whole texts) become one file:

    magic | plane blocks, each compressed or stored | footer (deflated) | footer size

The matrix has one bit-plane per bit of the largest id, highest bit first. In
plane k stands bit k of every token, in the order that plane k - 1 leaves:
tokens with a zero there first, then those with a one, both in their old order.
A plane is cut into blocks of ``BLOCK_BITS`` bits. The footer holds per block
its offset, its size and the ones before it (rank), per plane its zeros, and the
texts' ids and first tokens. So rank reads one block, select finds its block by
binary search over the ranks first; token access, counting and occurrence
lookup take one or two ranks a plane (one select a plane back up for a place)
and read only those blocks, never the file. ``tokens`` decodes whole files plane
by plane.

Files are written with pyarrow's file systems (local, S3, GCS, HDFS) below the
shared folder, each try of a task under names of its own. A file counts only if
the manifest names it, a Parquet table that Spark commits: what a lost executor
left behind, or a second try of a task wrote, is never read. Manifests hold one
row per shard; nothing is collected.

Row rules: null text counts as empty, i.e. one end token. Ties of ids (repeated
rows, null ids, which come first) are ordered by the rows' place in the table.
Very long texts are encoded in pieces and make a shard as long as they need.
An empty table writes no file and gives empty results. Only the columns named
are read, so other columns never clash.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsledger.session import work_path

from .common import stored, unused

SHARD_TOKENS = 1 << 21        # a task holds one shard: 4 bytes a token and as much again per plane in turn
BLOCK_BITS = 1 << 15          # 4 KiB a block
MAGIC = b"WVLTMTX2"
SLICE_BYTES = 1 << 23         # of text encoded at once
WORDS_AT_ONCE = 1 << 8        # new words of one text for the library
REMEMBERED = 1 << 19          # chunks kept by a worker, and as many parts (about 80 MB each)
STRETCH = 20                  # log2 of the tokens of a stretch, by which places meet their files
SHORT_CHUNK = 48              # bytes; what is longer is encoded but not remembered


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """pyarrow's file system and path of a URI or of an absolute path."""
    scheme, _, rest = uri.partition(":")
    if scheme in ("s3a", "s3n"):
        uri = f"s3:{rest}"
    elif scheme == "file" and not rest.startswith("//"):
        uri = f"file://{rest}"                          # file:/x, as Hadoop writes it
    return fs.FileSystem.from_uri(uri)


# ---- the file

class Writer:
    """Writes one file from all tokens of a shard."""

    @staticmethod
    def write(uri: str, tokens: np.ndarray, starts: np.ndarray, ids: pa.Array) -> int:
        """``starts``: first token of each text; ``ids``: their ids. Returns
        the file's size."""
        store, path = file_system(uri)
        store.create_dir(os.path.dirname(path), recursive=True)
        codec = pa.Codec("zstd", compression_level=1)
        width = max(1, int(tokens.max(initial=0)).bit_length())
        n_blocks = -(-len(tokens) // BLOCK_BITS)
        offsets, sizes = np.zeros((width, n_blocks), np.int64), np.zeros((width, n_blocks), np.int64)
        ranks, zeros = np.zeros((width, n_blocks), np.int64), np.zeros(width, np.int64)
        order = tokens.astype(np.uint16 if width <= 16 else np.uint32)
        with store.open_output_stream(path) as out:
            out.write(MAGIC)
            at = len(MAGIC)
            for k in range(width):
                ones = (order >> order.dtype.type(width - 1 - k)) & order.dtype.type(1) != 0
                plane = np.packbits(ones, bitorder="little").tobytes()
                each = np.add.reduceat(ones, np.arange(0, len(ones), BLOCK_BITS), dtype=np.int64) if n_blocks else np.zeros(0, np.int64)
                ranks[k], zeros[k] = np.cumsum(each) - each, len(ones) - each.sum()
                for b in range(n_blocks):
                    raw = plane[b * BLOCK_BITS // 8:(b + 1) * BLOCK_BITS // 8]
                    small = codec.compress(raw, asbytes=True)
                    part = small if len(small) < len(raw) else raw       # stored as it is: size says so
                    out.write(part)
                    offsets[k, b], sizes[k, b] = at, len(part)
                    at += len(part)
                order = np.concatenate([order[~ones], order[ones]])
            table = pa.record_batch([ids], ["id"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as ipc:
                ipc.write_batch(table)
            footer = zlib.compress(b"".join([
                struct.pack("<qqqq", len(tokens), width, n_blocks, len(starts)), zeros.tobytes(), offsets.tobytes(), sizes.tobytes(),
                ranks.tobytes(), np.asarray(starts, np.int64).tobytes(), sink.getvalue().to_pybytes()]), 6)
            out.write(footer + struct.pack("<q", len(footer)))
        return at + len(footer) + 8


class Reader:
    """Rank, select, access, counting and occurrences over one file; reads the
    footer and then only the blocks that are asked for."""

    def __init__(self, uri: str, kept_blocks: int = 1024):
        store, path = file_system(uri)
        self.file = store.open_input_file(path)
        size = self.file.size()
        (n,) = struct.unpack("<q", self.file.read_at(8, size - 8))
        if self.file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{uri} is no token file")
        raw = zlib.decompress(self.file.read_at(n, size - 8 - n))
        self.n, self.width, self.n_blocks, self.n_texts = struct.unpack_from("<qqqq", raw)
        at = 32

        def take(*shape: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, np.int64, int(np.prod(shape)), at).reshape(shape)
            at += out.nbytes
            return out
        grid = (self.width, self.n_blocks)
        self.zeros, self.offsets, self.sizes, self.ranks = take(self.width), take(*grid), take(*grid), take(*grid)
        self.starts = take(self.n_texts)
        self.ids = pa.ipc.open_stream(raw[at:]).read_all().column(0).combine_chunks()
        self.codec = pa.Codec("zstd")
        self.block = lru_cache(kept_blocks)(self._block)

    def close(self) -> None:
        self.file.close()

    def _block(self, k: int, b: int) -> np.ndarray:
        """The bits of block b of plane k as 0 and 1."""
        n = min(BLOCK_BITS, self.n - b * BLOCK_BITS)
        raw = self.file.read_at(int(self.sizes[k, b]), int(self.offsets[k, b]))
        if len(raw) < -(-n // 8):
            raw = self.codec.decompress(raw, -(-n // 8), asbytes=True)
        return np.unpackbits(np.frombuffer(raw, np.uint8), count=n, bitorder="little")

    def bit(self, k: int, i: int) -> int:
        return int(self.block(k, i // BLOCK_BITS)[i % BLOCK_BITS])

    def rank1(self, k: int, i: int) -> int:
        """Ones among the first i bits of plane k."""
        if i >= self.n:
            return self.n - int(self.zeros[k])
        b, rest = divmod(i, BLOCK_BITS)
        return int(self.ranks[k, b]) + (int(np.count_nonzero(self.block(k, b)[:rest])) if rest else 0)

    def select(self, k: int, bit: int, j: int) -> int:
        """Place of the j-th (from 0) bit of that value in plane k."""
        before = self.ranks[k] if bit else np.arange(self.n_blocks) * BLOCK_BITS - self.ranks[k]
        b = int(np.searchsorted(before, j, side="right")) - 1
        return b * BLOCK_BITS + int(np.flatnonzero(self.block(k, b) == bit)[j - int(before[b])])

    def _down(self, k: int, i: int, bit: int) -> int:
        ones = self.rank1(k, i)
        return int(self.zeros[k]) + ones if bit else i - ones

    def access(self, i: int) -> int:
        """Token i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        token = 0
        for k in range(self.width):
            bit = self.bit(k, i)
            token = 2 * token + bit
            i = self._down(k, i, bit)
        return token

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        """Where the occurrences of a token among tokens lo to hi - 1 end up
        below the last plane."""
        if token < 0 or token >> self.width:
            return 0, 0
        for k in range(self.width):
            bit = token >> (self.width - 1 - k) & 1
            lo, hi = self._down(k, lo, bit), self._down(k, hi, bit)
            if lo >= hi:
                return lo, lo
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of a token among tokens lo to hi - 1."""
        a, b = self._range(token, lo, self.n if hi is None else hi)
        return b - a

    def occurrences(self, token: int, lo: int = 0, hi: int | None = None) -> Iterator[int]:
        """Places of a token among tokens lo to hi - 1, ascending."""
        a, b = self._range(token, lo, self.n if hi is None else hi)
        for i in range(a, b):
            for k in reversed(range(self.width)):
                bit = token >> (self.width - 1 - k) & 1
                i = self.select(k, bit, i - int(self.zeros[k]) if bit else i)
            yield i

    def decode(self) -> np.ndarray:
        """All tokens, from the last plane up: the values below a plane are
        merged by its bits."""
        values = np.zeros(self.n, np.uint32)
        for k in reversed(range(self.width)):
            ones = np.concatenate([self._block(k, b) for b in range(self.n_blocks)]).astype(bool) if self.n_blocks else np.zeros(0, bool)
            merged = np.empty_like(values)
            merged[~ones] = values[:int(self.zeros[k])]
            merged[ones] = values[int(self.zeros[k]):] | np.uint32(1 << (self.width - 1 - k))
            values = merged
        return values


# ---- encoding

class Lists:
    """Lists of ids, one after the other."""

    def __init__(self, sizes: np.ndarray, flat: np.ndarray):
        self.sizes, self.flat, self.begin = sizes, flat, np.cumsum(sizes) - sizes

    def take(self, at: np.ndarray) -> "Lists":
        sizes = self.sizes[at]
        before = np.cumsum(sizes) - sizes
        return Lists(sizes, self.flat[np.repeat(self.begin[at] - before, sizes) + np.arange(int(sizes.sum()))])

    def add(self, more: "Lists") -> "Lists":
        return Lists(np.concatenate([self.sizes, more.sizes]), np.concatenate([self.flat, more.flat]))

    @staticmethod
    def none() -> "Lists":
        return Lists(np.zeros(0, np.int64), np.zeros(0, np.uint32))


class Remembered:
    """Ids of what was looked up lately; when there is too much of it, what was
    not asked for the longest goes."""

    def __init__(self, most: int):
        self.most, self.turn = most, 0
        self.keys, self.ids, self.used = pa.array([], pa.binary()), Lists.none(), np.zeros(0, np.int64)

    def find(self, keys: pa.BinaryArray) -> np.ndarray:
        """Where each key is; -1: nowhere."""
        self.turn += 1
        at = pc.fill_null(pc.index_in(keys, value_set=self.keys), -1).to_numpy().astype(np.int64)
        self.used[at[at >= 0]] = self.turn
        return at

    def put(self, keys: pa.BinaryArray, ids: Lists) -> None:
        short = np.flatnonzero(pc.binary_length(keys).to_numpy(zero_copy_only=False) <= SHORT_CHUNK)
        self.keys = pa.concat_arrays([self.keys, keys.take(pa.array(short))])
        self.ids = self.ids.add(ids.take(short))
        self.used = np.append(self.used, np.full(len(short), self.turn))
        if len(self.keys) > self.most:
            stay = np.sort(np.argsort(-self.used, kind="stable")[:self.most // 2])
            self.keys, self.ids, self.used = self.keys.take(pa.array(stay)), self.ids.take(stay), self.used[stay]


def binary(raw: np.ndarray, ends: np.ndarray) -> pa.BinaryArray:
    """Byte strings that lie one after the other."""
    offsets = np.append(0, ends).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(raw))])


def bytes_of(a: pa.BinaryArray | pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets of the strings in them, one more than there are)."""
    if not len(a) or a.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(a) + 1, np.int32)
    offsets = np.frombuffer(a.buffers()[1], np.int32)[a.offset:a.offset + len(a) + 1]
    return np.frombuffer(a.buffers()[2], np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks_of(texts: pa.StringArray) -> tuple[pa.BinaryArray, np.ndarray]:
    """The chunks between ASCII white space of all texts, and the number of
    the first chunk of each text (one more at the end)."""
    raw, bounds = bytes_of(texts)
    inside = ~IS_SPACE[raw]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    first = bounds[:-1][bounds[:-1] < len(raw)]
    start[first] = inside[first]                         # a text ends a chunk
    starts = np.flatnonzero(start)
    before = np.cumsum(inside, dtype=np.int32)
    ends = np.append(before[starts[1:]] - 1, before[-1]) if len(starts) else np.zeros(0, np.int32)
    return binary(raw[inside], ends), np.searchsorted(starts, bounds)


def _table(members: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


MARKS = b".,;:!?"
IS_SPACE, IS_MARK = _table(b"\t\n\v\f\r "), _table(MARKS)
IS_LETTER = _table(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
#: After the byte C3: the letters of U+00C0 to U+00FF, i.e. all but the two signs there.
IS_LATIN = _table(bytes(b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)))


class Coder:
    """Ids of whole texts by the tokenizers library. The tokenizer drops white
    space and no rule of it looks across, so a text is encoded by its chunks
    between ASCII white space. It also parts letters from the mark after them
    and lower-cases, so a chunk of Latin letters, with one of ``MARKS`` or
    without, is encoded by its letters and its mark: all new ones as words of one
    text, without the pattern, which would find each whole again. Other chunks
    are sent as they are. What is known is not sent again."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.ascii, self.latin = Tokenizer(self.tokenizer.model), Tokenizer(self.tokenizer.model)
        self.ascii.pre_tokenizer = pre_tokenizers.WhitespaceSplit()                  # small ASCII letters stay what they are
        self.latin.normalizer = normalizers.Lowercase()
        self.latin.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.chunks, self.parts = Remembered(REMEMBERED), Remembered(REMEMBERED)

    @staticmethod
    def _split(chunks: pa.BinaryArray) -> tuple[pa.BinaryArray, np.ndarray, np.ndarray]:
        """(what is left of each chunk without its mark and in small letters if
        that is a word, the mark or 0, whether it is a word)."""
        raw, offsets = bytes_of(chunks)
        starts, ends = offsets[:-1], offsets[1:]
        after = np.append(np.uint8(0), raw[:-1]) == 0xC3
        letter = np.where(after, IS_LATIN[raw], IS_LETTER[raw] | (raw == 0xC3))
        mark = np.where(IS_MARK[raw[ends - 1]] & (ends - starts > 1), raw[ends - 1], 0)
        letter[ends[mark > 0] - 1] = True                # the mark is left out of the test
        word = np.logical_and.reduceat(letter, starts)
        mark = np.where(word, mark, 0)
        keep = np.ones(len(raw), bool)
        keep[ends[mark > 0] - 1] = False
        small = np.where(np.repeat(word, ends - starts) & IS_LETTER[raw], raw | 0x20, raw)[keep]
        return binary(small, np.cumsum(ends - starts - (mark > 0))), mark, word

    def _library(self, parts: pa.BinaryArray, word: np.ndarray) -> Lists:
        """Ids of each part: words by the letters only, others by every rule."""
        found, raw = [np.zeros(0, np.uint32)] * len(parts), parts.to_pylist()
        is_ascii = [w and p.isascii() for w, p in zip(word.tolist(), raw)]
        for tokenizer, chosen in ((self.ascii, [i for i, x in enumerate(is_ascii) if x]),
                                  (self.latin, [i for i, x in enumerate(is_ascii) if word[i] and not x])):
            blocks = [chosen[at:at + WORDS_AT_ONCE] for at in range(0, len(chosen), WORDS_AT_ONCE)]
            coded = tokenizer.encode_batch([b" ".join([raw[i] for i in block]).decode() for block in blocks], add_special_tokens=False)
            for block, e in zip(blocks, coded):
                ids = np.array(e.ids, np.uint32)
                cuts = np.searchsorted(np.array(e.word_ids), np.arange(len(block) + 1)).tolist()
                for i, a, b in zip(block, cuts, cuts[1:]):
                    found[i] = ids[a:b]
        rest = np.flatnonzero(~word).tolist()
        for i, e in zip(rest, self.tokenizer.encode_batch([raw[i].decode() for i in rest], add_special_tokens=False)):
            found[i] = np.array(e.ids, np.uint32)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return Lists(sizes, np.concatenate(found) if found else np.zeros(0, np.uint32))

    def _part_ids(self, parts: pa.BinaryArray, word: np.ndarray) -> Lists:
        at = self.parts.find(parts)
        new = np.flatnonzero(at < 0)
        fresh = self._library(parts.take(pa.array(new)), word[new])
        at[new] = len(self.parts.ids.sizes) + np.arange(len(new))
        out = self.parts.ids.add(fresh).take(at)
        self.parts.put(parts.take(pa.array(new)), fresh)
        return out

    def _new_ids(self, chunks: pa.BinaryArray) -> Lists:
        if not len(chunks):
            return Lists.none()
        left, mark, word = self._split(chunks)
        marks = pa.array([bytes([m]) for m in MARKS], pa.binary())
        coded = pa.concat_arrays([marks, left]).dictionary_encode()
        codes = coded.indices.to_numpy()
        is_word = np.zeros(len(coded.dictionary), bool)
        is_word[codes[len(MARKS):][word]] = True          # a text is a word wherever it stands
        ids = self._part_ids(coded.dictionary, is_word)
        ids = ids.add(Lists(np.zeros(1, np.int64), np.zeros(0, np.uint32)))                  # the list of no mark
        of_mark = np.full(256, len(ids.sizes) - 1)
        of_mark[list(MARKS)] = codes[:len(MARKS)]
        both = np.stack([codes[len(MARKS):], of_mark[mark]], axis=1).ravel()
        joined = ids.take(both)
        return Lists(joined.sizes.reshape(-1, 2).sum(axis=1), joined.flat)

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each). No text is null."""
        chunks, first = chunks_of(texts)
        coded = chunks.dictionary_encode()
        at = self.chunks.find(coded.dictionary)
        new = np.flatnonzero(at < 0)
        keys = coded.dictionary.take(pa.array(new))
        fresh = self._new_ids(keys)
        at[new] = len(self.chunks.ids.sizes) + np.arange(len(new))
        ids = self.chunks.ids.add(fresh).take(at[coded.indices.to_numpy()])
        self.chunks.put(keys, fresh)
        before = np.append(0, np.cumsum(ids.sizes))
        return ids.flat, np.diff(before[first])


@lru_cache(maxsize=2)
def load(path: str) -> Coder:
    return Coder(path)


def slices(texts: pa.StringArray, most: int) -> Iterator[tuple[int, pa.StringArray]]:
    """(first row, texts) of at most so many bytes, one text at least."""
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(texts):
        done = int(sizes[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, done + most, side="right")))
        yield at, texts.slice(at, end - at)
        at = end


def write(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
          folder: str | None = None, shard_tokens: int = SHARD_TOKENS, tasks: int | None = None) -> DataFrame:
    """Encode, write the shards' files and return their manifest: (shard, path,
    first_token, n_tokens, n_texts, bytes), shards in ascending order of ids."""
    spark = docs.sparkSession
    folder = folder or work_path(spark, "llm", f"tokens-{uuid.uuid4().hex}")
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder, part, seq = load(tokenizer), TaskContext.get().partitionId(), 0
        attempt = uuid.uuid4().hex                      # a second try of the task writes other files
        tokens: list[np.ndarray] = []
        lengths: list[np.ndarray] = []
        ids: list[pa.Array] = []
        size = 0

        def close() -> pa.RecordBatch:
            nonlocal tokens, lengths, ids, size, seq
            each = np.concatenate(lengths)
            uri = f"{folder}/{part:06d}-{seq:06d}-{attempt}.wm"
            n_bytes = Writer.write(uri, np.concatenate(tokens), np.cumsum(each) - each, pa.concat_arrays(ids))
            row = [part, seq, uri, size, len(each), n_bytes]
            tokens, lengths, ids, size, seq = [], [], [], 0, seq + 1
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in row], ["part", "seq", "path", "n_tokens", "n_texts", "bytes"])

        for b in batches:
            for row, texts in slices(b.column(1), SLICE_BYTES):
                found, each = coder.encode(texts)
                found, each = np.insert(found, np.cumsum(each), end_id), each + 1
                ends, at = np.cumsum(each), 0
                while at < len(each):                   # texts up to the one that fills the shard
                    done = int(ends[at - 1]) if at else 0
                    to = min(len(each), int(np.searchsorted(ends, done + shard_tokens - size)) + 1)
                    tokens.append(found[done:int(ends[to - 1])])
                    lengths.append(each[at:to])
                    ids.append(b.column(0).slice(row + at, to - at))
                    size += int(ends[to - 1]) - done
                    at = to
                    if size >= shard_tokens:
                        yield close()
        if size:
            yield close()
    df = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                     F.monotonically_increasing_id().alias("row"))
    dealt = df.repartitionByRange(tasks, "id", "row").sortWithinPartitions("id", "row").select("id", "text")
    files = stored(dealt.mapInArrow(run, "part long, seq long, path string, n_tokens long, n_texts long, bytes long"), "shards")
    return numbered(files)


def numbered(files: DataFrame) -> DataFrame:
    """Shards numbered in order, with the tokens before each: sums per task,
    running sums over one row per task, running sums inside each task."""
    inside = Window.partitionBy("part").orderBy("seq")
    before = Window.orderBy("part")
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("s")).select(
        "part", (F.sum("t").over(before) - F.col("t")).alias("t0"), (F.sum("s").over(before) - F.col("s")).alias("s0"))
    return files.join(parts, "part").select(
        (F.col("s0") + F.col("seq")).alias("shard"), "path",
        (F.col("t0") + F.sum("n_tokens").over(inside) - F.col("n_tokens")).alias("first_token"), "n_tokens", "n_texts", "bytes")


# ---- reading

def _over_files(manifest: DataFrame, read: Callable[[str, int], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``read(path, first_token)`` yields record batches of each file, files
    dealt evenly over the tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, first in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                yield from read(path, first)
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("path", "first_token").repartition(tasks, "path").mapInArrow(run, schema)


def spans(manifest: DataFrame, id_type: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every text, read from the files."""
    def read(path: str, first: int) -> Iterator[pa.RecordBatch]:
        file = Reader(path)
        tokens, starts = file.decode().astype("<u4"), file.starts
        ends = np.append(starts[1:], file.n)
        crc = [zlib.crc32(tokens[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
        file.close()
        yield pa.RecordBatch.from_arrays([file.ids, pa.array(starts + first), pa.array(ends - starts), pa.array(crc, pa.int64())],
                                         [id_col, "start", "n_tokens", "ids_crc32"])
    return _over_files(manifest, read, f"`{id_col}` {id_type}, start long, n_tokens long, ids_crc32 long")


def tokens(manifest: DataFrame, id_type: str, id_col: str = "doc_id") -> DataFrame:
    """(id, ids): the tokens of every text, read from the files."""
    def read(path: str, first: int) -> Iterator[pa.RecordBatch]:
        file = Reader(path)
        found, bounds = file.decode().astype(np.int32), np.append(file.starts, file.n)
        file.close()
        for at in range(0, file.n_texts, 1024):
            part = bounds[at:at + 1025]
            lists = pa.ListArray.from_arrays(pa.array(part - part[0], pa.int32()), pa.array(found[part[0]:part[-1]]))
            yield pa.RecordBatch.from_arrays([file.ids.slice(at, 1024), lists], [id_col, "ids"])
    return _over_files(manifest, read, f"`{id_col}` {id_type}, ids array<int>")


def counts(manifest: DataFrame, wanted: Sequence[int]) -> DataFrame:
    """(token, n): occurrences of each wanted token in all shards, two ranks a
    plane and file."""
    def read(path: str, first: int) -> Iterator[pa.RecordBatch]:
        file = Reader(path)
        found = [file.count(t) for t in wanted]
        file.close()
        yield pa.RecordBatch.from_arrays([pa.array(wanted, pa.int64()), pa.array(found, pa.int64())], ["token", "n"])
    return _over_files(manifest, read, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def occurrences(manifest: DataFrame, token: int) -> DataFrame:
    """(position): every place of a token in the whole sequence."""
    def read(path: str, first: int) -> Iterator[pa.RecordBatch]:
        file = Reader(path)
        places = (i + first for i in file.occurrences(token))
        while len(part := np.fromiter((p for p, _ in zip(places, range(1 << 16))), np.int64)):
            yield pa.RecordBatch.from_arrays([pa.array(part)], ["position"])
        file.close()
    return _over_files(manifest, read, "position long")


def at(manifest: DataFrame, positions: DataFrame, col: str = "position") -> DataFrame:
    """``positions`` with the ``token`` at each place of the whole sequence
    (null outside it). Places meet their file by the stretches of 2^20 tokens
    that both touch; a file's places are dealt in groups, so that one file asked
    for a lot is no single task."""
    tasks = int(positions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stretch = lambda c: F.shiftright(c, STRETCH)
    files = manifest.select(F.explode(F.sequence(stretch(F.col("first_token")), stretch(F.col("first_token") + F.col("n_tokens") - 1))).alias("slot"),
                            "path", "first_token", "n_tokens")
    place = unused(positions, "place")
    asked = positions.select(F.col(col).cast("long").alias("place")).distinct()
    met = asked.withColumn("slot", stretch(F.col("place"))).join(files, "slot").where(
        "place >= first_token and place < first_token + n_tokens").select("path", "first_token", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, file = None, None
        for b in batches:
            out = []
            for p, first, i in zip(*(c.to_pylist() for c in b.columns)):
                if p != path:
                    if file:
                        file.close()
                    path, file = p, Reader(p)
                out.append(file.access(i - first))
            yield pa.RecordBatch.from_arrays([b.column(2), pa.array(out, pa.int64())], ["place", "token"])
        if file:
            file.close()
    found = met.repartition(tasks, "path", F.shiftright("place", 12)).sortWithinPartitions("path", "place").mapInArrow(
        run, "place long, token long")
    named = found.select(F.col("place").alias(place), F.col("token").alias(unused(positions, "token")))
    return positions.join(named, F.col(col).cast("long") == F.col(place), "left").drop(place)
