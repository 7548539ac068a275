"""Token ids in wavelet-matrix shards: one compressed file per run of documents, with rank, select and access.

File: MAGIC, the length of a JSON header, the header, then sections. The header names the sections' places: document ids,
token offsets, and for each bit plane (most significant first) its zeros, the ones before each block, the blocks' places
and the blocks. A block holds BLOCK bits of a plane, zstd-compressed where that is smaller.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vistaloom.llm.common import partitions, passing, saved, scratch, small_batches

MAGIC = b"WVLM0001"
BLOCK = 1 << 16
CACHE = 1_600_000
#: Bytes of text that are cut and looked up together.
TOGETHER = 6_000_000
#: Tokens of a file, beyond which a task begins another one.
SHARD = 8_000_000


def packed_planes(tokens: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, int]]:
    """Each plane's packed bits and number of zeros; zeros move stably to the front from plane to plane."""
    a = tokens
    for b in range(bits - 1, -1, -1):
        one = (a & a.dtype.type(1 << b)) != 0
        low = a.compress(~one)
        yield np.packbits(one, bitorder="little"), len(low)
        a = np.concatenate((low, a.compress(one)))


def written(tokens: np.ndarray, doc_ids: list[int | None], offsets: np.ndarray) -> bytes:
    """The bytes of a shard file. Planes are of the tokens' numbers among those that occur, so that there are few."""
    present = np.flatnonzero(np.bincount(tokens)) if len(tokens) else np.zeros(0, np.int64)
    number = np.zeros(int(present[-1]) + 1 if len(present) else 1, np.uint16 if len(present) <= 1 << 16 else np.uint32)
    number[present] = np.arange(len(present))
    tokens, bits = number[tokens], max(1, max(0, len(present) - 1).bit_length())
    zip_ = zstandard.ZstdCompressor(level=1)
    header: dict = {"tokens": len(tokens), "bits": bits, "docs": len(doc_ids), "null_ids": [k for k, d in enumerate(doc_ids) if d is None], "sections": {}, "zeros": []}
    parts: list[bytes] = []
    size = 0

    def put(name: str, data: bytes) -> None:
        nonlocal size
        header["sections"][name] = [size, len(data)]
        parts.append(data)
        size += len(data)

    put("doc_ids", np.array([d or 0 for d in doc_ids], "<i8").tobytes())
    put("offsets", offsets.astype("<i8").tobytes())
    put("alphabet", present.astype("<i8").tobytes())
    for k, (packed, zeros) in enumerate(packed_planes(tokens, bits)):
        header["zeros"].append(zeros)
        blocks, places, ones = [], [0], [0]
        for i in range(0, len(packed), BLOCK // 8):
            raw = packed[i : i + BLOCK // 8]
            small = zip_.compress(raw.tobytes())
            blocks.append(b"\x01" + small if len(small) < len(raw) else b"\x00" + raw.tobytes())
            places.append(places[-1] + len(blocks[-1]))
            ones.append(ones[-1] + int(np.bitwise_count(raw).sum(dtype=np.int64)))
        put(f"places{k}", np.array(places, "<i8").tobytes())
        put(f"ones{k}", np.array(ones, "<i8").tobytes())
        put(f"blocks{k}", b"".join(blocks))
    head = json.dumps(header).encode()
    return MAGIC + struct.pack("<Q", len(head)) + head + b"".join(parts)


class WaveletShard:
    """Reads a shard file; only the blocks that an access touches are decompressed."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a wavelet shard")
        (n,) = struct.unpack_from("<Q", data, 8)
        self.header = json.loads(data[16 : 16 + n])
        self.body = memoryview(data)[16 + n :]
        self.n, self.bits = self.header["tokens"], self.header["bits"]
        self.doc_ids: list[int | None] = self.numbers("doc_ids").tolist()
        for k in self.header["null_ids"]:
            self.doc_ids[k] = None
        self.offsets = self.numbers("offsets")
        self.alphabet = self.numbers("alphabet")
        self.zeros = self.header["zeros"]
        self.places = [self.numbers(f"places{k}") for k in range(self.bits)]
        self.ones = [self.numbers(f"ones{k}") for k in range(self.bits)]
        self.block = lru_cache(maxsize=256)(self._block)
        self.unzip = zstandard.ZstdDecompressor()

    def section(self, name: str) -> memoryview:
        at, size = self.header["sections"][name]
        return self.body[at : at + size]

    def numbers(self, name: str) -> np.ndarray:
        return np.frombuffer(self.section(name), "<i8")

    def _block(self, plane: int, k: int) -> np.ndarray:
        data = self.section(f"blocks{plane}")[self.places[plane][k] : self.places[plane][k + 1]]
        return np.frombuffer(self.unzip.decompress(data[1:], max_output_size=BLOCK // 8) if data[0] else data[1:], np.uint8)

    def ones_before(self, plane: int, i: int) -> int:
        k, rest = divmod(i, BLOCK)
        if not rest:
            return int(self.ones[plane][k])
        block = self.block(plane, k)
        whole = int(np.bitwise_count(block[: rest // 8]).sum(dtype=np.int64))
        return int(self.ones[plane][k]) + whole + ((int(block[rest // 8]) & ((1 << rest % 8) - 1)).bit_count() if rest % 8 else 0)

    def access(self, i: int) -> int:
        """The token at a place."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        token = 0
        for k in range(self.bits):
            b, r = self.block(k, i // BLOCK), i % BLOCK
            one = int(b[r // 8]) >> (r % 8) & 1
            before = self.ones_before(k, i)
            token = token << 1 | one
            i = self.zeros[k] + before if one else i - before
        return int(self.alphabet[token])

    def number(self, token: int) -> int | None:
        """A token's number among those that occur."""
        k = int(np.searchsorted(self.alphabet, token))
        return k if k < len(self.alphabet) and self.alphabet[k] == token else None

    def span(self, number: int, upto: int) -> tuple[int, int]:
        """The run of the last plane's order that holds a token's occurrences before a place."""
        a, b = 0, upto
        for k in range(self.bits):
            x, y = self.ones_before(k, a), self.ones_before(k, b)
            a, b = (self.zeros[k] + x, self.zeros[k] + y) if number >> (self.bits - 1 - k) & 1 else (a - x, b - y)
        return a, b

    def rank(self, token: int, upto: int) -> int:
        """How often the token occurs before a place."""
        number = self.number(token)
        if number is None:
            return 0
        a, b = self.span(number, upto)
        return b - a

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def place_of(self, plane: int, one: int, j: int) -> int:
        """Where the bit `one` occurs for the (j + 1)th time in a plane."""
        bounds = self.ones[plane] if one else np.minimum(np.arange(len(self.ones[plane])) * BLOCK, self.n) - self.ones[plane]
        k = int(np.searchsorted(bounds, j, side="right")) - 1
        bits = np.unpackbits(self.block(plane, k), bitorder="little")[: self.n - k * BLOCK]
        return k * BLOCK + int(np.flatnonzero(bits == one)[j - int(bounds[k])])

    def select(self, token: int, j: int) -> int:
        """The place of the token's (j + 1)th occurrence."""
        number = self.number(token)
        a, b = (0, 0) if number is None else self.span(number, self.n)
        if not 0 <= j < b - a:
            raise IndexError(j)
        i = a + j
        for k in range(self.bits - 1, -1, -1):
            one = number >> (self.bits - 1 - k) & 1
            i = self.place_of(k, one, i - self.zeros[k] if one else i)
        return i

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, j) for j in range(self.count(token))]

    def tokens(self) -> np.ndarray:
        """All tokens, by undoing the planes from the last to the first."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        a = np.zeros(self.n, kind)
        for k in range(self.bits - 1, -1, -1):
            packed = [self._block(k, j) for j in range(len(self.places[k]) - 1)]
            one = np.unpackbits(np.concatenate(packed), bitorder="little")[: self.n].view(bool) if packed else np.zeros(0, bool)
            out = np.empty(self.n, kind)
            out[~one] = a[: self.zeros[k]]
            out[one] = a[self.zeros[k] :] | kind(1 << (self.bits - 1 - k))
            a = out
        return self.alphabet.astype("<u4")[a] if self.n else np.zeros(0, "<u4")


#: Kinds of bytes: letters (all beyond ASCII too), digits, spaces, other white space, and the rest.
LETTER, DIGIT, SPACE, BREAK, SIGN = range(5)
KINDS = np.array([LETTER if b >= 128 or 65 <= b <= 90 or 97 <= b <= 122 else DIGIT if 48 <= b <= 57 else SPACE if b == 32 else BREAK if 9 <= b <= 13 else SIGN for b in range(256)], np.uint8)
WHITE = (KINDS == SPACE) | (KINDS == BREAK)
ODD = np.array([b == 39 or 28 <= b <= 31 for b in range(256)])


class Encoder:
    """Whole texts to packed ids.

    Texts are cut where the tokenizer's pattern cuts them: at each change between letters, digits and other signs, a space
    going with what follows it. That holds where no two white-space characters meet, there is no apostrophe, and all beyond
    ASCII are letters; other texts, and those with a special token's name, go to the library whole. Each distinct piece of a
    batch is looked up once, and new ones go to the library many at a time, as one text: each begins with its space, and so
    does the first token of each and no other.
    """

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel ones
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.bits = max(1, max(end_id, self.tokenizer.get_vocab_size() - 1).bit_length())
        self.kind, self.type = ("H", np.uint16) if self.bits <= 16 else ("I", np.uint32)
        self.end = np.array([end_id], self.type)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.beyond = re.compile(r"[^\x00-\x7f]+").findall
        space = self.tokenizer.encode(" ", add_special_tokens=False).tokens[0]
        self.spaced = np.zeros(1 << self.bits, bool)
        self.spaced[[i for t, i in self.tokenizer.get_vocab().items() if t.startswith(space)]] = True
        self.known: dict[bytes, bytes] = {}

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.type)

    def learn(self, pieces: list[bytes]) -> None:
        spaced = [p for p in pieces if p[:1] == b" " and len(p) > 1]
        groups = [spaced[k : k + 128] for k in range(0, len(spaced), 128)]
        for group, got in zip(groups, self.tokenizer.encode_batch_fast([b"".join(g).decode(errors="replace") for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(got.ids, self.type)
            cuts = (np.flatnonzero(self.spaced[ids]) * ids.itemsize).tolist()
            packed = ids.tobytes()
            self.known.update(zip(group, [packed[a:b] for a, b in zip(cuts, [*cuts[1:], len(packed)], strict=True)], strict=True))
        for p in pieces:
            if p not in self.known:
                self.known[p] = self.whole(p.decode(errors="replace")).tobytes()

    def regular(self, text: str) -> bool:
        return not any(t in text for t in self.special) and (text.isascii() or all(map(str.isalpha, self.beyond(text))))

    def pieces(self, buf: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Where pieces begin in texts laid end to end, which begin at starts."""
        kind = KINDS[buf]
        cut = np.empty(len(buf), bool)
        cut[0] = True
        np.not_equal(kind[1:], kind[:-1], out=cut[1:])
        cut[1:] &= kind[:-1] != SPACE
        cut |= kind == SPACE
        cut[1:] |= kind[:-1] == BREAK
        cut[starts] = True
        return np.flatnonzero(cut)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Of each text its ids and the end id."""
        out: list[np.ndarray] = [self.end] * len(texts)
        some = [k for k, t in enumerate(texts) if t]
        if not some:
            return out
        raw = [texts[k].encode() for k in some]
        joined = b"".join(raw)
        buf = np.frombuffer(joined + bytes(8), np.uint8)
        edge = np.cumsum([0, *map(len, raw)])
        white = WHITE[buf[:-8]]
        met = white[1:] & white[:-1]
        met[edge[1:-1] - 1] = False
        odd = {*(np.searchsorted(edge, np.append(np.flatnonzero(met), np.flatnonzero(ODD[buf[:-8]])), side="right") - 1).tolist()}
        at = self.pieces(buf[:-8], edge[:-1])
        stop = np.append(at[1:], len(joined))
        size = stop - at
        mark = hashed_spans(buf, at, size)
        mark, first, which = np.unique(mark, return_index=True, return_inverse=True)
        if not same_spans(buf, at, at[first[which]], size, size[first[which]]).all():  # two pieces of one hash
            return [np.concatenate((self.whole(t), self.end)) if t else self.end for t in texts]
        distinct = [joined[a:b] for a, b in zip(at[first].tolist(), stop[first].tolist(), strict=True)]
        if len(self.known) >= CACHE:
            self.known = {}
        if new := [p for p in distinct if p not in self.known]:
            self.learn(new)
        packed = [self.known[p] for p in distinct]
        ids = np.frombuffer(b"".join(packed), self.type)
        count = np.fromiter(map(len, packed), np.int64, len(packed)) // ids.itemsize
        begin = np.cumsum(count) - count
        each = count[which]
        upto = np.cumsum(each)
        flat = ids[np.repeat(begin[which] - (upto - each), each) + np.arange(upto[-1])]
        cut = np.append(0, upto)[np.searchsorted(at, edge)]
        for n, (k, a, b) in enumerate(zip(some, cut[:-1].tolist(), cut[1:].tolist(), strict=True)):
            out[k] = np.concatenate((flat[a:b] if n not in odd and self.regular(texts[k]) else self.whole(texts[k]), self.end))
        return out


def hashed_spans(buf: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; 8 readable bytes follow the last span."""
    x = np.ndarray(len(buf) - 7, "<u8", buf, strides=(1,))
    h = size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    low = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    live = np.arange(len(at))
    step = 0
    while len(live):
        left = size[live] - step
        part = x[np.minimum(at[live] + step, len(x) - 1)] & low[np.minimum(left, 8)]
        m = (h[live] ^ part) * np.uint64(0xBF58476D1CE4E5B9)
        m = (m ^ (m >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        h[live] = m ^ (m >> np.uint64(29))
        live = live[left > 8]
        step += 8
    return h


def same_spans(buf: np.ndarray, a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Whether the spans at a and at b have the same bytes; 8 readable bytes follow the last span."""
    x = np.ndarray(len(buf) - 7, "<u8", buf, strides=(1,))
    low = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    same = size_a == size_b
    live, step = np.flatnonzero(same & (a != b)), 0
    while len(live):
        left = size_a[live] - step
        differ = (x[a[live] + step] ^ x[b[live] + step]) & low[np.minimum(left, 8)]
        same[live] = differ == 0
        live = live[(differ == 0) & (left > 8)]
        step += 8
    return same


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, end_id: int) -> Encoder:
    """One encoder per worker process."""
    if (path, end_id) not in _encoders:
        _encoders[path, end_id] = Encoder(path, end_id)
    return _encoders[path, end_id]


def write_shards(folder: str, tokenizer: str, end_id: int, tokens: int = SHARD):
    """For mapInArrow over (doc_id, text) in order of doc_id: writes files of some `tokens` tokens each; their places and sizes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = encoder(tokenizer, end_id)
        fs, base = pafs.FileSystem.from_uri(folder)
        names: list[int | None] = []
        texts: list[str] = []
        docs: list[int | None] = []
        ids: list[np.ndarray] = []
        held, part = 0, 0

        def encode() -> int:
            got = use.ids(texts)
            docs.extend(names)
            ids.extend(got)
            names.clear()
            texts.clear()
            return sum(map(len, got))

        def shard() -> pa.RecordBatch:
            offsets = np.cumsum([0, *map(len, ids)])
            path, own = f"{base}/shard-{TaskContext.get().partitionId():07d}-{part:05d}.wvlm", f"{base}/{uuid.uuid4().hex}.part"
            with fs.open_output_stream(own) as out:  # attempts don't meet; each moves a whole file into place
                out.write(written(np.concatenate(ids), docs, offsets))
            fs.move(own, path)
            made = pa.record_batch([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([part], pa.int32()), pa.array([path.rpartition("/")[2]]), pa.array([len(docs)], pa.int64()), pa.array([int(offsets[-1])], pa.int64())], names=["shard", "part", "file", "n_docs", "n_tokens"])
            docs.clear()
            ids.clear()
            return made

        fs.create_dir(base, recursive=True)
        for b in batches:
            names += b.column(0).to_pylist()
            texts += [t or "" for t in b.column(1).to_pylist()]
            if sum(map(len, texts)) >= min(TOGETHER, tokens):
                held += encode()
            if held >= tokens:
                yield shard()
                held, part = 0, part + 1
        encode()
        if docs:
            yield shard()

    return rows


def read_shards(folder: str):
    """For mapInArrow over (file, start): of each document of the files its id, where its tokens start, and the tokens."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        for b in batches:
            for file, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                with fs.open_input_stream(f"{base}/{file}") as source:
                    shard = WaveletShard(source.read())
                tokens, at = shard.tokens(), shard.offsets
                for k in range(0, len(shard.doc_ids), 2000):
                    part = at[k : k + 2001]
                    crc = [zlib.crc32(tokens[x:y].tobytes()) for x, y in zip(part[:-1].tolist(), part[1:].tolist(), strict=True)]
                    yield pa.record_batch([pa.array(shard.doc_ids[k : k + 2000], pa.int64()), pa.array(start + part[:-1]), pa.array(np.diff(part)), pa.array(crc, pa.int64()), pa.array([file] * (len(part) - 1))], names=["doc_id", "start", "n_tokens", "ids_crc32", "file"])

    return rows


def sharded(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Writes the token ids of docs below folder; (shard, part, file, n_docs, n_tokens, start), files in order of doc_id.

    Each text ends with end_id. Null texts are empty, null ids come first, rows with one id follow one another. Documents are
    dealt by ranges of doc_id, so a source or a group of copies of any size spreads by its ids, and a range becomes as many
    files as its tokens need. An empty table writes no file.
    """
    spark = docs.sparkSession
    small_batches(spark)
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).repartitionByRange(partitions(spark), "doc_id").sortWithinPartitions("doc_id")
    files = saved(dealt.mapInArrow(write_shards(folder, tokenizer, end_id), "shard int, part int, file string, n_docs long, n_tokens long"), "wavelet-files")
    passing(spark, folder)
    return files.withColumn("start", F.coalesce(F.sum("n_tokens").over(Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))  # a row per file


def contents(files: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, file) of every document, read back from the files."""
    dealt = files.select("file", "start").repartitionByRange(partitions(files.sparkSession), "file")
    return dealt.mapInArrow(read_shards(folder), "doc_id long, start long, n_tokens long, ids_crc32 long, file string")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """sharded(), then contents(), in a new folder of the shared one."""
    folder = scratch(docs.sparkSession, "wavelet")
    return contents(sharded(docs, folder, tokenizer, end_id), folder)
