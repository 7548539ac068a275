"""Exact substring deduplication by a column-wise built Burrows-Wheeler transform with common prefixes.

Repeated strings of `length` bytes are found in three steps. Every document is cut at anchors, the leftmost least hash of
ANCHOR bytes in each window of `length` bytes: equal windows have equal anchors at equal places, so strings need to be
compared only where they share an anchor, and always in the same column. Contexts of an anchor (all windows around it)
that are equal, by two hashes of 64 bits, fold into the first one, whose copies are repeats as they stand. The contexts of
anchors that have several are the documents of a collection whose transform is built from the last column to the first, one
symbol per context a round; common prefixes of `length` or more make the classes of equal windows. Every window of a
context contains its anchor, so one collection may hold the contexts of any number of anchors.

An anchor at the edge of a passage that very many documents share has as many contexts. Such anchors are known beforehand,
from a sample of the documents; that decides only how rows are dealt out. Their contexts are folded where their hash says,
and go on in parts, each dealt by all bytes that its windows have in common; parts with a crowd of their own, as one window
alone each.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vistaloom.llm.common import document_bytes, merged, partitions, saved, shared_dir, small_batches, starts_of, table_of, utf8

ANCHOR = 32
PAD = 0xFF  # in no UTF-8 text
PIECE = 1 << 20
POSITION_BITS = 27
#: One document in SAMPLE tells which anchors are crowded: those with over half a task's share of the sample's contexts, and with CROWD at least.
SAMPLE, CROWD = 16, 16
PARTS = 9
#: Contexts of a collection, and those beyond which its layers go to files.
ROWS, IN_MEMORY = 200_000, 1_000_000


def words_at(buf: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position as one number."""
    return np.ndarray(len(buf) - 7, "<u8", buf, strides=(1,)).copy()


def mixed(h: np.ndarray, x: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    h += x
    return h


def finished(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def window_minima(key: np.ndarray, width: int) -> np.ndarray:
    low, have = key, 1
    while have * 2 <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    return low if have == width else np.minimum(low[: len(low) - (width - have)], low[width - have :])


class Pieces:
    """Gathers whole texts into padded buffers; a text longer than PIECE is cut where no window or context is lost."""

    def __init__(self, length: int):
        self.length, self.side = length, length - ANCHOR
        self.parts: list[np.ndarray] = []
        self.spans: list[tuple[int, int, int, int]] = []  # document, place of its byte 0 in the buffer, first window, end of windows
        self.size = 0
        self.pad = np.full(length + 8, PAD, np.uint8)

    def add(self, doc: int, raw: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        last = len(raw) - self.length + 1
        for a in range(0, last, PIECE):
            b = min(last, a + PIECE)
            lo, hi = max(0, a - self.side), min(len(raw), b + 2 * self.length)
            if self.size and self.size + hi - lo > PIECE:
                yield self.flush()
            self.spans.append((doc, self.size + len(self.pad) - lo, a, b))
            self.parts += [self.pad, raw[lo:hi]]
            self.size += len(self.pad) + hi - lo

    def flush(self) -> tuple[np.ndarray, ...]:
        """Of each anchor: its document, place in it, hash, and the hash of its context."""
        buf = np.concatenate([*self.parts, self.pad, self.pad])
        spans = np.array(self.spans, np.int64).reshape(-1, 4)
        self.parts, self.spans, self.size = [], [], 0
        x = words_at(buf)
        n = len(buf) - ANCHOR + 1
        h = x[:n].copy()
        for k in range(8, ANCHOR, 8):
            h = mixed(h, x[k : k + n])
        h = finished(h)
        key = (h & ~np.uint64((1 << POSITION_BITS) - 1)) | np.arange(n, dtype=np.uint64)
        low = window_minima(key, self.length - ANCHOR + 1)
        edge = np.zeros(len(low) + 1, np.int32)
        np.add.at(edge, spans[:, 1] + spans[:, 2], 1)
        np.add.at(edge, spans[:, 1] + spans[:, 3], -1)
        place = (low[np.cumsum(edge[:-1]) > 0] & np.uint64((1 << POSITION_BITS) - 1)).astype(np.int64)
        if len(place):
            place = place[np.append(True, place[1:] != place[:-1])]
        which = np.searchsorted(spans[:, 1] + spans[:, 2], place, side="right") - 1
        context = x[place - self.side]
        for k in range(8, self.side + self.length, 8):
            context = mixed(context, x[place - self.side + min(k, self.side + self.length - 8)])
        return spans[which, 0], place - spans[which, 1], h[place].view(np.int64), finished(context).view(np.int64)


def first_of_contexts(h: np.ndarray, context: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that puts equal contexts together, each with its earliest place first, without repeats; and where the contexts begin."""
    order = np.lexsort((pos, doc, context, h))
    keep = starts_of(h[order], context[order], doc[order], pos[order])
    order = order[keep]
    return order, starts_of(h[order], context[order])


RANGES = "doc long, start int, stop int, anchor long, crowded boolean"


def ranges_batch(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[pa.RecordBatch]:
    doc, start, end = merged(doc, start, end)
    for k in range(0, len(doc), 200_000):
        n = len(doc[k : k + 200_000])
        yield pa.record_batch([pa.array(doc[k : k + n]), pa.array(start[k : k + n].astype(np.int32)), pa.array(end[k : k + n].astype(np.int32)), pa.array(np.zeros(n, np.int64)), pa.array(np.zeros(n, bool))], names=["doc", "start", "stop", "anchor", "crowded"])


def cut_anchors(length: int):
    """For mapInArrow over (doc, text): anchors (key = their hash), and the ranges that copies within the task make (key = the document)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[np.ndarray, ...]] = []
        count = 0

        def given() -> Iterator[pa.RecordBatch]:
            doc, pos, h, context = (np.concatenate(c) for c in zip(*found, strict=True))
            found.clear()
            order, at = first_of_contexts(h, context, doc, pos)
            again = np.ones(len(order), bool)
            again[at] = False
            copy = order[again]
            d, s, e = merged(doc[copy], pos[copy] - (length - ANCHOR), pos[copy] + length)
            order = order[at]
            for k, c, w, a, b in ((h[order], context[order], doc[order], pos[order], np.full(len(order), -1)), (d * 2654435761, np.zeros(len(d), np.int64), d, s, e)):
                for i in range(0, len(k), 200_000):
                    j = slice(i, i + 200_000)
                    yield pa.record_batch([pa.array(k[j]), pa.array(c[j]), pa.array(w[j]), pa.array(a[j].astype(np.int32)), pa.array(b[j].astype(np.int32))], names=["key", "context", "doc", "pos", "stop"])

        pieces = Pieces(length)
        for b in batches:
            raw, at = utf8(b.column(1))
            for doc, s, e in zip(b.column(0).to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                for got in pieces.add(doc, raw[s:e]):
                    found.append(got)
                    count += len(got[0])
            if count > 2_000_000:
                yield from given()
                count = 0
        if pieces.spans:
            found.append(pieces.flush())
        if found:
            yield from given()

    return rows


def fold_contexts(length: int):
    """For mapInArrow over anchors dealt by key, crowded ones by key and context: the ranges of copied contexts, and a request (stop -1) for the first of each context, where its anchor has several or is crowded."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = table_of(batches, ["key", "context", "doc", "pos", "stop", "crowded"])
        if t is None:
            return
        known, anchor = t["stop"] >= 0, t["stop"] < 0
        h, context, doc, pos, crowded = (t[c][anchor] for c in ("key", "context", "doc", "pos", "crowded"))
        order, at = first_of_contexts(h, context, doc, pos)
        again = np.ones(len(order), bool)
        again[at] = False
        copy, first = order[again], order[at]
        yield from ranges_batch(np.append(t["doc"][known], doc[copy]), np.append(t["pos"][known], pos[copy] - (length - ANCHOR)), np.append(t["stop"][known], pos[copy] + length))
        group = starts_of(h[first])
        several = np.repeat(np.diff(np.append(group, len(first))), np.diff(np.append(group, len(first)))) > 1 if len(first) else np.zeros(0, bool)
        first = first[several | crowded[first].astype(bool)]
        for k in range(0, len(first), 200_000):
            f = first[k : k + 200_000]
            yield pa.record_batch([pa.array(doc[f]), pa.array(pos[f].astype(np.int32)), pa.array(np.full(len(f), -1, np.int32)), pa.array(h[f]), pa.array(crowded[f].astype(bool))], names=["doc", "start", "stop", "anchor", "crowded"])

    return rows


CONTEXTS = pa.schema([("key", pa.int64()), ("first", pa.int32()), ("windows", pa.int32()), ("doc", pa.int64()), ("pos", pa.int32()), ("stop", pa.int32()), ("context", pa.binary())])


def part_key(part: bytes, first: int, windows: int, length: int) -> int:
    """A hash of the bytes that all windows of a part have in common."""
    return int.from_bytes(hashlib.blake2b(part[windows - 1 : length], digest_size=8, salt=bytes([first, windows])).digest(), "little", signed=True)


def cut_contexts(length: int, split: frozenset[int] = frozenset()):
    """For mapInArrow over (doc, text, wanted): the context of each wanted anchor.

    The contexts of a crowded anchor go out in PARTS parts, each keyed by all bytes that its windows have in common, and
    parts with a key in split as one window alone each, so that a passage's edge in very many documents doesn't meet in one
    task. Equal parts of a task are one, and the others are ranges (stop >= 0, keyed by the document).
    """
    side = length - ANCHOR
    step = -(-(side + 1) // PARTS)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[tuple[int, int, int, bytes], tuple[int, int]] = {}
        copies: list[tuple[int, int, int]] = []

        def given(out: list[tuple]) -> Iterator[pa.RecordBatch]:
            for k in range(0, len(out), 50_000):
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out[k : k + 50_000], strict=True), CONTEXTS, strict=True)], schema=CONTEXTS)

        def crowd() -> Iterator[pa.RecordBatch]:
            yield from given([(k, o, n, *place, -1, part) for (k, o, n, part), place in parts.items()])
            if copies:
                d, s, e = merged(*(np.array(c, np.int64) for c in zip(*copies, strict=True)))
                yield from given([(x * 2654435761 & 0xFFFFFFFF, 0, 0, x, y, z, b"") for x, y, z in zip(d.tolist(), s.tolist(), e.tolist(), strict=True)])
            parts.clear()
            copies.clear()

        def put(context: bytes, o: int, n: int, doc: int, pos: int, end: int) -> None:
            low, high = max(o, side - pos), min(o + n - 1, end - length - pos + side)  # its windows inside the text
            if low > high:
                return
            part = context[o : o + n - 1 + length]
            key = part_key(part, o, n, length)
            if n > 1 and key in split:
                for w in range(low, high + 1):
                    put(context, w, 1, doc, pos, end)
                return
            mark, place = (key, o, n, part), (doc, pos)
            held = parts.setdefault(mark, place)
            if held == place:
                return
            parts[mark], (d, q) = min(held, place), max(held, place)
            copies.append((d, q - side + low, q - side + high + length))

        for b in batches:
            out: list[tuple] = []
            for doc, text, wanted in zip(b.column(0).to_pylist(), document_bytes(b.column(1)), b.column(2).to_pylist(), strict=True):
                for w in wanted:
                    pos = w["start"]
                    lo, hi = pos - side, pos + length
                    context = b"\xff" * max(0, -lo) + text[max(0, lo) : hi] + b"\xff" * max(0, hi - len(text))
                    if not w["crowded"]:
                        out.append((w["anchor"], 0, side + 1, doc, pos, -1, context))
                        continue
                    for o in range(0, side + 1, step):
                        put(context, o, min(step, side + 1 - o), doc, pos, len(text))
            yield from given(out)
            if len(parts) + len(copies) > ROWS:
                yield from crowd()
        yield from crowd()

    return rows


class Layers:
    """Named arrays of one round, read in the next: kept, or as sequential files of the shared folder where they are long."""

    def __init__(self, folder: str | None):
        self.kept: dict[str, np.ndarray] = {}
        if folder:
            self.fs, base = pafs.FileSystem.from_uri(folder)
            self.base = f"{base}/suffix-layers-{uuid.uuid4().hex}"
            self.fs.create_dir(self.base, recursive=True)
        self.folder = folder

    def put(self, name: str, x: np.ndarray) -> None:
        if not self.folder:
            self.kept[name] = x
            return
        with self.fs.open_output_stream(f"{self.base}/{name}") as out:
            out.write(x.tobytes())

    def get(self, name: str, kind: type) -> np.ndarray:
        if not self.folder:
            return self.kept[name]
        with self.fs.open_input_stream(f"{self.base}/{name}") as source:
            return np.frombuffer(source.read(), kind)

    def close(self) -> None:
        self.kept.clear()
        if self.folder:
            self.fs.delete_dir(self.base)


class ColumnwiseTransform:
    """Burrows-Wheeler transform and common prefixes of a collection of equally long rows, built column by column.

    Each round puts one symbol of every row in front of its suffix. Suffixes that begin in the same column form a layer:
    the order of its rows, their common prefixes, and its part of the transform, the symbols in front of its suffixes in
    order. The next round reads that part: the suffix with the symbol c in front that stands at place i of the last layer
    goes to the place of all smaller symbols plus the rank of c before i. The common prefix of two neighbours is one more
    than the least in the range between their places in the last layer, or 0. Suffixes of different columns are never
    neighbours that matter here, so layers are kept apart rather than merged. Columns and layers are arrays in Layers.
    """

    def __init__(self, column: Iterator[np.ndarray], folder: str | None = None):
        """column: the symbols of all rows in each column, the first column first."""
        self.layers, self.width = Layers(folder), 0
        m = 0
        for symbols in column:
            self.layers.put(f"column{self.width}", symbols)
            self.width, m = self.width + 1, len(symbols)
        self.layers.put("order", np.arange(m, dtype=np.int32))
        self.layers.put("prefix", np.zeros(m, np.int16))
        self.layers.put("transform", symbols)

    def step(self, column: int) -> tuple[np.ndarray, np.ndarray]:
        """Puts the symbols of a column in front; the new layer's order and common prefixes. Columns come from the last to the first."""
        order, prefix, symbol = self.layers.get("order", np.int32), self.layers.get("prefix", np.int16), self.layers.get("transform", np.uint8)
        by = np.argsort(symbol, kind="stable")  # all smaller symbols, then the rank among equal ones
        placed = symbol[by]
        now = np.zeros(len(by), np.int16)
        same = np.flatnonzero(placed[1:] == placed[:-1]) + 1
        now[same] = range_minima(prefix, by[same - 1] + 1, by[same]) + 1
        order = order[by]
        self.layers.put("order", order)
        self.layers.put("prefix", now)
        if column:
            self.layers.put("transform", self.layers.get(f"column{column - 1}", np.uint8)[order])
        return order, now

    def close(self) -> None:
        self.layers.close()


def range_minima(x: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The least of x[first..last], both included, for each range."""
    level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
    out = np.empty(len(first), x.dtype)
    low = x
    for k in range(int(level.max(initial=-1)) + 1):
        if k:
            half = 1 << (k - 1)
            low = np.minimum(low[:-half], low[half:])
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(low[first[at]], low[last[at] - (1 << k) + 1])
    return out


def repeated_windows(raw: np.ndarray, at: np.ndarray, windows: int, length: int, folder: str | None = None) -> np.ndarray:
    """For rows of raw that begin at the places at, the earlier rows first: whether the window at each of the first columns also occurs in a row before."""
    found = np.zeros((len(at), windows), bool)
    width = windows - 1 + length
    built = ColumnwiseTransform((raw[at + c] for c in range(width)), folder)
    for column in range(width - 1, -1, -1):
        order, prefix = built.step(column)
        if column < windows:
            run = np.flatnonzero(prefix < length)
            least = np.repeat(np.minimum.reduceat(order, run), np.diff(np.append(run, len(order))))
            inside = (raw[at + column] != PAD) & (raw[at + column + length - 1] != PAD)
            found[order, column] = inside[order] & (order > least)
    built.close()
    return found


def find_repeats(length: int, folder: str):
    """For mapInArrow over contexts dealt by key: the ranges of windows that also occur in an earlier context."""
    side = length - ANCHOR

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [b for b in batches if b.num_rows]
        if not kept:
            return
        t = pa.Table.from_batches(kept)
        known = t["stop"].to_numpy() >= 0
        out = [tuple(t[c].to_numpy()[known].astype(np.int64) for c in ("doc", "pos", "stop"))]
        t = t.filter(pa.array(~known)).combine_chunks()
        key, first, windows, doc, pos = (t[c].to_numpy() for c in ("key", "first", "windows", "doc", "pos"))
        text = t["context"].combine_chunks()
        raw, at = utf8(text if isinstance(text, pa.Array) else text.chunk(0) if text.num_chunks else pa.array([], pa.binary()))
        for f, n in sorted({*zip(first.tolist(), windows.tolist(), strict=True)}):
            part = np.flatnonzero((first == f) & (windows == n))
            part = part[np.argsort(key[part], kind="stable")]
            ends = np.append(starts_of(key[part])[1:], len(part))
            a = 0
            while a < len(part):  # collections of whole keys
                b = int(ends[max(np.searchsorted(ends, a, side="right"), np.searchsorted(ends, a + ROWS, side="right") - 1)])
                p = part[a:b]
                p = p[np.lexsort((pos[p], doc[p]))]
                a = b
                found = repeated_windows(raw, at[p], n, length, folder if len(p) > IN_MEMORY else None)
                edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
                (r, s), (_, e) = np.nonzero(edge == 1), np.nonzero(edge == -1)
                base = pos[p][r].astype(np.int64) - side + f
                out.append((doc[p][r], base + s, base + e - 1 + length))
        yield from ranges_batch(*(np.concatenate(c) for c in zip(*out, strict=True)))

    return rows


ANCHORS = "key long, context long, doc long, pos int, stop int"


def wanted_contexts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc, text, wanted) of the documents with requests (doc, start, anchor, crowded)."""
    each = wanted.groupBy("doc").agg(F.collect_list(F.struct("start", "anchor", "crowded")).alias("wanted")).withColumnRenamed("doc", "asked")
    return docs.join(each, F.col("doc") == F.col("asked")).select("doc", "text", "wanted")


def crowds(docs: DataFrame, length: int, sample: int, least: int) -> tuple[frozenset[int], frozenset[int]]:
    """Anchors, and keys of their contexts' parts, that have over half a task's share of all, from one document in `sample`.

    There are two per task at most of each. What a sample misses has less than about that share.
    """
    spark = docs.sparkSession
    some = docs.where(F.pmod(F.xxhash64("doc", F.lit(3)), F.lit(sample)) == 0)
    anchors = saved(some.mapInArrow(cut_anchors(length), ANCHORS).where("stop < 0").select("key", "doc", "pos"), "suffix-sample")
    limit = max(least, anchors.count() / (2 * partitions(spark)))
    hot = anchors.groupBy("key").count().where(F.col("count") > limit)
    keys = frozenset(r["key"] for r in hot.collect())
    if not keys:
        return keys, keys
    wanted = anchors.join(F.broadcast(hot.select("key")), "key", "left_semi").select("doc", F.col("pos").alias("start"), F.col("key").alias("anchor"), F.lit(True).alias("crowded"))
    parts = wanted_contexts(some, wanted).mapInArrow(cut_contexts(length), FIELDS).where("stop < 0")
    return keys, frozenset(r["key"] for r in parts.groupBy("key").count().where(F.col("count") > limit).collect())


FIELDS = "key long, first int, windows int, doc long, pos int, stop int, context binary"


def removals(docs: DataFrame, length: int = 100, sample: int = SAMPLE, least: int = CROWD) -> DataFrame:
    """(doc, start, stop) of ranges, overlapping in part, whose bytes repeat earlier ones; docs has (doc long, text)."""
    spark = docs.sparkSession
    small_batches(spark)
    n = partitions(spark)
    hot, split = crowds(docs, length, sample, least)
    anchors = docs.mapInArrow(cut_anchors(length), ANCHORS).withColumn("crowded", (F.col("stop") < 0) & F.col("key").isin(*hot) if hot else F.lit(False))
    deal = F.when(F.col("crowded"), F.xxhash64("key", "context")).otherwise(F.col("key"))
    folded = saved(anchors.withColumn("deal", deal).repartition(n, "deal").drop("deal").mapInArrow(fold_contexts(length), RANGES), "suffix-folded")
    contexts = wanted_contexts(docs, folded.where("stop < 0")).mapInArrow(cut_contexts(length, split), FIELDS)
    repeats = saved(contexts.repartition(n, "key").mapInArrow(find_repeats(length, shared_dir(spark)), RANGES), "suffix-repeats")
    return folded.where("stop >= 0").select("doc", "start", "stop").unionByName(repeats.select("doc", "start", "stop"))


def one_key(docs: DataFrame) -> DataFrame:
    """docs with `doc`, a number for each document in doc_id's order.

    That is doc_id itself, unless ids are missing or stand for several rows; then rows are numbered in order of
    (doc_id, nulls first, hash of the text), and rows alike in both are one document.
    """
    clear = docs.select("doc_id").groupBy("doc_id").count().where("doc_id is null or count > 1").isEmpty()
    if clear:
        return docs.withColumn("doc", F.col("doc_id").cast("long"))
    pairs = docs.select("doc_id", F.xxhash64("text").alias("mark")).distinct().orderBy(F.col("doc_id").asc_nulls_first(), "mark")
    ids = pairs.rdd.zipWithIndex().map(lambda x: (x[0][0], x[0][1], x[1])).toDF("numbered_id long, mark long, doc long")
    ids = saved(ids, "suffix-ids")
    return docs.join(ids, F.col("doc_id").eqNullSafe(F.col("numbered_id")) & (F.xxhash64("text") == F.col("mark")))


def apply_removals(as_text: bool):
    """For mapInArrow over (row, text, ranges): row, the bytes (or whole characters) that stay and what went."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, gone, runs, kept = [], [], [], []
            for text, ranges in zip(document_bytes(b.column(1)), b.column(2), strict=True):
                size.append(len(text))
                removed, spans, out, here = 0, 0, [], 0
                if ranges.is_valid and len(ranges):
                    both = ranges.values
                    s, e = both.field(0).to_numpy(), both.field(1).to_numpy()
                    _, s, e = merged(np.zeros(len(s), np.int64), np.maximum(s, 0), np.minimum(e, len(text)))
                    for x, y in zip(s.tolist(), e.tolist(), strict=True):
                        out.append(text[here:x])
                        removed += y - x
                        spans += 1
                        here = y
                out.append(text[here:])
                gone.append(removed)
                runs.append(spans)
                kept.append(b"".join(out))
            yield pa.record_batch([b.column(0), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()), pa.array([x.decode(errors="ignore") for x in kept], pa.string()) if as_text else pa.array(kept, pa.binary())], names=["row", "n_bytes", "n_removed", "n_spans", "kept"])

    return rows


def deduplicated(docs: DataFrame, length: int = 100, columns: tuple[str, ...] = ("doc_id",), as_text: bool = False, sample: int = SAMPLE, least: int = CROWD) -> DataFrame:
    """Per document: row (a struct of columns), n_bytes, n_removed, n_spans (maximal removed runs) and kept (the remaining bytes).

    as_text: kept is a string, without the bytes of characters that a cut splits.

    A byte goes if a string of `length` bytes that covers it also starts earlier: in a document of smaller doc_id, or
    further to the front. Null texts are empty; texts shorter than `length` stay whole. Rows alike in doc_id and text are one
    document and get equal results; rows with one doc_id but different texts are ordered by a hash of the text, and null
    ids come first. Columns not asked for are ignored, and those asked for may have any names. An empty table gives no rows.
    """
    keyed = one_key(docs.select(F.struct(*columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")))
    ranges = removals(keyed.select("doc", "text").dropDuplicates(["doc"]) if "mark" in keyed.columns else keyed.select("doc", "text"), length, sample, least)
    found = ranges.groupBy("doc").agg(F.collect_list(F.struct("start", "stop")).alias("ranges")).withColumnRenamed("doc", "ranges_doc")
    both = keyed.join(found, F.col("doc") == F.col("ranges_doc"), "left").select("row", "text", "ranges")
    kept = "string" if as_text else "binary"
    return both.mapInArrow(apply_removals(as_text), f"row {both.schema['row'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept {kept}")


def without_repeats(docs: DataFrame, length: int = 100) -> DataFrame:
    """docs with the remaining text of each, and its characters in n_chars where there is that column.

    Bytes of characters that a cut splits go as well. A null text stays null.
    """
    text = deduplicated(docs, length, tuple(docs.columns), as_text=True)  # one Python node, so that a task has one worker
    stays = F.when(F.col("row.text").isNotNull(), F.col("kept"))
    new = {"text": stays, "n_chars": F.length(stays).cast("long")}
    return text.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])
