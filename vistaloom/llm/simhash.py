"""SimHash near-duplicates: fingerprints in projected vantage-point trees, linked at a few differing bits."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vistaloom.llm.common import components, document_bytes, partitions, saved, small_batches, starts_of, table_of

SMALL = 256


def fingerprint(text: bytes, words: int = 4) -> int:
    """SimHash of one text: a bit is set where it is set in over half of the shingles' XXH64 (seed 42)."""
    parts = text.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(joined, 42)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.concatenate(([0], gaps + 1))[: len(parts) - words + 1].tolist()
    ends = np.concatenate((gaps, [len(joined)]))[words - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    total = np.zeros(64, np.int64)
    for k in range(0, len(starts), 1 << 16):
        h = np.array([digest(joined[a:b], 42) for a, b in zip(starts[k : k + (1 << 16)], ends[k : k + (1 << 16)], strict=True)], dtype="<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * total > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 4, key: Column | None = None) -> DataFrame:
    """(doc_id, fp long) of every row, and its key long where one is given; a null text is an empty one and has fingerprint 0."""
    small_batches(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t, words) for t in document_bytes(b.column(1))), dtype=np.uint64, count=b.num_rows)
            yield pa.record_batch([b.column(0), pa.array(fp.view(np.int64)), *b.columns[2:]], names=["doc_id", "fp", "key"][: b.num_columns])

    keys = [] if key is None else [key.alias("key")]
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *keys)
    return given.mapInArrow(rows, "doc_id long, fp long" + ", key long" * len(keys))


def blocks(radius: int, agree: int = 1) -> list[list[tuple[int, int]]]:
    """Sets of `agree` runs of the 64 bits, each (shift, width): of radius + agree runs, two fingerprints within the radius agree on one of the sets at least."""
    n = radius + agree
    cuts = [64 * k // n for k in range(n + 1)]
    return [list(each) for each in combinations([(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)], agree)]


def vantage_points(shift: int, width: int) -> list[int]:
    """The vantage points of a tree, below the bits of its run: each halves the values that those before leave together."""
    return [((1 << width) - 1) // ((1 << (1 << j)) + 1) << shift if (1 << j) < width else 0 for j in range(4)] + [1 << (shift + j) for j in range(width)]


def agreeing(classes: int, radius: int, leaf: int = 512) -> int:
    """How many runs linked fingerprints should agree on, so that a leaf has some `leaf` of so many classes, whatever their number."""
    return next((k for k in (1, 2, 3, 4) if classes >> sum(w for _, w in blocks(radius, k)[0]) <= leaf), 4)


def leaves(classes: DataFrame, radius: int, agree: int = 1) -> DataFrame:
    """Each fingerprint with its leaf in every tree.

    The distance on a set of runs of bits is a metric, and by the triangle bound two fingerprints whose runs agree are at the
    same distance from each vantage point, so no boundary between leaves has to be widened: with radius 0 on the runs, the
    overlap is empty. A tree over all 64 bits would not do: two unrelated fingerprints lie 32 bits apart with a deviation
    of 4, and a radius of 4 puts two thirds of them on both sides of each boundary.
    """
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    trees = []
    for k, runs in enumerate(blocks(radius, agree)):
        away = [F.bit_count((F.col("fp").bitwiseXOR(F.lit(signed(v)))).bitwiseAND(F.lit(signed(((1 << width) - 1) << shift)))) for shift, width in runs for v in vantage_points(shift, width)]
        trees.append(F.xxhash64(F.lit(k), *away))
    return classes.select("fp", "rep", F.explode(F.array(*trees)).alias("leaf"))


def links(classes: DataFrame, radius: int) -> DataFrame:
    """(a, b): links that join all classes (fp, rep) within the radius, directly or through others."""
    dealt = leaves(classes, radius, agreeing(classes.count(), radius)).repartition(partitions(classes.sparkSession), "leaf")
    return dealt.mapInArrow(leaf_links(radius), "a long, b long")


def close_pairs(x: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of positions that join all fingerprints of x within radius, directly or through others, by a vantage-point tree.

    Those within radius of a vantage point hang on it; the others are split at the median distance, and across it only
    the two bands that the triangle bound leaves are compared.
    """
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

    def across(a: np.ndarray, b: np.ndarray) -> None:
        for i in range(0, len(a), 1024):
            for j in range(0, len(b), 1024):
                p, q = np.nonzero(np.bitwise_count(x[a[i : i + 1024], None] ^ x[None, b[j : j + 1024]]) <= radius)
                if len(p):  # per row the first, per column the first: a forest with the same components within the block is found later
                    left.append(a[i + p])
                    right.append(b[j + q])

    todo = [np.arange(len(x))]
    while todo:
        at = todo.pop()
        if len(at) <= SMALL:
            across(at, at)
            continue
        d = np.bitwise_count(x[at] ^ x[at[0]]).astype(np.int64)
        near = at[d <= radius]
        left.append(np.full(len(near), at[0]))
        right.append(near)
        # Of those within half the radius all are linked to one another already; one side of a pair may be skipped, not both.
        tight, rest, d = at[d <= radius // 2], at[d > radius // 2], d[d > radius // 2]
        band = rest[d <= radius // 2 + radius]
        across(tight, band)
        if not len(rest):
            continue
        middle = int(np.median(d))
        inner, outer = rest[d <= middle], rest[d > middle]
        if not len(outer):
            middle = int(d.max()) - 1
            inner, outer = rest[d <= middle], rest[d > middle]
        if not len(inner):  # all at one distance: no bound helps
            for k in range(0, len(outer), 1024):
                across(outer[k : k + 1024], outer[k:])
            continue
        todo += [inner, outer]
        across(rest[(d <= middle) & (d > middle - radius)], rest[(d > middle) & (d <= middle + radius)])
    return np.concatenate(left), np.concatenate(right)


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest position that each of n positions reaches over pairs (a, b)."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        np.minimum.at(label, before, label.copy())
        label = label[label]
        if (label == before).all():
            return label


def leaf_links(radius: int):
    """For mapInArrow over rows (fp, rep, leaf) dealt by leaf: one link (a, b) per fingerprint and leaf at most."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = table_of(batches, ["fp", "rep", "leaf"])
        if t is None:
            return
        order = np.lexsort((t["rep"], t["leaf"]))
        leaf, fp, rep = t["leaf"][order], t["fp"][order].view(np.uint64), t["rep"][order]
        at = starts_of(leaf)
        size = np.diff(np.append(at, len(leaf)))
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        few = np.repeat(size <= SMALL, size)
        for lag in range(1, int(size[size <= SMALL].max(initial=1))):
            p = np.flatnonzero((leaf[lag:] == leaf[:-lag]) & few[lag:])
            if not len(p):
                break
            p = p[np.bitwise_count(fp[p] ^ fp[p + lag]) <= radius]
            a.append(p)
            b.append(p + lag)
        for s, n in zip(at[size > SMALL].tolist(), size[size > SMALL].tolist(), strict=True):
            p, q = close_pairs(fp[s : s + n], radius)
            a.append(s + p)
            b.append(s + q)
        root = roots(len(leaf), np.concatenate(a), np.concatenate(b))
        moved = np.flatnonzero(root != np.arange(len(leaf)))
        for k in range(0, len(moved), 100_000):
            m = moved[k : k + 100_000]
            yield pa.record_batch([pa.array(rep[m]), pa.array(rep[root[m]])], names=["a", "b"])

    return rows


def near_duplicates(docs: DataFrame, radius: int = 4, words: int = 4) -> DataFrame:
    """(doc_id, fp, component_id): documents whose fingerprints are linked at radius or fewer differing bits.

    Rows: one for each of docs; equal fingerprints are one class, whose smallest doc_id stands for it in the trees, so
    groups of copies are pre-aggregated before any shuffle by leaf. Null texts and texts without words have fingerprint 0
    and are linked like any other. Repeated rows share a component. A row with a null doc_id takes the component of the
    documents with ids that have its fingerprint, or null. Other columns are ignored. An empty table gives no rows.
    """
    prints = saved(fingerprints(docs, words), "simhash-prints")
    # Written, so that the last join has plain exchanges on both sides, which AQE splits where one text has very many copies.
    classes = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-classes")
    found = components(links(classes.where("rep is not null"), radius), "simhash-links")
    named = classes.join(found, F.col("rep") == F.col("node"), "left").select(F.col("fp").alias("class_fp"), F.coalesce("component", "rep").alias("component_id"))
    return prints.join(named, F.col("fp") == F.col("class_fp"), "left").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, radius: int = 4, words: int = 4) -> DataFrame:
    """docs with one document (the smallest doc_id, then the smallest hash of the text) of each linked group; rows with a null doc_id stay.

    Groups are of texts: texts that are not linked stay, also under one doc_id.
    """
    key = F.xxhash64(F.col("text").cast("string"))
    prints = saved(fingerprints(docs.where("doc_id is not null"), words, key), "simhash-keys")
    classes = saved(prints.groupBy("fp").agg(F.min(F.struct("doc_id", "key")).alias("first")), "simhash-texts")
    found = components(links(classes.withColumn("rep", F.col("fp")), radius), "simhash-links")
    named = classes.join(found, F.col("fp") == F.col("node"), "left").groupBy(F.coalesce("component", "fp").alias("group")).agg(F.min("first").alias("first"))
    kept = named.select(F.col("first.doc_id").alias("kept_id"), F.col("first.key").alias("kept_key"))
    # Rows as structs: docs may have columns of any names.
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), key.alias("key")).join(kept, (F.col("id") == F.col("kept_id")) & (F.col("key") == F.col("kept_key")), "left_semi")
    return rows.dropDuplicates(["id", "key"]).select("row.*").unionByName(docs.where("doc_id is null"))
