"""Language identification with language-bitmask n-gram filters."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vistaloom.llm.common import small_batches

GRAM = 5
MASK = np.uint64((1 << 8 * GRAM) - 1)
#: Everything in ASCII but letters becomes a space; capitals become small.
PLAIN = bytes((b + 32 if 65 <= b <= 90 else b) if 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
MULTIPLIERS = [0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93]


def letters(text: str) -> bytes | None:
    """The text in small letters with single bytes for all else; None where there is no letter."""
    plain = (text if text.isascii() else text.lower()).encode().translate(PLAIN)
    if not plain.strip() or not (text.isascii() or any(map(str.isalpha, text))):
        return None
    return plain


def grams(plain: bytes) -> np.ndarray:
    """Each n-gram of bytes, words' ends included, runs of spaces left out."""
    buf = np.frombuffer(b" " + b" ".join(plain.split()) + b"        ", np.uint8)
    n = max(1, len(buf) - 7 - (GRAM - 3))
    return np.ndarray(n, "<u8", buf, strides=(1,)) & MASK


@dataclass
class BitSlicedFilter:
    """A Bloom filter whose slots hold one bit per language, in words as wide as they need: the AND of an n-gram's slots names all languages that contain it."""

    languages: list[str]
    slots: np.ndarray
    hashes: int
    usual: int

    @classmethod
    def built(cls, languages: list[str], sets: list[np.ndarray], usual: int, hashes: int = 3, bits_each: int = 16) -> BitSlicedFilter:
        kind = next((k for k in (np.uint8, np.uint16, np.uint32) if np.iinfo(k).bits >= len(languages)), np.uint64)
        words = -(-max(1, len(languages)) // np.iinfo(kind).bits)
        size = 1 << max(10, int(bits_each * max([1, *map(len, sets)]) - 1).bit_length())
        made = cls(languages, np.zeros((size, words), kind), hashes, usual)
        for k, g in enumerate(sets):
            word, bit = divmod(k, np.iinfo(kind).bits)
            for at in made.places(g.astype(np.uint64)):
                made.slots[at, word] |= kind(1 << bit)  # equal places get equal values
        return made

    def places(self, g: np.ndarray) -> Iterator[np.ndarray]:
        shift = np.uint64(64 - (len(self.slots).bit_length() - 1))
        for k in range(self.hashes):
            yield ((g ^ (g >> np.uint64(17 + k))) * np.uint64(MULTIPLIERS[k])) >> shift

    def masks(self, g: np.ndarray) -> np.ndarray:
        """Of each n-gram the languages that contain it, a row of as many words as they need."""
        found = None
        for at in self.places(g):
            found = self.slots[at] if found is None else found & self.slots[at]
        return found

    def counts(self, masks: np.ndarray) -> np.ndarray:
        """How many masks have each language's bit."""
        width = 8 * masks.dtype.itemsize
        if width == 8:
            by, values = np.bincount(masks[:, 0], minlength=256), np.arange(256)
            return np.array([by[(values >> k & 1) == 1].sum() for k in range(len(self.languages))])
        return np.array([np.count_nonzero(masks[:, k // width] & masks.dtype.type(1 << k % width)) for k in range(len(self.languages))])

    @cached_property
    def false_rates(self) -> np.ndarray:
        """How often each language's bit is found set for an n-gram that it doesn't contain."""
        return (self.counts(self.slots) / len(self.slots)) ** self.hashes

    def shares(self, g: np.ndarray) -> np.ndarray:
        """For each language, the share of n-grams that it contains, corrected for false positives."""
        f = self.false_rates
        return np.clip((self.counts(self.masks(g)) / len(g) - f) / np.maximum(1 - f, 1e-9), 0, 1)

    def decide(self, text: str | None) -> tuple[str, float]:
        """(language, score): the largest share, the first name among equals; `und` and 0 without a letter."""
        plain = letters(text) if text else None
        if plain is None or not self.languages:
            return "und", 0.0
        share = self.shares(grams(plain))
        best = int(np.argmax(share))
        return (self.languages[best], float(share[best])) if share[best] > 0 else (self.languages[self.usual], 0.0)


def learned(train: DataFrame, fit_rows: int = 20_000, min_share: float = 0.002) -> BitSlicedFilter:
    """Filters from (doc_id, text, lang) rows with a language.

    Fitted on a bounded sample, fit_rows documents as expected by a hash of doc_id. A language contains the n-grams that
    occur in min_share of its documents, so that a few foreign or spoilt ones don't count; that also bounds its n-grams.
    """
    small_batches(train.sparkSession)
    rows = train.where("lang is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    n = rows.count()
    part = int(1_000_000 * min(1.0, fit_rows / max(n, 1)))
    sample = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(1_000_000)) < part) if part < 1_000_000 else rows

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            by: dict[str, list[np.ndarray]] = {}
            for text, lang in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                plain = letters(text)
                by.setdefault(lang, []).append(np.unique(grams(plain)) if plain else np.zeros(0, np.uint64))
            for lang, each in by.items():
                g, c = np.unique(np.concatenate(each), return_counts=True)
                g, c = np.append(g, np.uint64(0)), np.append(c, len(each))  # 0: documents
                yield pa.record_batch([pa.array([lang] * len(g)), pa.array(g.view(np.int64)), pa.array(c.astype(np.int64))], names=["lang", "gram", "n"])

    counts = sample.mapInArrow(counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    totals = counts.where("gram = 0").select(F.col("lang").alias("of"), F.col("n").alias("docs"))
    kept = counts.join(F.broadcast(totals), F.col("lang") == F.col("of")).where((F.col("gram") == 0) | (F.col("n") >= F.greatest(F.lit(2.0), F.col("docs") * min_share)))  # totals: a row per language
    got = kept.select("lang", "gram", "n").toPandas()
    languages = sorted(got["lang"].unique().tolist())
    sets = [got.loc[(got["lang"] == x) & (got["gram"] != 0), "gram"].to_numpy(np.int64).view(np.uint64) for x in languages]
    docs = [int(got.loc[(got["lang"] == x) & (got["gram"] == 0), "n"].iloc[0]) for x in languages]
    return BitSlicedFilter.built(languages, sets, int(np.argmax(docs)) if docs else 0)


def predicted(docs: DataFrame, model: BitSlicedFilter, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(row, lang_pred, score) of every row: row is a struct of columns, whatever their names.

    Null, empty and letterless texts are `und` with score 0; texts of any length are read whole. Equal texts get equal
    results, rows repeat as they come, and only the text decides. An empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # its size is bounded by the sample's n-grams, not by the documents
    fields = [*columns] if "text" in columns else [*columns, "text"]
    place = fields.index("text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = shared.value
        for b in batches:
            row = b.column(0)
            got = [use.decide(t) for t in row.field(place).cast(pa.string()).to_pylist()]
            kept = row if len(fields) == len(columns) else pa.StructArray.from_arrays([row.field(k) for k in range(len(columns))], fields=[row.type.field(k) for k in range(len(columns))])
            yield pa.record_batch([kept, pa.array([x for x, _ in got], pa.string()), pa.array([s for _, s in got], pa.float64())], names=["row", "lang_pred", "score"])

    kept_type = docs.select(F.struct(*columns).alias("row")).schema["row"].dataType.simpleString()
    return docs.select(F.struct(*fields).alias("row")).mapInArrow(rows, f"row {kept_type}, lang_pred string, score double")


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from learning: crc32 of its id as text is divisible by 5 (a null id is kept from it)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(True))


def identified(docs: DataFrame, fit_rows: int = 20_000) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row, learned from the rows that aren't held out."""
    model = learned(docs.where(~held_out()), fit_rows)
    found = predicted(docs.select("doc_id", held_out().alias("held_out"), "text"), model, ("doc_id", "held_out"))
    return found.select("row.*", "lang_pred", "score")
