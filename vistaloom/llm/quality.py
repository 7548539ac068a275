"""Quality from weak labels: EM over overlapping heuristic labellers, then a hashed linear scorer of their posteriors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vistaloom.llm.common import document_bytes, small_batches
from vistaloom.llm.suffix_dedup import words_at

BUCKETS = 1 << 14
GRAM = np.uint64((1 << 24) - 1)
BAD, GOOD, ABSTAIN = 0, 1, 2
#: Documents that what labellers are taken to do before any is seen counts for.
TRUST = 10
#: Labellers are written to be specific: none is taken to call more than this share of good texts bad. What each finds of the bad ones is estimated.
FALSE_ALARMS = 0.002
#: N-grams at which a text counts for half of what a long one does.
FEW = 60
SYMBOLS = np.array([c in b"#$%&*|<>{}[]=\\^~_@+" for c in range(256)])
UPPER = np.array([65 <= c <= 90 for c in range(256)])
ASCII_LETTERS = np.array([65 <= c <= 90 or 97 <= c <= 122 for c in range(256)])


def between(x: float, bad_low: float, good_low: float, good_high: float, bad_high: float) -> int:
    """Bad outside the outer bounds, good inside the inner ones, no vote between them."""
    return BAD if x < bad_low or x > bad_high else GOOD if good_low <= x <= good_high else ABSTAIN


def votes(raw: bytes) -> tuple[int, ...]:
    """What each labeller says of a text; a text without words gets no vote but the one on its length."""
    words = raw.split()
    n = len(words)
    if not n:
        return (BAD, *[ABSTAIN] * 7)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size = len(raw)
    letters = max(1, int(counts[ASCII_LETTERS].sum()))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    ends = int(counts[46] + counts[33] + counts[63])
    inf = float("inf")
    return (
        BAD if counts[ASCII_LETTERS].sum() + counts[128:].sum() < size / 4 else GOOD if n >= 40 else ABSTAIN,
        between(counts[SYMBOLS].sum() / size, -1, -1, 0.01, 0.03),
        between(counts[124] / n, -1, -1, 0.02, 0.2),
        between(counts[33] / n, -1, -1, 0.05, 0.3),
        between(int(counts[UPPER].sum()) / letters, -1, -1, 0.15, 0.5),
        between(len({*words}) / n ** 0.9, 0.15, 0.35, inf, inf) if n >= 20 else ABSTAIN,
        between(len({*lines}) / len(lines), 0.5, 0.8, inf, inf) if len(lines) >= 4 else ABSTAIN,
        between(ends / n, 0.005, 0.02, 0.3, 0.6) if n >= 20 else ABSTAIN,
    )


def hashed(raw: bytes) -> np.ndarray:
    """Each n-gram of three bytes as a bucket."""
    x = words_at(np.frombuffer(raw + b"       ", np.uint8))[: max(1, len(raw) - 2)] & GRAM
    return ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(50)).astype(np.int64)


def features(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and their values: roots of the n-grams' shares, less for short texts, which the bias then decides."""
    at, n = np.unique(hashed(raw), return_counts=True) if len(raw) < 4096 else (lambda c: (np.flatnonzero(c), c[c > 0]))(np.bincount(hashed(raw), minlength=BUCKETS))
    x = n.astype(float)
    total = x.sum()
    return at, (np.sqrt(x / np.sqrt((x**2).sum())) * total / (total + FEW)).astype(np.float32)


@dataclass
class LabelModel:
    """Two classes and what each labeller votes in them, by expectation and maximisation."""

    prior: np.ndarray
    table: np.ndarray  # labeller, class, vote

    @classmethod
    def fitted(cls, patterns: np.ndarray, weight: np.ndarray, rounds: int = 60) -> LabelModel:
        """From distinct vote patterns and the number of documents with each. It begins with those that any labeller calls bad: each knows one kind of spoilt text, so a bad vote is specific and a good one is not."""
        some = (patterns == BAD).any(axis=1)
        p = np.stack([np.where(some, 0.98, 0.02), np.where(some, 0.02, 0.98)], axis=1)
        model = cls(np.array([0.5, 0.5]), np.full((patterns.shape[1], 2, 2), 1 / 2))
        before = TRUST * np.array([[0.2, 0.8], [0.003, 0.997]])  # what labellers are taken to do before any document is seen
        for _ in range(rounds):
            mass = p * weight[:, None]
            prior = (mass.sum(axis=0) + 1) / (weight.sum() + 2)
            table = np.array([[[mass[patterns[:, j] == v, c].sum() + before[c, v] + 1e-3 for v in (BAD, GOOD)] for c in (BAD, GOOD)] for j in range(patterns.shape[1])])
            table /= table.sum(axis=2, keepdims=True)
            table[:, GOOD, BAD] = np.minimum(table[:, GOOD, BAD], FALSE_ALARMS)
            table[:, GOOD, GOOD] = 1 - table[:, GOOD, BAD]
            model = cls(prior, table)
            p = model.posteriors(patterns)
        return model

    def posteriors(self, patterns: np.ndarray) -> np.ndarray:
        """(patterns, class); a labeller that doesn't vote says nothing."""
        log = np.log(self.prior)[None, :] + sum(np.log(np.concatenate((self.table[j], np.ones((2, 1))), axis=1))[:, patterns[:, j]].T for j in range(patterns.shape[1]))
        p = np.exp(log - log.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    def accuracies(self) -> np.ndarray:
        """Of each labeller, how often a vote is right."""
        right = self.prior[BAD] * self.table[:, BAD, BAD] + self.prior[GOOD] * self.table[:, GOOD, GOOD]
        return right

    def good(self, pattern: tuple[int, ...]) -> float:
        return float(self.posteriors(np.array([pattern]))[0, GOOD])


def vote_patterns(docs: DataFrame) -> DataFrame:
    """(pattern, n): how many documents got which votes; at most 3 to the number of labellers rows."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p, n = np.unique(np.array(["".join(map(str, votes(t))) for t in document_bytes(b.column(0))], dtype="U16"), return_counts=True)
            yield pa.record_batch([pa.array(p.tolist(), pa.string()), pa.array(n.astype(np.int64))], names=["pattern", "n"])

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(rows, "pattern string, n long").groupBy("pattern").agg(F.sum("n").alias("n"))


def trained(vectors: Iterator[tuple[np.ndarray, np.ndarray, float]], rounds: int = 60) -> np.ndarray:
    """Weights (last: the bias) of a logistic scorer of bucket shares against soft labels; the rarer class weighs more, by the root of its share."""
    buckets, values, sizes, labels = [], [], [], []
    for b, v, y in vectors:
        buckets.append(b)
        values.append(v)
        sizes.append(len(b))
        labels.append(y)
    w = np.zeros(BUCKETS + 1)
    if not labels:
        return w
    at = np.cumsum([0, *sizes[:-1]])
    bucket, value, y = np.concatenate(buckets).astype(np.int64), np.concatenate(values), np.array(labels)
    doc = np.repeat(np.arange(len(y)), sizes)
    share = np.array([(1 - y).sum(), y.sum()]) + 1
    each = y / np.sqrt(share[1]) + (1 - y) / np.sqrt(share[0])
    each /= each.sum()
    w[-1] = np.log(share[1] / share[0]) / 2
    past = np.full(BUCKETS + 1, 1e-8)
    for _ in range(rounds):
        z = np.add.reduceat(w[bucket] * value, at) + w[-1]
        error = (1 / (1 + np.exp(-z)) - y) * each
        gradient = np.append(np.bincount(bucket, weights=value * error[doc], minlength=BUCKETS), error.sum()) + 1e-7 * w
        past += gradient**2
        w -= 1.0 * gradient / np.sqrt(past)
    return w


def fit_scorer(docs: DataFrame, model: LabelModel, fit_rows: int = 6000) -> np.ndarray:
    """The scorer's weights, from a bounded sample of documents: fit_rows as expected, chosen by a hash of the text."""
    n = docs.count()
    part = int(1_000_000 * min(1.0, fit_rows / max(n, 1)))
    texts = docs.select(F.col("text").cast("string").alias("text")).where("text is not null")
    sample = texts.where(F.pmod(F.xxhash64("text", F.lit(10)), F.lit(1_000_000)) < part) if part < 1_000_000 else texts

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            buckets, values, labels = [], [], []
            for t in document_bytes(b.column(0)):
                at, x = features(t)
                buckets.append(at.astype(np.int16).tobytes())
                values.append(x.tobytes())
                labels.append(model.good(votes(t)))
            yield pa.record_batch([pa.array(buckets, pa.binary()), pa.array(values, pa.binary()), pa.array(labels, pa.float64())], names=["buckets", "values", "label"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = [x for b in batches for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
        each.sort()  # whatever order the rows came in
        yield pa.record_batch([pa.array([trained((np.frombuffer(b, np.int16), np.frombuffer(v, np.float32), y) for b, v, y in each).astype(np.float32).tobytes()], pa.binary())], names=["weights"])

    got = sample.mapInArrow(vectors, "buckets binary, values binary, label double").repartition(1).mapInArrow(train, "weights binary").collect()  # one row; the sample is bounded
    return np.frombuffer(got[0]["weights"], np.float32) if got else np.zeros(BUCKETS + 1, np.float32)


def scored(docs: DataFrame, fit_rows: int = 6000, threshold: float = 0.35) -> DataFrame:
    """(doc_id, score, keep, posterior) of every row.

    score: the scorer's probability that the text is good; posterior: what the labellers' votes on the text alone say; keep:
    score at or above the threshold, which leans towards keeping. The accuracies come from the votes on all documents, the scorer from a bounded sample.
    A null, empty or wordless text has score 0 and isn't kept. Texts are read whole; equal texts get equal results; rows
    repeat as they come; other columns are ignored. An empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    found = vote_patterns(docs).collect()  # bounded by the number of patterns
    if found:
        found.sort()
        model = LabelModel.fitted(np.array([[int(v) for v in r["pattern"]] for r in found]), np.array([r["n"] for r in found], float))
    else:
        model = LabelModel(np.array([0.5, 0.5]), np.full((8, 2, 2), 1 / 2))
    weights = fit_scorer(docs, model, fit_rows).astype(np.float64)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score, posterior = [], []
            for t in document_bytes(b.column(1)):
                v = votes(t)
                posterior.append(model.good(v))
                if not t.split():
                    score.append(0.0)
                    continue
                at, x = features(t)
                z = float((weights[at] * x).sum() + weights[-1])
                score.append(float(1 / (1 + np.exp(-z))))
            yield pa.record_batch([b.column(0), pa.array(score, pa.float64()), pa.array([s >= threshold for s in score], pa.bool_()), pa.array(posterior, pa.float64())], names=["doc_id", "score", "keep", "posterior"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(rows, "doc_id long, score double, keep boolean, posterior double")
