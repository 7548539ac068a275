"""Language-model scores: masked pseudo-likelihood of a bidirectional window network trained in NumPy.

Each token is predicted from the two before and the two after it. The window's embeddings, scaled by place, sum to a hidden
layer; one softmax over classes of words, and one within the token's class, turn it into a probability. The model
is trained on every token: in each of R rounds a task starts from the same parameters and learns from its documents, with
every R-th token as a target, and the parameters are averaged over the tasks, weighted by targets. The targets shift by one
from round to round, so that after R rounds each token of each document has been one once.

The vocabulary is all words of the documents. The most frequent are leaves; each of the others belongs to one of a few
leaves, and its probability is that of its leaf times its share of the leaf's count, from a written table that grows with
the documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vistaloom.llm.common import saved, small_batches, starts_of

PLACES = (-2, -1, 1, 2)
#: Leaves that the words beyond the most frequent belong to, by a checksum.
RARE = 64
#: Bytes of words that are counted together before they go on.
TOGETHER = 64_000_000
#: Logarithms of shares are summed as whole numbers, so that their order doesn't matter.
FINE = 1 << 30
SLICE = 1 << 14
BATCH = 1 << 14
BLOCK = 64
RATE = 0.2
#: Words beyond the network's own whose shares are at hand in each worker, some 30 bytes each.
NEAR = 131_072
#: Tasks whose parameters are averaged together.
FAN = 256


@dataclass
class Ids:
    """Words to leaves: its own for a word of the network's vocabulary, one of RARE by a checksum for each other. Of some others, `near`, the shares are at hand."""

    vocabulary: list[str]
    near: list[str]
    shares: np.ndarray

    def __post_init__(self) -> None:
        self.known = pa.array([*self.vocabulary, *self.near], pa.large_string())
        n = len(self.vocabulary)
        self.leaf = np.array([*range(n), *(n + zlib.crc32(w.encode()) % RARE for w in self.near)], np.int32)
        self.share = np.concatenate((np.zeros(n, np.int64), self.shares))

    def of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each word its leaf, the logarithm of its share of it (0 where that isn't at hand), and whether it is at hand."""
        each = words.dictionary_encode()
        at = pc.index_in(each.dictionary, value_set=self.known)
        held = at.is_valid().to_numpy(zero_copy_only=False)
        place = at.fill_null(0).to_numpy(zero_copy_only=False)
        leaf, share = (np.where(held, x[place], 0) if len(x) else np.zeros(len(place), x.dtype) for x in (self.leaf, self.share))
        other = np.flatnonzero(~held)
        names = each.dictionary.cast(pa.large_binary()).take(pa.array(other)).to_pylist()
        leaf[other] = len(self.vocabulary) + np.fromiter((zlib.crc32(w) % RARE for w in names), np.int32, len(names))
        which = each.indices.to_numpy()
        return leaf.astype(np.int32)[which], share[which], held[which]


def classes(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leaves by falling count, and where the classes of about equal mass begin in that order (and its end)."""
    order = np.argsort(-counts, kind="stable")
    mass = np.cumsum(counts[order]) / counts.sum()
    of = np.minimum((mass * np.sqrt(len(counts))).astype(np.int64), int(np.sqrt(len(counts))))
    return order, np.append(starts_of(of), len(order))


@dataclass
class WindowNetwork:
    """Parameters: embedding (leaves + 1 for beyond the text), scale (place), bias, classes, leaves in their classes' order; the last two with a bias in the last column."""

    vocabulary: list[str]
    counts: np.ndarray
    width: int = 16

    def __post_init__(self) -> None:
        n = len(self.vocabulary) + RARE
        self.edge = n
        order, self.bounds = classes(self.counts)
        self.place = np.empty(n, np.int64)
        self.place[order] = np.arange(n)
        self.of = (np.searchsorted(self.bounds, self.place, side="right") - 1).astype(np.uint16)
        share = np.maximum(self.counts[order], 1) / max(1, self.counts.sum())
        self.shapes = [(n + 1, self.width), (len(PLACES), self.width), (1, self.width), (len(self.bounds) - 1, self.width + 1), (n, self.width + 1)]
        r = np.random.default_rng(5)
        self.parameters = [(r.standard_normal(self.shapes[0]) * 0.3).astype(np.float32), np.ones(self.shapes[1], np.float32), np.full(self.shapes[2], 0.1, np.float32), np.zeros(self.shapes[3], np.float32), np.zeros(self.shapes[4], np.float32)]
        self.parameters[3][:, -1] = np.log(np.add.reduceat(share, self.bounds[:-1]))
        self.parameters[4][:, -1] = np.log(share)

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parameters])

    def load(self, flat: np.ndarray) -> None:
        cuts = np.cumsum([a * b for a, b in self.shapes])[:-1]
        self.parameters = [x.reshape(s).astype(np.float32) for x, s in zip(np.split(flat, cuts), self.shapes, strict=True)]

    def hidden(self, window: np.ndarray) -> np.ndarray:
        """The hidden layer, and a column of ones for the biases above it."""
        embedding, scale, bias = self.parameters[:3]
        h = np.ones((len(window), self.width + 1), np.float32)
        z = h[:, :-1]
        z[:] = bias
        for k in range(len(PLACES)):
            z += np.take(embedding * scale[k], window[:, k], axis=0)
        np.maximum(z, 0, out=z)
        return h

    def by_class(self, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The order of tokens by class, and where each class begins in it (and the end)."""
        order = np.argsort(self.of[token], kind="stable")
        return order, np.searchsorted(self.of[token[order]], np.arange(len(self.bounds)))

    def log_likelihood(self, window: np.ndarray, token: np.ndarray) -> np.ndarray:
        """The log-probability of each token in its window: its class's, and its own in the class.

        Rows go through the layers in blocks of BLOCK, each of one class, so that a row's result doesn't depend on the others'.
        """
        order, cut = self.by_class(token)
        size = np.diff(cut)
        blocks = -(-size // BLOCK)
        first = np.cumsum(blocks) - blocks
        at = np.repeat(first * BLOCK - cut[:-1], size) + np.arange(len(token))
        h = np.ones((int(blocks.sum()) * BLOCK, self.width + 1), np.float32)
        h[at] = self.hidden(window[order])
        h = h.reshape(-1, BLOCK, self.width + 1)
        leaf = np.zeros(len(h) * BLOCK, np.int64)
        leaf[at] = self.place[token[order]]
        upper, lower = self.parameters[3:]
        out = np.empty(len(leaf))
        for k in range(0, len(h), 16):
            x = h[k : k + 16] @ upper.T
            out[k * BLOCK : (k + 16) * BLOCK] = chosen(x.reshape(-1, len(upper)), np.repeat(np.repeat(np.arange(len(size)), blocks)[k : k + 16], BLOCK))
        for c in np.flatnonzero(size).tolist():
            a, b, lo, hi = first[c], first[c] + blocks[c], self.bounds[c], self.bounds[c + 1]
            if hi - lo > 1:
                x = h[a:b] @ lower[lo:hi].T
                out[a * BLOCK : b * BLOCK] += chosen(x.reshape(-1, hi - lo), np.maximum(leaf[a * BLOCK : b * BLOCK] - lo, 0))
        result = np.empty(len(token))
        result[order] = out[at]
        return result

    def sums(self, ids: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """Of texts laid end to end, each one's sum of log-probabilities; texts share the network's passes and nothing else."""
        window = windows(ids, upto, self.edge)
        each = [self.log_likelihood(window[k : k + BATCH], ids[k : k + BATCH]) for k in range(0, len(ids), BATCH)]
        total = np.concatenate([*each, np.zeros(1)])
        return np.where(np.diff(upto) > 0, np.add.reduceat(total, upto[:-1]), 0.0) if len(upto) > 1 else np.zeros(0)

    def learn(self, window: np.ndarray, token: np.ndarray, past: list[np.ndarray], rate: float) -> None:
        """One step on a batch, with rates that fall by what each parameter has seen."""
        embedding, scale, bias, upper, lower = self.parameters
        order, cut = self.by_class(token)
        window, token = window[order], token[order]
        h = self.hidden(window)
        back, gradient, of = np.empty_like(h), np.zeros_like(upper), self.of[token]
        for k in range(0, len(h), 1024):
            part = h[k : k + 1024]
            error = errors(part @ upper.T, of[k : k + 1024])
            np.matmul(error, upper, out=back[k : k + 1024])
            gradient += error.T @ part
        step(upper, gradient, past[3], rate)
        for c in np.flatnonzero(np.diff(cut)).tolist():
            a, b, lo, hi = cut[c], cut[c + 1], self.bounds[c], self.bounds[c + 1]
            if hi - lo > 1:
                at, part = lower[lo:hi], h[a:b]
                error = errors(part @ at.T, self.place[token[a:b]] - lo)
                back[a:b] += error @ at
                step(at, error.T @ part, past[4][lo:hi], rate)
        back = back[:, :-1] * (h[:, :-1] > 0)
        moved = np.stack([np.einsum("ij,ij->j", back, embedding[window[:, k]]) for k in range(len(PLACES))])
        step(embedding, summed(window, back, scale, len(embedding)), past[0], rate)
        step(scale, moved, past[1], rate)
        step(bias, back.sum(axis=0, keepdims=True), past[2], rate)


def chosen(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of each row's softmax, the logarithm of one entry."""
    np.clip(x, -80, 80, out=x)
    got = x[np.arange(len(x)), at]
    return got - np.log(np.exp(x, out=x).sum(axis=1))


def errors(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Each row's softmax, less one where it should be one."""
    np.clip(x, -80, 80, out=x)
    np.exp(x, out=x)
    x /= (x @ np.ones(x.shape[1], x.dtype))[:, None]
    x[np.arange(len(x)), at] -= 1
    return x


def step(p: np.ndarray, gradient: np.ndarray, past: np.ndarray, rate: float) -> None:
    past += gradient * gradient
    p -= rate * gradient / np.sqrt(past)


def summed(window: np.ndarray, back: np.ndarray, scale: np.ndarray, n: int) -> np.ndarray:
    """What each of n tokens gets from all its places in windows."""
    width = back.shape[1]
    total, lane = np.zeros(n * width, np.float32), np.arange(width)
    for k in range(0, len(back), 1024):
        at = window[k : k + 1024, :, None].astype(np.int64) * width + lane
        np.add.at(total, at.ravel(), (back[k : k + 1024, None, :] * scale).ravel())
    return total.reshape(n, width)


def windows(ids: np.ndarray, upto: np.ndarray, edge: int) -> np.ndarray:
    """The window of each token of texts laid end to end."""
    far = max(map(abs, PLACES))
    at = np.arange(len(ids)) + far * (np.repeat(np.arange(len(upto) - 1), np.diff(upto)) + 1)
    wide = np.full(len(ids) + far * len(upto), edge, np.int32)
    wide[at] = ids
    return np.stack([wide[at + p] for p in PLACES], axis=1)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of texts, end to end, and where each text's begin (and the end): small letters, cut at white space; none of a null text."""
    lists = pc.utf8_split_whitespace(pc.utf8_lower(texts.cast(pa.large_string()).fill_null("")))
    flat, upto = lists.flatten(), np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)))
    some = pc.greater(pc.binary_length(flat), 0)
    kept = np.append(0, np.cumsum(some.to_numpy(zero_copy_only=False)))
    return flat.filter(some), kept[upto]


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all documents."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def given() -> Iterator[pa.RecordBatch]:
            words, n = pa.chunked_array(held, pa.large_string()).value_counts().flatten()
            held.clear()
            for k in range(0, len(words), 100_000):
                yield pa.record_batch([words[k : k + 100_000].cast(pa.string()), n[k : k + 100_000]], names=["word", "n"])

        for b in batches:
            held.append(words_of(b.column(0))[0])
            size += held[-1].nbytes
            if size > TOGETHER:
                yield from given()
                size = 0
        yield from given()

    return docs.select("text").mapInArrow(rows, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def targets(upto: np.ndarray, turn: int, rounds: int) -> np.ndarray:
    """The places, of texts laid end to end, that are targets in a round: over all rounds, each place once."""
    size = np.diff(upto)
    inside = np.arange(upto[-1]) - np.repeat(upto[:-1], size)
    return np.flatnonzero(inside % rounds == np.repeat((turn + size) % rounds, size))


def flattened(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of lists, end to end, and where each list's begin (and the end)."""
    return lists.flatten().to_numpy(), np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy()))


def encoded(docs: DataFrame, ids_of: Ids) -> DataFrame:
    """(row, doc_id, ids, inside, others), written: the leaves of each text's words, the sum of the shares at hand, and the words without. A row number holds wherever the table is read."""
    shared = docs.sparkSession.sparkContext.broadcast(ids_of)  # bounded by the numbers of its words

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = shared.value
        for b in batches:
            words, upto = words_of(b.column(2))
            ids, share, held = use.of(words)
            total = np.append(0, np.cumsum(share))
            cut = np.append(0, np.cumsum(~held))[upto]
            others = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), words.filter(pa.array(~held)).cast(pa.string()))
            yield pa.record_batch([b.column(0), b.column(1), pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(ids)), pa.array(np.diff(total[upto])), others], names=["row", "doc_id", "ids", "inside", "others"])

    given = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return saved(given.mapInArrow(rows, "row long, doc_id long, ids array<int>, inside long, others array<string>"), "likelihood-ids")


def task_training(network: WindowNetwork, flat: np.ndarray, turn: int, rounds: int):
    """For mapInArrow over texts' ids: the parameters that a task ends with, in slices, with its number of targets."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network.load(flat)
        learned = 0
        past = [np.full(s, 0.1, np.float32) for s in network.shapes]
        window, token = np.zeros((0, len(PLACES)), np.int32), np.zeros(0, np.int32)
        for b in batches:
            ids, upto = flattened(b.column(0))
            these = targets(upto, turn, rounds)
            window, token = np.concatenate((window, windows(ids, upto, network.edge)[these])), np.concatenate((token, ids[these]))
            learned += len(these)
            whole = len(token) - len(token) % BATCH
            for k in range(0, whole, BATCH):
                network.learn(window[k : k + BATCH], token[k : k + BATCH], past, RATE)
            window, token = window[whole:], token[whole:]
        if len(token):
            network.learn(window, token, past, RATE)
        if not learned:
            return
        end = network.flat()
        task = TaskContext.get().partitionId()
        for k in range(0, len(end), SLICE):
            yield pa.record_batch([pa.array([k], pa.int64()), pa.array([task], pa.int64()), pa.array([learned], pa.int64()), pa.array([end[k : k + SLICE].astype(np.float64).tobytes()], pa.binary())], names=["at", "task", "targets", "part"])

    return rows


def averaged(key: tuple, table: pa.Table) -> pa.Table:
    """The mean of a slice over some tasks, weighted by targets; tasks are summed in their order."""
    rows = sorted(zip(table["task"].to_pylist(), table["targets"].to_pylist(), table["part"].to_pylist(), strict=True))
    total, n = np.zeros(len(rows[0][2]) // 8), sum(n for _, n, _ in rows)
    for _, m, part in rows:
        total += m / n * np.frombuffer(part)
    return pa.table({"at": pa.array([key[0].as_py()], pa.int64()), "task": pa.array([rows[0][0] // FAN], pa.int64()), "targets": pa.array([n], pa.int64()), "part": pa.array([total.tobytes()], pa.binary())})


def vocabulary(docs: DataFrame, size: int, near: int = NEAR) -> tuple[WindowNetwork, Ids, DataFrame]:
    """An untrained network for docs; its words and those whose shares are at hand; and (word, share) of all others, the share being the logarithm of a word's share of its leaf.

    The network's words are the most frequent ones of all documents, `size` at most: words of one count are all in or all
    out. The next ones, `near` in all at most, are kept at hand; the others are a table that grows with the documents.
    """
    counts = saved(word_counts(docs), "likelihood-words")
    by_count = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("n")).limit(size + near + 1).collect()  # bounded by both
    least = [None, None]
    for k, room in enumerate((size, size + near)):
        for r in by_count:
            room -= r["words"]
            if room < 0:
                break
            least[k] = r["n"]
    inside, close = (F.lit(False) if x is None else F.col("n") >= x for x in least)
    top = sorted(counts.where(inside).collect(), key=lambda r: (-r["n"], r["word"]))  # size rows at most
    leaf = (F.crc32(F.col("word").cast("binary")) % RARE).cast("int")
    others = counts.where(~inside).withColumn("leaf", leaf)
    mass = {r["leaf"]: r["mass"] for r in others.groupBy("leaf").agg(F.sum("n").alias("mass")).collect()}  # one row per leaf
    network = WindowNetwork([r["word"] for r in top], np.array([r["n"] for r in top] + [max(1, mass.get(k, 0)) for k in range(RARE)], np.int64))
    masses = F.array(*[F.lit(float(mass.get(k, 0))) for k in range(RARE)])
    shares = others.select("word", "n", F.round((F.log("n") - F.log(F.get(masses, F.col("leaf")))) * FINE).cast("long").alias("share"))
    at_hand = shares.where(close).select("word", "share").collect()  # near rows at most
    ids_of = Ids(network.vocabulary, [r["word"] for r in at_hand], np.array([r["share"] for r in at_hand], np.int64))
    return network, ids_of, shares.where(~close).select("word", "share")


def trained(texts: DataFrame, network: WindowNetwork, rounds: int = 2) -> WindowNetwork:
    """The network after its rounds over texts' ids. Tasks' parameters are averaged FAN at a time, whatever their number."""
    flat = network.flat()
    ids = texts.select("ids")
    tasks = ids.rdd.getNumPartitions()
    form = "at long, task long, targets long, part binary"
    for turn in range(rounds):
        parts, left = ids.mapInArrow(task_training(network, flat, turn, rounds), form), tasks
        while left > FAN:
            parts, left = parts.groupBy("at", F.floor(F.col("task") / FAN).alias("group")).applyInArrow(averaged, form), -(-left // FAN)
        got = parts.groupBy("at").applyInArrow(averaged, form).collect()  # one row per slice: the model's size
        if got:
            flat = np.concatenate([np.frombuffer(r["part"]) for r in sorted(got)]).astype(np.float32)
    network.load(flat)
    return network


def scored(docs: DataFrame, size: int = 8191, rounds: int = 2, near: int = NEAR) -> DataFrame:
    """(doc_id, n_tokens, pll, mean_pll): the sum and mean of the log-probabilities of a text's tokens in their windows.

    Null and empty texts have 0 tokens, sum 0 and a null mean. Texts are read whole; equal texts get equal results, to six
    places; rows repeat as they come; other columns are ignored. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    network, ids_of, shares = vocabulary(docs.select(F.col("text").cast("string").alias("text")), size, near)
    texts = encoded(docs, ids_of)
    shared = docs.sparkSession.sparkContext.broadcast(trained(texts, network, rounds))  # bounded by size

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = shared.value
        for b in batches:
            ids, upto = flattened(b.column(2))
            yield pa.record_batch([b.column(0), b.column(1), pa.array(np.diff(upto), pa.int64()), pa.array(use.sums(ids, upto), pa.float64()), b.column(3)], names=["row", "doc_id", "n_tokens", "leaves", "inside"])

    found = texts.select("row", "doc_id", "ids", "inside").mapInArrow(rows, "row long, doc_id long, n_tokens long, leaves double, inside long")
    words = texts.select("row", F.explode("others").alias("word"))
    # A word's row meets its texts by hash, as both sides are long: no sort of all rare words.
    rest = words.join(shares.hint("shuffle_hash"), "word").groupBy("row").agg(F.sum("share").alias("rest"))
    pll = F.round(F.col("leaves") + (F.col("inside") + F.coalesce("rest", F.lit(0))) / FINE, 6)
    return found.join(rest, "row", "left").select("doc_id", "n_tokens", pll.alias("pll"), F.when(F.col("n_tokens") > 0, pll / F.col("n_tokens")).alias("mean_pll"))
