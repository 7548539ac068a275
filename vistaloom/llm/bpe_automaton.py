"""BPE with word ends as a deterministic automaton over tokens, built merge by merge.

A state is the token emitted last. A merge (u, v) -> w puts a gadget in: wherever u is followed by v, the arc v goes and an
arc w takes the place of both. Tokens that end with u or begin with v inherit it, as long as the merge comes before the
one that took u or v into the larger token. What is left are the arcs of proper tokenizations only, of which each word has
exactly one: a pass over the word's symbols keeps, for each prefix, the one token that can end it.

The tokens that proper tokenizations hold are compiled into one table of transitions over symbols, a row of them for
each state, which deterministically spells all tokens from a place; arcs between tokens are worked out from the gadgets when a
word first needs them, since there are thousands of millions.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vistaloom.llm.common import small_batches

#: Entries of a worker's tables, and characters of a word that is kept. Frequent ones come early, so a full table takes no more;
#: workers outlive their stage and share an executor's memory with the stages after, so tables are bounded in bytes as well. What isn't kept is worked out again.
CHUNKS, PIECES, ARCS, LONGEST = 150_000, 250_000, 200_000, 64
LATE = 1 << 60


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where it is one, else the next from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Automaton:
    """Arcs between tokens; from a tokenizer file with merges, an end-of-word suffix and byte symbols."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        self.ids, self.suffix = vocabulary, suffix
        self.labels = {i: t for t, i in vocabulary.items()}
        self.gadget: dict[int, int] = {}
        self.ends = {i: [(i, LATE)] for i in self.labels}  # tokens that a token ends with, each with the merge that took it in
        self.begins = {i: [(i, LATE)] for i in self.labels}
        self.improper: set[int] = set()
        made: set[int] = set()
        for rank, (u, v) in enumerate(merges):
            self.insert(rank, self.ids[u], self.ids[v], self.ids[u + v], made)
        self.table: list[dict[str, int]] = [{}]
        self.inner, self.final = [-1], [-1]
        for t, i in self.ids.items():
            if i not in self.improper:
                self.spell(t, i)
        self.arcs: dict[int, bool] = {}

    def spell(self, token: str, i: int) -> None:
        """Transitions over a token's symbols; the state they end in knows the token, as one within a word or as a word's last."""
        ends = bool(self.suffix) and token.endswith(self.suffix) and len(token) > len(self.suffix)
        state = 0
        for c in token.removesuffix(self.suffix) if ends else token:
            state = self.table[state].setdefault(c, len(self.table))
            if state == len(self.table):
                self.table.append({})
                self.inner.append(-1)
                self.final.append(-1)
        if not ends:
            self.inner[state] = i
        if ends or not self.suffix:
            self.final[state] = i

    def insert(self, rank: int, u: int, v: int, w: int, made: set[int]) -> None:
        """The gadget of one merge. A token that several merges make keeps the first one's parts."""
        self.gadget[u << 32 | v] = rank
        if w not in made:
            made.add(w)
            if u in self.improper or v in self.improper or self.earliest(u, v) < rank:
                self.improper.add(w)  # other merges break its symbols up; no word's tokens hold it
            self.ends[w] = [(w, LATE), (v, rank), *self.ends[v][1:]]
            self.begins[w] = [(w, LATE), (u, rank), *self.begins[u][1:]]

    def earliest(self, a: int, b: int) -> int:
        """The first merge that joins a's end to b's beginning; LATE if none does. Of equal merges the left one comes first."""
        first = LATE
        for u, taken in self.ends[a]:
            for v, taken_right in self.begins[b]:
                rank = self.gadget.get(u << 32 | v, LATE)
                if rank < taken and rank <= taken_right and rank < first:
                    first = rank
        return first

    def arc(self, a: int, b: int) -> bool:
        """Whether token b may follow token a; the table of arcs fills as words need them."""
        known = self.arcs.get(a << 32 | b)
        if known is None:
            known = self.earliest(a, b) == LATE
            if len(self.arcs) < ARCS:
                self.arcs[a << 32 | b] = known
        return known

    def encode(self, symbols: str) -> list[int]:
        """Token ids of one word, given as byte symbols."""
        n, inner, final, table, arcs = len(symbols), self.inner, self.final, self.table, self.arcs
        token_at: list[int] = [-1] * (n + 1)
        from_at = [0] * (n + 1)
        todo = [0]
        while token_at[n] < 0:  # the longest token first; a place is reached by one proper path only, so once is enough
            start = todo.pop()
            last = token_at[start] << 32
            state = 0
            for end in range(start, n):
                state = table[state].get(symbols[end])
                if state is None:
                    break
                token = inner[state] if end + 1 < n else final[state]
                if token < 0 or token_at[end + 1] >= 0:
                    continue
                if start:
                    open_ = arcs.get(last | token)
                    if not (self.arc(last >> 32, token) if open_ is None else open_):
                        continue
                token_at[end + 1], from_at[end + 1] = token, start
                todo.append(end + 1)
        out, at = [], n
        while at:
            out.append(token_at[at])
            at = from_at[at]
        return out[::-1]

    def decode(self, ids: list[int]) -> str:
        """The arcs' labels, one space between them."""
        return " ".join(map(self.labels.__getitem__, ids))


class Bpe(dict):
    """White-space separated chunks with their ids; each is worked out once as long as it is kept. Ids are the vocabulary's own numbers, so that an entry is a tuple and no text."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocabulary = model["vocab"] | self.special
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.automaton = Automaton(vocabulary, merges, model["end_of_word_suffix"] or "")
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(split["pattern"]["Regex"]).findall
        self.marks = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))))
        self.odd = regex.compile(r"[\x1c-\x1f]|" + self.marks.pattern).search
        self.space = regex.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+").split
        self.symbols = byte_symbols()
        self.numbers = {i: str(i) for i in self.automaton.labels}
        self.words: dict[str, tuple[int, ...]] = {}

    def __missing__(self, chunk: str) -> tuple[int, ...]:
        text = chunk if chunk.isascii() else unicodedata.normalize("NFC", chunk).replace("Σ", "σ")
        parts = [self.words.get(piece) or self.word(piece) for piece in self.pieces(text.lower())]
        made = parts[0] if len(parts) == 1 else tuple(chain.from_iterable(parts))
        if len(self) < CHUNKS and len(chunk) <= LONGEST:
            self[chunk] = made
        return made

    def word(self, piece: str) -> tuple[int, ...]:
        """One pre-split word; kept apart, as words recur with other punctuation."""
        symbols = piece if piece.isascii() and piece.isprintable() else "".join([self.symbols[b] for b in piece.encode()])
        made = tuple(self.automaton.encode(symbols))
        if len(self.words) < PIECES and len(piece) <= LONGEST:
            self.words[piece] = made
        return made

    def chunks(self, text: str) -> Iterator[tuple[int, ...]]:
        """Of whole texts; names of special tokens stand for themselves, before anything else."""
        at = 0
        for m in self.marks.finditer(text):
            yield from (self[c] for c in self.space(text[at : m.start()]) if c)
            yield (self.special[m[0]],)
            at = m.end()
        yield from (self[c] for c in self.space(text[at:]) if c)

    def coded(self, text: str) -> tuple[str, int, str]:
        """(ids as text, number of ids, decoded text)."""
        ids = list(chain.from_iterable(self.chunks(text) if self.odd(text) else map(self.__getitem__, text.split())))
        return " ".join(map(self.numbers.__getitem__, ids)), len(ids), self.automaton.decode(ids)


_coders: dict[str, Bpe] = {}


def coder(path: str) -> Bpe:
    """One automaton per worker process."""
    if path not in _coders:
        _coders[path] = Bpe(path)
    return _coders[path]


def encoded(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every row: decimal ids and decoded labels, each joined by one space.

    Null texts are empty: no ids and an empty decoded text. Rows repeat as they come; other columns are ignored, whatever
    their names. Texts of any length are coded whole. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = coder(tokenizer)
        for b in batches:
            ids, n, decoded = zip(*[use.coded(t or "") for t in b.column(1).to_pylist()], strict=True) if b.num_rows else ((), (), ())
            yield pa.record_batch([b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], names=["doc_id", "n_tokens", "ids", "decoded"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(rows, "doc_id long, n_tokens long, ids string, decoded string")
