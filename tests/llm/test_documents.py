"""Operators over documents: brute force on small tables, and the odd cases of every column."""

import hashlib
import math
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vistaloom.llm import audio, bpe_automaton, decontaminate, language_id, pseudo_likelihood, quality, simhash, suffix_dedup, wavelet
from vistaloom.llm.common import components, merged, scratch

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, doc long, row string, component_id long"
WORDS = "the of and to in is that it was for on are with as they be at one have this from by hot but some what there out".split()


def prose(r, n):
    return " ".join(r.choice(WORDS) + r.choice(["", "", ".", "ing"]) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    r = random.Random(3)
    base = [prose(r, r.randint(0, 120)) for _ in range(50)]
    passage = prose(r, 60)
    out = base + base[:8] + [b.replace(" the ", " a ", 1) for b in base[:10]] + [f"{prose(r, 5)} {passage} {prose(r, 9)}" for _ in range(12)]
    return [*out, None, "", "   \n\t ", "one", "one two three", "é" * 130, "x" * 250, "ab " * 3000, passage, passage]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(k, t, None if k % 9 == 0 else "en", "s", None, 7, 7, "r", 5) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def fingerprint(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def linked(prints, radius):
    """Smallest id reachable, by brute force."""
    label = {k: k for k in prints}
    while True:
        new = {k: min(label[j] for j in prints if (prints[j] ^ prints[k]).bit_count() <= radius) for k in prints}
        if new == label:
            return label
        label = new


def test_simhash_brute_force(docs, texts):
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    prints = {k: fingerprint(t) for k, t in enumerate(texts)}
    assert {k: r.fp & (2**64 - 1) for k, r in got.items()} == prints
    assert {k: r.component_id for k, r in got.items()} == linked(prints, 4)


def test_keep_one_by_texts_not_ids(spark, docs, texts):
    """Unlinked texts under one doc_id stay; groups without repeated ids keep their smallest doc_id."""
    a, b = "alpha beta gamma delta epsilon zeta", "one two three four five six seven"
    rows = [(5, a), (5, b), (5, b), (3, a), (7, b), (8, None), (9, ""), (None, a)]
    got = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(3, a), (5, b), (8, None), (None, a)], key=repr)
    label = linked({k: fingerprint(t) for k, t in enumerate(texts)}, 4)
    assert sorted(r.doc_id for r in simhash.keep_one(docs).collect()) == sorted(set(label.values()))


def test_simhash_equals_native_hash(spark):
    t = "Alpha beta  gamma"
    (row,) = spark.createDataFrame([(t,)], "t string").select(F.xxhash64(F.lit("alpha beta gamma")).alias("h")).collect()
    assert simhash.fingerprint(t.encode()) == row.h & (2**64 - 1)


def test_vantage_tree_finds_every_link():
    r = np.random.default_rng(0)
    centers = r.integers(0, 2**63, 40, dtype=np.uint64)
    x = np.unique(np.concatenate([centers, *[centers ^ (np.uint64(1) << np.uint64(k)) ^ (np.uint64(1) << np.uint64(2 * k % 63)) for k in range(30)]]))
    assert len(x) > 3 * simhash.SMALL
    a, b = simhash.close_pairs(x, 4)
    assert (np.bitwise_count(x[a] ^ x[b]) <= 4).all()
    p, q = np.nonzero(np.bitwise_count(x[:, None] ^ x[None, :]) <= 4)
    assert (simhash.roots(len(x), a, b) == simhash.roots(len(x), p, q)).all()


@pytest.mark.parametrize(("radius", "agree"), [(0, 1), (3, 1), (4, 1), (4, 2), (4, 3)])
def test_leaves_keep_close_fingerprints_together(spark, radius, agree):
    r = random.Random(1)
    pairs = []
    for k in range(60):
        x = r.getrandbits(64)
        y = x
        for b in r.sample(range(64), radius):
            y ^= 1 << b
        pairs += [(k, x), (k, y)]
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    df = spark.createDataFrame([(signed(v), k) for k, v in pairs], "fp long, rep long")
    leaves = {}
    for row in simhash.leaves(df, radius, agree).collect():
        leaves.setdefault((row.rep, row.fp), set()).add(row.leaf)
    for k in range(60):
        a, b = [v for (rep, _), v in leaves.items() if rep == k] * 2 if radius == 0 else [v for (rep, _), v in leaves.items() if rep == k]
        assert a & b


def test_components(spark):
    chain = [(k, k + 1) for k in range(30)] + [(100, 90), (90, 95), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long"), "test").collect()}
    assert got == {**{k: 0 for k in range(1, 31)}, 95: 90, 100: 90}


def removed(rows, length):
    """n_removed, n_spans and the rest of every document, by looking at every string."""
    seen, out = set(), {}
    for d, t in sorted(rows):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            if w in seen:
                gone[s : s + length] = True
            seen.add(w)
        edge = np.diff(np.pad(gone.astype(int), 1))
        out[d] = (len(b), int(gone.sum()), int((edge == 1).sum()), np.frombuffer(b, np.uint8)[~gone].tobytes())
    return out


@pytest.mark.parametrize(("sample", "least"), [(1, 1), (2, 2), (16, 50_000)])
def test_suffix_dedup_brute_force(docs, texts, monkeypatch, sample, least):
    """Also with all anchors, or some, dealt as crowded ones."""
    monkeypatch.setattr(suffix_dedup, "partitions", lambda spark: 40)
    got = suffix_dedup.deduplicated(docs, 100, sample=sample, least=least).select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got} == removed(enumerate(texts), 100)


def test_suffix_dedup_long_text_over_pieces(spark, monkeypatch):
    r = random.Random(5)
    one = "".join(r.choice("abcdefgh ") for _ in range(6000))
    rows = [(1, one), (2, "zz" + one[2500:4500] + "qq"), (3, one[:90])]
    monkeypatch.setattr(suffix_dedup, "PIECE", 1024)
    found = []
    for d, t in rows:
        pieces = suffix_dedup.Pieces(100)
        got = [*pieces.add(d, np.frombuffer(t.encode(), np.uint8))]
        if pieces.spans:
            got.append(pieces.flush())
        found.append({(int(p), int(h), int(c)) for _, ps, hs, cs in got for p, h, c in zip(ps, hs, cs, strict=True)})
    monkeypatch.undo()
    for (_, t), f in zip(rows, found, strict=True):
        pieces = suffix_dedup.Pieces(100)
        got = [*pieces.add(1, np.frombuffer(t.encode(), np.uint8))] + ([pieces.flush()] if pieces.spans else [])
        assert f == {(int(p), int(h), int(c)) for _, ps, hs, cs in got for p, h, c in zip(ps, hs, cs, strict=True)}


def test_suffix_dedup_ids_that_repeat(spark):
    r = random.Random(4)
    t = "".join(r.choice("abcdefgh") for _ in range(300))
    rows = [(1, t), (1, t), (1, t[::-1]), (None, t), (2, None), (2, t[50:200])]
    got = suffix_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).select("row.doc_id", "n_bytes", "n_removed").collect()
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_removed) for r in got) == [(-1, 300, 0), (1, 300, 0), (1, 300, 300), (1, 300, 300), (2, 0, 0), (2, 150, 150)]


def test_without_repeats_keeps_columns(docs):
    got = suffix_dedup.without_repeats(docs)
    assert got.columns == docs.columns
    rows = {r.doc_id: r for r in got.collect()}
    assert len(rows) == docs.count() and all(r.text is None or r.n_chars == len(r.text) for r in rows.values())


@pytest.mark.parametrize("files", [False, True])
def test_transform_matches_sorted_suffixes(tmp_path, files):
    r = np.random.default_rng(2)
    rows = r.integers(97, 100, (40, 30)).astype(np.uint8)
    built = suffix_dedup.ColumnwiseTransform(iter(np.ascontiguousarray(rows.T)), f"file://{tmp_path}" if files else None)
    for c in range(29, -1, -1):
        order, prefix = built.step(c)
        suffixes = [rows[i, c:].tobytes() for i in order]
        assert suffixes == sorted(suffixes)
        if c:
            assert (built.layers.get("transform", np.uint8) == rows[order, c - 1]).all()
        for k in range(1, 40):
            a, b = suffixes[k - 1 : k + 1]
            assert prefix[k] == next((j for j in range(len(a)) if a[j] != b[j]), len(a))
    built.close()
    assert not list(tmp_path.iterdir())


def test_merged_ranges():
    d, s, e = merged(np.array([2, 1, 1, 1, 2]), np.array([0, 5, -3, 40, 9]), np.array([9, 12, 6, 41, 11]))
    assert (d.tolist(), s.tolist(), e.tolist()) == ([1, 1, 2], [-3, 40, 0], [12, 41, 11])


def test_wavelet_round_trip(spark, docs, texts):
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    odd = [(1000, "it's <|endoftext|> two  spaces\n\n x"), (None, "null id"), (1001, "ünï ²³ ٣ 　wide"), (1001, "again\ttab")]
    both = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    rows = sorted([(k, x) for k, x in enumerate(texts)] + [o for o in odd if o[0] is not None], key=lambda x: x[0])
    got = sorted(wavelet.round_trip(both, path).collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.start))
    want, start = [], 0
    for d, x in [(None, "null id"), *rows]:
        ids = t.encode(x or "", add_special_tokens=False).ids + [2]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    tail = [w[2:] for w in want if w[0] == 1001]
    assert [(r.doc_id, r.n_tokens, r.ids_crc32) for r in got if r.doc_id != 1001] == [(w[0], *w[2:]) for w in want if w[0] != 1001]
    assert sorted((r.n_tokens, r.ids_crc32) for r in got if r.doc_id == 1001) == sorted(tail)
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got[:-1]]]).tolist()


def test_pieces_of_one_hash_are_told_apart(monkeypatch):
    e = wavelet.Encoder(public_tokenizers.path("byte_bpe_50k.json"), 2)
    texts = ["one two three", "", "two one the", "a much longerpieceofabovesixteenbytes here"]
    want = [x.tolist() for x in e.ids(texts)]
    monkeypatch.setattr(wavelet, "hashed_spans", lambda buf, at, size: np.zeros(len(at), np.uint64))
    assert [x.tolist() for x in e.ids(texts)] == want


def test_wavelet_tasks_write_bounded_files(texts, tmp_path, monkeypatch):
    monkeypatch.setattr(wavelet.TaskContext, "get", lambda: type("", (), {"partitionId": lambda self: 3})())
    path, folder = public_tokenizers.path("byte_bpe_50k.json"), f"file://{tmp_path}/shards"
    batches = [pa.record_batch([pa.array(range(k, min(k + 5, len(texts)))), pa.array(texts[k : k + 5], pa.string())], names=["doc_id", "text"]) for k in range(0, len(texts), 5)]
    files = pa.Table.from_batches(list(wavelet.write_shards(folder, path, 2, 400)(iter(batches)))).to_pylist()
    assert len(files) > 5 and sum(f["n_docs"] for f in files) == len(texts) and [f["part"] for f in files] == list(range(len(files)))
    starts = np.cumsum([0, *[f["n_tokens"] for f in files]])[:-1]
    read = wavelet.read_shards(folder)(iter([pa.record_batch([pa.array([f["file"] for f in files]), pa.array(starts)], names=["file", "start"])]))
    rows = pa.Table.from_batches(list(read)).to_pylist()
    t = Tokenizer.from_file(path)
    want = [t.encode(x or "", add_special_tokens=False).ids + [2] for x in texts]
    assert [(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows] == [(k, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for k, i in enumerate(want)]
    assert [r["start"] for r in rows] == np.cumsum([0, *map(len, want)])[:-1].tolist()


def test_wavelet_queries():
    r = np.random.default_rng(1)
    a = (r.zipf(1.5, 200_000) % 3000).astype(np.uint16)
    shard = wavelet.WaveletShard(wavelet.written(a, [4, None], np.array([0, 10, len(a)])))
    assert (shard.tokens() == a).all() and shard.doc_ids == [4, None]
    for i in r.integers(0, len(a), 50).tolist():
        assert shard.access(i) == a[i] and shard.rank(int(a[i]), i) == (a[:i] == a[i]).sum()
    rare = int(a[np.argmin(np.bincount(a)[a])])
    assert shard.occurrences(rare) == np.flatnonzero(a == rare).tolist()
    assert shard.count(65000) == 0 and shard.rank(65000, 5) == 0
    with pytest.raises(IndexError):
        shard.select(rare, 10**6)
    none = wavelet.WaveletShard(wavelet.written(np.zeros(0, np.uint16), [], np.array([0])))
    assert none.tokens().tolist() == [] and none.count(3) == 0


def test_bpe_equals_library(docs, texts, spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    odd = ["It's ΣΑΣ İstanbul <|endoftext|>x", "A\x1cb 　z", "é ẹ́ 12345 ---!!!", "aaaaaaaaaaaaaaaaaa " + "th" * 500, "👩‍👩‍👧 ок"]
    both = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(900 + k, x) for k, x in enumerate(odd)], "doc_id long, text string"))
    got = {r.doc_id: r for r in bpe_automaton.encoded(both, path).collect()}
    for k, x in [*enumerate(texts), *[(900 + k, x) for k, x in enumerate(odd)]]:
        ids = t.encode(x or "", add_special_tokens=False).ids
        assert (got[k].ids, got[k].n_tokens, got[k].decoded) == (" ".join(map(str, ids)), len(ids), t.decode(ids, skip_special_tokens=False))


def test_bpe_tables_bounded_in_bytes():
    """Full tables of words take under 80 MB of a worker, and words of any length are coded but only short ones kept."""
    path = public_tokenizers.path("word_bpe_49k.json")
    use, t, r = bpe_automaton.Bpe(path), Tokenizer.from_file(path), random.Random(7)
    words = sorted({"".join(r.choices("abcdefghijklmnoprstu", k=9)) for _ in range(10_000)})
    tracemalloc.start()
    try:
        use.coded(", ".join(words))
        use.automaton.arcs.clear()
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert held / (len(use) + len(use.words)) * (bpe_automaton.CHUNKS + bpe_automaton.PIECES) < 80e6
    before = len(use), len(use.words)
    for text in ("x" * 50_000, "th" * 500 + "," + "q" * 70):
        ids = t.encode(text, add_special_tokens=False).ids
        assert use.coded(text) == (" ".join(map(str, ids)), len(ids), t.decode(ids, skip_special_tokens=False))
    assert len(use) == before[0] and max(map(len, use.words)) <= 64


def test_bpe_small_automaton_against_merging():
    merges = [("a", "b"), ("b", "a"), ("ab", "a"), ("a", "a"), ("ab", "ab"), ("b", "b"), ("aa", "b")]
    vocabulary = {t: k for k, t in enumerate(["a", "b", *dict.fromkeys(u + v for u, v in merges)])}
    m = bpe_automaton.Automaton(vocabulary, merges, "")
    rank = {p: k for k, p in enumerate(merges)}

    def merged_by_rule(word):
        parts = list(word)
        while True:
            found = [(rank[p], k) for k, p in enumerate(zip(parts, parts[1:], strict=False)) if p in rank]
            if not found:
                return parts
            _, k = min(found)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    for n in range(1, 11):
        for x in range(1 << n):
            word = "".join("ab"[x >> k & 1] for k in range(n))
            assert [m.labels[i] for i in m.encode(word)] == merged_by_rule(word), word


def test_language_id(spark, docs, empty):
    langs = {"xx": "abcde", "yy": "fghij", "zz": "klmno"}
    r = random.Random(2)
    say = lambda a: " ".join("".join(r.choice(a) for _ in range(6)) for _ in range(30))
    rows = [(k, say(a), lang) for k, (lang, a) in enumerate([*langs.items()] * 60)] + [(900, None, "xx"), (901, "123 !!", "yy"), (902, "", None), (903, "Q", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {x.doc_id: x for x in language_id.identified(df).collect()}
    assert all(got[k].lang_pred == lang for k, _, lang in rows[:180]) and all(0 <= x.score <= 1 for x in got.values())
    assert [got[k].lang_pred for k in (900, 901, 902)] == ["und"] * 3 and got[903].lang_pred in langs
    assert all(x.held_out == (zlib.crc32(str(k).encode()) % 5 == 0) for k, x in got.items())
    assert language_id.identified(empty.select("doc_id", "text", "lang")).count() == 0


def test_bit_sliced_filter_never_misses():
    r = np.random.default_rng(4)
    sets = [r.integers(0, 2**40, 500, dtype=np.uint64) for _ in range(11)]
    f = language_id.BitSlicedFilter.built([f"l{k:02}" for k in range(11)], sets, 0)
    for k, s in enumerate(sets):
        assert (f.counts(f.masks(s))[k]) == len(s)
    other = r.integers(0, 2**40, 20_000, dtype=np.uint64)
    assert np.abs(f.counts(f.masks(other)) / len(other) - f.false_rates).max() < 0.01


@pytest.mark.parametrize("n", [3, 12, 70, 150])
def test_shares_brute_force(n):
    """Any number of languages: shares of n-grams are those of plain sets, but for false positives."""
    r = np.random.default_rng(n)
    sets = [r.integers(0, 2**40, 300, dtype=np.uint64) for _ in range(n)]
    f = language_id.BitSlicedFilter.built([f"l{k:03}" for k in range(n)], sets, 0)
    some = np.concatenate([sets[0][:60], sets[n - 1][:120], sets[n // 2][:20], r.integers(2**41, 2**42, 100, dtype=np.uint64)])
    plain = np.array([np.isin(some, s).mean() for s in sets])
    assert np.abs(f.shares(some) - plain).max() < 0.03 and int(np.argmax(f.shares(some))) == n - 1


def weighted_jaccard(a, b):
    both = sum(min(a.count(x), b.count(x)) for x in set(a))
    return both / (len(a) + len(b) - both)


def test_decontamination_brute_force(spark):
    r = random.Random(8)
    vocabulary = [f"w{k}" for k in range(400)]
    items = [(k, " ".join(r.choice(vocabulary) for _ in range(r.randint(6, 40)))) for k in range(12)] + [(50, "too short"), (51, None)]
    docs = []
    for k in range(60):
        words = [r.choice(vocabulary) for _ in range(r.randint(0, 80))]
        if k % 3 == 0:
            item = items[k % 12][1].upper().split()
            if k % 2 and len(item) > 20:
                item[0] = "CHANGED"
            at = r.randint(0, len(words))
            words[at:at] = item
        docs.append((k, " ".join(words)))
    items += [(60 + k, " ".join(r.choice(vocabulary) for _ in range(60))) for k in range(3)] + [(70, "ab ab ab ab ab ab ab ab ab ab cd"), (71, "x y " * 12)]
    moved = lambda t, k: " ".join([*t.split()[k:], *t.split()[:k]])
    docs += [(70, None), (71, ""), (None, items[0][1]), (0, docs[0][1]), (80, "ab " * 300), (81, "x y " * 100), (82, "some y x " + "x y " * 9)]
    docs += [(90 + 10 * k + j, f"{' '.join(r.choice(vocabulary) for _ in range(j))} {x} after it") for k in range(3) for t in [items[-5 + k][1]] for j, x in enumerate([moved(t, 30), moved(t, 7), f"{t[: len(t) // 2]} put in {t[len(t) // 2 :]}", " ".join(t.split()[:-5]), t.replace(" ", " extra ", 1)])]
    docs += [(130 + k, " ".join(items[-5 + k][1].split()[3:])) for k in range(3)]  # whole texts that are shorter than the item
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(x.doc_id, x.item_id): x for x in decontaminate.contaminated(df, bench).collect()}
    want = {}
    shingles = lambda w: [" ".join(w[k : k + 5]) for k in range(len(w) - 4)]
    for d, t in docs:
        for i, x in items:
            w, q = (t or "").lower().split(), (x or "").lower().split()
            if d is None or len(q) < 5 or len(w) < 5:
                continue
            best = max(weighted_jaccard(shingles(q), shingles(w[s : s + len(q)])) for s in range(max(1, len(w) - len(q) + 1)))
            if best >= 0.8:
                want[d, i] = best
    assert got.keys() == want.keys() and all(math.isclose(got[k].similarity, v) for k, v in want.items())
    clean = decontaminate.without_contaminated(df, bench).collect()
    assert {x.doc_id for x in clean} == {d for d, _ in docs} - {d for d, _ in want}
    assert decontaminate.contaminated(df.limit(0), bench).count() == 0 and decontaminate.contaminated(df, bench.limit(0)).count() == 0


def test_audio_round_trip_and_features(docs, texts):
    got = {r.doc_id: r for r in audio.described(audio.media(docs)).collect()}
    for k, t in enumerate(texts):
        raw = (t or "").encode()
        payload = raw + b"\xff" * (max(1, -(-len(raw) // 576)) * 576 - len(raw))
        r = got[k]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert (r.media_bytes, r.media_sha256) == (len(payload) + 44, hashlib.sha256(audio.wav(payload)).hexdigest())
    assert got[len(texts) - 1].feature == got[len(texts) - 2].feature
    rows = audio.audio_features(audio.media(docs.limit(3))).collect()
    assert all(len(r.tensor) == len(r.spans) * audio.WINDOW * audio.MELS and bytes(r.payload) for r in rows)


def test_audio_resampling_and_segments():
    x = np.sin(np.arange(16000) * 2 * np.pi * 440 / 16000).astype(np.float32)
    y = audio.resampled(x, 16000, 10000)
    assert len(y) == 10000 and np.abs(y - np.sin(np.arange(10000) * 2 * np.pi * 440 / 10000))[50:-50].max() < 5e-3
    assert audio.segments(np.array([0, 0.7, 1, 0.7, 0.7, 0.5, 0.7, 0.95])) == [(2, 5), (7, 8)]
    assert audio.segments(np.zeros(4)) == []
    t = audio.tensor_batch(pa.array([3]), pa.array([15_000]), [audio.wav(audio.padded(b"abc" * 5000))])
    assert t["features"].type.value_type.shape == [audio.WINDOW, audio.MELS] and len(t["features"][0]) > 1


def test_log_mel_brute_force():
    """Every frame's bands by a plain transform, and the resampling by a plain sum over its filter."""
    x = np.random.default_rng(3).standard_normal(1500).astype(np.float32)
    mels, energy = audio.log_mel(x)
    mel = lambda f: 2595 * math.log10(1 + f / 700)
    edges = [700 * (10 ** ((mel(60) + (mel(audio.FEATURE_RATE / 2) - mel(60)) * k / (audio.MELS + 1)) / 2595) - 1) for k in range(audio.MELS + 2)]
    wide = np.append(x, np.zeros(2 * audio.FRAME))
    for k in (0, 3, len(mels) - 1):
        frame = wide[k * audio.HOP : k * audio.HOP + audio.FRAME] * [0.5 - 0.5 * math.cos(2 * math.pi * i / (audio.FRAME - 1)) for i in range(audio.FRAME)]
        power = [abs(sum(v * complex(math.cos(2 * math.pi * j * i / audio.FRAME), -math.sin(2 * math.pi * j * i / audio.FRAME)) for i, v in enumerate(frame))) ** 2 for j in range(audio.FRAME // 2 + 1)]
        for m in range(audio.MELS):
            low, top, high = edges[m : m + 3]
            weight = lambda f: max(0.0, min((f - low) / (top - low), (high - f) / (high - top)))  # noqa: B023, E731
            assert math.isclose(mels[k, m], math.log(sum(p * weight(j * audio.FEATURE_RATE / audio.FRAME) for j, p in enumerate(power)) + 1e-6), abs_tol=1e-3)
        assert math.isclose(energy[k], float((frame**2).mean()), rel_tol=1e-4)
    assert len(mels) == 1 + -(-(len(x) - audio.FRAME) // audio.HOP)
    got, h = audio.resampled(x, 16_000, 10_000), audio.polyphase(5, 8)
    for n in (0, 7, 100, len(got) - 1):
        first, phase = divmod(n * 8, 5)
        assert math.isclose(got[n], sum(float(h[phase, j]) * float(x[i]) for j in range(16) for i in [first - 7 + j] if 0 <= i < len(x)), abs_tol=1e-4)


def test_quality_learns_from_labellers(spark, texts):
    r = random.Random(6)
    good = [(k, ". ".join(prose(r, 12).capitalize() for _ in range(6)) + ".") for k in range(150)]
    bad = [(500 + k, " ".join(f"{w}###" if k % 2 else f"{w.upper()} |" for w in prose(r, 60).split())) for k in range(40)]
    odd = [(900, None), (901, ""), (902, "!!"), (903, "x" * 50_000), (904, good[0][1]), (904, good[0][1])]
    df = spark.createDataFrame([*good, *bad, *odd], "doc_id long, text string")
    got = quality.scored(df).collect()
    keep = {x.doc_id: x.keep for x in got}
    assert len(got) == len(good) + len(bad) + len(odd)
    assert sum(keep[k] for k, _ in good) >= 147 and sum(keep[k] for k, _ in bad) <= 2
    assert not keep[900] and not keep[901] and all(0 <= x.score <= 1 for x in got)
    assert quality.scored(df.limit(0)).count() == 0


def test_label_model_brute_force():
    """Posteriors by Bayes' rule, written out, and a step of estimation by hand."""
    table = np.array([[[0.7, 0.3], [0.01, 0.99]], [[0.4, 0.6], [0.002, 0.998]]])
    model = quality.LabelModel(np.array([0.2, 0.8]), table)
    patterns = np.array([[a, b] for a in range(3) for b in range(3)])
    got = model.posteriors(patterns)
    for (a, b), p in zip(patterns.tolist(), got, strict=True):
        w = [model.prior[c] * (table[0, c, a] if a < 2 else 1) * (table[1, c, b] if b < 2 else 1) for c in range(2)]
        assert np.allclose(p, np.array(w) / sum(w))


def test_label_model_recovers_classes():
    r = np.random.default_rng(7)
    truth = (r.random(20_000) < 0.85).astype(int)
    finds = np.array([0.6, 0.5, 0.7, 0.4, 0.5])  # how often each labeller knows a bad text
    bad = r.random((20_000, 5)) < np.where(truth[:, None] == 0, finds, 0.003)
    votes = np.where(bad, quality.BAD, quality.GOOD)
    votes[r.random((20_000, 5)) < 0.1] = quality.ABSTAIN
    patterns, n = np.unique(votes, axis=0, return_counts=True)
    model = quality.LabelModel.fitted(patterns, n.astype(float))
    p = model.posteriors(votes)[:, quality.GOOD]
    assert ((p > 0.5) == truth).mean() > 0.97
    assert (model.table[:, quality.BAD, quality.BAD] > 0.2).all() and (model.table[:, quality.GOOD, quality.BAD] < 0.02).all()


def test_pseudo_likelihood(spark, empty):
    r = random.Random(9)
    rows = [(k, " ".join(r.choice(["red apple pie", "blue sky day"]) for _ in range(40))) for k in range(200)] + [(900, "pie sky red day apple blue " * 20), (901, None), (902, ""), (903, "unseen"), (904, None)]
    got = {x.doc_id: x for x in pseudo_likelihood.scored(spark.createDataFrame(rows, "doc_id long, text string"), size=50).collect()}
    usual = [got[k].mean_pll for k in range(200)]
    assert got[900].mean_pll < min(usual) and got[901].n_tokens == 0 and got[901].pll == 0 and got[901].mean_pll is None
    assert all(x.pll <= 0 for x in got.values())
    assert pseudo_likelihood.scored(empty.select("doc_id", "text")).count() == 0


@pytest.mark.parametrize("near", [0, 120, 1000])
def test_rare_words_by_their_counts(spark, near):
    """Words beyond the network's own: the shares of a leaf's words sum to one, and texts of more frequent ones score higher."""
    rare = [f"r{k}" for k in range(300)]
    rows = [(k, "common words " * 50) for k in range(20)] + [(100 + k, w) for k, w in enumerate(rare) for _ in range(1 + k % 7)] + [(900, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    network, ids_of, shares = pseudo_likelihood.vocabulary(docs.select("text"), 2, near)
    assert len(ids_of.near) <= near and (len(ids_of.near) == 300) == (near == 1000)
    got = {r.word: math.exp(r.share / pseudo_likelihood.FINE) for r in shares.collect()} | {w: math.exp(s / pseudo_likelihood.FINE) for w, s in zip(ids_of.near, ids_of.shares.tolist(), strict=True)}
    leaf = {w: zlib.crc32(w.encode()) % pseudo_likelihood.RARE for w in rare}
    mass = [sum(1 + k % 7 for k, w in enumerate(rare) if leaf[w] == b) for b in range(pseudo_likelihood.RARE)]
    assert network.vocabulary == ["common", "words"] and network.counts.tolist() == [1000, 1000] + [max(1, m) for m in mass]
    assert set(got) == set(rare) and all(math.isclose(got[w], (1 + k % 7) / mass[leaf[w]], rel_tol=1e-6) for k, w in enumerate(rare))
    scores = {}
    for r in pseudo_likelihood.scored(docs, size=2, near=near).collect():
        assert scores.setdefault(r.doc_id, r.pll) == r.pll  # repeated rows, equal texts
    for b in range(pseudo_likelihood.RARE):
        same = sorted((k % 7, scores[100 + k]) for k, w in enumerate(rare) if leaf[w] == b)
        assert all(x[1] < y[1] for x, y in zip(same, same[1:]) if x[0] < y[0])


def test_every_token_is_a_target_once(monkeypatch):
    """Texts of 1 to 40 words, none twice in the corpus: what the rounds learn is the corpus, short texts too."""
    texts = [[f"w{n}x{k}" for k in range(n)] for n in range(1, 41)]
    words = sorted(w for t in texts for w in t)
    network = pseudo_likelihood.WindowNetwork(words, np.ones(len(words) + pseudo_likelihood.RARE, np.int64))
    seen = []
    monkeypatch.setattr(network, "learn", lambda window, token, past, rate: seen.extend(token.tolist()))
    monkeypatch.setattr(pseudo_likelihood.TaskContext, "get", lambda: type("", (), {"partitionId": lambda self: 0})())
    found, upto = pseudo_likelihood.words_of(pa.array([" ".join(t) for t in texts] + [None, "", " \n "]))
    assert found.to_pylist() == [w for t in texts for w in t]
    ids, _, held = pseudo_likelihood.Ids(words, [], np.zeros(0, np.int64)).of(found)
    assert held.all()
    batch = pa.record_batch([pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(ids))], names=["ids"])
    weights = []
    for turn in range(2):
        weights += [b.column("targets")[0].as_py() for b in pseudo_likelihood.task_training(network, network.flat(), turn, 2)(iter([batch]))][:1]
    assert sorted(seen) == list(range(len(words))) and sum(weights) == len(words)


def test_probabilities_sum_to_one():
    net = pseudo_likelihood.WindowNetwork(["a", "b", "c"], np.array([9, 5, 2] + [1] * pseudo_likelihood.RARE))
    r = np.random.default_rng(0)
    for p in net.parameters[3:]:
        p += r.standard_normal(p.shape).astype(np.float32)
    every = np.arange(3 + pseudo_likelihood.RARE, dtype=np.int32)
    window = np.tile(np.array([[0, 1, 2, net.edge]], np.int32), (len(every), 1))
    assert len(net.bounds) > 3 and math.isclose(np.exp(net.log_likelihood(window, every).astype(float)).sum(), 1, rel_tol=1e-4)


def test_network_brute_force():
    """Log-probabilities and the gradient of a step, against plain loops and differences; a token's result doesn't depend on its batch."""
    r = np.random.default_rng(1)
    net = pseudo_likelihood.WindowNetwork([f"w{k}" for k in range(60)], r.integers(1, 50, 60 + pseudo_likelihood.RARE))
    net.parameters = [p + 0.3 * r.standard_normal(p.shape).astype(np.float32) for p in net.parameters]
    token, window = r.integers(0, net.edge, 700).astype(np.int32), r.integers(0, net.edge + 1, (700, 4)).astype(np.int32)

    def plain(parameters, t, w):
        embedding, scale, bias, upper, lower = (p.astype(float) for p in parameters)
        h = np.append(np.maximum(sum(embedding[x] * s for x, s in zip(w, scale, strict=True)) + bias[0], 0), 1)
        k, c = net.place[t], net.of[t]
        lo, hi = net.bounds[c], net.bounds[c + 1]
        soft = lambda z, j: z[j] - np.log(np.exp(z).sum())
        return soft(upper @ h, c) + soft(lower[lo:hi] @ h, k - lo)

    got = net.log_likelihood(window, token)
    assert np.allclose(got, [plain(net.parameters, t, w) for t, w in zip(token, window, strict=True)], atol=1e-4)
    part = r.permutation(700)[:90]
    assert (net.log_likelihood(window[part], token[part]) == got[part]).all()
    some = slice(0, 40)
    before = [p.copy() for p in net.parameters]
    net.learn(window[some], token[some], [np.zeros_like(p) for p in before], 1e-3)  # with nothing past, a step is the gradient's sign
    for k, p in enumerate(before):
        for place in r.permutation(p.size)[:40]:
            loss = []
            for move in (1e-4, -1e-4):
                moved = [q.astype(float) for q in before]
                moved[k].flat[place] += move
                loss.append(-sum(plain(moved, t, w) for t, w in zip(token[some], window[some], strict=True)))
            slope = (loss[0] - loss[1]) / 2e-4
            if abs(slope) > 1e-2:
                assert np.sign(before[k].flat[place] - net.parameters[k].flat[place]) == np.sign(slope)


def test_audio_is_stored_as_tensors(spark, docs):
    """Media and windows lie in the shared folder, and the digests are those of what is read back."""
    files = {r.doc_id: bytes(r.media) for r in audio.media(docs).collect()}
    got = {r.doc_id: r for r in audio.described(audio.media(docs)).collect()}
    folder = scratch(spark, "audio")
    named = audio.stored(audio.media(docs), folder).collect()
    rows = [r for n in named for r in pa.ipc.open_file(f"{folder.removeprefix('file://')}/{n.file}").read_all().to_batches()]
    assert sum(n.n_rows for n in named) == sum(b.num_rows for b in rows) == len(got) == len(files)
    for b in rows:
        assert b["features"].type.value_type == audio.TENSOR
        digests = audio.summary(b).to_pylist()
        for k, d in enumerate(b["doc_id"].to_pylist()):
            tensors, spans, active = audio.features(files[d])
            assert b["media"][k].as_py() == files[d] and digests[k] == got[d].asDict()
            part = b["features"].offsets.to_numpy()[k : k + 2]
            assert np.array_equal(b["features"].values.to_numpy_ndarray()[part[0] : part[1]], tensors.astype(np.float16))
            assert [(x["start"], x["end"]) for x in b["spans"][k].as_py()] == spans and [(x["start"], x["end"]) for x in b["active"][k].as_py()] == active


@pytest.mark.parametrize(
    "run",
    [
        lambda d: simhash.near_duplicates(d),
        lambda d: simhash.keep_one(d),
        lambda d: suffix_dedup.deduplicated(d),
        lambda d: suffix_dedup.without_repeats(d),
        lambda d: bpe_automaton.encoded(d, public_tokenizers.path("word_bpe_49k.json")),
        lambda d: wavelet.round_trip(d, public_tokenizers.path("byte_bpe_50k.json")),
        lambda d: audio.described(audio.media(d)),
    ],
)
def test_empty_tables(empty, run):
    assert run(empty).count() == 0


def test_scratch_is_in_the_shared_folder(spark):
    assert scratch(spark, "x").startswith(spark.sparkContext.getConf().get("spark.checkpoint.dir"))
