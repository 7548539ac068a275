"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact weighted-shingle similarity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vistaloom.llm.common import saved

SHINGLE = 5
#: Shingles of a benchmark up to which its side of the first join is broadcast; beyond, Spark joins by shuffle.
BROADCAST_SHINGLES = 200_000
#: Numbers in the table of windows up to which it is broadcast to the second read of the texts; beyond, Spark joins by shuffle.
BROADCAST_NUMBERS = 1_000_000


def words_of(text: Column) -> Column:
    """Words of a text in small letters; an empty array for null or empty texts."""
    return F.filter(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"\s+"), lambda w: w != "")


def shingle_hashes(words: Column) -> Column:
    """A hash of each five words in a row."""
    at = lambda i, k: F.get(words, i + k)
    return F.transform(F.slice(words, 1, F.greatest(F.size(words) - (SHINGLE - 1), F.lit(0))), lambda w, i: F.xxhash64(w, at(i, 1), at(i, 2), at(i, 3), at(i, 4)))


def shingle_texts(words: Column) -> Column:
    return F.transform(F.slice(words, 1, F.greatest(F.size(words) - (SHINGLE - 1), F.lit(0))), lambda w, i: F.array_join(F.slice(words, i + 1, SHINGLE), " "))


def with_fingerprint(rows: DataFrame, name: str) -> DataFrame:
    """The distinct rows (with an array of shingles, one at least) with the 64-bit SimHash of their shingles, each counted as often as it occurs: a bit is 1 if set in over half.

    The bits of a shingle are the first 64 of its MD5. Bits are counted as sums over the shingles' rows, so that they are
    compiled and partly added up before one row per fingerprint is shuffled.
    """
    keys = rows.columns
    each = rows.select("*", F.explode_outer("shingles").alias("__s")).withColumn("__m", F.md5("__s"))
    half = {n: F.conv(F.substring("__m", at, 8), 16, 10).cast("long") for n, at in (("__hi", 1), ("__lo", 9))}
    sums = [F.sum(F.call_function("shiftright", n, F.lit(b)).bitwiseAND(F.lit(1))).alias(f"{n}{b}") for n in half for b in range(32)]
    counted = each.withColumns(half).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *sums)
    word = lambda n: sum((F.when(F.col(f"{n}{b}") * 2 > F.col("__n"), F.lit(1 << b).cast("long")).otherwise(F.lit(0).cast("long")) for b in range(32)), F.lit(0).cast("long"))
    return counted.select(*keys, F.call_function("shiftleft", word("__hi"), F.lit(32)).bitwiseOR(word("__lo")).alias(name))


def hamming_blocks(fingerprint: Column, radius: int) -> Column:
    """radius + 1 runs of bits, each with its number: fingerprints within radius agree on one at least."""
    cuts = [64 * k // (radius + 1) for k in range(radius + 2)]
    return F.array(*[F.struct(F.lit(k).alias("run"), F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("bits")) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))])


def similarity(a: Column, b: Column) -> Column:
    """Weighted Jaccard of two shingle arrays: a shingle weighs as often as it occurs."""
    times = lambda s, x: F.size(F.filter(s, lambda y: y == x))
    both = F.aggregate(F.array_distinct(a), F.lit(0), lambda n, x: n + F.least(times(a, x), times(b, x)))
    return both / (F.size(a) + F.size(b) - both)


def window_starts(places: Column, enough: Column, shingles: Column, last: Column) -> Column:
    """Where windows of so many shingles begin that hold enough of the given places, in order; no window begins after last."""
    many = F.size(places) - enough + 1

    def run(i: Column) -> Column:
        low, high = F.greatest(F.lit(0), F.get(places, i + enough - 1) - shingles + 1), F.least(F.get(places, i), last)
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    return F.when(many > 0, F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0), F.greatest(many, F.lit(1)) - 1), run))))


def contaminated(docs: DataFrame, benchmark: DataFrame, radius: int = 20, least: float = 0.8) -> DataFrame:
    """(doc_id, item_id, start, n_words, similarity, hamming): documents with a window that holds a benchmark item.

    A window has as many words as the item; of a text with fewer words, the whole text is one. Of the windows whose SimHash is
    within radius of the item's and whose weighted shingle similarity is `least` or more, the most similar one is given, the
    first among equals. A similarity of `least` takes some number of shingles in common: only windows with that many
    shingles of some item of their size are fingerprinted, which loses none, and blocks pair them with all items of the size.
    Null and short texts, and items of under five words, match nothing; rows with a null id are left out; rows that share an
    id count as one document with each of their texts. Repeated items with one id count as one. Empty tables give no rows.
    """
    items = benchmark.where("item_id is not null").select("item_id", words_of(F.col("text")).alias("item_words")).where(F.size("item_words") >= SHINGLE).distinct()
    items = items.select("item_id", F.size("item_words").alias("n_words"), shingle_hashes(F.col("item_words")).alias("hashes"), shingle_texts(F.col("item_words")).alias("item_shingles"))
    keys = items.select("item_id", "n_words", F.explode("hashes").alias("key")).distinct()
    few = keys.limit(BROADCAST_SHINGLES + 1).count() <= BROADCAST_SHINGLES
    read = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), words_of(F.col("text")).alias("words"))
    placed = read.select("doc_id", F.size("words").alias("size"), F.posexplode_outer(shingle_hashes(F.col("words"))).alias("p", "key"))  # outer: no filter works the hashes out twice
    hits = placed.join(F.broadcast(keys) if few else keys, "key")
    m = F.col("n_words") - (SHINGLE - 1)
    # weighted Jaccard of `least` between a and b shingles needs (a + b) * least / (1 + least) in common
    enough = F.ceil((m + F.least(m, F.col("shortest") - (SHINGLE - 1))) * F.lit(least / (1 + least)) - 1e-9).cast("int")
    found = (
        hits.groupBy("doc_id", "item_id", "n_words")
        .agg(F.sort_array(F.collect_set("p")).alias("places"), F.min("size").alias("shortest"), F.max("size").alias("longest"))
        .select("doc_id", "n_words", window_starts(F.col("places"), enough, m, F.greatest(F.lit(0), F.col("longest") - F.col("n_words"))).alias("starts"))
        .where(F.size("starts") > 0)
        .groupBy("doc_id", "n_words")
        .agg(F.array_distinct(F.flatten(F.collect_list("starts"))).alias("starts"))
        .withColumnRenamed("doc_id", "in_doc")
    )
    windows = saved(found, "decontamination-windows")
    room = windows.agg(F.sum(F.size("starts") + 8)).first()[0] or 0
    cut = (
        read.join(F.broadcast(windows) if room <= BROADCAST_NUMBERS else windows, F.col("doc_id") == F.col("in_doc"))
        .select("doc_id", "n_words", "words", F.explode("starts").alias("start"))
        .where(F.col("start") <= F.greatest(F.lit(0), F.size("words") - F.col("n_words")))
        .select("doc_id", "n_words", "start", shingle_texts(F.slice("words", F.col("start") + 1, F.col("n_words"))).alias("shingles"))
    )
    cut = with_fingerprint(cut, "fingerprint")
    marked = with_fingerprint(items.select("item_id", F.col("n_words").alias("item_n"), F.col("item_shingles").alias("shingles")), "item_fingerprint").withColumnRenamed("shingles", "item_shingles")
    blocks = {n: hamming_blocks(F.col(n), radius) for n in ("fingerprint", "item_fingerprint")}
    left = cut.withColumn("block", F.explode(blocks["fingerprint"]))
    right = marked.withColumn("item_block", F.explode(blocks["item_fingerprint"]))
    distance = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_fingerprint")))
    first = F.array_min(F.array_intersect(*blocks.values()))  # of the blocks that agree, one gives the pair
    near = left.join(F.broadcast(right) if few else right, (F.col("n_words") == F.col("item_n")) & (F.col("block") == F.col("item_block"))).withColumn("hamming", distance).where((F.col("hamming") <= radius) & (F.col("block") == first))
    # Written, so that the similarity is worked out for pairs within the radius and no others.
    near = saved(near.select("doc_id", "item_id", "n_words", "start", "hamming", "shingles", "item_shingles"), "decontamination-near")
    exact = near.withColumn("similarity", similarity(F.col("item_shingles"), F.col("shingles"))).where(F.col("similarity") >= least)
    best = exact.groupBy("doc_id", "item_id").agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"), (-F.col("hamming")).alias("near"), "n_words")).alias("best"))
    return best.select("doc_id", "item_id", (-F.col("best.back")).alias("start"), F.col("best.n_words").alias("n_words"), F.col("best.similarity").alias("similarity"), (-F.col("best.near")).alias("hamming"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, radius: int = 20, least: float = 0.8) -> DataFrame:
    """docs without those that hold a benchmark item; rows with a null id stay."""
    found = contaminated(docs, benchmark, radius, least).select(F.col("doc_id").alias("leaked_id")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"))  # docs may have columns of any names
    return rows.join(found, F.col("id") == F.col("leaked_id"), "left_anti").select("row.*")
