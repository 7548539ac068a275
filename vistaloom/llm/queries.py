"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistaloom.llm import audio, bpe_automaton, chat, decontaminate, language_id, pseudo_likelihood, quality, simhash, suffix_dedup, wavelet


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.deduplicated(table(spark, sf_dir, "documents"))
    return found.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "start", "n_words", F.round("similarity", 6).alias("similarity"), "hamming")


def op5_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood.scored(table(spark, sf_dir, "documents"))


def op6_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audio.described(audio.media(table(spark, sf_dir, "documents")))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chat.rotated(table(spark, sf_dir, "conversations"))
    spans = F.array_join(F.transform("mask", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select("conv_id", "perspective", "part", "n_turns", "text", spans.alias("mask"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identified(table(spark, sf_dir, "documents"))


def op9_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe_automaton.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_wavelet": op1_wavelet,
    "op2_simhash": op2_simhash,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_decontamination": op4_decontamination,
    "op5_pseudo_likelihood": op5_pseudo_likelihood,
    "op6_audio": op6_audio,
    "op7_chat": op7_chat,
    "op8_language_id": op8_language_id,
    "op9_bpe_automaton": op9_bpe_automaton,
    "op10_quality": op10_quality,
}
OP4_SQL = r"""
with item_words as (
  select item_id, list_filter(string_split_regex(lower(text), '\s+'), lambda w: w <> '') w
  from (select distinct item_id, text from benchmark where item_id is not null)
), items as (
  select item_id, w, len(w) n_words, len(w) - 4 m from item_words where len(w) >= 5
), docs as (
  select doc_id, list_filter(string_split_regex(lower(text), '\s+'), lambda w: w <> '') w from documents where doc_id is not null and text is not null
), item_shingles as (
  select item_id, n_words, m, q, array_to_string(w[q + 1:q + 5], ' ') s from items, range(m) t(q)
), doc_shingles as (
  select doc_id, p, array_to_string(w[p + 1:p + 5], ' ') s from docs, range(len(w) - 4) t(p) where len(w) >= 5
), hits as (
  select distinct d.doc_id, i.item_id, n_words, m, p, len(w) size from doc_shingles d join item_shingles i using (s) join docs using (doc_id)
), starts as (
  select distinct doc_id, n_words, start from (
    select doc_id, item_id, n_words, start from hits, range(greatest(0, p - m + 1), least(p, greatest(0, size - n_words)) + 1) t(start)
    group by doc_id, item_id, n_words, m, size, start having count(*) >= ceil((m + least(m, size - 4)) * (0.8 / 1.8) - 1e-9)
  )
), windows as (
  select s.doc_id, n_words, start, k, array_to_string(w[start + k + 1:start + k + 5], ' ') s
  from starts s join docs using (doc_id), range(least(n_words, len(w)) - 4) t(k)
), bits as (
  select doc_id, n_words, start, b, count(*) n, count(*) filter ((('0x' || substr(md5(s), 1, 16))::ubigint >> b) & 1 = 1) ones from windows, range(64) t(b) group by all
), prints as (
  select doc_id, n_words, start, sum(case when 2 * ones > n then 1::hugeint << b else 0 end)::ubigint fp from bits group by all
), item_bits as (
  select item_id, n_words, b, count(*) n, count(*) filter ((('0x' || substr(md5(s), 1, 16))::ubigint >> b) & 1 = 1) ones from item_shingles, range(64) t(b) group by all
), item_prints as (
  select item_id, n_words, sum(case when 2 * ones > n then 1::hugeint << b else 0 end)::ubigint fp from item_bits group by all
), near as (
  select doc_id, start, item_id, p.n_words, bit_count(xor(p.fp, i.fp)) hamming from prints p join item_prints i using (n_words) where bit_count(xor(p.fp, i.fp)) <= 20
), window_counts as (select doc_id, n_words, start, s, count(*) c from windows group by all
), item_counts as (select item_id, s, count(*) c from item_shingles group by all
), shared as (
  select n.doc_id, n.start, n.item_id, sum(least(w.c, i.c)) both_n from near n
  join window_counts w using (doc_id, n_words, start) join item_counts i on i.item_id = n.item_id and i.s = w.s group by all
), scored as (
  select n.*, both_n / ((select sum(c) from window_counts w where (w.doc_id, w.n_words, w.start) = (n.doc_id, n.n_words, n.start)) + n.n_words - 4 - both_n) sim
  from near n join shared using (doc_id, start, item_id)
)
select doc_id, item_id, start::int "start", n_words::int n_words, round(sim, 6)::double similarity, hamming::int hamming
from scored where sim >= 0.8 qualify row_number() over (partition by doc_id, item_id order by sim desc, start, hamming, n_words desc) = 1
"""

OP7_SQL = """
with rows as (
  select conv_id, coalesce(floor(turn / 64), -1)::bigint part, turn, coalesce(role, 'unknown') "role", replace(coalesce(text, ''), '<|', '< |') said
  from conversations where conv_id is not null
), speakers as (select distinct conv_id, "role" perspective from rows where "role" <> 'system'
), pieces as (
  select conv_id, perspective, part, turn, "role", said, "role" = perspective own,
    case when "role" = perspective then '<|im_start|>assistant' when "role" = 'system' then '<|im_start|>system' else '<|im_start|>user name=' || replace("role", '<|', '< |') end || chr(10) head
  from rows join speakers using (conv_id)
), placed as (
  select *, row_number() over w n, length(head) + length(said) + 11 size,
    sum(length(head) + length(said) + 11) over (w rows between unbounded preceding and current row) upto
  from pieces window w as (partition by conv_id, perspective, part order by turn nulls first, "role", said)
)
select conv_id, perspective, part, count(*) n_turns, string_agg(head || said || '<|im_end|>' || chr(10), '' order by n) "text",
  coalesce(string_agg((upto - size + length(head))::bigint || '-' || (upto - 1)::bigint, ',' order by n) filter (own), '') mask
from placed group by conv_id, perspective, part
"""

ORACLE_SQL: dict[str, str] = {"op4_decontamination": OP4_SQL, "op7_chat": OP7_SQL}
