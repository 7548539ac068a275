"""Cleaning of a corpus in stages; each is written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistaloom.llm import bpe_automaton, decontaminate, language_id, simhash, suffix_dedup
from vistaloom.llm.common import passing, scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Share of a document's n-grams that its language must contain. Clean prose has four fifths and more, odd lines two fifths.
LEAST_SCORE = 0.05


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told: not without letters, and not of n-grams foreign to every learned language.

    Null, empty and letterless texts are rejected. Rows repeat as they come, ids may be null or repeat, and other columns stay
    whatever their names. Of no documents, or where none has a language to learn from, nothing is kept.
    """
    model = language_id.learned(docs.where(~language_id.held_out()))
    found = language_id.predicted(docs, model, tuple(docs.columns))
    kept = found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE))
    return kept.select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the smallest doc_id, then the smallest hash of the text.

    Rows alike in id and text are one; texts that aren't linked stay, also under one id; rows with a null id stay. A null text
    is one without words, as are empty ones, and those are linked. Other columns stay; of rows alike, one row's values do.
    """
    return simhash.keep_one(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes that repeat earlier ones; n_chars follows the text.

    Null texts stay null, short ones stay whole, and a text may become empty. Ties of one id are ordered by a hash of the text;
    null ids come first. Other columns stay.
    """
    return suffix_dedup.without_repeats(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Rows with a null id, null and short texts stay; rows that share an id go together."""
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's ids and their decoded text: doc_id, n_tokens, ids, decoded. Null and empty texts have no ids; rows repeat."""
    return bpe_automaton.encoded(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeats),
    ("benchmark_decontamination", leaks),
    ("bpe_encoding", encoding),
]
#: Most stages can't be told in SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES applied to documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        passing(spark, path)
        docs = spark.read.parquet(path)
    return docs
