"""All queries over lifted driver tables, each with its SQL; importing a module registers its queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vistaloom.plans import curate_queries, extra_queries, file_queries, frame_queries, misc_queries, skill_queries, vision_queries, vote_queries  # noqa: F401
from vistaloom.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "flagship"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["select_pairs"](spark, sf_dir)
