"""Queries by name with their SQL, and the lifts that read driver tables as scenes.

A lift is one SQL text that both engines run: it makes inputs (frames, detections, votes, ...) from the driver's tables.
What a query does with a lift is DataFrame code here and independent SQL in its oracle.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
LIFTS: dict[str, str] = {}
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def lift(name: str, sql: str) -> None:
    LIFTS[name] = sql.strip()


def needed(sql: str, found: list[str] | None = None) -> list[str]:
    """The lifts that a text names, those they name first."""
    found = [] if found is None else found
    for name in re.findall(r"\bl_\w+\b", sql):
        if name in LIFTS and name not in found:
            needed(LIFTS[name], found)
            if name not in found:
                found.append(name)
    return found


def with_lifts(sql: str, table: Callable[[str], str]) -> str:
    """sql with its lifts as common table expressions, and {name} as what table gives for it."""
    found = needed(sql)
    rest = re.sub(r"^\s*with\s+(recursive\s+)?", "", sql)
    has, recursive = rest != sql, re.match(r"\s*with\s+recursive\b", sql) is not None
    head = ", ".join(f"{n} as ({LIFTS[n]})" for n in found)
    text = sql if not found else f"with {'recursive ' * recursive}{head}{', ' if has else ' '}{rest if has else sql}"
    return re.sub(r"\{(\w+)\}", lambda m: table(m[1]) if m[1] in TABLES else m[0], text)


class Tables:
    """The driver's tables and lifts of one folder as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def lift(self, name: str) -> DataFrame:
        return self.spark.sql(with_lifts(f"select * from {name}", lambda t: f"parquet.`{self.sf_dir}/{t}.parquet`"))


def query(name: str, sql: str | None = None):
    """Registers a function of Tables as a query, with the SQL that it is held against."""

    def put(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLE_SQL[name] = with_lifts(sql.strip(), lambda t: t)
        return f

    return put
