"""Ordered greedy scans per group: each row is kept or not in view of the rows kept before it.

The native form folds a group's sorted rows in one expression; it stays in the JVM and needs the group in one row. The
Arrow form runs the same rule in Python per group and suits large groups, whose kept rows it holds in arrays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def greedy(df: DataFrame, by: list[str], order: list[str], fields: list[str], keep: Callable[[Column, Column], Column]) -> DataFrame:
    """Rows that a greedy scan keeps; keep(kept, row) sees the array of kept rows and the next row as structs.

    order must be total within a group. The result has by and fields.
    """
    rows = F.array_sort(F.collect_list(F.struct(*order, *[f for f in fields if f not in order])))
    grouped = df.groupBy(*by).agg(rows.alias("__rows"))
    kept = F.aggregate("__rows", F.slice("__rows", 1, 0), lambda acc, x: F.when(keep(acc, x), F.array_append(acc, x)).otherwise(acc))
    return grouped.select(*by, F.explode(kept).alias("__r")).select(*by, *[F.col(f"__r.{f}").alias(f) for f in fields])


def from_last(df: DataFrame, by: list[str], order: list[str], fields: list[str], keep: Callable[[Column, Column], Column]) -> DataFrame:
    """greedy() with a rule that compares to the last kept row only; a group's first row is kept."""
    return greedy(df, by, order, fields, lambda acc, x: (F.size(acc) == 0) | keep(F.element_at(acc, -1), x))


def first_fit(df: DataFrame, by: list[str], order: list[str], fields: list[str], joins: Callable[[Column, Column], Column], name: str = "cluster") -> DataFrame:
    """Rows with the number of the first cluster that they join; joins(founder, row) looks at a cluster's first row.

    order must be total within a group. A row that joins none founds one.
    """
    rows = F.array_sort(F.collect_list(F.struct(*order, *[f for f in fields if f not in order])))
    grouped = df.groupBy(*by).agg(rows.alias("__rows"))

    def step(acc: Column, x: Column) -> Column:
        at = F.array_position(F.transform(acc["founders"], lambda c: joins(c, x)), F.lit(True)).cast("int")
        new = at == 0
        return F.struct(
            F.when(new, F.array_append(acc["founders"], x)).otherwise(acc["founders"]).alias("founders"),
            F.array_append(acc["at"], F.when(new, F.size(acc["founders"]) + 1).otherwise(at)).alias("at"),
        )

    start = F.struct(F.slice("__rows", 1, 0).alias("founders"), F.array().cast("array<int>").alias("at"))
    numbered = grouped.withColumn("__at", F.aggregate("__rows", start, step, lambda acc: acc["at"]))
    flat = numbered.select(*by, F.explode(F.arrays_zip("__rows", "__at")).alias("__z"))
    return flat.select(*by, *[F.col(f"__z.__rows.{f}").alias(f) for f in fields], F.col("__z.__at").alias(name))


def claims(df: DataFrame, by: list[str], order: list[str], row: str, options: str) -> DataFrame:
    """(by, row, claimed): each row in order takes the first of its options (an array, best first) that none before it took."""
    rows = F.array_sort(F.collect_list(F.struct(*order, *[c for c in (row, options) if c not in order])))
    grouped = df.groupBy(*by).agg(rows.alias("__rows"))

    def step(acc: Column, x: Column) -> Column:
        pick = F.get(F.array_except(x[options], acc["claimed"]), F.lit(0))  # keeps the options' order
        return F.struct(F.when(pick.isNotNull(), F.array_append(acc["claimed"], pick)).otherwise(acc["claimed"]).alias("claimed"), F.array_append(acc["picks"], pick).alias("picks"))

    none = F.slice(F.flatten(F.transform("__rows", lambda x: x[options])), 1, 0)
    picked = grouped.withColumn("__p", F.aggregate("__rows", F.struct(none.alias("claimed"), F.slice(F.array(F.get(none, F.lit(0))), 1, 0).alias("picks")), step, lambda acc: acc["picks"]))
    flat = picked.select(*by, F.explode(F.arrays_zip("__rows", "__p")).alias("__z"))
    return flat.select(*by, F.col(f"__z.__rows.{row}").alias(row), F.col("__z.__p").alias("claimed")).where("claimed is not null")
