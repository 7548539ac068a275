"""What the operators share: scratch tables, Arrow access to texts, connected components."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from spark.checkpoint.dir; a temporary one only where that is unset and there is one machine."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="vistaloom-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def passing(spark: SparkSession, path: str) -> None:
    """A written folder goes when the driver ends; results are lazy and may read it until then."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)


def saved(df: DataFrame, name: str) -> DataFrame:
    """df as a written table of the shared folder: later plans start from files that outlive executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    passing(spark, path)
    del df
    release(spark)
    return spark.read.schema(schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner drop the shuffle files of plans that are no longer referenced."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of whole texts: few rows and few bytes, so that long texts don't add up.

    Plans are lazy and read the session's limits when they run, so these stay set; they are the same for all operators.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of a string column; nulls are empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, dtype="<i8" if large else "<i4")[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def document_bytes(column: pa.Array) -> Iterator[bytes]:
    """Each text as UTF-8 bytes; nulls are empty."""
    raw, at = utf8(column)
    view = memoryview(np.ascontiguousarray(raw)) if len(raw) else memoryview(b"")
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        yield bytes(view[a:b])


def table_of(batches: Iterable[pa.RecordBatch], names: list[str]) -> dict[str, np.ndarray] | None:
    """All rows of a partition as NumPy columns without nulls; None where there are no rows."""
    kept = [b for b in batches if b.num_rows]
    if not kept:
        return None
    table = pa.Table.from_batches(kept)
    return {n: table[n].to_numpy() for n in names}


def starts_of(*keys: np.ndarray) -> np.ndarray:
    """Where the groups of equal keys begin, in sorted columns."""
    n = len(keys[0])
    if not n:
        return np.zeros(0, np.int64)
    new = np.zeros(n, bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of overlapping or touching ranges of each document."""
    if not len(doc):
        return doc, start, end
    o = np.lexsort((start, doc))
    doc, start, end = doc[o], start[o].astype(np.int64), end[o].astype(np.int64)
    group = np.zeros(len(doc), np.int64)
    group[1:] = np.cumsum(doc[1:] != doc[:-1])
    span = int(max(end.max(), -start.min())) + 2
    reach = np.maximum.accumulate(end + group * 2 * span)  # a document's ends lie above those of the documents before it
    new = np.ones(len(doc), bool)
    new[1:] = (group[1:] != group[:-1]) | (start[1:] + group[1:] * 2 * span > reach[:-1])
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(doc)) - 1
    return doc[at], start[at], reach[last] - group[last] * 2 * span


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, component) of an undirected graph with edges (a, b): the smallest node that each node reaches.

    Alternates large and small stars, which move each node's neighbours to the smallest one; every round is a written
    table, minima are partial aggregates and the joins back are ordinary joins that AQE splits when a hub is hot.
    """

    def ends(e: DataFrame) -> DataFrame:
        return e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))

    def large(e: DataFrame) -> DataFrame:
        both = ends(e)
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        return both.join(least, F.col("u") == F.col("k")).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))

    def small(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = down.join(least.withColumnRenamed("u", "k"), F.col("u") == F.col("k")).where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        return least.select(F.col("u").alias("a"), F.col("m").alias("b")).unionByName(moved)

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    before, mark = None, state(now)
    while mark != before and mark[0]:
        now = saved(small(large(now).distinct()).where("a <> b").distinct(), name)
        before, mark = mark, state(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
