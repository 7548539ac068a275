"""Writers of stages' artifacts. Spark's committers make them whole or absent, also when an executor is lost."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from vistaloom.operators import curate


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> int:
    """JSON lines; how many were written, counted in the same pass."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append" if append else "overwrite").json(path)
    return seen.get["n"]


def write_scored_pairs(pairs: DataFrame, path: str, append: bool = False) -> int:
    """Scored pairs with their tasks in sorted order."""
    return write_jsonl(pairs.withColumn("tasks", F.array_sort("tasks")), path, append)


def write_frames(frames: DataFrame, path: str) -> int:
    """Frame references in order as one JSON array; how many.

    One task streams them to a file of its own and moves it into place. A path without `.json` becomes a folder of JSON lines,
    written by all tasks; scans.load reads both.
    """
    rows = frames.select("adapter", "scene_id", "frame_id", "image_path")
    if not path.endswith(".json"):
        return write_jsonl(rows.sortWithinPartitions("adapter", "scene_id", "frame_id"), path)
    line = F.to_json(F.struct("*"))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = pafs.FileSystem.from_uri(path if "://" in path else f"file://{os.path.abspath(path)}")
        own, n = f"{at}.{uuid.uuid4().hex}.part", 0
        with fs.open_output_stream(own) as out:
            out.write(b"[")
            for b in batches:
                for text in b.column(0).to_pylist():
                    out.write((b",\n  " if n else b"\n  ") + text.encode())
                    n += 1
            out.write(b"\n]\n")
        fs.move(own, at)
        yield pa.record_batch([pa.array([n], pa.int64())], names=["n"])

    ordered = rows.repartition(1).sortWithinPartitions("adapter", "scene_id", "frame_id")
    done = ordered.select(line.alias("line")).mapInArrow(put, "n long").collect()
    if not done:  # no rows, and so no task
        next(put(iter(())))
    return sum(r["n"] for r in done)


REFUSED = ("scene_id", "frame_src", "frame_tgt", "pair_id", "match_idx", "src_mask_id", "reason")


def write_correspondences(records: DataFrame, path: str, resume: bool = False) -> dict[str, int]:
    """Emitted records (null reason) and, beside them, the ledger of rejections; the counts by reason.

    The rows are worked out once and held for the two writes; what is lost meanwhile is worked out again.
    """
    mode = "append" if resume else "overwrite"
    held = records.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        held.where("reason is null").drop("reason").write.mode(mode).json(f"{path}/records")
        held.where("reason is not null").select(*[c for c in REFUSED if c in held.columns]).write.mode(mode).json(f"{path}/rejected")
        counts = held.groupBy(F.coalesce("reason", F.lit("emitted")).alias("reason")).count().collect()  # as many rows as reasons
    finally:
        held.unpersist()
    return {r["reason"]: r["count"] for r in counts}


def write_manifests(manifests: DataFrame, root: str, skills: tuple[str, ...]) -> None:
    """<root>/<skill>/pairs.jsonl for each registered skill with rows, as scans.manifest_tree reads them; rows of other skills are left out.

    evidence is JSON already and goes in as it is. The rows are worked out once and held for the skills' writes.
    """
    head = F.to_json(F.struct(*[c for c in manifests.columns if c != "evidence"]))
    line = F.concat(F.substring(head, 1, F.length(head) - 1), F.lit(', "evidence": '), F.coalesce("evidence", F.lit("{}")), F.lit("}"))
    held = manifests.where(F.col("skill").isin(*skills)).select("skill", line.alias("value")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for r in held.select("skill").distinct().collect():  # registered names
            held.where(F.col("skill") == r["skill"]).select("value").write.mode("overwrite").text(f"{root}/{r['skill']}/pairs.jsonl")
    finally:
        held.unpersist()


def write_verified(manifests: DataFrame, verdicts: DataFrame, keys: list[str], root: str) -> None:
    """Verified manifests by skill. Only folders of skills with survivors are replaced."""
    kept = curate.verified(manifests, verdicts, keys)
    kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("skill").parquet(root)


def write_balanced(rows: DataFrame, decided: DataFrame, root: str) -> None:
    """Kept rows and, beside them, the refused ones with their reasons."""
    both = rows.join(decided, ["skill", "id"])
    both.where("reason is null").drop("reason").write.mode("overwrite").partitionBy("skill").json(f"{root}/balanced")
    both.where("reason is not null").select("skill", "id", "scene_id", "reason").write.mode("overwrite").partitionBy("skill").json(f"{root}/rejected")


def write_report(report: DataFrame, path: str) -> None:
    report.coalesce(1).write.mode("overwrite").json(path)  # a row per scene and label


def write_trace(stages: dict[str, DataFrame], path: str) -> None:
    """One line per stage and row, each row as JSON."""
    out = None
    for name, df in stages.items():
        part = df.select(F.lit(name).alias("stage"), F.to_json(F.struct("*")).alias("payload"))
        out = part if out is None else out.unionByName(part)
    if out is not None:
        out.write.mode("overwrite").json(path)
