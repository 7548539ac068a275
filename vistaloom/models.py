"""Where models come in: detectors, segmenters, labelers, filters and verifiers as functions of batches.

A model is made once per worker by a factory and called on rows in Arrow batches. None is part of this repository but the
rule-based ones for tests.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vistaloom.operators import vision, votes

Call = Callable[[dict[str, Any]], Any]
Factory = Callable[[], Call]

#: What a detector gives for a frame, and what a segmenter gives for a frame's detections.
DETECTIONS = "array<struct<det:int,label:string,canonical:string,score:double,x0:double,y0:double,x1:double,y1:double>>"
MASKS = "array<struct<mask:int,label:string,canonical:string,score:double,x0:double,y0:double,x1:double,y1:double,cu:double,cv:double,runs:array<struct<v:int,u0:int,u1:int>>>>"


@dataclass(frozen=True)
class ModelSpec:
    """What a model needs and is called; rows of a small table that queries may join."""

    name: str
    backend: str
    model_id: str = ""
    tp: int = 1
    gpu_memory_utilization: float = 0.9
    images_per_prompt: int = 1
    max_model_len: int = 8192
    concurrency: int = 8
    extras: dict[str, str] = field(default_factory=dict)


REGISTRY: dict[str, tuple[ModelSpec, Factory]] = {}


def register(spec: ModelSpec, factory: Factory) -> None:
    REGISTRY[spec.name] = (spec, factory)


def resolve(name: str) -> tuple[ModelSpec, Factory]:
    if name not in REGISTRY:
        raise KeyError(f"no model {name!r}; there are {sorted(REGISTRY)}")
    return REGISTRY[name]


def verifier(name: str) -> tuple[ModelSpec, Factory]:
    """A model that sees both images of a pair at once."""
    spec, factory = resolve(name)
    if spec.images_per_prompt < 2:
        raise ValueError(f"{name!r} takes one image per prompt; a verifier needs two")
    return spec, factory


def retried(call: Callable[[], Any], tries: int = 3) -> tuple[Any, str | None, int]:
    """(result, last error, tries used); None and an exception are failures."""
    error = None
    for k in range(1, tries + 1):
        try:
            result = call()
        except Exception as e:  # noqa: BLE001  a model's failure is a row's, not the job's
            error = f"{type(e).__name__}: {e}"
            continue
        if result is not None:
            return result, None, k
        error = "no result"
    return None, error, tries


def applied(rows: DataFrame, factory: Factory, result: str, tries: int = 3, concurrency: int = 1) -> DataFrame:
    """rows with result, error and attempts of a model's call on each; a failed row has a null result.

    A model with a method `many` gets a batch's rows as a list and gives their results in order; rows that it gives None for,
    and all rows if it raises, are tried one by one. Single calls go out `concurrency` at a time; rows stay in order.
    """
    names = rows.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()
        many = getattr(model, "many", None)
        with ThreadPoolExecutor(max(1, concurrency)) as pool:
            for b in batches:
                records = b.to_dict("records")
                at_once, _, _ = retried(lambda r=records: many(r), 1) if many and records else (None, None, 0)
                first = list(at_once) if at_once is not None and len(at_once) == len(records) else [None] * len(records)
                done = list(pool.map(lambda x: (x[1], None, 1) if x[1] is not None else retried(lambda: model(x[0]), tries), zip(records, first, strict=True)))
                yield b.assign(result=pd.Series([x for x, _, _ in done], index=b.index, dtype=object), error=[e for _, e, _ in done], attempts=[k for _, _, k in done])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInPandas(run, f"{fields}, result {result}, error string, attempts int").select(*names, "result", "error", "attempts")


def missing(rows: DataFrame, cache: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that a cache doesn't hold."""
    return rows.join(cache, keys, "left_anti")


def cached(rows: DataFrame, cache: DataFrame, keys: list[str], factory: Factory, result: str, valid: Column | None = None, backfill: Callable[[Column], Column] | None = None) -> DataFrame:
    """Cached results for rows that have one and new ones for the others; failed ones aren't kept, so they are tried again.

    valid tells a sound entry of the cache from a broken one, which is worked out anew; backfill is put on new results, for
    names that are only known afterwards.
    """
    sound = cache if valid is None else cache.where(F.coalesce(valid, F.lit(False)))
    new = applied(missing(rows, sound, keys), factory, result).where(F.col("error").isNull()).select(*keys, "result")
    if backfill is not None:
        new = new.withColumn("result", backfill(F.col("result")))
    return sound.join(rows.select(*keys), keys, "left_semi").select(*keys, "result").unionByName(new)


def filter_votes(runs: DataFrame, by: list[str], n_votes: int, threshold: int | None = None) -> DataFrame:
    """(by, usable, reason, keep_in_cache) from runs (by, run, usable, reason, error): error is a passing failure's name, else null.

    A frame whose votes all failed is usable for now. Failed votes don't count, and a verdict is only kept if as many votes
    as the threshold came through, or none failed.
    """
    least = threshold if threshold is not None else (n_votes + 1) // 2
    sound = runs.where("error is null")
    counted = runs.groupBy(*by).agg(F.count_if(F.col("error").isNull()).alias("done"), F.count_if(F.col("error").isNotNull()).alias("failed"), F.min("error").alias("why"))
    one = sound.groupBy(*by).agg(F.min_by(F.struct("usable", "reason"), "run").alias("only"))
    voted = votes.majority(sound, by, least) if n_votes > 1 else one.select(*by, "only.usable", "only.reason")
    failed = F.when(F.lit(n_votes > 1), F.lit("filter_error:all_votes_failed")).otherwise(F.concat(F.lit("filter_error:"), "why"))
    both = counted.join(voted, by, "left")
    return both.select(*by, F.coalesce("usable", F.lit(True)).alias("usable"), F.when(F.col("done") == 0, failed).otherwise(F.col("reason")).alias("reason"), ((F.col("done") > 0) & ((F.col("done") >= least) | (F.col("failed") == 0))).alias("keep_in_cache"))


def verdicts(manifests: DataFrame, cache: DataFrame, keys: list[str], live: DataFrame | None = None) -> DataFrame:
    """(keys, usable, reason, new) of a verifier for each manifest: from the cache, or from live answers (keys, result, error).

    A live call that failed to the last is a refusal, and kept as such. Without live answers, a manifest that the cache
    doesn't hold raises an error: nothing passes unseen.
    """
    rows = manifests.select(*keys).distinct().join(cache.select(*keys, "usable", "reason"), keys, "left")
    held = F.col("usable").isNotNull()
    if live is None:
        said = F.when(held, F.col("usable")).otherwise(F.raise_error(F.concat(F.lit("no verdict in the cache for "), F.concat_ws("/", *[F.col(k).cast("string") for k in keys]))).cast("boolean"))
        return rows.select(*keys, said.alias("usable"), "reason", F.lit(False).alias("new"))
    answers = live.select(*keys, F.col("result").alias("answer"), F.col("error").alias("failure"))
    usable, reason = votes.parsed(F.col("answer"))
    rows = rows.join(answers, keys, "left")
    gone = F.concat(F.lit("verify_exhausted:"), F.coalesce("failure", F.lit("no answer")))
    answered = F.col("answer").isNotNull()
    return rows.select(*keys, F.coalesce("usable", F.when(answered, usable).otherwise(F.lit(False))).alias("usable"), F.when(held, F.col("reason")).when(answered, reason).otherwise(gone).alias("reason"), (~held).alias("new"))


def detect(frames: DataFrame, factory: Factory, tries: int = 3) -> DataFrame:
    """frames' keys with a row per detection; a model gives a list of dicts with the fields of DETECTIONS."""
    keys = [c for c in ("adapter", "scene_id", "frame_id", "ord") if c in frames.columns]
    return applied(frames, factory, DETECTIONS, tries).select(*keys, F.inline("result"))


def segment(frames: DataFrame, detections: DataFrame, factory: Factory, tries: int = 3) -> DataFrame:
    """frames' keys with a row per mask; a model gets a frame with its `detections` and gives a list of dicts with the fields of MASKS."""
    keys = [c for c in ("adapter", "scene_id", "frame_id", "ord") if c in frames.columns]
    each = F.struct(*[c for c in detections.columns if c not in keys])
    found = detections.groupBy(*keys).agg(F.array_sort(F.collect_list(each)).alias("detections"))
    return applied(frames.join(found, keys), factory, MASKS, tries).select(*keys, F.inline("result"))


def rectangles(dets: DataFrame, width: int, height: int) -> DataFrame:
    """The rule-based segmenter: each detection's rectangle as a mask with the fields of MASKS; keys and other columns stay."""
    rows = vision.rectangle_masks(dets, width, height).withColumnRenamed("det", "mask")
    runs = F.when((F.col("m1") > F.col("m0")) & (F.col("n1") > F.col("n0")), F.transform(F.sequence("n0", F.col("n1") - 1), lambda v: F.struct(v.alias("v"), F.col("m0").alias("u0"), F.col("m1").alias("u1"))))
    return rows.withColumn("runs", F.coalesce(runs, F.array().cast("array<struct<v:int,u0:int,u1:int>>"))).drop("m0", "n0", "m1", "n1", "area")


#: Rule-based detectors of frames and segmenters of detections by name: functions of tables and the image's size.
DETECTORS: dict[str, Callable[..., DataFrame]] = {"noop": lambda frames, width, height: vision.noop_detections(frames, 4, width, height)}
SEGMENTERS: dict[str, Callable[..., DataFrame]] = {"noop": rectangles}


def named(registry: dict[str, Callable[..., DataFrame]], name: str) -> Callable[..., DataFrame]:
    if name not in registry:
        raise KeyError(f"{name!r} is not at hand; there are {sorted(registry)}")
    return registry[name]
