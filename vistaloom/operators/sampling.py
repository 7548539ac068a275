"""Keyframe samplers over the ordered frames of each scene: columns scene_id, ord, pose."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vistaloom.functions import geometry as g
from vistaloom.operators import fold


def adaptive(frames: DataFrame, least_translation: float = 0.2, least_rotation: float = 15.0) -> DataFrame:
    """(scene_id, ord) of keyframes: the first valid pose, then each that moved or turned enough from the last kept one."""
    valid = frames.where(g.finite_pose(F.col("pose"))).select("scene_id", "ord", F.array(*g.camera_center(F.col("pose")), *g.optical_axis(F.col("pose"))).alias("seen"))

    def moved(last, row):
        part = lambda r, k: tuple(F.get(r["seen"], F.lit(k + i)) for i in range(3))
        t, r = g.pose_deltas(part(last, 0), part(last, 3), part(row, 0), part(row, 3))
        return (t >= least_translation) | (r >= least_rotation)

    return fold.from_last(valid, ["scene_id"], ["ord"], ["ord", "seen"], moved).select("scene_id", "ord")


def stride(frames: DataFrame, step: int = 50, least_frames: int = 30) -> DataFrame:
    """(scene_id, ord) of every step-th frame; the step shrinks so that a scene yields least_frames where it can."""
    w = Window.partitionBy("scene_id")
    ranked = frames.select("scene_id", "ord", (F.row_number().over(w.orderBy("ord")) - 1).alias("k"), F.count(F.lit(1)).over(w).alias("n"))
    eff = F.least(F.lit(step), F.greatest(F.lit(1), F.floor(F.col("n") / least_frames))) if least_frames > 0 else F.lit(step)
    return ranked.where(F.col("k") % eff == 0).select("scene_id", "ord")


SAMPLERS = {"adaptive": adaptive, "stride": stride}


def sample(frames: DataFrame, strategy: str = "stride", limit: int = 0, base: str = "stride", **knobs) -> DataFrame:
    """Keyframes by a strategy's name; `cosmic` samples by its base. limit > 0 keeps the first of each scene."""
    name = base if strategy == "cosmic" else strategy
    if name not in SAMPLERS:
        raise ValueError(f"unknown sampling strategy {strategy!r}")
    kept = SAMPLERS[name](frames, **knobs)
    if limit <= 0:
        return kept
    return kept.withColumn("k", F.row_number().over(Window.partitionBy("scene_id").orderBy("ord"))).where(F.col("k") <= limit).drop("k")


def spread(frames: DataFrame, n: int) -> DataFrame:
    """(scene_id, ord) of n frames at even steps, order kept; all where there are fewer."""
    w = Window.partitionBy("scene_id")
    ranked = frames.select("scene_id", "ord", (F.row_number().over(w.orderBy("ord")) - 1).alias("k"), F.count(F.lit(1)).over(w).alias("n"))
    # the j-th pick is floor(j * n / picks); k is one if such a j exists
    j = F.ceil(F.col("k") * n / F.col("n"))
    return ranked.where((F.col("n") <= n) | ((j < n) & (F.floor(j * F.col("n") / n) == F.col("k")))).select("scene_id", "ord")
