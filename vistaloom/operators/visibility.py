"""Which instances a frame shows, and pairs whose frames show enough of a scene in common."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vistaloom.functions import geometry as g

#: Labels of structure that is no object.
BLOCKED = ("wall", "floor", "ceiling", "doorframe", "door frame")


def is_object(label: Column) -> Column:
    """Whether a label names something and isn't blocked."""
    name = F.lower(F.trim(F.coalesce(label, F.lit(""))))
    return (name != "") & ~name.isin(*BLOCKED)


def footprints(pixels: DataFrame) -> DataFrame:
    """(scene_id, ord, inst_id, n_px, n_valid): pixels of each instance in each frame, and those with depth."""
    return pixels.groupBy("scene_id", "ord", "inst_id").agg(F.count(F.lit(1)).alias("n_px"), F.count_if("valid").alias("n_valid"))


def footprints_by_rule(frames: DataFrame, rule: DataFrame, by: list[str]) -> DataFrame:
    """footprints() where a frame's pixels follow from its columns `by`: rule (by, inst_id, n_px, n_valid) is small, and frames
    (scene_id, ord, by) meet it instead of their pixels. Frames are dealt by scene, so what follows by scene needs no more shuffle.
    """
    shows = rule.groupBy(*by).agg(F.collect_list(F.struct("inst_id", "n_px", "n_valid")).alias("shows"))
    rows = frames.repartition(int(frames.sparkSession.conf.get("spark.sql.shuffle.partitions")), "scene_id").join(F.broadcast(shows), by)
    each = rows.select("scene_id", "ord", F.inline("shows"))
    return each.groupBy("scene_id", "ord", "inst_id").agg(F.sum("n_px").alias("n_px"), F.sum("n_valid").alias("n_valid"))


def visible(prints: DataFrame, labels: DataFrame, image: int, least_share: float = 0.005, least_depth: int = 50) -> DataFrame:
    """Footprints large enough, with enough depth, of instances that are objects; labels: inst_id, label, small per scene."""
    shown = prints.where((F.col("n_px") >= least_share * image) & (F.col("n_valid") >= least_depth))
    return shown.join(labels.where(is_object(F.col("label"))), "inst_id")


def frame_sets(shown: DataFrame) -> DataFrame:
    """(scene_id, ord, ids): the sorted instances of each frame that shows any."""
    return shown.groupBy("scene_id", "ord").agg(F.array_sort(F.collect_set("inst_id")).alias("ids"))


def scene_sets(sets: DataFrame) -> DataFrame:
    """(scene_id, all_ids): instances of any of a scene's frames. Distinct pairs first, so that frames of one scene pre-aggregate."""
    ids = sets.select("scene_id", F.explode("ids").alias("id")).distinct()
    return ids.groupBy("scene_id").agg(F.array_sort(F.collect_list("id")).alias("all_ids"))


def cosmic(frames: DataFrame, sets: DataFrame, scenes: DataFrame, least_coverage: float = 0.3, least_yaw: float = 30.0) -> DataFrame:
    """All pairs of a scene's frames, the earlier one first, with what they show and `reason`, null where the pair passes, else the first test that it fails.

    frames: scene_id, ord, yaw; pairs hold ord_a, ord_b. A pair without visibility on a side fails as such. What frames show
    is joined to frames before they meet, so that only frames are shuffled, by their scene, and never pairs.
    """
    seen = frames.select("scene_id", "ord", "yaw").join(sets.select("scene_id", "ord", "ids"), ["scene_id", "ord"], "left")
    a, b = seen.join(scenes, "scene_id", "left").alias("a"), seen.alias("b")
    met = a.join(b, (F.col("a.scene_id") == F.col("b.scene_id")) & (F.col("b.ord") > F.col("a.ord")))
    rows = met.select("a.scene_id", "all_ids", *[F.col(f"{s}.{n}").alias(f"{n}_{s}") for s in "ab" for n in ("ord", "ids", "yaw")])
    both, either = F.array_intersect("ids_a", "ids_b"), F.array_union("ids_a", "ids_b")
    rows = rows.withColumns({
        "n_src": F.size("ids_a"), "n_tgt": F.size("ids_b"), "n_intersection": F.size(both), "n_union": F.size(either), "n_scene": F.size("all_ids"),
        "coverage": F.size(either) / F.size("all_ids"), "yaw_diff": g.circular_difference(F.col("yaw_a"), F.col("yaw_b")),
    })
    reason = (
        F.when(F.coalesce(F.size("all_ids") <= 0, F.lit(True)), "cosmic_no_scene_objects")
        .when(F.col("ids_a").isNull() | F.col("ids_b").isNull(), "cosmic_no_visibility")
        .when(F.col("n_intersection") == 0, "cosmic_no_shared_anchor")
        .when(F.col("coverage") < least_coverage, F.concat(F.lit("cosmic_low_union_coverage:"), F.format_string("%.2f", "coverage")))
        .when(F.col("yaw_diff") < least_yaw, "cosmic_low_yaw_diff")
    )
    return rows.withColumn("reason", reason)


def places(frames: DataFrame, sets: DataFrame) -> DataFrame:
    """(scene_id, ord, ids, yaws): the sets with the yaws of their frames."""
    return frames.groupBy("scene_id", "ord").agg(F.collect_list("yaw").alias("yaws")).join(sets.select("scene_id", "ord", "ids"), ["scene_id", "ord"]).select("scene_id", "ord", "ids", "yaws")


def anchored(places: DataFrame, scenes: DataFrame, least_coverage: float = 0.3) -> DataFrame:
    """(scene_id, ord_a, ord_b, both_ids, any_ids, coverage, yaws_a, yaws_b): pairs of a scene's places() whose frames pass cosmic() but for its test of yaws.

    Sets belong to a place, however many frames it has, so they meet once for all pairs of its frames; turned() gives those.
    They stand behind a generator, so that the tests don't work them out again.
    """
    dealt = places.repartition(int(places.sparkSession.conf.get("spark.sql.shuffle.partitions")), "scene_id")  # small rows, much work
    a, b = dealt.join(scenes.select("scene_id", F.size("all_ids").alias("n_scene")).where("n_scene > 0"), "scene_id").alias("a"), dealt.alias("b")
    met = a.join(b, (F.col("a.scene_id") == F.col("b.scene_id")) & (F.col("b.ord") > F.col("a.ord")))
    rows = met.select("a.scene_id", "n_scene", *[F.col(f"{s}.{n}").alias(f"{n}_{s}") for s in "ab" for n in ("ord", "ids", "yaws")])
    rows = rows.select("*", F.inline(F.array(F.struct(F.array_intersect("ids_a", "ids_b").alias("both_ids")))))
    rows = rows.withColumn("coverage", (F.size("ids_a") + F.size("ids_b") - F.size("both_ids")) / F.col("n_scene"))
    rows = rows.where((F.size("both_ids") > 0) & (F.col("coverage") >= least_coverage))
    return rows.select("scene_id", "ord_a", "ord_b", "both_ids", F.array_union("ids_a", "ids_b").alias("any_ids"), "coverage", "yaws_a", "yaws_b")


def turned(pairs: DataFrame, least_yaw: float = 30.0) -> DataFrame:
    """anchored() pairs of places as pairs of frames, those whose yaws differ enough, without the yaws: all else stays as it is per pair of places."""
    each = pairs.withColumn("yaw_a", F.explode("yaws_a")).drop("yaws_a").withColumn("yaw_b", F.explode("yaws_b")).drop("yaws_b")
    return each.where(g.circular_difference(F.col("yaw_a"), F.col("yaw_b")) >= least_yaw).drop("yaw_a", "yaw_b")
