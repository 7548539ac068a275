"""Stages as functions of DataFrames; each runs on what the one before it left."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vistaloom import models
from vistaloom.functions import geometry as g
from vistaloom.operators import curate, emit, pairs, sampling, skills, vision, votes
from vistaloom.operators import match as matching

#: Skills that a pair must have been tagged with by its poses before its matches are looked at.
POSE_SKILLS = tuple(sorted(pairs.POSE_TASKS))


def sample(frames: DataFrame, settings: dict) -> DataFrame:
    """(scene_id, ord) of keyframes by the stage's settings."""
    knobs = {"stride": {"step": settings["frame_stride"], "least_frames": settings["min_keyframes"]}, "adaptive": {"least_translation": settings["min_translation_m"], "least_rotation": settings["min_rotation_deg"]}}
    name, base = settings["sampling"], settings["cosmic_base_sampling"]
    return sampling.sample(frames, name, settings["limit_frames"], base, **knobs.get(base if name == "cosmic" else name, {}))


def pair_gate(frames: DataFrame, depth, medians, camera, image, cells, config: pairs.PairConfig, carry: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Selected pairs, and the frames in them, which are all that models have to look at."""
    found = pairs.select_pairs(frames, depth, medians, camera, image, cells, config, carry)
    used = found.select("scene_id", F.explode(F.array("ord_a", "ord_b")).alias("ord")).distinct()
    return found, frames.join(used, ["scene_id", "ord"], "left_semi")


def scored(found: DataFrame, frames: DataFrame, adapter: str) -> DataFrame:
    """Selected pairs as they are written: with names and images of both frames, and their place in their scene, the best first."""
    names = frames.select("scene_id", "ord", "frame_id", "image_path")
    rows = found
    for s, side in (("a", "src"), ("b", "tgt")):
        rows = rows.join(names.select("scene_id", F.col("ord").alias(f"ord_{s}"), F.col("frame_id").alias(f"{side}_id"), F.col("image_path").alias(f"image_{side}")), ["scene_id", f"ord_{s}"])
    return rows.select(
        F.lit(adapter).alias("adapter"), "scene_id", "src_id", "tgt_id", "image_src", "image_tgt", "overlap", "occluded_frac", F.col("angle").alias("angle_deg"), F.col("distance").alias("distance_m"),
        "quality", F.col("median_depth_a").alias("median_depth_src"), F.col("median_depth_b").alias("median_depth_tgt"), "tasks",
    )


def filter_pairs(found: DataFrame, runs: DataFrame) -> DataFrame:
    """Pairs whose frames the runs' majority finds usable."""
    return votes.apply_filter(found, votes.majority(runs, ["scene_id", "ord"])).where("reason is null").drop("reason")


def label(items: DataFrame, by: list[str], settings: dict) -> DataFrame:
    """(by, place, object, canonical) of each frame's label runs (by, run, item, obj, canon): one run's as they are, several as a union or by majority."""
    n = settings["n_votes"]
    if n <= 1:
        return votes.label_list(items, by, ["run", "item"])
    found = votes.majority_items(items, by, n) if settings.get("vote_strategy") == "majority" else votes.united(items, by)
    return found.select(*by, "place", "object", "canonical")


def perceive(frames: DataFrame, settings: dict, image: tuple[int, int], names: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(masks, runs) of frames by the rule-based detector and segmenter that the settings name.

    names: (scene_id, object, canonical), the scene's vocabulary, which masks' canonical names are looked up in afterwards.
    """
    keys = ["scene_id", "frame_id"]
    dets = models.named(models.DETECTORS, settings["detector"])(frames.select(*keys).distinct(), *image)
    masks = models.named(models.SEGMENTERS, settings["segmenter"])(dets, *image)
    if names is not None:
        known = names.select("scene_id", F.lower(F.trim("object")).alias("__of"), F.col("canonical").alias("__canonical"))
        masks = masks.withColumn("__of", F.lower(F.trim("label"))).join(known, ["scene_id", "__of"], "left").withColumn("canonical", F.coalesce("__canonical", F.lower(F.trim("label")))).drop("__of", "__canonical")
    if "canonical" not in masks.columns:
        masks = masks.withColumn("canonical", F.lit(""))
    runs = masks.select(*keys, "mask", F.inline("runs")).select(*keys, "mask", "v", "u0", "u1")
    return masks.drop("runs"), runs


def pair_key(src: str = "src", tgt: str = "tgt") -> Column:
    return F.concat_ws("|", "scene_id", src, tgt)


def match(found: DataFrame, frames: DataFrame, masks: DataFrame, runs: DataFrame, depth: matching.Depth, camera, image: tuple[int, int], settings: dict, seeds: DataFrame | None = None, source: str = "unknown", save: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(records, rejections, manifests) of scored pairs, from frames, masks and depth.

    found: the columns of scored(). frames: scene_id, frame_id, pose. masks: scene_id, frame_id, mask, label, canonical, score,
    x0 to y1, cu, cv, and coverage where it is known. Pairs are taken in order of src_id and tgt_id as numbers; a scene stops
    at its cap, and what comes after the pair that reached it isn't told. save writes what is used several times.
    """
    save = save or (lambda df: df)
    place = F.row_number().over(Window.partitionBy("scene_id").orderBy(F.col("src_id").try_cast("int").asc_nulls_last(), F.col("tgt_id").try_cast("int").asc_nulls_last(), "src_id", "tgt_id"))
    rows = found.withColumn("place", place).withColumnsRenamed({"src_id": "src", "tgt_id": "tgt"}).withColumn("pair_id", pair_key())
    asked = rows.select("scene_id", "src", "tgt")
    if seeds is None:
        by = ["scene_id", "src", "tgt"]
        held = asked.join(runs.withColumnRenamed("frame_id", "src"), ["scene_id", "src"])
        seeds = matching.hashed_seeds(vision.mask_areas(held, by), held, by, settings["seed"], settings["seed_retries"])
    tried = save(matching.match_pairs(asked, frames, masks, runs, seeds, depth, camera, image, settings["depth_tol"], settings["iou_min"], settings["emit_occlusion_negatives"]))

    area = F.greatest(F.lit(0.0), F.col("x1") - F.col("x0")) * F.greatest(F.lit(0.0), F.col("y1") - F.col("y0"))
    pixels = vision.mask_areas(runs, ["scene_id", "frame_id"]).withColumnRenamed("area", "pixels")
    facts = masks.join(pixels, ["scene_id", "frame_id", "mask"], "left").select(
        "scene_id", "frame_id", "mask", "label", "canonical", F.col("score").cast("double").alias("score"), area.alias("area"), F.coalesce("pixels", F.lit(0)).cast("double").alias("pixels"),
        F.col("coverage") if "coverage" in masks.columns else F.lit(1.0).alias("coverage"), F.array("x0", "y0", "x1", "y1").alias("bbox"), F.array("cu", "cv").alias("centroid"),
    )

    def of(side: str) -> DataFrame:
        return facts.select("scene_id", F.col("frame_id").alias(side), F.col("mask").alias(f"{side}_mask"), *[F.col(c).alias(f"{side}_{c}") for c in ("label", "canonical", "score", "area", "pixels", "coverage", "bbox", "centroid")])

    keyed = rows.select("scene_id", "src", "tgt", "pair_id", "place", "overlap", "tasks", "image_src", "image_tgt")
    good = tried.where("reason is null").join(of("src"), ["scene_id", "src", "src_mask"]).join(of("tgt"), ["scene_id", "tgt", "tgt_mask"], "left").join(keyed, ["scene_id", "src", "tgt"])
    good = good.withColumn("tgt_label", F.coalesce("tgt_label", F.lit(""))).withColumn("tgt_mask_area", F.col("tgt_pixels")).withColumn("coverage", F.col("src_coverage"))

    poses = frames.select("scene_id", F.col("frame_id").alias("tgt"), *[c.alias(n) for c, n in zip((*g.camera_center(F.col("pose")), *g.optical_axis(F.col("pose"))), ("center_x", "center_y", "center_z", "axis_x", "axis_y", "axis_z"), strict=True)])
    asked_of = rows.join(poses, ["scene_id", "tgt"]).select(
        "pair_id", "tasks", "overlap", F.col("occluded_frac").alias("occluded"), F.col("angle_deg").alias("rotation"), F.col("distance_m").alias("translation"), F.coalesce(g.frame_gap(F.col("src"), F.col("tgt")), F.lit(2**31 - 1)).alias("gap"),
        pairs.depth_ratio(F.col("median_depth_src"), F.col("median_depth_tgt")).alias("ratio"), *[f"{n}_{c}" for n in ("center", "axis") for c in "xyz"],
    )
    sides = F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("frame_id")) for s in ("src", "tgt")])
    every = rows.select("scene_id", "pair_id", F.inline(sides)).join(facts.select("scene_id", "frame_id", "mask", "label", "canonical"), ["scene_id", "frame_id"])
    shown = skills.evidence(asked_of, good.drop("overlap", "tasks"), every)
    tagged = shown.join(rows.select("pair_id", "tasks"), "pair_id").where(~F.col("skill").isin(*POSE_SKILLS) | F.array_contains("tasks", F.col("skill"))).drop("tasks")
    tagged = save(tagged)

    cap = settings["max_samples_per_scene"]
    judged = save(emit.emitted(good, *image, cap, settings["voxel_dedup"], ("place", "match_idx")))
    stops = judged.where("reason is null").groupBy("scene_id").agg(F.count(F.lit(1)).alias("n"), F.max("place").alias("stop"))
    stops = stops.where(F.col("n") >= cap).drop("n") if cap is not None else stops.limit(0).drop("n")
    upto = lambda df: df.join(stops, "scene_id", "left").where(F.col("stop").isNull() | (F.col("place") <= F.col("stop"))).drop("stop")

    own = tagged.groupBy("pair_id").agg(F.collect_set("skill").alias("shown"))
    tasks = F.array_sort(F.array_union("tasks", F.coalesce("shown", F.array().cast("array<string>"))))
    none = F.array(*[F.lit(-1.0)] * 4)
    records = judged.where("reason is null").join(own, "pair_id", "left").select(
        "scene_id", F.lit(source).alias("dataset_source"), F.col("src").alias("frame_src"), F.col("tgt").alias("frame_tgt"), "image_src", "image_tgt", F.array("psu", "psv").alias("point_src"), F.array("pu", "pv").alias("point_tgt"),
        F.array("x", "y", "z").alias("X_world"), F.col("src_mask").alias("src_mask_id"), F.col("tgt_mask").alias("tgt_mask_id"), "src_bbox", F.coalesce("tgt_bbox", none).alias("tgt_bbox"), "src_label", "tgt_label",
        F.coalesce("src_canonical", F.lit("")).alias("src_canonical"), F.coalesce("tgt_canonical", F.lit("")).alias("tgt_canonical"), "depth_src", F.col("depth_pred").alias("depth_pred_tgt"), F.col("depth_obs").alias("depth_obs_tgt"),
        F.col("iou").alias("iou_src_to_tgt"), F.col("overlap").alias("pair_overlap"), F.col("try").alias("seed_retry"), "visible", tasks.alias("tasks"),
    )
    records = emit.rounded(records, ["depth_src", "depth_pred_tgt", "depth_obs_tgt", "iou_src_to_tgt", "pair_overlap"])
    refused = [F.col("src").alias("frame_src"), F.col("tgt").alias("frame_tgt"), F.col("src_mask").alias("src_mask_id"), "reason"]
    rejections = upto(tried.where("reason is not null").join(keyed.select("scene_id", "src", "tgt", "place"), ["scene_id", "src", "tgt"])).select("scene_id", *refused)
    rejections = rejections.unionByName(judged.where("reason is not null").select("scene_id", *refused))

    inside = lambda c, n: F.greatest(F.lit(0), F.least(F.lit(n - 1), F.rint(c).cast("int")))
    one = F.struct(
        F.col("match_idx").cast("int").alias("match_idx"), F.col("src_mask").alias("src_mask_id"), F.col("tgt_mask").alias("tgt_mask_id"), "src_label", "tgt_label", "src_bbox", F.coalesce("tgt_bbox", none).alias("tgt_bbox"), "src_centroid",
        F.coalesce("tgt_centroid", F.array(F.lit(-1.0), F.lit(-1.0))).alias("tgt_centroid"), F.array(inside("su", image[0]), inside("sv", image[1])).alias("point_src"), F.array(inside("u", image[0]), inside("v", image[1])).alias("point_tgt"),
        F.array("x", "y", "z").alias("X_world"), *[F.bround(c, 4).alias(n) for c, n in (("depth_src", "depth_src"), ("depth_pred", "depth_pred_tgt"), ("depth_obs", "depth_obs_tgt"), ("iou", "iou_src_to_tgt"))], "visible",
    )
    objects = good.groupBy("pair_id").agg(F.array_sort(F.collect_list(one)).alias("objects"))
    pose = lambda side: frames.select("scene_id", F.col("frame_id").alias(side), F.col("pose").alias(f"pose_{side}_c2w"))
    whole = rows.join(objects, "pair_id").join(pose("src"), ["scene_id", "src"]).join(pose("tgt"), ["scene_id", "tgt"])
    manifests = upto(tagged.join(whole, "pair_id")).select(
        "skill", "scene_id", F.lit(source).alias("dataset_source"), F.col("src").alias("frame_src"), F.col("tgt").alias("frame_tgt"), "image_src", "image_tgt", F.array(F.lit(image[0]), F.lit(image[1])).alias("image_src_size"),
        F.array(F.lit(image[0]), F.lit(image[1])).alias("image_tgt_size"), "pose_src_c2w", "pose_tgt_c2w", F.bround("overlap", 4).alias("pair_overlap"), F.bround("occluded_frac", 4).alias("pair_occluded_frac"),
        F.bround("angle_deg", 4).alias("pair_angle_deg"), F.bround("distance_m", 4).alias("pair_distance_m"), "objects", "evidence",
    )
    return records, rejections, manifests


def verify(manifests: DataFrame, verdicts: DataFrame, keys: list[str]) -> DataFrame:
    """Manifests that a verifier accepts; what it wasn't asked about goes."""
    return curate.verified(manifests, verdicts, keys)


def numbered(manifests: DataFrame) -> DataFrame:
    """manifests with `id`, one of its own for each row, the same on every run: a hash of the row, and a count among rows alike."""
    mark = F.xxhash64(*manifests.columns)
    again = F.row_number().over(Window.partitionBy("skill", "__mark").orderBy("__mark"))
    return manifests.withColumn("__mark", mark).withColumn("id", F.concat_ws(":", F.col("__mark").cast("string"), again.cast("string"))).drop("__mark")


def balance(manifests: DataFrame, verdicts: DataFrame | None, scene_cap: int | None, bucket_cap: int | None, seed: int) -> tuple[DataFrame, DataFrame]:
    """(manifests with ids, (skill, id, reason)): quotas by scene and by the answer that a manifest teaches.

    verdicts: (skill, scene_id, frame_src, frame_tgt, usable); without any, all manifests are usable, else those without one are not.
    """
    rows = numbered(manifests)
    keys = ["skill", "scene_id", "frame_src", "frame_tgt"]
    told = rows.withColumn("usable", F.lit(True)) if verdicts is None else rows.join(verdicts.select(*keys, "usable"), keys, "left")
    bucket = curate.answer_bucket(F.col("skill"), skills.parsed(F.col("evidence")))
    return rows, curate.balanced(told.select("skill", "id", F.coalesce("scene_id", F.lit("?")).alias("scene_id"), bucket.alias("bucket"), "usable"), scene_cap, bucket_cap, seed)
