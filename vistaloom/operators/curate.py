"""Curation of manifests: quotas, verdicts, agreement with ground truth."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vistaloom.operators import fold


def shuffle_key(seed: int, identity: Column) -> Column:
    """An order that looks random, the same on every run and engine."""
    return F.md5(F.concat(F.lit(f"{seed}:"), identity.cast("string")))


def answer_bucket(skill: Column, evidence: Column) -> Column:
    """The answer that a manifest teaches; `?` where it can't be told.

    evidence: a struct with shared_objects, category, unique_total, candidates, targets, transformed_objects, varying_objects
    (arrays of structs), n_visible and n_occluded.
    """
    first = lambda array, field: F.coalesce(F.get(evidence[array], F.lit(0))[field].cast("string"), F.lit("?"))
    yes = lambda c: F.when(F.coalesce(evidence[c], F.lit(0)) > 0, "True").otherwise("False")
    return (
        F.when(skill == "anchor", first("shared_objects", "src_label"))
        .when(skill == "counting", F.concat(F.coalesce(evidence["category"], F.lit("?")), F.lit("/"), F.coalesce(evidence["unique_total"], F.lit(0)).cast("string")))
        .when(skill == "relative_distance", first("candidates", "label"))
        .when(skill == "relative_direction", first("targets", "bucket"))
        .when(skill == "cross_spatial_transformation", first("transformed_objects", "label"))
        .when(skill == "cross_depth_variation", F.when(F.size(F.coalesce(evidence["varying_objects"], F.slice(evidence["varying_objects"], 1, 0))) < 1, "?").when(F.get(evidence["varying_objects"], F.lit(0))["delta_m"] > 0, "closer").otherwise("farther"))
        .when(skill == "cross_occlusion_visibility", F.concat(F.lit("vis="), yes("n_visible"), F.lit("/occ="), yes("n_occluded")))
        .otherwise("?")
    )


def balanced(rows: DataFrame, scene_cap: int | None, bucket_cap: int | None, seed: int = 0) -> DataFrame:
    """(skill, id, reason) for rows (skill, id, scene_id, bucket, usable): null reason is kept.

    Each skill's rows are taken in shuffled order. The scene's cap is looked at first, then the bucket's, then the verdict;
    only a kept row counts towards the caps, and a missing verdict is a refusal. A skill's rows stream through one task in
    order, in linear time; what is held is a counter for each of its scenes and buckets.
    """
    ranked = rows.select("skill", "id", "scene_id", "bucket", F.coalesce("usable", F.lit(False)).alias("usable"), shuffle_key(seed, F.col("id")).alias("key"))
    ordered = ranked.repartition("skill").sortWithinPartitions("skill", "key", "id")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, scenes, buckets = None, Counter(), Counter()
        for b in batches:
            reasons = []
            for skill, scene, bucket, usable in zip(*(b.column(c).to_pylist() for c in ("skill", "scene_id", "bucket", "usable")), strict=True):
                if skill != now:
                    now, scenes, buckets = skill, Counter(), Counter()
                if scene_cap is not None and scenes[scene] >= scene_cap:
                    reasons.append("per_scene_cap")
                elif bucket_cap is not None and buckets[bucket] >= bucket_cap:
                    reasons.append("per_bucket_cap")
                elif not usable:
                    reasons.append("verifier")
                else:
                    reasons.append(None)
                    scenes[scene] += 1
                    buckets[bucket] += 1
            yield pa.record_batch([b.column("skill"), b.column("id"), pa.array(reasons, pa.string())], names=["skill", "id", "reason"])

    return ordered.mapInArrow(scan, f"skill string, id {rows.schema['id'].dataType.simpleString()}, reason string")


def verified(manifests: DataFrame, verdicts: DataFrame, keys: list[str]) -> DataFrame:
    """Manifests with a verdict of usable; false and missing ones go."""
    return manifests.join(verdicts.where("usable"), keys, "left_semi")


def agreement(points: DataFrame, instances: DataFrame) -> DataFrame:
    """points with the instance under either end (0: none) and whether both are the same one.

    points: scene_id, src, tgt (frames), us, vs, ut, vt. instances: scene_id, frame, pu, pv, inst_id.
    """
    at = lambda n, f, u, v: instances.select("scene_id", F.col("frame").alias(f), F.col("pu").alias(u), F.col("pv").alias(v), F.col("inst_id").alias(n))
    rows = points.join(at("inst_src", "src", "us", "vs"), ["scene_id", "src", "us", "vs"], "left").join(at("inst_tgt", "tgt", "ut", "vt"), ["scene_id", "tgt", "ut", "vt"], "left")
    rows = rows.fillna(0, ["inst_src", "inst_tgt"])
    return rows.withColumn("correct", (F.col("inst_src") == F.col("inst_tgt")) & (F.col("inst_src") != 0))


def agreement_report(judged: DataFrame) -> DataFrame:
    """Correct, total and rate, overall, by scene and by label, in one pass."""
    sets = judged.groupingSets([[], ["scene_id"], ["label"]], "scene_id", "label").agg(F.count_if("correct").alias("correct"), F.count(F.lit(1)).alias("total"), F.grouping("scene_id").alias("gs"), F.grouping("label").alias("gl"))
    kind = F.when(F.col("gs") == 0, "scene").when(F.col("gl") == 0, "label").otherwise("overall")
    return sets.select(kind.alias("kind"), F.coalesce("scene_id", "label").alias("name"), "correct", "total", (F.col("correct") / F.col("total")).alias("rate"))


def apart_from_kept(manifests: DataFrame, least: int) -> DataFrame:
    """(scene_id, id) of manifests, in order, none of whose frames is within `least` of a kept one's; non-numeric frames are kept."""
    if least <= 0:
        return manifests.select("scene_id", "id")
    rows = manifests.select("scene_id", "id", F.col("src").try_cast("int").alias("a"), F.col("tgt").try_cast("int").alias("b"))
    odd = F.col("a").isNull() | F.col("b").isNull()
    near = lambda k, x: (F.abs(x - k["a"]) <= least) | (F.abs(x - k["b"]) <= least)
    kept = fold.greedy(rows.where(~odd), ["scene_id"], ["id"], ["id", "a", "b"], lambda acc, x: ~F.exists(acc, lambda k: near(k, x["a"]) | near(k, x["b"])))
    return kept.select("scene_id", "id").unionByName(rows.where(odd).select("scene_id", "id"))
