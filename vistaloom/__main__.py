"""python -m vistaloom COMMAND: the stages over files, quotas and agreement reports, and queries by name."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def session() -> SparkSession:
    return SparkSession.builder.appName("vistaloom").config("spark.sql.adaptive.enabled", "true").getOrCreate()


def ordered(frames: DataFrame) -> DataFrame:
    return frames.withColumn("ord", F.col("frame_id").try_cast("long")).where("ord is not null")


def camera(k: Column) -> tuple[Column, ...]:
    """(fx, fy, cx, cy) of a camera matrix of 9 or 16 numbers."""
    side = F.when(F.size(k) == 16, 4).otherwise(3)
    return F.get(k, F.lit(0)), F.get(k, side + 1), F.get(k, F.lit(2)), F.get(k, side + 2)


def scene_frames(a: argparse.Namespace, spark: SparkSession) -> tuple[DataFrame, tuple, tuple[int, int], tuple[int, int]]:
    """Frames of the source's folders, their camera, and the sizes of images and rasters, which one run has once."""
    from vistaloom.sources import scans

    frames = ordered(scans.frames_of_source(spark, a.adapter, a.scenes_root))
    some = frames.where("depth is not null").select("width", "height", "k").first()
    if some is None:
        sys.exit(f"no frame with depth below {a.scenes_root}")
    w, h = (int(x) for x in a.image_size.split("x"))
    one = spark.range(1).select(F.array(*camera(F.array(*map(F.lit, some.k)))).alias("c")).first().c
    return frames, tuple(one), (w, h), (some.width, some.height)


def sample(a: argparse.Namespace) -> None:
    from vistaloom import config, stages
    from vistaloom.sources import scans, sinks

    spark = session()
    poses = ordered(scans.scene_poses(spark, a.scenes_root))
    settings = config.stage("sample", a.run, {"sampling": a.sampling, "frame_stride": a.frame_stride, "limit_frames": a.limit_frames})
    images = ordered(scans.scene_images(spark, a.scenes_root, scans.IMAGE_KINDS.get(a.adapter, ("jpg",))))
    kept = stages.sample(poses, settings).join(images, ["scene_id", "ord"])
    print(json.dumps({"frames": sinks.write_frames(kept.select(F.lit(a.adapter).alias("adapter"), "scene_id", "frame_id", "image_path"), a.out)}))


def pair_gate(a: argparse.Namespace) -> None:
    from vistaloom import config, stages
    from vistaloom.operators import pairs
    from vistaloom.sources import scans, sinks

    spark = session()
    frames, k, image, cells = scene_frames(a, spark)
    asked = scans.frames_of(*scans.load(spark, a.input)).select("scene_id", "frame_id").distinct()
    frames = frames.join(asked, ["scene_id", "frame_id"], "left_semi")

    def depth(which: str, i: Column, j: Column) -> Column:
        return F.get(F.col(f"depth_{which}"), (j * cells[0] + i).cast("int")).cast("double")

    def medians(used: DataFrame) -> DataFrame:
        rows = frames.join(used, ["scene_id", "ord"], "left_semi")
        return pairs.median_depths(rows.select("scene_id", "ord"), rows.select("scene_id", "ord", F.explode(F.col("depth").cast("array<double>")).alias("z")))

    chosen = config.pair_config(a.adapter, json.loads(a.selection) if a.selection else None)
    found, _ = stages.pair_gate(frames.select("scene_id", "ord", "frame_id", "pose", "depth", "image_path"), depth, medians, k, image, cells, chosen, ("depth",))
    print(json.dumps({"pairs": sinks.write_scored_pairs(stages.scored(found, frames, a.adapter), a.out, a.append)}))


def perceive(a: argparse.Namespace) -> None:
    from vistaloom import config, stages
    from vistaloom.sources import scans

    spark = session()
    settings = config.stage("perceive", a.run, {"detector": a.detector, "segmenter": a.segmenter})
    frames = scans.frames_of(*scans.load(spark, a.input)).select("scene_id", "frame_id").distinct()
    w, h = (int(x) for x in a.image_size.split("x"))
    masks, runs = stages.perceive(frames, settings, (w, h))
    masks.write.mode("overwrite").parquet(f"{a.cache}/masks")
    runs.write.mode("overwrite").parquet(f"{a.cache}/runs")


def match(a: argparse.Namespace) -> None:
    from vistaloom import config, scratch, stages
    from vistaloom.operators import match as matching
    from vistaloom.operators import skills
    from vistaloom.sources import scans, sinks

    spark = session()
    kind, found = scans.load(spark, a.input)
    if kind != "pairs":
        sys.exit(f"{a.input} holds {kind}, not pairs")
    if found.select("adapter").distinct().count() > 1:
        sys.exit("pairs of several sources; match them one by one")
    frames, k, image, _ = scene_frames(a, spark)
    masks, runs = spark.read.parquet(f"{a.cache}/masks"), spark.read.parquet(f"{a.cache}/runs")
    asked = scans.frames_of(kind, found).select("scene_id", "frame_id").distinct()
    lost = asked.join(masks.select("scene_id", "frame_id").distinct(), ["scene_id", "frame_id"], "left_anti").count()
    if lost and not a.allow_missing:
        sys.exit(f"{lost} frames have no masks in {a.cache}; run perceive on {a.input} first")
    overrides = {"max_samples_per_scene": a.max_samples_per_scene, "emit_occlusion_negatives": a.emit_occlusion_negatives, "iou_min": a.iou_min, "depth_tol": a.depth_tol}
    settings = config.stage("match", a.run, overrides)

    def save(df: DataFrame) -> DataFrame:
        path = scratch.folder(spark, "match")
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    poses = frames.select("scene_id", "frame_id", "pose")
    depth = matching.raster_depth(frames.select("scene_id", "frame_id", "width", "height", "depth"), image)
    records, rejections, manifests = stages.match(found, poses, masks, runs, depth, k, image, settings, source=a.adapter, save=save)
    counts = sinks.write_correspondences(records.withColumn("reason", F.lit(None).cast("string")).unionByName(rejections, allowMissingColumns=True), f"{a.out_root}/correspondences", a.resume)
    sinks.write_manifests(manifests, f"{a.out_root}/stage_1", tuple(skills.SKILLS))
    print(json.dumps(counts))


def load(a: argparse.Namespace) -> None:
    from vistaloom.sources import scans

    kind, rows = scans.load(session(), a.path)
    print(json.dumps({"kind": kind, "rows": rows.count(), "columns": rows.columns}))


def votes_of(a: argparse.Namespace) -> None:
    """filter: answers (scene_id, frame_id, run, answer) to verdicts; with pairs, those whose frames are usable."""
    from vistaloom.operators import votes
    from vistaloom.sources import scans, sinks

    spark = session()
    usable, reason = votes.parsed(F.col("answer"))
    runs = spark.read.json(a.answers).select("scene_id", "frame_id", "run", usable.alias("usable"), reason.alias("reason"))
    verdicts = votes.majority(runs, ["scene_id", "frame_id"])
    verdicts.write.mode("overwrite").json(f"{a.out}/verdicts.jsonl")
    if a.input:
        kind, found = scans.load(spark, a.input)
        if kind != "pairs":
            sys.exit(f"{a.input} holds {kind}, not pairs")
        named = found.withColumnsRenamed({"src_id": "ord_a", "tgt_id": "ord_b"})
        left = votes.apply_filter(named, verdicts.withColumnRenamed("frame_id", "ord")).where("reason is null").drop("reason")
        sinks.write_scored_pairs(left.withColumnsRenamed({"ord_a": "src_id", "ord_b": "tgt_id"}).select(*found.columns), f"{a.out}/pairs.scored.jsonl")


def label(a: argparse.Namespace) -> None:
    """label: answers (scene_id, frame_id, run, answer) to each frame's labels."""
    from vistaloom import config, stages
    from vistaloom.functions import salvage

    settings = config.stage("label", a.run, {"n_votes": a.n_votes})
    rows = session().read.json(a.answers).select("scene_id", "frame_id", "run", F.posexplode(salvage.label_items(F.col("answer"))).alias("item", "x"))
    items = rows.select("scene_id", "frame_id", "run", "item", F.col("x.object").alias("obj"), F.col("x.canonical").alias("canon"))
    stages.label(items, ["scene_id", "frame_id"], settings).write.mode("overwrite").json(a.out)


KEYS = ["skill", "scene_id", "frame_src", "frame_tgt"]


def verify(a: argparse.Namespace) -> None:
    from vistaloom.operators import curate
    from vistaloom.sources import scans, sinks

    spark = session()
    found = scans.manifest_tree(spark, a.out_root, a.skill)
    verdicts = spark.read.json(a.verdicts).select(*KEYS, "usable")
    sinks.write_verified(curate.verified(found, verdicts, KEYS), verdicts, KEYS, f"{a.out_root}/verified")


def balance(a: argparse.Namespace) -> None:
    from vistaloom import stages
    from vistaloom.sources import scans, sinks

    spark = session()
    verdicts = spark.read.json(a.verdicts).select(*KEYS, "usable") if a.verdicts else None
    rows, decided = stages.balance(scans.manifest_tree(spark, a.out_root, a.skill), verdicts, a.per_scene_cap, a.per_bucket_cap, a.seed)
    sinks.write_balanced(rows, decided, f"{a.out_root}/balanced")


def qc(a: argparse.Namespace) -> None:
    """qc: how often both ends of a record lie on one instance of the label rasters (<scene>/instance-filt/<frame>.png)."""
    from vistaloom.operators import curate
    from vistaloom.sources import rasters, sinks

    spark = session()
    records = spark.read.json(a.jsonl)
    at = lambda c, k: F.get(c, F.lit(k)).cast("int")
    points = records.where("visible").select("scene_id", F.col("frame_src").alias("src"), F.col("frame_tgt").alias("tgt"), at("point_src", 0).alias("us"), at("point_src", 1).alias("vs"), at("point_tgt", 0).alias("ut"), at("point_tgt", 1).alias("vt"), F.col("src_label").alias("label"))
    scenes = [r.scene_id for r in points.select("scene_id").distinct().collect()]  # one path of rasters each
    pixels = None
    for s in scenes:
        part = rasters.instance_rasters(spark, f"{a.scenes_root}/{s}/instance-filt").select(F.lit(s).alias("scene_id"), F.regexp_replace("member", r"\.png$", "").alias("frame"), "width", F.posexplode("ids").alias("p", "inst_id"))
        part = part.select("scene_id", "frame", (F.col("p") % F.col("width")).cast("int").alias("pu"), F.floor(F.col("p") / F.col("width")).cast("int").alias("pv"), F.col("inst_id").cast("long").alias("inst_id"))
        pixels = part if pixels is None else pixels.unionByName(part)
    if pixels is not None:
        sinks.write_report(curate.agreement_report(curate.agreement(points, pixels)), a.out)


def query(a: argparse.Namespace) -> None:
    from vistaloom.plans.queries import QUERIES

    if a.name not in QUERIES:
        sys.exit(f"no query {a.name!r}; there are: {' '.join(sorted(QUERIES))}")
    df = QUERIES[a.name](session(), a.sf_dir)
    if a.out:
        df.write.mode("overwrite").parquet(a.out)
    else:
        df.show(a.rows, truncate=False)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="vistaloom")
    commands = p.add_subparsers(required=True)

    def command(name: str, do, text: str, *needed: str, **optional) -> argparse.ArgumentParser:
        c = commands.add_parser(name, help=text)
        for n in needed:
            c.add_argument(n, **({"required": True} if n.startswith("--") else {}), **({"dest": "input"} if n == "--in" else {}))
        for n, kind in optional.items():
            flag = "--" + n.replace("_", "-")
            if kind is bool:
                c.add_argument(flag, action=argparse.BooleanOptionalAction)
            elif kind is list:
                c.add_argument(flag, nargs="*")
            else:
                c.add_argument(flag, **({"type": kind} if isinstance(kind, type) else {"type": type(kind), "default": kind}))
        c.set_defaults(do=do)
        return c

    command("sample", sample, "keyframes of scene folders", "--scenes-root", "--out", adapter="scannet", run=str, sampling=str, frame_stride=int, limit_frames=int)
    command("pair_gate", pair_gate, "pairs of frames that see enough in common", "--in", "--scenes-root", "--out", adapter="scannet", image_size="640x480", selection=str, append=bool)
    command("filter", votes_of, "verdicts on frames from answers, and the pairs left", "--answers", "--out").add_argument("--in", dest="input")
    command("label", label, "labels of frames from answers", "--answers", "--out", run=str, n_votes=int)
    command("perceive", perceive, "masks of the frames of an artifact", "--in", "--cache", run=str, detector=str, segmenter=str, image_size="640x480")
    command("match", match, "correspondences and manifests of pairs", "--in", "--scenes-root", "--cache", "--out-root", adapter="scannet", run=str, image_size="640x480", max_samples_per_scene=int, emit_occlusion_negatives=bool, iou_min=float, depth_tol=float, resume=bool, allow_missing=bool)
    command("verify", verify, "manifests that a verifier accepts", "--out-root", "--verdicts", skill=list)
    command("balance", balance, "quotas over manifests", "--out-root", skill=list, verdicts=str, per_scene_cap=int, per_bucket_cap=int, seed=0)
    command("qc", qc, "agreement of records with ground truth", "--jsonl", "--scenes-root", "--out")
    command("load", load, "what kind of artifact a path holds", "path")
    command("query", query, "a query over driver tables", "name", "--sf-dir", out=str, rows=20)
    a = p.parse_args(argv)
    a.do(a)


if __name__ == "__main__":
    main()
