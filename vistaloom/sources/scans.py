"""Readers of scene folders and of the files that stages leave, and filters on their rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vistaloom.functions import text as tx

#: What a pair manifest must have.
REQUIRED = ("skill", "scene_id", "frame_src", "frame_tgt", "image_src", "image_tgt")
MANIFEST = "skill string, scene_id string, frame_src string, frame_tgt string, image_src string, image_tgt string, dataset_source string, evidence string"
SCORED = (
    "adapter string, scene_id string, src_id string, tgt_id string, image_src string, image_tgt string, overlap double, occluded_frac double, "
    "angle_deg double, distance_m double, quality double, median_depth_src double, median_depth_tgt double, tasks array<string>"
)
FRAME = "adapter string, scene_id string, frame_id string, image_path string"


def complete() -> Column:
    out = F.lit(True)
    for c in REQUIRED:
        out &= F.col(c).isNotNull()
    return out


def collected(manifests: DataFrame, skills: list[str] | None = None) -> DataFrame:
    """Manifests with all required keys, of some skills or all."""
    rows = manifests.where(complete())
    return rows if skills is None else rows.where(F.col("skill").isin(*skills))


def tolerant_json(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """JSON lines by a schema; blank and malformed lines are left out."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = F.from_json("value", f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    return lines.select(parsed.alias("r")).where("r is not null and r._bad is null").select("r.*").drop("_bad")


def strict_json(spark: SparkSession, path: str, schema: str = SCORED) -> DataFrame:
    """JSON lines by a schema; a malformed line raises an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def frames_json(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of frame references, or a folder of them as JSON lines; a name with a slash is an error."""
    rows = spark.read.schema(FRAME).option("multiLine", _entries(spark, path) == [""]).option("mode", "FAILFAST").json(path)
    bad = F.concat_ws(" ", "adapter", "scene_id", "frame_id").rlike(r"[/\\]")
    return rows.where(F.when(bad, F.raise_error(F.lit("a frame key holds a slash"))).otherwise(F.lit(True)))


def _entries(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, by Hadoop's file systems, so that any store that Spark reads will do."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        raise FileNotFoundError(path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop)) if fs.getFileStatus(hadoop).isDirectory() else [""]


def manifest_tree(spark: SparkSession, root: str, skills: list[str] | None = None) -> DataFrame:
    """Manifests of <root>/<skill>/pairs.jsonl, in any number of skills."""
    try:
        found = [n for n in _entries(spark, root) if (skills is None or n in skills) and "pairs.jsonl" in _entries(spark, f"{root}/{n}")]
    except FileNotFoundError:
        found = []
    if not found:
        return spark.createDataFrame([], MANIFEST)
    return collected(tolerant_json(spark, [f"{root}/{n}/pairs.jsonl" for n in found], MANIFEST), skills)


def load(spark: SparkSession, path: str) -> tuple[str, DataFrame]:
    """(kind, rows) of a stage's artifact, told by its name and first row: frames, pairs, manifests or unknown.

    An artifact is a file, or a folder that Spark wrote. A folder whose name has no such ending is searched for frames.json,
    pairs.scored.jsonl and pairs.jsonl, in this order; one with Spark's part files is an artifact, told by its first row.
    """
    names = _entries(spark, path)
    parts = any(n.startswith("part-") for n in names)
    ending = path.rstrip("/").rpartition("/")[2].rpartition(".")[2]
    if names != [""] and not parts and ending not in ("json", "jsonl"):
        for n in ("frames.json", "pairs.scored.jsonl", "pairs.jsonl"):
            if n in names:
                return load(spark, f"{path}/{n}")
        raise ValueError(f"no artifact of a stage in {path}")
    if ending == "json":
        return "frames", frames_json(spark, path)
    if ending != "jsonl" and not parts:
        raise ValueError(f"unknown kind of file: {path}")
    first = spark.read.text(path).where(F.trim("value") != "").select(F.json_object_keys("value").alias("k")).take(1)
    if not first:
        return "unknown", spark.createDataFrame([], SCORED)
    keys = set(first[0].k or [])
    if {"skill", "frame_src", "frame_tgt"} <= keys:
        return "manifests", tolerant_json(spark, path, MANIFEST)
    if {"src_id", "tgt_id", "overlap"} <= keys:
        return "pairs", strict_json(spark, path)
    if {"adapter", "scene_id", "frame_id", "image_path"} <= keys:
        return "frames", frames_json(spark, path)
    raise ValueError(f"rows of an unknown kind in {path}")


def frames_of(kind: str, rows: DataFrame) -> DataFrame:
    """The distinct frames of an artifact."""
    if kind == "frames":
        return rows.distinct()
    src, tgt, adapter = ("src_id", "tgt_id", "adapter") if kind == "pairs" else ("frame_src", "frame_tgt", "dataset_source")
    side = lambda i, p: F.struct(F.col(adapter).alias("adapter"), "scene_id", F.col(i).alias("frame_id"), F.col(p).alias("image_path"))
    return rows.select(F.inline(F.array(side(src, "image_src"), side(tgt, "image_tgt")))).distinct()


def vocabulary(lines: DataFrame, most: int | None = None) -> DataFrame:
    """(place, name) of lines (place, value) without comments and blanks; the first `most`."""
    rows = lines.select("place", tx.without_comment(F.col("value")).alias("name")).where("name <> ''")
    return rows if most is None else rows.orderBy("place").limit(most)


def scene_images(spark: SparkSession, root: str, kinds: tuple[str, ...] = ("jpg",)) -> DataFrame:
    """(scene_id, frame_id, frame_no, image_path) of <root>/<scene>/color/<number>.<kind>; names that aren't numbers have no frame_no."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    form = r"/([^/]+)/color/([^/]+)\.(" + "|".join(kinds) + ")$"
    rows = files.where(F.col("path").rlike(form))
    stem = F.regexp_extract("path", form, 2)
    return rows.select(F.regexp_extract("path", form, 1).alias("scene_id"), stem.alias("frame_id"), stem.try_cast("int").alias("frame_no"), F.col("path").alias("image_path"))


def scene_poses(spark: SparkSession, root: str) -> DataFrame:
    """(scene_id, frame_id, pose) of <root>/<scene>/pose/<id>.txt: poses alone, without a look at depth."""
    files = spark.read.text(root, wholetext=True, recursiveFileLookup=True).select("value", F.col("_metadata.file_path").alias("path"))
    form = r"/([^/]+)/pose/([^/]+)\.txt$"
    rows = files.where(F.col("path").rlike(form))
    return rows.select(F.regexp_extract("path", form, 1).alias("scene_id"), F.regexp_extract("path", form, 2).alias("frame_id"), tx.matrix(F.col("value")).alias("pose"))


def intrinsics(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """((scene_id, k), (scene_id, frame_id, k)): camera matrices of scenes, and of single frames where there are any."""
    files = spark.read.text(root, wholetext=True, recursiveFileLookup=True).select("value", F.col("_metadata.file_path").alias("path"))
    whole, single = r"/([^/]+)/intrinsic/[^/]*color[^/]*\.txt$", r"/([^/]+)/intrinsic_per_frame/([^/]+)\.txt$"
    scenes = files.where(F.col("path").rlike(whole)).select(F.regexp_extract("path", whole, 1).alias("scene_id"), tx.matrix(F.col("value")).alias("k"))
    frames = files.where(F.col("path").rlike(single)).select(F.regexp_extract("path", single, 1).alias("scene_id"), F.regexp_extract("path", single, 2).alias("frame_id"), tx.matrix(F.col("value")).alias("k"))
    return scenes, frames


def with_intrinsics(frames: DataFrame, scenes: DataFrame, single: DataFrame) -> DataFrame:
    """frames with k: the frame's own camera matrix, else its scene's."""
    own = single.select("scene_id", "frame_id", F.col("k").alias("own_k"))
    usual = scenes.select("scene_id", F.col("k").alias("usual_k"))
    return frames.join(own, ["scene_id", "frame_id"], "left").join(usual, "scene_id", "left").withColumn("k", F.coalesce("own_k", "usual_k")).drop("own_k", "usual_k")


def aggregation(spark: SparkSession, path: str) -> DataFrame:
    """(inst_id, label) of a scene's segment groups; instances count from 1."""
    rows = spark.read.schema("segGroups array<struct<objectId:int,label:string>>").option("multiLine", True).json(path)
    return rows.select(F.explode("segGroups").alias("s")).select((F.col("s.objectId") + 1).alias("inst_id"), "s.label")


def scannetpp(spark: SparkSession, root: str) -> DataFrame:
    raise NotImplementedError("the layout of this source is not read yet")


IMAGE_KINDS = {"scannet": ("jpg",), "matterport": ("jpg", "jpeg", "png")}


def full_frames(spark: SparkSession, root: str, source: str) -> DataFrame:
    """Frames of scene folders with all that they have: image_path, pose, k, and the depth raster in metres with its size.

    A pose with a value that isn't finite is all NaN; a frame without a pose file has none. k is the frame's own camera
    matrix where the source has such, else the scene's. Listing, poses and rasters are scans of their own, so that a plan
    that needs poses only reads poses only.
    """
    if source not in IMAGE_KINDS:
        return scannetpp(spark, root)
    from vistaloom.sources import rasters

    keys = ["scene_id", "frame_id"]
    poses = scene_poses(spark, root)
    sound = F.forall("pose", lambda x: ~F.isnan(x) & (F.abs(x) < float("inf")))
    poses = poses.withColumn("pose", F.when(sound, F.col("pose")).otherwise(F.transform("pose", lambda x: F.lit(float("nan")))))
    found = scene_images(spark, root, IMAGE_KINDS[source]).join(poses, keys, "left")
    return with_intrinsics(found, *intrinsics(spark, root)).join(rasters.depth_rasters(spark, root, source), keys, "left")


#: Sources by name: a function of (spark, root) that gives frames. A new source is an entry.
ADAPTERS = {
    "scannet": lambda spark, root: full_frames(spark, root, "scannet"),
    "matterport": lambda spark, root: full_frames(spark, root, "matterport"),
    "scannet++": scannetpp,
}


def frames_of_source(spark: SparkSession, name: str, root: str) -> DataFrame:
    if name not in ADAPTERS:
        raise KeyError(f"no source {name!r}; there are {sorted(ADAPTERS)}")
    return ADAPTERS[name](spark, root)
