"""Sources, sinks, model hooks and streams over files that are made from the driver's tables, with their SQL.

A query writes what a scene folder or an artifact would hold below the shared folder, and reads it back with the operator.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vistaloom import config, models, scratch
from vistaloom.operators import emit, vision
from vistaloom.plans.curate_queries import CAP, EMIT, H, W
from vistaloom.plans.registry import Tables, query
from vistaloom.sources import rasters, scans, sinks
from vistaloom.streaming import incremental


def put_files(files: DataFrame, root: str) -> None:
    """Writes rows (path, content) as files below root."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(root)
        n = 0
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                fs.create_dir(f"{base}/{path}".rpartition("/")[0], recursive=True)
                with fs.open_output_stream(f"{base}/{path}") as out:
                    out.write(content)
                n += 1
        yield pa.record_batch([pa.array([n], pa.int64())], names=["n"])

    files.select("path", "content").mapInArrow(put, "n long").agg(F.sum("n")).collect()


def png_rows(rows: DataFrame, top: str) -> DataFrame:
    """(path, content) of rasters of 8 by 6 cells for rows (scene, frame): cell p of row-major order has the value (p * 37 + frame * 11) mod 5 * `unit` below top."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            paths, contents = [], []
            for scene, frame in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                values = (np.arange(48) * 37 + frame * 11) % 5
                raster = (values * 1000).astype(np.uint16) if top == "depth" else values.astype(np.uint8)
                paths.append(f"scene{scene}/{top}/{10 * frame}.png")
                contents.append(rasters.write_png(raster.reshape(6, 8)))
            yield pa.record_batch([pa.array(paths), pa.array(contents, pa.binary())], names=["path", "content"])

    return rows.select(F.col("scene").cast("long"), F.col("frame").cast("long")).mapInArrow(made, "path string, content binary")


def scene_tree(t: Tables, parts: tuple[str, ...]) -> str:
    """Scene folders: a scene per region, a frame per nation, whose pose stands at (nation, region, 1.5)."""
    root = scratch.folder(t.spark, "scenes")
    f = t.nation.select(F.col("n_regionkey").alias("scene"), F.col("n_nationkey").alias("frame"), F.concat(F.lit("scene"), F.col("n_regionkey").cast("string")).alias("dir"))
    name = (F.col("frame") * 10).cast("string")
    file = lambda df, path, text: df.select(path.alias("path"), F.encode(text, "UTF-8").alias("content"))
    spoilt = F.when(F.col("frame") % 7 == 3, "nan").otherwise(F.col("frame").cast("string"))
    wanted = {
        "color": lambda: file(f, F.concat("dir", F.lit("/color/"), name, F.lit(".jpg")), F.lit("x")),
        "pose": lambda: file(f, F.concat("dir", F.lit("/pose/"), name, F.lit(".txt")), F.concat(F.lit("1 0 0 "), spoilt, F.lit("\n0 1 0 "), F.col("scene").cast("string"), F.lit("\n0 0 1 1.5\n0 0 0 1\n"))),
        "depth": lambda: png_rows(f, "depth"),
        "instance-filt": lambda: png_rows(f, "instance-filt"),
        "intrinsic": lambda: file(t.region.select(F.concat(F.lit("scene"), F.col("r_regionkey").cast("string"), F.lit("/intrinsic/intrinsic_color.txt")).alias("p"), "r_regionkey"), F.col("p"), F.concat(F.lit("50"), F.col("r_regionkey").cast("string"), F.lit(" 0 320\n0 500 240\n0 0 1"))),
        "intrinsic_per_frame": lambda: file(f.where("frame % 5 = 2"), F.concat("dir", F.lit("/intrinsic_per_frame/"), name, F.lit(".txt")), F.concat(F.lit("70"), F.col("frame").cast("string"), F.lit(",0,320,0,500,240,0,0,1"))),
    }
    for p in parts:
        put_files(wanted[p](), root)
    return root


FRAME_SQL = "select 'scene' || n_regionkey scene_id, (10 * n_nationkey)::varchar frame_id, n_nationkey n, n_regionkey r from nation"


@query("s2_scene_listing", f"select scene_id, frame_id, (10 * n)::int frame_no, row_number() over (partition by scene_id order by n) place from ({FRAME_SQL})")
def s2(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    found = scans.scene_images(t.spark, scene_tree(t, ("color", "pose")))
    return found.select("scene_id", "frame_id", "frame_no", F.row_number().over(Window.partitionBy("scene_id").orderBy("frame_no")).cast("long").alias("place"))


def depth_at(p: int) -> str:
    return f"(({p} * 37 + n * 11) % 5)"


FULL = f"""select scene_id, frame_id, n % 7 = 3 lost, case when n % 7 <> 3 then n::double end px, {{k}} fx, 8 width, round({depth_at(0)} * {{s}}, 4) z0, round({depth_at(29)} * {{s}}, 4) z29 from ({FRAME_SQL})"""


def full(t: Tables, source: str) -> DataFrame:
    parts = ("color", "pose", "depth", "intrinsic") + (("intrinsic_per_frame",) if source == "matterport" else ())
    found = scans.frames_of_source(t.spark, source, scene_tree(t, parts))
    z = lambda p: F.round(F.get("depth", F.lit(p)).cast("double"), 4)
    lost = F.exists("pose", F.isnan)
    return found.select("scene_id", "frame_id", lost.alias("lost"), F.when(~lost, F.get("pose", F.lit(3))).alias("px"), F.get("k", F.lit(0)).alias("fx"), "width", z(0).alias("z0"), z(29).alias("z29"))


@query("s3_full_frames", FULL.format(k="(500 + r)::double", s="1.0::double"))
def s3(t: Tables) -> DataFrame:
    return full(t, "scannet")


@query("s5_own_intrinsics", FULL.format(k="case when n % 5 = 2 then ('70' || n)::double else (500 + r)::double end", s="0.25::double"))
def s5(t: Tables) -> DataFrame:
    return full(t, "matterport")


@query("s1_source_registry", "select * from (values ('matterport', true), ('scannet', true), ('scannet++', false)) v(source, reads)")
def s1(t: Tables) -> DataFrame:
    """Every source by its name; one of them says that it isn't read."""
    root, out = scene_tree(t, ("color", "pose", "depth", "intrinsic")), []
    for name in sorted(scans.ADAPTERS):
        try:
            out.append((name, not scans.frames_of_source(t.spark, name, root).isEmpty()))
        except NotImplementedError:
            out.append((name, False))
    return t.spark.createDataFrame(out, "source string, reads boolean")


@query("s4_pose_scan", f"select scene_id, frame_id, case when n % 7 = 3 then null else n::double end x, r::double y, 1.5::double z from ({FRAME_SQL})")
def s4(t: Tables) -> DataFrame:
    p = scans.scene_poses(t.spark, scene_tree(t, ("pose",)))
    x, y, z = (F.get("pose", F.lit(k)) for k in (3, 7, 11))
    return p.select("scene_id", "frame_id", F.when(~F.isnan(x), x).alias("x"), y.alias("y"), z.alias("z"))


@query("s9_instance_rasters", f"select scene_id, frame_id || '.png' member, ((p * 37 + n * 11) % 5)::bigint inst_id, count(*) n_px, min(p % 8)::int left_, max(p // 8)::int bottom from ({FRAME_SQL}), range(48) t(p) group by all")
def s9(t: Tables) -> DataFrame:
    """Label rasters of a folder for two scenes, and from zip files for the others; a broken zip gives nothing."""
    import io
    import zipfile

    root = scene_tree(t, ("instance-filt",))
    images = t.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.png").load(root).select(F.regexp_extract("path", r"/(scene\d+)/", 1).alias("scene"), F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "content")

    def zipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for files in b.column(1).to_pylist():
                sink = io.BytesIO()
                with zipfile.ZipFile(sink, "w") as z:
                    for x in files:
                        z.writestr(f"instance-filt/{x['name']}", x["content"])
                out.append(sink.getvalue())
            yield pa.record_batch([pa.array([f"zips/{s}/labels.zip" for s in b.column(0).to_pylist()]), pa.array(out, pa.binary())], names=["path", "content"])

    put_files(images.groupBy("scene").agg(F.collect_list(F.struct("name", "content")).alias("files")).mapInArrow(zipped, "path string, content binary"), root)
    put_files(t.spark.createDataFrame([("zips/scene0/broken.zip", bytearray(b"PK not a zip"))], "path string, content binary"), root)
    out = None
    for (k,) in t.region.select("r_regionkey").collect():
        path = f"{root}/scene{k}/instance-filt" if k < 2 else f"{root}/zips/scene{k}"
        part = rasters.instance_rasters(t.spark, path).select(F.lit(f"scene{k}").alias("scene_id"), "member", "width", F.posexplode("ids").alias("p", "inst_id"))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("scene_id", "member", F.col("inst_id").cast("long").alias("inst_id")).agg(F.count(F.lit(1)).alias("n_px"), F.min((F.col("p") % F.col("width")).cast("int")).alias("left_"), F.max(F.floor(F.col("p") / F.col("width")).cast("int")).alias("bottom"))


SCORED_SQL = """select 'lifted' adapter, scene_id, pair_id::varchar src_id, (pair_id + 1)::varchar tgt_id, overlap, occluded occluded_frac, rotation angle_deg, array_to_string(case when pair_id % 3 = 0 then ['anchor', 'counting'] else ['zeta'] end, ',') tasks from l_pairs"""


def scored_pairs(t: Tables) -> DataFrame:
    p = t.lift("l_pairs")
    num = lambda c: F.col(c).cast("double")
    return p.select(
        F.lit("lifted").alias("adapter"), "scene_id", F.col("pair_id").cast("string").alias("src_id"), (F.col("pair_id") + 1).cast("string").alias("tgt_id"), F.lit("a.jpg").alias("image_src"), F.lit("b.jpg").alias("image_tgt"),
        num("overlap").alias("overlap"), num("occluded").alias("occluded_frac"), num("rotation").alias("angle_deg"), num("translation").alias("distance_m"), F.lit(0.5).alias("quality"), F.lit(1.0).alias("median_depth_src"), F.lit(2.0).alias("median_depth_tgt"),
        F.when(F.col("pair_id") % 3 == 0, F.array(F.lit("counting"), F.lit("anchor"))).otherwise(F.array(F.lit("zeta"))).alias("tasks"),
    )


def told(rows: DataFrame) -> DataFrame:
    return rows.select("adapter", "scene_id", "src_id", "tgt_id", "overlap", "occluded_frac", "angle_deg", F.array_join("tasks", ",").alias("tasks"))


@query("k7_scored_writer", SCORED_SQL)
def k7(t: Tables) -> DataFrame:
    path = f"{scratch.folder(t.spark, 'scored')}/pairs.scored.jsonl"
    n = sinks.write_scored_pairs(scored_pairs(t), path)
    found = scans.strict_json(t.spark, path)
    return told(found) if n == t.orders.count() else told(found).limit(0)


@query("s12_strict_scan", "select 'raised' outcome, count(*) n from orders")
def s12(t: Tables) -> DataFrame:
    """A sound file is read whole; with one malformed line the scan raises."""
    path = f"{scratch.folder(t.spark, 'strict')}/pairs.scored.jsonl"
    sinks.write_scored_pairs(scored_pairs(t), path)
    n = scans.strict_json(t.spark, path).count()
    t.spark.createDataFrame([('{"adapter": ',)], "value string").write.mode("append").text(path)
    try:
        scans.strict_json(t.spark, path).write.format("noop").mode("overwrite").save()
        outcome = "read"
    except Exception:  # noqa: BLE001  what the query tells
        outcome = "raised"
    return t.spark.createDataFrame([(outcome, n)], "outcome string, n long")


REFS = "select 'lifted' adapter, scene_id, frame_no::varchar frame_id, scene_id || '/' || frame_no || '.jpg' image_path from l_frames"


def refs(t: Tables) -> DataFrame:
    f = t.lift("l_frames").select("scene_id", F.col("frame_no").cast("string").alias("frame_id"))
    return f.select(F.lit("lifted").alias("adapter"), "scene_id", "frame_id", F.concat_ws("", "scene_id", F.lit("/"), "frame_id", F.lit(".jpg")).alias("image_path"))


@query("k9_frames_writer", REFS)
def k9(t: Tables) -> DataFrame:
    """One JSON array, read back."""
    path = f"{scratch.folder(t.spark, 'frames')}/frames.json"
    sinks.write_frames(refs(t), path)
    return scans.frames_json(t.spark, path)


@query("s13_frames_scan", REFS)
def s13(t: Tables) -> DataFrame:
    """A folder of JSON lines, told by its rows."""
    path = f"{scratch.folder(t.spark, 'frames')}/written"
    sinks.write_frames(refs(t), path)
    kind, rows = scans.load(t.spark, path)
    return rows if kind == "frames" else rows.limit(0)


@query("s14_artifact_kinds", "select * from (values ('frames', 'frames.json'), ('manifests', 'pairs.jsonl'), ('pairs', 'pairs.scored.jsonl'), ('pairs', 'folder'), ('unknown', 'empty.jsonl'), ('ValueError', 'odd.jsonl'), ('ValueError', 'odd.txt'), ('FileNotFoundError', 'none.jsonl')) v(kind, path)")
def s14(t: Tables) -> DataFrame:
    root = scratch.folder(t.spark, "artifacts")
    manifest = json.dumps({c: "x" for c in scans.REQUIRED})
    texts = {"pairs.jsonl": manifest, "empty.jsonl": "\n", "odd.jsonl": '{"a": 1}', "odd.txt": "x", "folder/pairs.jsonl": manifest}
    put_files(t.spark.createDataFrame([(k, bytearray(v.encode())) for k, v in texts.items()], "path string, content binary"), root)
    sinks.write_frames(refs(t).limit(3), f"{root}/frames.json")
    for p in ("pairs.scored.jsonl", "folder/pairs.scored.jsonl"):
        sinks.write_scored_pairs(scored_pairs(t).limit(3), f"{root}/{p}")
    out = []
    for p in ("frames.json", "pairs.jsonl", "pairs.scored.jsonl", "folder", "empty.jsonl", "odd.jsonl", "odd.txt", "none.jsonl"):
        try:
            out.append((scans.load(t.spark, f"{root}/{p}")[0], p))
        except (ValueError, FileNotFoundError) as e:
            out.append((type(e).__name__, p))
    return t.spark.createDataFrame(out, "kind string, path string")


LEDGER = f"with {EMIT}"


@query("k1_correspondence_writer", LEDGER + " select coalesce(reason, 'emitted') reason, scene_id, count(*) n, sum(pair_id)::bigint pairs from emitted group by all")
def k1(t: Tables) -> DataFrame:
    """Records and, beside them, the ledger of rejections, read back."""
    path = scratch.folder(t.spark, "correspondences")
    sinks.write_correspondences(emit.emitted(t.lift("l_matches"), W, H, CAP), path)
    both = t.spark.read.json(f"{path}/records").withColumn("reason", F.lit("emitted")).select("reason", "scene_id", "pair_id")
    both = both.unionByName(t.spark.read.schema("reason string, scene_id string, pair_id long").json(f"{path}/rejected"))
    return both.groupBy("reason", "scene_id").agg(F.count(F.lit(1)).alias("n"), F.sum("pair_id").alias("pairs"))


@query("t1_resumed_writer", LEDGER + " select scene_id, 2 * count(*) n from emitted where reason is null group by scene_id")
def t1(t: Tables) -> DataFrame:
    """A resumed writer appends, and its voxels begin anew: the same records come twice."""
    path = scratch.folder(t.spark, "resumed")
    for resume in (False, True):
        sinks.write_correspondences(emit.emitted(t.lift("l_matches"), W, H, CAP), path, resume)
    return t.spark.read.json(f"{path}/records").groupBy("scene_id").agg(F.count(F.lit(1)).alias("n"))


@query("k15_trace_writer", "select 'frames' stage, count(*) n, sum(ord)::bigint total from l_frames union all select 'pairs', count(*), sum(pair_id)::bigint from l_pairs")
def k15(t: Tables) -> DataFrame:
    path = scratch.folder(t.spark, "trace")
    sinks.write_trace({"frames": t.lift("l_frames").select("scene_id", F.col("ord").alias("x")), "pairs": t.lift("l_pairs").select("scene_id", F.col("pair_id").alias("x"))}, path)
    x = F.get_json_object("payload", "$.x").cast("long")
    return t.spark.read.schema("stage string, payload string").json(path).groupBy("stage").agg(F.count(F.lit(1)).alias("n"), F.sum(x).alias("total"))


@query("k16_whole_or_absent", "select scene_id, count(*) n from l_frames group by scene_id")
def k16(t: Tables) -> DataFrame:
    """A write that fails leaves the cache as it was: no part of it is read."""
    path = f"{scratch.folder(t.spark, 'cache')}/masks"
    f = t.lift("l_frames").select("scene_id", "ord")
    f.write.parquet(path)
    bad = F.when(F.col("ord") % 2 == 1, F.raise_error(F.lit("lost"))).otherwise(F.col("ord")).cast(f.schema["ord"].dataType)
    try:
        f.select("scene_id", bad.alias("ord")).write.mode("append").parquet(path)
    except Exception:  # noqa: BLE001, S110  the failure is what the query is about
        pass
    return t.spark.read.parquet(path).groupBy("scene_id").agg(F.count(F.lit(1)).alias("n"))


def by_rule(rows: DataFrame, rule, result: str) -> DataFrame:
    """rows with the result of a function of a row as a dict, in batches."""
    names = rows.columns

    def run(batches):
        for b in batches:
            yield b.assign(result=[rule(r) for r in b.to_dict("records")])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInPandas(run, f"{fields}, result {result}").select(*names, "result")


@query("p24_comment_stripping", """select r_regionkey, '{"a": {"b": [{"n": ' || r_regionkey || '}]}, "c": "_kept"}' text from region""")
def p24(t: Tables) -> DataFrame:
    given = F.format_string('{"_note": "x", "a": {"_y": 1, "b": [{"_z": [1], "n": %d}]}, "c": "_kept"}', "r_regionkey")
    return by_rule(t.region.select("r_regionkey", given.alias("given")), lambda r: json.dumps(config.load(r["given"])), "string").select("r_regionkey", F.col("result").alias("text"))


@query("f36_merged_settings", """select r_regionkey, '{"a": {"b": 9, "c": ' || r_regionkey || '}, "d": [2], "e": 5}' text from region""")
def f36(t: Tables) -> DataFrame:
    rule = lambda r: json.dumps(config.merged({"a": {"b": 1, "c": r["r_regionkey"]}, "d": [1, 1], "e": 5}, {"a": {"b": 9}, "d": [2]}), sort_keys=True)
    return by_rule(t.region.select("r_regionkey"), rule, "string").select("r_regionkey", F.col("result").alias("text"))


@query("s17_prompt_files", "select r_regionkey, 'ask ' || r_name body from region")
def s17(t: Tables) -> DataFrame:
    named = F.when(F.col("r_regionkey") % 2 == 0, "a.txt").otherwise("a.json")
    text = F.concat(F.lit("ask "), "r_name")
    given = t.region.select("r_regionkey", named.alias("name"), F.when(named == "a.txt", text).otherwise(F.to_json(F.struct(text.alias("prompt"), F.lit(1).alias("other")))).alias("text"))
    return by_rule(given, lambda r: config.prompt_text(r["text"], r["name"]), "string").select("r_regionkey", F.col("result").alias("body"))


def answering():
    """A model that fails at first for some rows, always for others, and gives nothing for others still."""
    calls: dict[int, int] = {}

    def call(row):
        k = row["id"]
        calls[k] = calls.get(k, 0) + 1
        if k % 7 == 0 or (k % 5 == 0 and calls[k] < 3):
            raise RuntimeError("down")
        return f"r{k}" if k % 11 else None

    return call


ANSWERS = "select o_orderkey id, case when o_orderkey % 7 <> 0 and o_orderkey % 11 <> 0 then 'r' || o_orderkey end result, case when o_orderkey % 7 = 0 or o_orderkey % 11 = 0 or o_orderkey % 5 = 0 then 3 else 1 end attempts from orders"


def tried(t: Tables, concurrency: int) -> DataFrame:
    return models.applied(t.orders.select(F.col("o_orderkey").alias("id")), answering, "string", 3, concurrency)


@query("x20_retries", ANSWERS)
def x20(t: Tables) -> DataFrame:
    return tried(t, 1).select("id", "result", "attempts")


@query("x19_fan_out", f"select id, result from ({ANSWERS})")
def x19(t: Tables) -> DataFrame:
    return tried(t, 8).select("id", "result")


def two_boxes():
    return lambda f: [{"det": k, "label": f"l{k}", "canonical": "", "score": 0.9 - 0.1 * k, "x0": float(f["ord"] % 50), "y0": 10.0 * k, "x1": float(f["ord"] % 50 + 20), "y1": 10.0 * k + 8} for k in range(2)]


def boxes_as_masks():
    def call(f):
        return [
            {"mask": d["det"], "label": d["label"], "canonical": "", "score": d["score"], "x0": d["x0"], "y0": d["y0"], "x1": d["x1"], "y1": d["y1"], "cu": (d["x0"] + d["x1"]) / 2, "cv": (d["y0"] + d["y1"]) / 2, "runs": [{"v": v, "u0": int(d["x0"]), "u1": int(d["x1"])} for v in range(int(d["y0"]), int(d["y1"]))]}
            for d in f["detections"]
        ]

    return call


@query("x3_detector_hook", "select scene_id, ord, k::int det, 'l' || k label, (ord % 50)::double x0, (ord % 50 + 20)::double x1 from l_frames, range(2) t(k)")
def x3(t: Tables) -> DataFrame:
    return models.detect(t.lift("l_frames").select("scene_id", "ord"), two_boxes).select("scene_id", "ord", "det", "label", "x0", "x1")


@query("x4_segmenter_hook", "select scene_id, ord, k::int mask, 160::bigint area, (ord % 50 + 10)::double cu from l_frames, range(2) t(k)")
def x4(t: Tables) -> DataFrame:
    frames = t.lift("l_frames").select("scene_id", "ord", F.col("event_id").cast("string").alias("frame_id"))  # tells frames apart where users share a scene
    found = models.segment(frames, models.detect(frames, two_boxes), boxes_as_masks)
    area = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["u1"] - r["u0"])
    return found.select("scene_id", "ord", "mask", area.alias("area"), "cu")


@query("x22_registries", "select * from (values ('detector', 'noop'), ('model', 'rule'), ('sampler', 'adaptive'), ('sampler', 'stride'), ('segmenter', 'noop'), ('source', 'matterport'), ('source', 'scannet'), ('source', 'scannet++'), ('unknown', 'KeyError')) v(kind, name)")
def x22(t: Tables) -> DataFrame:
    from vistaloom.operators import sampling

    models.register(models.ModelSpec("rule", "none"), answering)
    held = {"detector": models.DETECTORS, "segmenter": models.SEGMENTERS, "source": scans.ADAPTERS, "sampler": sampling.SAMPLERS, "model": {"rule": models.resolve("rule")}}
    rows = [(k, n) for k, names in held.items() for n in names]
    try:
        models.resolve("nothing of this name")
    except KeyError as e:
        rows.append(("unknown", type(e).__name__))
    return t.spark.createDataFrame(rows, "kind string, name string")


def masks_with_boxes(t: Tables) -> DataFrame:
    return vision.rectangle_masks(t.lift("l_near"), W, H).withColumnRenamed("det", "mask")


SEGMENTED = f"""with recursive rects as (select *, greatest(0, least({W}, round_even(x0, 0)::int)) m0, greatest(0, least({H}, round_even(y0, 0)::int)) n0, greatest(0, least({W}, round_even(x1, 0)::int)) m1, greatest(0, least({H}, round_even(y1, 0)::int)) n1 from l_near),
big as (select * from rects where (m1 - m0) * (n1 - n0) >= floor(0.05 * {W * H})), ranked as (select *, row_number() over (partition by frame order by score desc, det) n from big), step as (
  select frame, n, [{{'m0': m0, 'n0': n0, 'm1': m1, 'n1': n1}}] kept, true keep from ranked where n = 1
  union all
  select frame, n, case when ok then list_append(kept, {{'m0': m0, 'n0': n0, 'm1': m1, 'n1': n1}}) else kept end, ok from (
    select r.*, s.kept, len(list_filter(s.kept, lambda k: greatest(0, least(k.m1, r.m1) - greatest(k.m0, r.m0)) * greatest(0, least(k.n1, r.n1) - greatest(k.n0, r.n0)) >= 0.4 * ((k.m1 - k.m0) * (k.n1 - k.n0) + (r.m1 - r.m0) * (r.n1 - r.n0)
      - greatest(0, least(k.m1, r.m1) - greatest(k.m0, r.m0)) * greatest(0, least(k.n1, r.n1) - greatest(k.n0, r.n0))))) = 0 ok from step s join ranked r on r.frame = s.frame and r.n = s.n + 1)
) select r.frame, r.det mask, row_number() over (partition by r.frame order by n) place from ranked r join step using (frame, n) where keep"""


@query("x12_segmenter_tail", SEGMENTED)
def x12(t: Tables) -> DataFrame:
    """What a segmenter's masks go through: the floor on their area and on what they share with their box, then suppression."""
    from vistaloom.functions import geometry as g

    rows = masks_with_boxes(t)
    mask = [F.col(c).cast("double") for c in ("m0", "n0", "m1", "n1")]
    kept = rows.where((F.col("area") >= int(0.05 * W * H)) & (g.box_iou(mask, vision.box()) >= 0.5))
    found = vision.suppressed_masks(vision.bands(kept, ["frame"], ("score",), empty=True), ["frame"], 0.4)
    return found.withColumn("place", F.col("place").cast("long"))


def streamed(t: Tables, rows: DataFrame, name: str, parts: int = 3) -> tuple[DataFrame, str]:
    """rows as a stream of files, and a folder for what comes of it."""
    root = scratch.folder(t.spark, name)
    rows.repartition(parts).write.mode("overwrite").parquet(f"{root}/in")
    return t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in"), root


@query("t4_stream_dedup", "select scene_id, visible, floor(x / 0.05)::bigint vx, floor(y / 0.05)::bigint vy, floor(z / 0.05)::bigint vz, 1::bigint n from l_matches group by all")
def t4(t: Tables) -> DataFrame:
    """First arrivals in each voxel, over batches: one record each, whichever came first."""
    rows = t.lift("l_matches").select("scene_id", "visible", *[F.col(c).cast("double").alias(c) for c in "xyz"])
    stream, root = streamed(t, rows, "voxels")
    incremental.first_in_voxel(stream).writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.parquet(f"{root}/out").groupBy("scene_id", "visible", "vx", "vy", "vz").agg(F.count(F.lit(1)).alias("n"))


@query("t2_cache_top_up", "select scene_id, ord, 10 * ord took from l_frames")
def t2(t: Tables) -> DataFrame:
    """Frames come twice; the cache has each once. The event tells frames apart where users share a scene."""
    f = t.lift("l_frames").select("scene_id", F.col("ord").cast("long").alias("ord"), "event_id")
    stream, root = streamed(t, f.unionByName(f.where("ord % 2 = 0")), "top-up")
    incremental.top_up(stream, f"{root}/cache", ["scene_id", "ord", "event_id"], lambda d: d.withColumn("took", F.col("ord") * 10), f"{root}/checkpoint").awaitTermination()
    return t.spark.read.parquet(f"{root}/cache").select("scene_id", "ord", "took")


@query("t3_progress", "select count(*) done from l_frames")
def t3(t: Tables) -> DataFrame:
    """How many items a listener has been told of when the stream is through."""
    import threading

    f = t.lift("l_frames").select("scene_id", F.col("ord").cast("long").alias("ord"))
    want, seen, enough = f.count(), [0], threading.Event()

    def tell(name: str, batch: int, done: int) -> None:
        if name == "progress":
            seen[0] = max(seen[0], done)
            if seen[0] >= want:
                enough.set()

    listener = incremental.Progress(tell)
    t.spark.streams.addListener(listener)
    try:
        stream, root = streamed(t, f, "progress")
        stream.writeStream.queryName("progress").format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
        enough.wait(30)
    finally:
        t.spark.streams.removeListener(listener)
    return t.spark.createDataFrame([(seen[0],)], "done long")
