"""Stages one after another over scene folders: sample, pair_gate, perceive, match, balance, by the command line; and match_pair by hand."""

import json
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vistaloom import __main__ as cli
from vistaloom import config, models, stages
from vistaloom.operators import match, skills, vision
from vistaloom.sources import rasters, scans, sinks

K = (100.0, 100.0, 32.0, 24.0)
IMAGE, CELLS = (64, 48), (16, 12)


def pose(x, yaw):
    c, s = math.cos(math.radians(yaw)), math.sin(math.radians(yaw))
    return [s, 0.0, c, x, -c, 0.0, s, 0.0, 0.0, -1.0, 0.0, 1.5, 0.0, 0.0, 0.0, 1.0]


@pytest.fixture(scope="module")
def scenes(tmp_path_factory):
    root = tmp_path_factory.mktemp("scenes")
    wall = np.full((CELLS[1], CELLS[0]), 2000, np.uint16)
    wall[:3, :6] = 5000  # one object stands far behind the others
    for scene in ("scene0000_00", "scene0001_00"):
        base = root / scene
        for d in ("color", "depth", "pose", "intrinsic", "instance-filt"):
            (base / d).mkdir(parents=True)
        (base / "intrinsic" / "intrinsic_color.txt").write_text("100 0 32 0\n0 100 24 0\n0 0 1 0\n0 0 0 1\n")
        for n in range(4):
            k = 50 * n
            (base / "color" / f"{k}.jpg").write_bytes(b"x")
            (base / "depth" / f"{k}.png").write_bytes(rasters.write_png(wall))
            (base / "pose" / f"{k}.txt").write_text("\n".join(" ".join(map(str, pose(0.02 * n, 1.5 * n)[i : i + 4])) for i in range(0, 16, 4)))
            (base / "instance-filt" / f"{k}.png").write_bytes(rasters.write_png(np.repeat(np.arange(1, 17, dtype=np.uint8).reshape(4, 4), 12, 0).repeat(16, 1)))
    return str(root)


LOOSE = json.dumps({"angle": [0.0, 80.0], "yaw": 0.0, "overlap": 0.0, "quality": -1.0, "diversity": 0.0, "floors": {"unknown": 0, "scannet": 0}, "tasks": {}})


@pytest.fixture(scope="module")
def chain(spark, scenes, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    size = f"{IMAGE[0]}x{IMAGE[1]}"
    cli.main(["sample", "--scenes-root", scenes, "--out", f"{out}/frames.json"])
    cli.main(["pair_gate", "--in", f"{out}/frames.json", "--scenes-root", scenes, "--out", f"{out}/pairs.scored.jsonl", "--image-size", size, "--selection", LOOSE])
    cli.main(["perceive", "--in", f"{out}/pairs.scored.jsonl", "--cache", f"{out}/cache", "--run", "cpu_smoke", "--image-size", size])
    cli.main(["match", "--in", f"{out}/pairs.scored.jsonl", "--scenes-root", scenes, "--cache", f"{out}/cache", "--out-root", f"{out}/m", "--image-size", size, "--iou-min", "0.05"])
    return out


def test_chain(spark, scenes, chain):
    assert len(json.load(open(f"{chain}/frames.json"))) == 8
    pairs = spark.read.json(f"{chain}/pairs.scored.jsonl")
    assert pairs.count() == 12 and pairs.select("scene_id").distinct().count() == 2
    assert spark.read.parquet(f"{chain}/cache/masks").count() == 8 * 16
    records = spark.read.json(f"{chain}/m/correspondences/records").collect()
    assert {r.visible for r in records} == {True, False}
    for r in records:
        assert len(r.point_src) == len(r.point_tgt) == 2 and len(r.X_world) == 3 and r.dataset_source == "scannet" and r.iou_src_to_tgt > 0
        assert min(abs(r.depth_src - 2), abs(r.depth_src - 5)) < 1e-6 and (abs(r.depth_pred_tgt - r.depth_obs_tgt) <= 0.15 if r.visible else r.depth_obs_tgt < r.depth_pred_tgt)
    kind, rows = scans.load(spark, f"{chain}/pairs.scored.jsonl")
    assert kind == "pairs" and rows.count() == 12


def test_manifests_feed_balance(spark, chain):
    found = scans.manifest_tree(spark, f"{chain}/m/stage_1")
    rows = found.collect()
    assert rows and {r.skill for r in rows} <= set(skills.SKILLS)
    for r in rows:
        assert isinstance(json.loads(r.evidence)["qualifying_matches"], list)
    cli.main(["balance", "--out-root", f"{chain}/m/stage_1", "--per-scene-cap", "1"])
    kept = spark.read.json(f"{chain}/m/stage_1/balanced/balanced").groupBy("skill", "scene_id").count().collect()
    assert kept and all(r["count"] == 1 for r in kept)
    cli.main(["load", f"{chain}/frames.json"])


def test_agreement_by_the_command_line(spark, scenes, chain):
    cli.main(["qc", "--jsonl", f"{chain}/m/correspondences/records", "--scenes-root", scenes, "--out", f"{chain}/qc"])
    got = {(r.kind, r.name): r for r in spark.read.json(f"{chain}/qc").collect()}
    assert got["overall", None].total == spark.read.json(f"{chain}/m/correspondences/records").where("visible").count()


def test_match_needs_masks(scenes, chain):
    with pytest.raises(SystemExit, match="sources|pairs"):
        cli.main(["match", "--in", f"{chain}/frames.json", "--scenes-root", scenes, "--cache", f"{chain}/cache", "--out-root", f"{chain}/n"])


def test_frames_round_trip(spark, tmp_path):
    rows = [("a", "s", f"{k:04}", f"/p/{k}.jpg") for k in range(20)]
    df = spark.createDataFrame(rows, scans.FRAME)
    assert sinks.write_frames(df, f"{tmp_path}/frames.json") == 20 and sinks.write_frames(df, f"{tmp_path}/frames") == 20
    assert [tuple(x.values()) for x in json.load(open(f"{tmp_path}/frames.json"))] == rows
    for name in ("frames.json", "frames"):
        kind, found = scans.load(spark, f"{tmp_path}/{name}")
        assert kind == "frames" and sorted(map(tuple, found.collect())) == rows
    assert scans.load(spark, str(tmp_path))[0] == "frames"
    assert sinks.write_frames(df.limit(0), f"{tmp_path}/none.json") == 0 and scans.load(spark, f"{tmp_path}/none.json")[1].count() == 0


def filtered(values, kinds):
    """A PNG whose rows have the given filters."""
    raw = values.astype(">u2" if values.dtype == np.uint16 else "u1")
    step = raw.dtype.itemsize
    lines, above = [], bytes(values.shape[1] * step)
    for r, kind in zip(raw, kinds, strict=True):
        line = r.tobytes()
        out = bytearray([kind])
        for k, x in enumerate(line):
            a, b, c = line[k - step] if k >= step else 0, above[k], above[k - step] if k >= step else 0
            p = a + b - c
            paeth = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
            out.append((x - [0, a, b, (a + b) // 2, paeth][kind]) & 255)
        lines.append(bytes(out))
        above = line
    png = rasters.write_png(values)
    at = png.index(b"IDAT") - 4
    body = zlib.compress(b"".join(lines))
    chunk = lambda name, part: len(part).to_bytes(4, "big") + name + part + zlib.crc32(name + part).to_bytes(4, "big")
    return png[:at] + chunk(b"IDAT", body) + chunk(b"IEND", b"")


@pytest.mark.parametrize("kind", [np.uint8, np.uint16])
@pytest.mark.parametrize("kinds", [[0, 1, 2, 1, 2, 0, 1], [4, 3, 2, 1, 0, 4, 3], [4] * 7])
def test_png_filters(kind, kinds):
    a = np.random.default_rng(1).integers(0, np.iinfo(kind).max, (7, 9)).astype(kind)
    assert (rasters.read_png(filtered(a, kinds)) == a).all()


def by_hand(pairs, poses, boxes, depth, seeds, tolerance, least, negatives):
    """match_pair over rectangles with plain loops."""
    fx, fy, cx, cy = K
    out = {}

    def at(f, u, v):
        i, j = round(u * CELLS[0] / IMAGE[0]), round(v * CELLS[1] / IMAGE[1])
        return depth(f, i, j) if 0 <= i < CELLS[0] and 0 <= j < CELLS[1] else 0.0

    def seen(f, t, u, v, z):
        p = np.array(poses[f]).reshape(4, 4) @ [(u - cx) / fx * z, (v - cy) / fy * z, z, 1]
        x, y, w = (np.linalg.inv(np.array(poses[t]).reshape(4, 4)) @ p)[:3]
        return (cx + fx * x / w, cy + fy * y / w, w, p) if w > 0 else (-1, -1, w, p)

    for src, tgt in pairs:
        for m, (a0, b0, a1, b1) in enumerate(boxes[src]):
            pixels = [(u, v) for v in range(b0, b1) for u in range(a0, a1)][::4]
            hit = set()
            for u, v in pixels:
                z = depth(src, min(CELLS[0] - 1, max(0, round(u * CELLS[0] / IMAGE[0]))), min(CELLS[1] - 1, max(0, round(v * CELLS[1] / IMAGE[1]))))
                if z > 0:
                    x, y, w, _ = seen(src, tgt, u, v, z)
                    if w > 0 and 0 <= round(x) < IMAGE[0] and 0 <= round(y) < IMAGE[1]:
                        hit.add((round(x), round(y)))
            iou = []
            for c0, d0, c1, d1 in boxes[tgt]:
                n = sum(c0 <= x < c1 and d0 <= y < d1 for x, y in hit)
                iou.append(n / (len(hit) + (c1 - c0) * (d1 - d0) - n) if hit else 0.0)
            good = neg = None
            last = "empty_mask" if a1 <= a0 or b1 <= b0 else None
            for k, (u, v) in enumerate(seeds.get((src, tgt, m), [])):
                z = at(src, u, v)
                if z <= 0:
                    last = "bad_depth"
                    continue
                x, y, w, p = seen(src, tgt, u, v, z)
                if not (w > 0 and 0 <= x < IMAGE[0] and 0 <= y < IMAGE[1]):
                    last = "out_of_bounds"
                    continue
                o = at(tgt, x, y)
                under = [t for t, (c0, d0, c1, d1) in enumerate(boxes[tgt]) if c0 <= round(x) < c1 and d0 <= round(y) < d1]
                near = min(under, key=lambda t: (((boxes[tgt][t][0] + boxes[tgt][t][2]) / 2 - x) ** 2 + ((boxes[tgt][t][1] + boxes[tgt][t][3]) / 2 - y) ** 2, t)) if under else None
                share = iou[near] if near is not None else max(iou, default=0.0)
                if o <= 0:
                    last = "no_tgt_depth"
                elif abs(w - o) > tolerance:
                    last = "occluded"
                    if negatives and o < w and neg is None:
                        if share > 0:
                            neg = (k, near if near is not None else -1)
                        else:
                            last = "occluded_no_mask_support"
                elif near is None:
                    last = "no_tgt_mask"
                elif share < least:
                    last = "low_iou"
                else:
                    good = (k, near)
                    break
            out[src, tgt, m] = ("accepted", None, *good) if good else ("occluded", None, *neg) if neg else ("rejected", last, None, None)
    return out


@pytest.mark.parametrize("negatives", [True, False])
def test_match_pair_by_hand(spark, negatives):
    r = np.random.default_rng(11)
    names = [str(k) for k in range(8)]
    poses = {f: pose(float(r.uniform(-0.1, 0.1)), float(r.uniform(-4, 4))) for f in names}
    boxes = {f: [(int(a), int(b), int(a) + int(w), int(b) + int(h)) for a, b, w, h in zip(r.integers(0, 44, 5), r.integers(0, 30, 5), r.integers(0, 20, 5), r.integers(4, 18, 5), strict=True)] for f in names}
    grid = {f: r.choice([0.0, 2.0, 2.0, 2.0, 2.05, 1.5, 2.6], (CELLS[1], CELLS[0])) for f in names}
    pairs = [(a, b) for a in names for b in names if a != b]
    seeds = {(a, b, m): [(int(r.integers(x[0], x[2])), int(r.integers(x[1], x[3]))) for _ in range(5)] for a, b in pairs for m, x in enumerate(boxes[a]) if x[2] > x[0]}
    want = by_hand(pairs, poses, boxes, lambda f, i, j: float(grid[f][j, i]), seeds, 0.15, 0.05, negatives)
    of = lambda rows, kind: spark.createDataFrame(rows, kind)
    masks = of([("s", f, m, (x[0] + x[2]) / 2, (x[1] + x[3]) / 2) for f in names for m, x in enumerate(boxes[f])], "scene_id string, frame_id string, mask int, cu double, cv double")
    runs = of([("s", f, m, v, x[0], x[2]) for f in names for m, x in enumerate(boxes[f]) if x[2] > x[0] for v in range(x[1], x[3])], "scene_id string, frame_id string, mask int, v int, u0 int, u1 int")
    drawn = of([("s", a, b, m, k, u, v) for (a, b, m), each in seeds.items() for k, (u, v) in enumerate(each)], "scene_id string, src string, tgt string, mask int, try int, u int, v int")
    depths = of([("s", f, CELLS[0], CELLS[1], g.ravel().tolist()) for f, g in grid.items()], "scene_id string, frame_id string, width int, height int, depth array<double>")
    found = match.match_pairs(of([("s", a, b) for a, b in pairs], "scene_id string, src string, tgt string"), of([("s", f, p) for f, p in poses.items()], "scene_id string, frame_id string, pose array<double>"), masks, runs, drawn, match.raster_depth(depths, IMAGE), K, IMAGE, 0.15, 0.05, negatives)
    got = {(x.src, x.tgt, x.src_mask): (x.outcome, x.reason, x["try"], x.tgt_mask) for x in found.collect()}
    assert got == want
    kinds = {w[0] for w in want.values()} | {w[1] for w in want.values()}
    assert {"accepted", "bad_depth", "no_tgt_depth", "occluded"} <= kinds and (negatives or all(w[0] != "occluded" for w in want.values()))


def test_depth_coverage(spark):
    r = np.random.default_rng(4)
    valid = r.random((CELLS[1], CELLS[0])) < 0.6
    boxes = [(0, 0, 64, 48), (3, 5, 17, 9), (61, 40, 64, 48), (7, 7, 8, 8)]
    runs = spark.createDataFrame([("s", "f", m, v, x[0], x[2]) for m, x in enumerate(boxes) for v in range(x[1], x[3])], "scene_id string, frame_id string, mask int, v int, u0 int, u1 int")
    cells = spark.createDataFrame([("s", "f", int(i), int(j)) for j, i in zip(*np.nonzero(valid), strict=True)], "scene_id string, frame_id string, i long, j long")
    got = {x.mask: x.coverage for x in match.depth_coverage(runs, cells, IMAGE, CELLS).collect()}
    for m, (a, b, c, d) in enumerate(boxes):
        assert math.isclose(got[m], np.mean([valid[v * CELLS[1] // IMAGE[1], u * CELLS[0] // IMAGE[0]] for v in range(b, d) for u in range(a, c)]))


def test_filter_votes_and_verdicts(spark):
    runs = [("a", 0, True, "x", None), ("a", 1, False, "y", None), ("a", 2, None, None, "timeout"), ("b", 0, None, None, "down"), ("b", 1, None, None, "down"), ("b", 2, None, None, "down"), ("c", 0, False, "z", None), ("c", 1, None, None, "t"), ("c", 2, None, None, "t")]
    df = spark.createDataFrame(runs, "frame string, run int, usable boolean, reason string, error string")
    got = {r.frame: (r.usable, r.reason, r.keep_in_cache) for r in models.filter_votes(df, ["frame"], 3).collect()}
    assert got == {"a": (True, "majority(1/2)", True), "b": (True, "filter_error:all_votes_failed", False), "c": (True, "majority(1/1): z", False)} or (got["b"] == (True, "filter_error:all_votes_failed", False) and got["a"][2] and not got["c"][2])
    one = models.filter_votes(df.where("run = 0"), ["frame"], 1)
    assert {r.frame: (r.usable, r.reason, r.keep_in_cache) for r in one.collect()} == {"a": (True, "x", True), "b": (True, "filter_error:down", False), "c": (False, "z", True)}
    rows = spark.createDataFrame([("k1",), ("k2",), ("k3",)], "key string")
    cache = spark.createDataFrame([("k1", True, "seen")], "key string, usable boolean, reason string")
    with pytest.raises(Exception, match="no verdict in the cache for k[23]"):
        models.verdicts(rows, cache, ["key"]).collect()
    live = spark.createDataFrame([("k2", "fine | yes", None), ("k3", None, "RuntimeError: down")], "key string, result string, error string")
    said = {r.key: (r.usable, r.reason, r.new) for r in models.verdicts(rows, cache, ["key"], live).collect()}
    assert said == {"k1": (True, "seen", False), "k2": (True, "fine", True), "k3": (False, "verify_exhausted:RuntimeError: down", True)}


def test_models_in_batches(spark):
    def factory():
        class Model:
            def many(self, rows):
                if any(r["id"] == 7 for r in rows):
                    raise RuntimeError("batch")
                return [f"m{r['id']}" if r["id"] % 2 else None for r in rows]

            def __call__(self, row):
                return f"s{row['id']}" if row["id"] != 4 else None

        return Model()

    got = {r.id: r.result for r in models.applied(spark.range(6).coalesce(1), factory, "string", concurrency=3).collect()}
    assert got == {0: "s0", 1: "m1", 2: "s2", 3: "m3", 4: None, 5: "m5"}
    assert {r.result for r in models.applied(spark.range(7, 9).coalesce(1), factory, "string").collect()} == {"s7", "s8"}
    cache = spark.createDataFrame([(0, "old"), (1, "broken")], "id long, result string")
    again = models.cached(spark.range(3), cache, ["id"], factory, "string", F.col("result") != "broken", lambda r: F.upper(r))
    assert {(r.id, r.result) for r in again.collect()} == {(0, "old"), (1, "M1"), (2, "S2")}
    models.register(models.ModelSpec("one-image", "none"), factory)
    with pytest.raises(ValueError, match="two"):
        models.verifier("one-image")


def test_detectors_and_segmenters(spark):
    frames = spark.createDataFrame([("s", "1"), ("s", "2")], "scene_id string, frame_id string")

    def detector():
        return lambda f: [{"det": 0, "label": f"l{f['frame_id']}", "canonical": "", "score": 0.5, "x0": 1.0, "y0": 2.0, "x1": 5.0, "y1": 6.0}]

    def segmenter():
        def call(f):
            return [{"mask": d["det"], "label": d["label"], "canonical": "", "score": d["score"], "x0": d["x0"], "y0": d["y0"], "x1": d["x1"], "y1": d["y1"], "cu": 3.0, "cv": 4.0, "runs": [{"v": 2, "u0": 1, "u1": 5}]} for d in f["detections"]]

        return call

    dets = models.detect(frames, detector)
    assert {(r.frame_id, r.label) for r in dets.collect()} == {("1", "l1"), ("2", "l2")}
    masks = models.segment(frames, dets, segmenter)
    assert [(r.mask, r.runs[0].u1) for r in masks.collect()] == [(0, 5)] * 2
    names = spark.createDataFrame([("s", "OBJ3", "thing")], "scene_id string, object string, canonical string")
    made, runs = stages.perceive(frames, config.stage("perceive", "cpu_smoke"), (64, 48), names)
    assert {r.canonical for r in made.collect()} >= {"thing", "obj0"} and made.count() == 32
    assert runs.join(made, ["scene_id", "frame_id", "mask"], "left_anti").count() == 0
    assert vision.mask_areas(runs, ["scene_id", "frame_id"]).count() == 32
    with pytest.raises(KeyError, match="labeled-gdino"):
        stages.perceive(frames, config.stage("perceive", "default"), (64, 48))
