"""Truth tables, parity and invariants of the scene operators."""

import datetime
import hashlib
import json
import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vistaloom import config, models
from vistaloom.functions import geometry as g
from vistaloom.functions import salvage
from vistaloom.functions import text as tx
from vistaloom.operators import curate, emit, fold, match, pairs, sampling, skills, vision, votes
from vistaloom.sources import rasters, scans, sinks
from vistaloom.streaming import incremental


def pose(yaw, x=0.0, y=0.0, z=0.0, up="y"):
    c, s = math.cos(math.radians(yaw)), math.sin(math.radians(yaw))
    r = [[c, 0, s], [0, 1, 0], [-s, 0, c]] if up == "y" else [[s, 0, c], [-c, 0, s], [0, -1, 0]]
    return [float(v) for v in (*r[0], x, *r[1], y, *r[2], z, 0, 0, 0, 1)]


def one(df):
    (row,) = df.collect()
    return row


def test_single_point_projection(spark):
    k, size = (600.0, 600.0, 320.0, 240.0), (640, 480)
    df = spark.createDataFrame([("same", 2.0, pose(0), pose(0)), ("shift", 2.0, pose(0), pose(0, 0.1)), ("none", 0.0, pose(0), pose(0)), ("behind", 2.0, pose(0), pose(180))], "name string, z double, a array<double>, b array<double>")
    point = g.unproject(F.lit(320.0), F.lit(240.0), F.col("z"), k, F.col("a"))
    u, v, z, inside = g.project(point, k, F.col("b"), *size)
    got = {r.name: r for r in df.select("name", *[p.alias(n) for p, n in zip(point, "xyw", strict=True)], u.alias("u"), v.alias("v"), z.alias("d"), inside.alias("inside")).collect()}
    assert (got["same"].x, got["same"].y, got["same"].w) == (0, 0, 2) and (got["same"].u, got["same"].v, got["same"].d, got["same"].inside) == (320, 240, 2, True)
    assert math.isclose(got["shift"].u, 290) and got["shift"].v == 240
    assert got["none"].x is None and not got["none"].inside
    assert (got["behind"].u, got["behind"].v, got["behind"].inside) == (-1, -1, False)


def test_voxel_truth_table(spark):
    rows = [(k, "s", True, x, 0.0, 0.0) for k, x in enumerate((0.0, 0.01, 0.10))]
    df = spark.createDataFrame(rows, "match_idx int, scene_id string, visible boolean, x double, y double, z double").withColumn("pair_id", F.lit(1))
    assert [r.first for r in emit.first_in_voxel(df).orderBy("match_idx").collect()] == [True, False, True]


def test_angles(spark):
    r = one(spark.range(1).select(g.circular_difference(F.lit(350.0), F.lit(10.0)).alias("c"), *[g.angle_weight(F.lit(float(a))).alias(f"w{a}") for a in (10, 20, 30, 55, 80)], g.angle_between((F.lit(0.0),) * 3, (F.lit(1.0),) * 3).alias("zero")))
    assert (r.c, r.w10, r.w20, r.w30, r.w55, r.w80, r.zero) == (20, 0, 0.5, 1, 0.5, 0, 0)


def test_nan_poses_go(spark):
    rows = [("s", 0, pose(0)), ("s", 1, [float("nan")] * 16), ("s", 2, [float("inf")] + pose(0)[1:]), ("s", 3, None)]
    df = spark.createDataFrame(rows, "scene_id string, ord long, pose array<double>")
    assert [r.ord for r in df.where(g.finite_pose(F.col("pose"))).collect()] == [0]
    assert [r.ord for r in sampling.adaptive(df).collect()] == [0]


def adaptive_by_hand(poses, t, r):
    kept, last = [], None
    for o, p in poses:
        c, a = np.array(p)[[3, 7, 11]], np.array(p)[[2, 6, 10]]
        if last is None or np.linalg.norm(c - last[0]) >= t or np.degrees(np.arccos(np.clip(a @ last[1], -1, 1))) >= r:
            kept.append(o)
            last = (c, a)
    return kept


@pytest.mark.parametrize("seed", range(4))
def test_adaptive_by_hand(spark, seed):
    r = random.Random(seed)
    poses, x, yaw = [], 0.0, 0.0
    for k in range(60):
        x, yaw = x + r.random() * 0.1, yaw + r.uniform(-6, 9)
        poses.append((k, pose(yaw, x)))
    df = spark.createDataFrame([("s", k, p) for k, p in poses], "scene_id string, ord long, pose array<double>")
    assert sorted(q.ord for q in sampling.adaptive(df, 0.2, 15).collect()) == adaptive_by_hand(poses, 0.2, 15)


@pytest.mark.parametrize(("n", "step", "least", "want"), [(100, 50, 30, 34), (10, 3, 0, 4), (0, 5, 3, 0), (29, 50, 30, 29), (3, 50, 1, 1)])
def test_stride(spark, n, step, least, want):
    df = spark.range(n).select(F.lit("s").alias("scene_id"), F.col("id").alias("ord"))
    assert sampling.stride(df, step, least).count() == want


def test_unknown_sampler(spark):
    with pytest.raises(ValueError, match="unknown"):
        sampling.sample(spark.range(0), "nope")


def scene(spark):
    rows = [("mock", k, f"f{k}", k, pose(30 * k, up="z")) for k in range(3)]
    return spark.createDataFrame(rows, "scene_id string, ord long, frame_id string, event_id long, pose array<double>")


FLAT = pairs.PairConfig(source="unknown", max_distance=100.0, yaw=0.0, overlap=0.0, quality=0.0, diversity=0.0, tasks={"cross_spatial_transformation": pairs.TaskGate(angle=30.0)}, floors={"unknown": 0})


def run_selection(spark, cfg):
    frames = scene(spark)
    medians = lambda used: used.select("scene_id", "ord", F.lit(2.0).alias("median_depth"))
    return pairs.select_pairs(frames, lambda w, i, j: F.lit(2.0), medians, (600.0, 600.0, 320.0, 240.0), (640, 480), (640, 480), cfg, ("event_id",))


def test_mock_scene_gives_pairs(spark):
    got = run_selection(spark, FLAT).collect()
    assert {(r.ord_a, r.ord_b) for r in got} == {(0, 1), (1, 2), (0, 2)}
    assert all(r.tasks == ["cross_spatial_transformation"] for r in got if r.angle >= 30)
    from dataclasses import replace

    assert run_selection(spark, replace(FLAT, quality=999.0)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_diversity_keeps_a_maximal_set(spark, seed):
    r = random.Random(seed)
    rows = [("s", k, k + 100, *[r.random() for _ in range(6)], round(r.random(), 2)) for k in range(40)]
    names = "scene_id ord_a ord_b cx_a cy_a cz_a cx_b cy_b cz_b quality".split()
    df = spark.createDataFrame(rows, ", ".join(f"{n} {'string' if n == 'scene_id' else 'long' if n.startswith('ord') else 'double'}" for n in names))
    kept = {q.ord_a for q in pairs.diverse(df, 0.5).collect()}
    at = {row[1]: np.array(row[3:9]) for row in rows}
    want = []
    for row in sorted(rows, key=lambda x: (-x[9], x[1])):
        if all(np.linalg.norm(at[row[1]] - at[k]) >= 0.5 for k in want):
            want.append(row[1])
    assert kept == set(want)
    assert pairs.diverse(df, 0).count() == 40


def test_source_floors():
    c = pairs.PairConfig(source="scannet")
    assert (c.floor(), c.task_gap("cross_occlusion_visibility"), c.gap_before()) == (40, 100, 40)
    assert pairs.PairConfig(source="elsewhere").floor() == 0 and pairs.PairConfig(source="scannet", tasks={}).gap_before() == 40


def test_gaps_of_names(spark):
    df = spark.createDataFrame([("10", "60"), ("10", "30"), ("a", "30")], "a string, b string")
    assert [r.p for r in df.select(g.gap_passes(F.col("a"), F.col("b"), 40).alias("p")).collect()] == [True, False, True]


VERDICTS = [("sharp | yes", True, "sharp"), ("x\n dim | NO ", False, "dim"), ("", True, "empty_response"), (None, True, "empty_response"), ("there is no chair", False, "there is no chair"), ("nothing else", True, "nothing else"), ("a | b | yes", True, "a | b")]


def test_verdicts(spark):
    df = spark.createDataFrame([(k, t) for k, (t, _, _) in enumerate(VERDICTS)], "k int, t string")
    usable, reason = votes.parsed(F.col("t"))
    got = df.select("k", usable.alias("u"), reason.alias("r")).orderBy("k").collect()
    assert [(r.u, r.r) for r in got] == [(u, r) for _, u, r in VERDICTS]


@pytest.mark.parametrize(("usable", "want"), [([True, False, False], (False, "majority(2/3): b")), ([True, True, False], (True, "majority(2/3): a")), ([True, False], (True, "majority(1/2): a"))])
def test_majority(spark, usable, want):
    rows = [("f", k, u, "a" if u else "b") for k, u in enumerate(usable)]
    r = one(votes.majority(spark.createDataFrame(rows, "frame string, run int, usable boolean, reason string"), ["frame"]))
    assert (r.usable, r.reason) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [('x [{"a": "]"}] y', '[{"a": "]"}]'), ('[{"a": 1}, {"b": 2', '[{"a": 1}]'), ("none", None), ("", None), (None, None), ("[1, [2, 3]] [4]", "[1, [2, 3]]"), ('["\\"", {"a": 1}', '["\\"", {"a": 1}]'), ("[" * 50, None), ('[{"a": "x', None)],
)
def test_salvage(text, want):
    assert salvage.json_array(text) == want


def test_salvage_is_linear():
    assert salvage.json_array('[{"a": "' + "\\" * 200_001) is None
    assert salvage.json_array("[" + '{"object": "x"}, ' * 50_000).endswith('{"object": "x"}]')


def greedy_nms(boxes, thr):
    def iou(a, b):
        w, h = max(0, min(a[2], b[2]) - max(a[0], b[0])), max(0, min(a[3], b[3]) - max(a[1], b[1]))
        u = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - w * h
        return w * h / u if u > 0 else 0

    kept = []
    for k, s, b in sorted(boxes, key=lambda x: (-x[1], x[0])):
        if all(iou(b, c) <= thr for _, c in kept):
            kept.append((k, b))
    return [k for k, _ in kept]


@pytest.mark.parametrize("seed", range(3))
def test_nms(spark, seed):
    r = random.Random(seed)
    boxes = [(k, round(r.random(), 1), [x := r.randint(0, 50), y := r.randint(0, 50), x + r.randint(1, 40), y + r.randint(1, 40)]) for k in range(40)]
    df = spark.createDataFrame([("f", k, s, *map(float, b)) for k, s, b in boxes], "frame string, det int, score double, x0 double, y0 double, x1 double, y1 double")
    got = vision.suppressed(df, ["frame"], 0.3, 100).orderBy("place").collect()
    assert [q.det for q in got] == greedy_nms(boxes, 0.3)


def test_claims_leave_none_twice(spark):
    df = spark.createDataFrame([("f", 1, [5, 6]), ("f", 2, [5]), ("f", 3, [5, 6]), ("f", 4, [7])], "frame string, det int, options array<int>")
    assert {(r.det, r.claimed) for r in fold.claims(df, ["frame"], ["det"], "det", "options").collect()} == {(1, 5), (3, 6), (4, 7)}


def test_balance_caps(spark):
    r = random.Random(3)
    rows = [("anchor", k, f"s{r.randint(0, 5)}", f"b{r.randint(0, 3)}", r.choice([True, True, False, None])) for k in range(200)]
    df = spark.createDataFrame(rows, "skill string, id long, scene_id string, bucket string, usable boolean")
    got = {q.id: q.reason for q in curate.balanced(df, 4, 5, 11).collect()}
    kept = [row for row in rows if got[row[1]] is None]
    assert len(got) == 200 and all(row[4] for row in kept)
    for col, cap in ((2, 4), (3, 5)):
        names = [row[col] for row in kept]
        assert max(names.count(n) for n in names) <= cap
    assert all(q is None or q == "verifier" for q in {x.id: x.reason for x in curate.balanced(df, None, None).collect()}.values())


def test_router_and_counters(spark):
    df = spark.createDataFrame([(1, True, ["anchor", "counting"]), (2, False, ["anchor", "counting"])], "id int, visible boolean, tasks array<string>")
    got = {(r.id, r.skill, r.polarity) for r in emit.routed(df, tuple(skills.SKILLS)).collect()}
    assert got == {(1, "_all", "pos"), (1, "anchor", "pos"), (1, "counting", "pos"), (2, "_all", "neg"), (2, "counting", "neg")}


@pytest.mark.parametrize(("x", "want"), [(-2.0, 0), (-2.1, None), (641.0, 639), (641.1, None), (2.5, 2), (3.5, 4), (639.4, 639)])
def test_round_clip(spark, x, want):
    assert one(spark.range(1).select(g.round_clip(F.lit(x), 640).alias("p"))).p == want


def test_azimuth_buckets(spark):
    az = [0, 13, 45, 90, -90, 180, -175, 160, 200, 22.5]
    df = spark.createDataFrame([(k, float(a)) for k, a in enumerate(az)], "k int, a double")
    got = [r.b for r in df.select("k", skills.azimuth_bucket(F.col("a")).alias("b")).orderBy("k").collect()]
    assert got == ["front", None, "front-right", "right", "left", "back", "back", None, None, None]


def test_text_functions(spark):
    r = one(
        spark.range(1).select(
            tx.meta(F.lit("a = 1\nbad\nb_2=  x y \na = 3")).alias("meta"), tx.matrix(F.lit("1, 2\n 3.5  4 ")).alias("m"), tx.points(F.lit("[ 1, 2 ] [3,4] [a,1]")).alias("p"),
            tx.source_of(F.lit("/d/scene0001_02/color/1.jpg")).alias("s1"), tx.source_of(F.lit("/d/0123456789/x")).alias("s2"), tx.source_of(F.lit("/x")).alias("s3"),
            tx.codes(F.array(F.lit("counting"), F.lit("anchor"), F.lit("counting"), F.lit("other"))).alias("c"), tx.without_comment(F.lit(" chair # seat")).alias("w"),
        )
    )
    assert r.meta == {"a": "3", "b_2": "x y"} and r.m == [1, 2, 3.5, 4] and [(q.x, q.y) for q in r.p] == [(1, 2), (3, 4)]
    assert (r.s1, r.s2, r.s3, r.c, r.w) == ("scannet", "scannet++", "unknown", "anc,cnt,oth", "chair")


def test_unknown_prompt_is_an_error(spark):
    with pytest.raises(Exception, match="no prompt"):
        spark.range(1).select(tx.prompt(F.lit("nope"), skills.parsed(F.lit("{}")))).collect()


def test_erosion():
    m = np.ones((21, 21), bool)
    e = match.eroded(m)
    assert e.sum() == 11 * 11 and e[5, 5] and not e[4, 10]
    small = np.ones((3, 3), bool)
    assert (match.eroded(small) == small).all()


def test_seeds_lie_in_masks_and_repeat(spark):
    runs = spark.createDataFrame([("s", "1", "2", 0, v, 10, 40) for v in range(5, 30)], "scene_id string, src string, tgt string, mask int, v int, u0 int, u1 int")
    a, b = (sorted(map(tuple, match.seeds(runs, ["scene_id", "src", "tgt"]).collect())) for _ in range(2))
    assert a == b and len(a) == 5 and all(15 <= r[5] < 35 and 10 <= r[6] < 25 for r in a)


def test_mask_pixels_take_every_fourth(spark):
    runs = spark.createDataFrame([("f", 1, 0, 0, 6), ("f", 1, 1, 2, 5), ("f", 1, 2, 0, 4)], "frame string, mask int, v int, u0 int, u1 int")
    every = [(u, v) for v, a, b in ((0, 0, 6), (1, 2, 5), (2, 0, 4)) for u in range(a, b)]
    assert sorted((r.v, r.u) for r in match.mask_pixels(runs, ["frame"]).collect()) == sorted((v, u) for u, v in every[::4])


def test_config():
    assert config.merged({"a": {"b": 1, "c": 2}, "d": [1]}, {"a": {"b": 99}, "d": [99]}) == {"a": {"b": 99, "c": 2}, "d": [99]}
    assert config.load('{"_x": 1, "a": {"_y": 2, "b": [{"_z": 1}]}}') == {"a": {"b": [{}]}}
    assert config.stage("label", "qwen3vl_vote3")["n_votes"] == 3 and config.stage("label", "qwen3vl_vote3", {"n_votes": 5, "vote_temperature": None})["n_votes"] == 5
    assert config.stage("match")["emit_occlusion_negatives"] is True and config.stage("sample", "default")["sampling"] == "adaptive"
    with pytest.raises(KeyError):
        config.stage("sample", overrides={"nope": 1})
    assert config.pair_config("scannet", {"quality": 0.3, "tasks": {"t": {"angle": 5.0}}}).tasks["t"].angle == 5.0


def test_prompt_text():
    assert config.prompt_text("ask", "a.txt") == "ask" and config.prompt_text('{"prompt": "ask"}', "a.json") == "ask"


def test_intrinsics(spark, tmp_path):
    for name, text in (("s1/intrinsic/intrinsic_color.txt", "1 0 2\n0 1 3\n0 0 1"), ("s1/intrinsic_per_frame/7.txt", "5,0,6,0,5,7,0,0,1"), ("s2/intrinsic/color.txt", "9 0 9 0 9 9 0 0 1")):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    frames = spark.createDataFrame([("s1", "7"), ("s1", "8"), ("s2", "7"), ("s3", "1")], "scene_id string, frame_id string")
    got = {(r.scene_id, r.frame_id): r.k and r.k[0] for r in scans.with_intrinsics(frames, *scans.intrinsics(spark, str(tmp_path))).collect()}
    assert got == {("s1", "7"): 5, ("s1", "8"): 1, ("s2", "7"): 9, ("s3", "1"): None}


def test_cells_and_large_scenes_give_the_same(spark):
    r = random.Random(2)
    rows = [("s", k, f"{k}", k, pose(r.uniform(0, 360), r.uniform(0, 40), r.uniform(0, 40), up="z")) for k in range(120)]
    frames = spark.createDataFrame(rows, "scene_id string, ord long, frame_id string, event_id long, pose array<double>")
    c = pairs.PairConfig(source="unknown", yaw=0.0, tasks={}, floors={"unknown": 0})
    key = lambda d: sorted((q.ord_a, q.ord_b) for q in d.collect())
    a = pairs.candidates(frames, c)
    assert key(a) == key(pairs.candidates_by_cell(frames, c)) and key(a)
    scored = a.withColumn("quality", F.round(F.rand(1), 2))
    fixed = spark.createDataFrame(scored.collect(), scored.schema)
    kept = []
    for q in sorted(fixed.collect(), key=lambda q: (-q.quality, q.ord_a, q.ord_b)):
        place = np.array([q[c] for c in pairs.PLACE])
        if all(np.linalg.norm(place - p) >= 5.0 for _, p in kept):
            kept.append(((q.ord_a, q.ord_b), place))
    assert key(pairs.diverse(fixed, 5.0)) == sorted(k for k, _ in kept)


def test_models(spark):
    def factory():
        calls = {}

        def model(row):
            calls[row["id"]] = calls.get(row["id"], 0) + 1
            if row["id"] == 3:
                raise RuntimeError("down")
            return f"r{row['id']}" if row["id"] != 2 or calls[2] == 3 else None

        return model

    df = spark.range(5).coalesce(1)
    got = {r.id: r for r in models.applied(df, factory, "string").collect()}
    assert got[0].result == "r0" and got[0].attempts == 1 and got[2].result == "r2" and got[2].attempts == 3
    assert got[3].result is None and "down" in got[3].error
    cache = spark.createDataFrame([(0, "old")], "id long, result string")
    assert {(r.id, r.result) for r in models.cached(df, cache, ["id"], factory, "string").collect()} == {(0, "old"), (1, "r1"), (2, "r2"), (4, "r4")}
    with pytest.raises(KeyError):
        models.resolve("nope")


PAIR = dict(adapter="a", scene_id="s", src_id="50", tgt_id="200", image_src="x.jpg", image_tgt="y.jpg", overlap=0.45, occluded_frac=0.12, angle_deg=28.3, distance_m=1.42, quality=0.38, median_depth_src=2.1, median_depth_tgt=2.3, tasks=["z", "a", "m"])


def test_scored_pairs_round_trip(spark, tmp_path):
    path = f"{tmp_path}/pairs.scored.jsonl"
    df = spark.createDataFrame([PAIR], scans.SCORED)
    assert sinks.write_scored_pairs(df, path) == 1 and sinks.write_scored_pairs(df, path, append=True) == 1
    rows = scans.strict_json(spark, path).collect()
    assert len(rows) == 2 and rows[0].tasks == ["a", "m", "z"] and rows[0].quality == 0.38


def test_loader(spark, tmp_path):
    (tmp_path / "pairs.jsonl").write_text(json.dumps({k: "x" for k in scans.REQUIRED}) + "\nbroken\n\n" + json.dumps({"skill": "x"}) + "\n")
    assert scans.load(spark, str(tmp_path))[0] == "manifests"
    assert scans.collected(scans.load(spark, f"{tmp_path}/pairs.jsonl")[1]).count() == 1
    (tmp_path / "pairs.scored.jsonl").write_text(json.dumps(PAIR) + "\n" + json.dumps(PAIR) + "\n")
    kind, rows = scans.load(spark, str(tmp_path))
    assert kind == "pairs" and scans.frames_of(kind, rows).count() == 2
    (tmp_path / "frames.json").write_text(json.dumps([dict(adapter="a", scene_id="s", frame_id="1", image_path="p")]))
    assert scans.load(spark, str(tmp_path))[0] == "frames"
    (tmp_path / "other").mkdir()
    (tmp_path / "other" / "odd.jsonl").write_text('{"a": 1}\n')
    for bad in ("other/odd.jsonl", "other"):
        with pytest.raises(ValueError):
            scans.load(spark, f"{tmp_path}/{bad}")
    with pytest.raises(FileNotFoundError):
        scans.load(spark, f"{tmp_path}/missing")
    (tmp_path / "empty.jsonl").write_text("\n")
    assert scans.load(spark, f"{tmp_path}/empty.jsonl")[0] == "unknown"


def test_manifest_tree(spark, tmp_path):
    assert scans.manifest_tree(spark, f"{tmp_path}/none").count() == 0
    for s, n in (("anchor", 2), ("counting", 1)):
        (tmp_path / s).mkdir()
        (tmp_path / s / "pairs.jsonl").write_text("".join(json.dumps({k: s if k == "skill" else str(i) for k in scans.REQUIRED}) + "\n" for i in range(n)) + "oops\n")
    assert scans.manifest_tree(spark, str(tmp_path)).count() == 3 and scans.manifest_tree(spark, str(tmp_path), ["counting"]).count() == 1


def test_verified_keeps_folders_without_survivors(spark, tmp_path):
    rows = spark.createDataFrame([("anchor", 1), ("anchor", 2), ("counting", 3)], "skill string, id long")
    first = spark.createDataFrame([("anchor", 1, True), ("anchor", 2, False), ("counting", 3, True)], "skill string, id long, usable boolean")
    again = spark.createDataFrame([("anchor", 2, True), ("counting", 3, None)], "skill string, id long, usable boolean")
    for v, want in ((first, {1, 3}), (again, {2, 3})):
        sinks.write_verified(rows, v, ["skill", "id"], f"{tmp_path}/out")
        assert {r.id for r in spark.read.parquet(f"{tmp_path}/out").collect()} == want


def test_correspondence_sink(spark, tmp_path):
    df = spark.createDataFrame([("s", 1, 0, None), ("s", 1, 1, "voxel_dup"), ("s", 2, 0, None)], "scene_id string, pair_id long, match_idx int, reason string")
    assert sinks.write_correspondences(df, f"{tmp_path}/c") == {"emitted": 2, "voxel_dup": 1}
    assert spark.read.json(f"{tmp_path}/c/rejected").count() == 1


@pytest.mark.parametrize("kind", [np.uint8, np.uint16])
def test_png(kind):
    a = np.random.default_rng(0).integers(0, np.iinfo(kind).max, (13, 17)).astype(kind)
    assert (rasters.read_png(rasters.write_png(a)) == a).all()


def test_scene_folder(spark, tmp_path):
    base = tmp_path / "scene0000_00"
    for d in ("color", "depth", "pose"):
        (base / d).mkdir(parents=True)
    for k in (0, 10, 2):
        (base / "color" / f"{k}.jpg").write_bytes(b"x")
        (base / "depth" / f"{k}.png").write_bytes(rasters.write_png(np.full((4, 6), 1500 + k, np.uint16)))
        (base / "pose" / f"{k}.txt").write_text("\n".join(" ".join(map(str, pose(k)[i : i + 4])) for i in range(0, 16, 4)))
    assert [r.frame_id for r in scans.scene_images(spark, str(tmp_path)).orderBy("frame_no").collect()] == ["0", "2", "10"]
    assert {len(r.pose) for r in scans.scene_poses(spark, str(tmp_path)).collect()} == {16}
    d = {r.frame_id: r for r in rasters.depth_rasters(spark, str(tmp_path), "scannet").collect()}
    assert (d["10"].width, d["10"].height) == (6, 4) and math.isclose(d["10"].depth[0], 1.51, rel_tol=1e-6)
    assert rasters.instance_pixels(spark, str(base / "depth")).count() == 3
    with pytest.raises(NotImplementedError):
        scans.scannetpp(spark, str(tmp_path))


def test_stream_keyframes_equal_batch(spark, tmp_path):
    poses = [("s", k, pose(7 * k, 0.05 * k)) for k in range(30)] + [("t", k, pose(0)) for k in range(5)]
    df = spark.createDataFrame(poses, "scene_id string, ord long, pose array<double>")
    for k in range(3):
        df.where((F.col("ord") >= 10 * k) & (F.col("ord") < 10 * k + 10)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = incremental.keyframes(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in"))
        stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
    key = lambda d: sorted((r.scene_id, r.ord) for r in d.collect())
    assert key(spark.read.parquet(f"{tmp_path}/out")) == key(sampling.adaptive(df))


def test_stream_voxels_and_windows(spark, tmp_path):
    t0 = datetime.datetime(2024, 1, 1)
    rows = [("s", True, 0.01 * (k % 3), 0.0, 0.0, t0 + datetime.timedelta(minutes=k), "view") for k in range(90)]
    df = spark.createDataFrame(rows, "scene_id string, visible boolean, x double, y double, z double, ts timestamp, event_type string")
    df.write.parquet(f"{tmp_path}/in")
    for name, f in (("voxel", lambda s: incremental.first_in_voxel(s, lateness="1 day")), ("windows", lambda s: incremental.windowed_counts(s, "30 minutes"))):
        q = f(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")).writeStream.format("memory").queryName(name).outputMode("append" if name == "voxel" else "update").trigger(availableNow=True).start()
        q.awaitTermination()
    assert spark.table("voxel").count() == 1
    assert {r.n for r in spark.table("windows").collect()} == {30}


def test_cache_top_up(spark, tmp_path):
    src = f"{tmp_path}/in"
    for part in ([1, 2, 2], [2, 3]):
        spark.createDataFrame([(k,) for k in part], "id long").coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema("id long").parquet(src)
        incremental.top_up(stream, f"{tmp_path}/cache", ["id"], lambda d: d.withColumn("v", F.col("id") * 10), f"{tmp_path}/cp").awaitTermination()
    assert sorted((r.id, r.v) for r in spark.read.parquet(f"{tmp_path}/cache").collect()) == [(1, 10), (2, 20), (3, 30)]


def test_signatures_equal_python_json(spark):
    """The text that is hashed is what json.dumps with sorted keys gives."""
    rows = [{"b": {"z": 1, "a": 'x, y: "q" \\ é 🙂'}, "a": [{"n": None, "m": 2.5}, {"n": "t\n", "m": 0.125}], "c": True}, {"b": {"z": -3, "a": ""}, "a": [], "c": False}]
    df = spark.createDataFrame([(json.dumps(r),) for r in rows], "j string")
    e = F.from_json("j", "b struct<z:int,a:string>, a array<struct<n:string,m:double>>, c boolean")
    df = df.select("j", e.alias("e"))
    kind = df.schema["e"].dataType
    for r in df.select("j", tx.spaced_json(tx.in_order(F.col("e"), kind)).alias("t"), tx.signature(F.col("e"), kind).alias("s")).collect():
        want = json.dumps(json.loads(r.j), sort_keys=True)
        assert r.t == want and r.s == hashlib.sha1(want.encode()).hexdigest()[:10]


def test_counting_counts_masks_without_matches(spark):
    pairs_ = spark.createDataFrame([(1, 0.3)], "pair_id long, overlap double")
    matches = spark.createDataFrame([(1, 0, 0, 1, True), (1, 1, 3, -1, False)], "pair_id long, match_idx int, src_mask int, tgt_mask int, visible boolean")
    masks = spark.createDataFrame([(1, "src", k, "Chair ", None) for k in range(4)] + [(1, "tgt", k, "seat", "chair") for k in range(2)], "pair_id long, side string, mask int, label string, canonical string")
    r = one(skills.counting(pairs_, matches, masks))
    assert (r.category, r.unique_total, r.shared_match_idx, r.private_src_idx, r.private_tgt_idx) == ("chair", 5, [0], [1, 2, 3], [0])


def test_paths_of_evidence(spark):
    r = one(spark.range(1).select(tx.signature(F.struct(F.lit("chair").alias("src_label"))).alias("s")))
    assert len(r.s) == 10 and os.path.basename(r.s) == r.s
