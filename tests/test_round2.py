"""Findings of the second round: queries against their SQL where scenes share an id, and plans that hold no more than they need."""

import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from vistaloom.operators import match, pairs, skills, vision
from vistaloom.plans import misc_queries, queries, skill_queries
from vistaloom.plans.lifts import CELLS, IMAGE, K, depth_of_pair, depths_of_pair, frames
from vistaloom.plans.registry import TABLES, Tables

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


def plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 6)
    return x


def against_sql(spark, name, folder=SF):
    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    df = queries.QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    answer = duck.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in answer.description]
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in answer.fetchall()), key=repr)
    return got, want


def plan(spark, name):
    return queries.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()


def test_depths_are_looked_up_without_rows_of_cells(spark):
    got, want = against_sql(spark, "j3_depth_lookup")
    assert got == want and "Generate" not in plan(spark, "j3_depth_lookup")


def test_lookup_in_stored_rasters(spark):
    rasters = spark.createDataFrame([("s", "a", 4, 2, [float(x) for x in range(1, 9)])], "scene_id string, frame_id string, width int, height int, depth array<double>")
    points = spark.createDataFrame([("s", "a", 0.0, 0.0), ("s", "a", 25.0, 10.0), ("s", "a", 39.0, 0.0), ("s", "b", 0.0, 0.0)], "scene_id string, frame_id string, u double, v double")
    found = match.lookup_depth(points, match.raster_depth(rasters, (40, 20)), "frame_id").select("frame_id", "u", "z").collect()
    assert sorted(map(tuple, found)) == [("a", 0.0, 1.0), ("a", 25.0, 7.0), ("a", 39.0, 0.0), ("b", 0.0, 0.0)]


@pytest.mark.parametrize("name", ["f11_mask_iou", "w6_mask_nms", "j5_cross_mask_iou", "j6_best_mask_iou", "j4_nearest_mask", "x12_segmenter_tail"])
def test_masks_meet_as_bands(spark, name):
    got, want = against_sql(spark, name)
    assert got == want and "sequence(" not in plan(spark, name)  # no row for each row of a mask


def test_bands_and_runs_give_the_same(spark):
    rects = spark.createDataFrame([("f", 1, 0, 0, 10, 6), ("f", 2, 5, 2, 15, 9), ("f", 3, 30, 0, 31, 1), ("g", 1, 5, 2, 15, 9), ("f", 4, 4, 4, 4, 9)], "frame string, mask int, m0 int, n0 int, m1 int, n1 int").withColumns({"cu": F.lit(1.0), "cv": F.col("mask") * 1.0, "score": 1 - F.col("mask") / 10})
    bands, runs = vision.bands(rects, ["frame"], ("cu", "cv", "score")), vision.run_lengths(rects, ["frame"]).join(rects.select("frame", "mask", "cu", "cv", "score"), ["frame", "mask"])
    rows = lambda df: sorted(map(tuple, df.collect()))
    a, b = (rows(vision.mask_overlaps(m, m, ["frame"], same=True)) for m in (bands, runs))
    assert a == b == [("f", 1, 2, 20, 20 / 110)]
    a, b = (rows(vision.best_overlaps(m, m.where("mask <> 1"), ["frame"])) for m in (bands, runs))
    assert a == b == [("f", 1, 20 / 110), ("f", 2, 1.0), ("f", 3, 1.0), ("g", 1, 0.0)]
    a, b = (rows(vision.suppressed_masks(m, ["frame"], 0.1)) for m in (bands, runs))
    assert a == b == [("f", 1, 1), ("f", 3, 2), ("g", 1, 1)]
    points = spark.createDataFrame([("f", 7, 6, 3), ("f", 8, 12, 8), ("f", 9, 6, 9)], "frame string, point int, u int, v int")
    a, b = (rows(vision.nearest_mask(points, m, ["frame"], "point").select("point", "mask")) for m in (bands, runs))
    assert a == b == [(7, 2), (8, 2)]


@pytest.fixture(scope="module")
def shared(spark, tmp_path_factory):
    """The smallest tables with more users than four digits tell apart, so that users share scenes and places in them."""
    folder = tmp_path_factory.mktemp("tables")
    for t in TABLES:
        (folder / f"{t}.parquet").symlink_to(f"{SF}/{t}.parquet")
    (folder / "events.parquet").unlink()
    duckdb.sql(f"select * replace (event_id + k * 1000000 as event_id, case k when 0 then user_id + 1000 else 10 * (user_id + 1000) + k end as user_id) from '{SF}/events.parquet', range(3) r(k)").write_parquet(str(folder / "events.parquet"))
    return str(folder)


@pytest.mark.parametrize("name", ["x2b_hashed_seeds", "x4_segmenter_hook", "t2_cache_top_up"])
def test_users_that_share_a_scene(spark, shared, name):
    got, want = against_sql(spark, name, shared)
    assert len(want) > len({r[:2] for r in want}) and got == want


@pytest.mark.parametrize("name", ["a2_probe_ratios", "j2_lattice_probe", "p6_overlap_quality", "a17_funnel", "a18_task_histogram", "x21_stage_pair_gate"])
def test_probes_by_batches(spark, name):
    got, want = against_sql(spark, name)
    assert got == want and "explode([ab,ba])" not in plan(spark, name)  # no row for each point


def test_probes_by_points_and_by_batches_agree(spark):
    f = frames(Tables(spark, SF))
    some = pairs.candidates(f, pairs.PairConfig(), ("pose", "event_id"))
    a, b = (sorted(map(tuple, pairs.probed(some, d, K, IMAGE, CELLS).select("scene_id", "ord_a", "ord_b", "overlap", "occluded_frac").collect())) for d in (depth_of_pair, depths_of_pair))
    assert a and a == b


def test_medians_without_rows_of_cells(spark):
    got, want = against_sql(spark, "a1_median_depth")
    assert got == want and "Generate" not in plan(spark, "a1_median_depth")
    p7, want = against_sql(spark, "p7_task_gates")
    assert p7 == want and "sequence(" not in plan(spark, "p7_task_gates")


@pytest.mark.parametrize("name", ["p11_cosmic_gate", "u2_set_algebra", "p12_filter_pairs", "k8_view_to_scored"])
def test_pairs_of_shared_scenes(spark, shared, name):
    got, want = against_sql(spark, name, shared)
    assert got == want


def test_distances_are_rounded_once(spark):
    rows = [(1, k, True, 1.0, "a", x, 0.0, 0.0) for k, x in enumerate((0.0, 0.1, 0.86784999995))]
    matches = spark.createDataFrame(rows, "pair_id long, match_idx int, visible boolean, coverage double, src_label string, x double, y double, z double")
    some = spark.createDataFrame([(1, 0.5)], "pair_id long, overlap double")
    found = skills.relative_distance(some, matches, places=None).select(F.transform("candidates", lambda c: skill_queries.d4(c["distance_m"])).alias("d")).first()
    assert list(found.d) == [8679, 1000]  # 8678 where a rounded distance is rounded again
    assert skills.relative_distance(some, matches).first().candidates[0].distance_m == 0.8678


def test_reprojected_points_are_no_rows_of_the_plan(spark):
    got, want = against_sql(spark, "f8_reproject")
    assert got == want and "Generate" not in plan(spark, "f8_reproject") and "Join" not in plan(spark, "f8_reproject")


def test_masks_reprojected_from_shared_places(spark, shared):
    got, want = against_sql(spark, "f10_reproject_mask", shared)
    assert want and got == want and "Generate" not in plan(spark, "f10_reproject_mask")


def test_matching_writes_nothing(spark, monkeypatch, shared):
    monkeypatch.setattr(match, "saved", lambda df, name="table": pytest.fail(f"{name} is written"))
    got, want = against_sql(spark, "x2_match_pair")
    assert want and got == want
    found = queries.QUERIES["x2_match_pair"](spark, shared)
    assert found.count() == 3 * Tables(spark, shared).lift("l_frames").count()  # users that share a scene keep their pairs


def test_matching_of_rectangles_and_of_runs_agree(spark):
    t = Tables(spark, SF)
    w = {k: df.where("scene_id = 'scene0003'") for k, df in misc_queries.walls(t).items()}
    by, short = match.PAIR, lambda c: F.substring_index(c, "_", -1)
    runs = w["pairs"].join(w["runs"].withColumnRenamed("frame_id", "src"), ["scene_id", "src"]).withColumns({"no_src": short("src"), "no_tgt": short("tgt")})
    areas = vision.mask_areas(runs, [*by, "no_src", "no_tgt"])
    seeds = match.hashed_seeds(areas, runs.drop("no_src", "no_tgt"), by, told=["scene_id", "no_src", "no_tgt"]).select(*by, "mask", "try", "u", "v")
    a = match.match_pairs(w["pairs"], w["frames"], w["masks"], w["runs"], seeds, match.rule_depth(misc_queries.wall, IMAGE, CELLS), K, IMAGE).withColumns({c: short(c) for c in ("src", "tgt")})
    b = match.match_rectangles(misc_queries.wall_pairs(t).where("scene_id = 'scene0003'"), misc_queries.walls_of_pair, K, IMAGE, CELLS)
    names = [c for c in b.columns if c in a.columns]
    a, b = (sorted((tuple(plain(x) for x in r) for r in df.select(*names).collect()), key=repr) for df in (a, b))
    assert a and a == b


def test_keyframes_of_shared_scenes_but_for_ties(spark, shared, monkeypatch):
    """The SQL's order by ord is open where users share a scene: told apart by the pose, it gives the query's rows."""
    told = queries.ORACLE_SQL["w1_adaptive_keyframes"].replace("partition by scene_id order by ord)", "partition by scene_id order by ord, cx, cy, cz, ax, ay, az)")
    monkeypatch.setitem(queries.ORACLE_SQL, "w1_adaptive_keyframes", told)
    got, want = against_sql(spark, "w1_adaptive_keyframes", shared)
    assert want and got == want
