"""Erosion, data URLs, record adaptors and stage plans, with their SQL."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vistaloom import stages
from vistaloom.functions import text as tx
from vistaloom.operators import match, pairs, vision, votes
from vistaloom.plans.frame_queries import CONFIG, SELECT_SQL, gate_sql, medians
from vistaloom.plans.lifts import CELLS, IMAGE, K, depths_of_pair, frames
from vistaloom.plans.registry import Tables, query
from vistaloom.plans.vision_queries import H, W, greedy_sql, iou_sql


@query(
    "f15_seed_erosion",
    """with r as (select o_orderkey frame, 3 + o_orderkey % 28 w, 4 + o_custkey % 25 h from orders)
select frame, case when w > 10 and h > 10 then (w - 10) * (h - 10) else w * h end area from r""",
)
def f15(t: Tables) -> DataFrame:
    o = t.orders.select(F.col("o_orderkey").alias("frame"), F.lit(0).alias("mask"), F.lit(7).alias("m0"), F.lit(9).alias("n0"), (10 + F.col("o_orderkey") % 28).cast("int").alias("m1"), (13 + F.col("o_custkey") % 25).cast("int").alias("n1"))
    return match.eroded_areas(vision.run_lengths(o, ["frame"]), ["frame"]).drop("mask")


@query("s22_image_url", "select page_id, 'data:image/' || case page_id % 2 when 0 then 'jpeg' else 'png' end || ';base64,' || base64(encode(url)) url from pages")
def s22(t: Tables) -> DataFrame:
    path = F.concat(F.lit("/x/"), F.col("page_id").cast("string"), F.when(F.col("page_id") % 2 == 0, ".jpg").otherwise(".PNG"))
    content = F.encode("url", "UTF-8")
    return t.pages.select("page_id", F.regexp_replace(tx.data_url(path, content), r"[\r\n]", "").alias("url"))


@query(
    "f37_view_records",
    """select l_orderkey, line, 'view_' || v as "view", x from (select l_orderkey, line, v, case when (line + v) % 3 <> 0 then l_partkey + v end x from l_lines, range(4) t(v)) where x is not null""",
)
def f37(t: Tables) -> DataFrame:
    p = t.lift("l_lines")
    views = F.map_from_arrays(F.array(*[F.lit(f"view_{v}") for v in range(4)]), F.array(*[F.when((F.col("line") + v) % 3 != 0, F.col("l_partkey") + v) for v in range(4)]))
    return p.select("l_orderkey", "line", F.explode(views).alias("view", "x")).where("x is not null")


@query("s21_scenes", "select scene_id, count(*) n from l_all group by scene_id")
def s21(t: Tables) -> DataFrame:
    return t.lift("l_all").groupBy("scene_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "x10_detection_tail",
    f"""with recursive sized as (select * from l_near where (x1 - x0) * (y1 - y0) / {W * H}.0 <= 0.1), ranked as (select *, row_number() over (partition by frame order by score desc, det) n from sized),
{greedy_sql('frame', 'x0 y0 x1 y1', iou_sql('k', 'r') + ' > 0.7')} select r.frame, r.det from ranked r join step using (frame, n) where keep qualify row_number() over (partition by r.frame order by n) <= 30""",
)
def x10(t: Tables) -> DataFrame:
    return vision.suppressed(vision.not_too_large(t.lift("l_near"), W, H, 0.1), ["frame"], 0.7, 30).select("frame", "det")


CHUNKED = f"""with recursive chunks as (select *, det % 2 chunk from l_near), ranked as (select *, row_number() over (partition by frame, chunk order by score desc, det) n from chunks),
{greedy_sql('frame chunk', 'x0 y0 x1 y1', iou_sql('k', 'r') + ' > 0.5')}, first_ as (select r.* exclude (n) from ranked r join step using (frame, chunk, n) where keep),
again as (select *, row_number() over (partition by frame order by score desc, det) n from first_),
{greedy_sql('frame', 'x0 y0 x1 y1', iou_sql('k', 'r') + ' > 0.5').replace('step', 'step2').replace('ranked', 'again')} select r.frame, r.det from again r join step2 using (frame, n) where keep"""


@query("x9_chunked_suppression", CHUNKED)
def x9(t: Tables) -> DataFrame:
    dets = t.lift("l_near").withColumn("chunk", F.col("det") % 2)
    first = vision.suppressed(dets, ["frame", "chunk"], 0.5, 10**6).drop("place", "chunk")
    return vision.suppressed(first, ["frame"], 0.5, 10**6).select("frame", "det")


@query("x21_stage_pair_gate", f"with recursive {SELECT_SQL} select scene_id, ord_a ord from tasked union select scene_id, ord_b from tasked")
def x21(t: Tables) -> DataFrame:
    _, used = stages.pair_gate(frames(t), depths_of_pair, lambda used: medians(t, used), K, IMAGE, CELLS, CONFIG, ("event_id",))
    return used.select("scene_id", "ord")


@query("j1b_pairs_by_cell", gate_sql("d <= 1.5 and g between 10 and 80 and least(y, 360 - y) >= 30"))
def j1b(t: Tables) -> DataFrame:
    found = pairs.candidates_by_cell(frames(t), replace(CONFIG, max_distance=1.5))
    return found.select("scene_id", "ord_a", "ord_b", F.round("distance", 4).alias("distance"), F.round("angle", 4).alias("angle"))


@query("x14_filter_votes", "select frame, count(*) runs, count(*) filter (answer = '') empty from l_runs group by frame")
def x14(t: Tables) -> DataFrame:
    usable, reason = votes.parsed(F.col("answer"))
    rows = t.lift("l_runs").select("frame", usable.alias("usable"), reason.alias("reason"))
    return rows.groupBy("frame").agg(F.count(F.lit(1)).alias("runs"), F.count_if(F.col("reason") == "empty_response").alias("empty"))


@query("x13_label_runs", "select frame, count(distinct run) runs, count(*) filter (trim(obj) <> '') items from l_items group by frame")
def x13(t: Tables) -> DataFrame:
    return t.lift("l_items").groupBy("frame").agg(F.count_distinct("run").alias("runs"), F.count_if(F.trim("obj") != "").alias("items"))


@query("k14_upload_summary", "select reason_ reason, n from (select case when l_quantity < 0 then 'x' when visible then 'visible' else 'occluded' end reason_, count(*) n from (select *, 1 l_quantity from l_matches) group by all)")
def k14(t: Tables) -> DataFrame:
    return t.lift("l_matches").groupBy(F.when(F.col("visible"), "visible").otherwise("occluded").alias("reason")).agg(F.count(F.lit(1)).alias("n"))
