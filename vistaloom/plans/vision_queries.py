"""Detections and masks, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vistaloom.functions import geometry as g
from vistaloom.operators import vision
from vistaloom.plans.registry import Tables, query

W, H = 640, 480
R4 = lambda c: F.round((F.col(c) if isinstance(c, str) else c) + 1e-9, 4)  # noqa: E731  # ratios of whole numbers hit ties, which engines round apart


def iou_sql(a: str, b: str, box_a: str = "x0 y0 x1 y1", box_b: str = "x0 y0 x1 y1") -> str:
    p, q = [f"{a}.{c}" for c in box_a.split()], [f"{b}.{c}" for c in box_b.split()]
    w = f"greatest(0, least({p[2]}, {q[2]}) - greatest({p[0]}, {q[0]}))"
    h = f"greatest(0, least({p[3]}, {q[3]}) - greatest({p[1]}, {q[1]}))"
    area = lambda s: f"greatest(0, {s[2]} - {s[0]}) * greatest(0, {s[3]} - {s[1]})"
    return f"(case when {area(p)} + {area(q)} - {w} * {h} > 0 then {w} * {h} / ({area(p)} + {area(q)} - {w} * {h}) else 0 end)"


def greedy_sql(keys: str, fields: str, clash: str) -> str:
    """Steps of a greedy scan over `ranked` (keys, n, fields): keep says whether no kept row k clashes with r."""
    made = lambda a: "{" + ", ".join(f"'{f}': {a}{f}" for f in fields.split()) + "}"
    ks = keys.split()
    ok = f"len(list_filter(s.kept, lambda k: {clash})) = 0"
    return f"""step as (
  select {', '.join(ks)}, n, [{made('')}] kept, true keep from ranked where n = 1
  union all
  select {', '.join('r.' + k for k in ks)}, r.n, case when {ok} then list_append(s.kept, {made('r.')}) else s.kept end, {ok}
  from step s join ranked r on {' and '.join(f'r.{k} = s.{k}' for k in ks)} and r.n = s.n + 1
)"""


@query("p16_size_filter", f"select frame, det from l_dets where (x1 - x0) * (y1 - y0) / {W * H}.0 <= 0.2")
def p16(t: Tables) -> DataFrame:
    return vision.not_too_large(t.lift("l_dets"), W, H, 0.2).select("frame", "det")


@query("f12_box_iou", f"select a.frame, a.det det_a, b.det det_b, round({iou_sql('a', 'b')} + 1e-9, 4) iou from l_dets a join l_dets b on a.frame = b.frame and a.det < b.det")
def f12(t: Tables) -> DataFrame:
    d = t.lift("l_dets")
    a, b = d.alias("a"), d.alias("b")
    of = lambda s: [F.col(f"{s}.{n}") for n in vision.BOX]
    return a.join(b, (F.col("a.frame") == F.col("b.frame")) & (F.col("a.det") < F.col("b.det"))).select("a.frame", F.col("a.det").alias("det_a"), F.col("b.det").alias("det_b"), R4(g.box_iou(of("a"), of("b"))).alias("iou"))


@query("w5_box_nms", f"with recursive ranked as (select *, row_number() over (partition by frame order by score desc, det) n from l_near), {greedy_sql('frame', 'x0 y0 x1 y1', iou_sql('k', 'r') + ' > 0.5')}, kept as (select r.frame, r.det, row_number() over (partition by frame order by n) place from ranked r join step using (frame, n) where keep) select * from kept where place <= 3")
def w5(t: Tables) -> DataFrame:
    return vision.suppressed(t.lift("l_near"), ["frame"], 0.5, 3).select("frame", "det", F.col("place").cast("long").alias("place"))


RECT = f"rects as (select *, greatest(0, least({W}, round_even(x0, 0)::int)) m0, greatest(0, least({H}, round_even(y0, 0)::int)) n0, greatest(0, least({W}, round_even(x1, 0)::int)) m1, greatest(0, least({H}, round_even(y1, 0)::int)) n1 from l_near)"


def rects(t: Tables) -> DataFrame:
    return vision.rectangle_masks(t.lift("l_near"), W, H).withColumnRenamed("det", "mask")


@query("x6_rectangle_masks", f"with {RECT} select frame, det, m0, n0, m1, n1, greatest(0, m1 - m0) * greatest(0, n1 - n0) area, (m0 + m1) / 2 cu, (n0 + n1) / 2 cv from rects")
def x6(t: Tables) -> DataFrame:
    return vision.rectangle_masks(t.lift("l_near"), W, H).select("frame", "det", "m0", "n0", "m1", "n1", "area", "cu", "cv")


MASK_IOU = f"{RECT}, ious as (select a.frame, a.det mask_a, b.det mask_b, {iou_sql('a', 'b', 'm0 n0 m1 n1', 'm0 n0 m1 n1')} iou from rects a join rects b on a.frame = b.frame and a.det < b.det)"


@query("f11_mask_iou", f"with {MASK_IOU} select frame, mask_a, mask_b, round(iou + 1e-9, 4) iou from ious where iou > 0")
def f11(t: Tables) -> DataFrame:
    masks = vision.bands(rects(t), ["frame"])
    return vision.mask_overlaps(masks, masks, ["frame"], same=True).select("frame", "mask_a", "mask_b", R4("iou").alias("iou"))


@query("w6_mask_nms", f"with recursive {RECT}, ranked as (select *, row_number() over (partition by frame order by score desc, det) n from rects), {greedy_sql('frame', 'm0 n0 m1 n1', iou_sql('k', 'r', 'm0 n0 m1 n1', 'm0 n0 m1 n1') + ' >= 0.4')} select r.frame, r.det mask, row_number() over (partition by r.frame order by n) place from ranked r join step using (frame, n) where keep")
def w6(t: Tables) -> DataFrame:
    found = vision.suppressed_masks(vision.bands(rects(t), ["frame"], ("score",), empty=True), ["frame"])
    return found.withColumn("place", F.col("place").cast("long"))


@query("j5_cross_mask_iou", f"with {RECT} select a.frame + 1 frame, a.det mask_a, b.det mask_b, round({iou_sql('a', 'b', 'm0 n0 m1 n1', 'm0 n0 m1 n1')} + 1e-9, 4) iou from rects a join rects b on b.frame = a.frame + 1 where {iou_sql('a', 'b', 'm0 n0 m1 n1', 'm0 n0 m1 n1')} > 0")
def j5(t: Tables) -> DataFrame:
    masks = vision.bands(rects(t), ["frame"])
    moved = masks.withColumn("frame", F.col("frame") + 1)  # the masks of a frame, reprojected in place into the next
    return vision.mask_overlaps(moved, masks, ["frame"]).select("frame", "mask_a", "mask_b", R4("iou").alias("iou"))


@query("j6_best_mask_iou", f"with {RECT}, best as (select a.frame + 1 frame, a.det mask, max({iou_sql('a', 'b', 'm0 n0 m1 n1', 'm0 n0 m1 n1')}) iou from rects a join rects b on b.frame = a.frame + 1 group by all) select r.frame + 1 frame, r.det mask, round(coalesce(iou, 0) + 1e-9, 4) iou from rects r left join best b on b.frame = r.frame + 1 and b.mask = r.det")
def j6(t: Tables) -> DataFrame:
    masks = vision.bands(rects(t), ["frame"], empty=True)
    return vision.best_overlaps(masks.withColumn("frame", F.col("frame") + 1), masks, ["frame"]).select("frame", "mask", R4("iou").alias("iou"))


@query(
    "j4_nearest_mask",
    f"""with {RECT}, points as (select frame, det point, (x0 + 30)::int u, (y0 + 25)::int v from l_gtp),
hits as (select p.frame, p.point, r.det mask, (u - (m0 + m1) / 2) ** 2 + (v - (n0 + n1) / 2) ** 2 d2 from points p join rects r on p.frame = r.frame and u >= m0 and u < m1 and v >= n0 and v < n1)
select frame, point, mask, round(d2 + 1e-9, 4) d2 from hits qualify row_number() over (partition by frame, point order by d2, mask) = 1""".replace("l_gtp", "(select frame, inst det, x0, y0 from l_gt)"),
)
def j4(t: Tables) -> DataFrame:
    points = t.lift("l_gt").select("frame", F.col("inst").alias("point"), (F.col("x0") + 30).cast("int").alias("u"), (F.col("y0") + 25).cast("int").alias("v"))
    return vision.nearest_mask(points, vision.bands(rects(t), ["frame"], ("cu", "cv")), ["frame"], "point").select("frame", "point", "mask", R4("d2").alias("d2"))


@query("p17_mask_floors", f"with {RECT} select frame, det from rects r where (m1 - m0) * (n1 - n0) >= floor(0.05 * {W * H}) and {iou_sql('r', 'r', 'm0 n0 m1 n1')} >= 0.5")
def p17(t: Tables) -> DataFrame:
    rows = vision.rectangle_masks(t.lift("l_near"), W, H)
    mask = [F.col(c).cast("double") for c in ("m0", "n0", "m1", "n1")]
    return rows.where((F.col("area") >= int(0.05 * W * H)) & (g.box_iou(mask, vision.box()) >= 0.5)).select("frame", "det")


@query("f13_mask_box_iou", f"with {RECT} select r.frame, r.det, i.inst, round({iou_sql('r', 'i', 'm0 n0 m1 n1')} + 1e-9, 4) iou from rects r join l_gt i on i.frame = r.frame")
def f13(t: Tables) -> DataFrame:
    gt = t.lift("l_gt").select("frame", "inst", *[F.col(a).alias(b) for a, b in zip(vision.BOX, ("i0", "j0", "i1", "j1"), strict=True)])
    rows = vision.rectangle_masks(t.lift("l_near"), W, H).join(gt, "frame")
    iou = vision.mask_box_iou([F.col(c) for c in ("m0", "n0", "m1", "n1")], [F.col(c) for c in ("i0", "j0", "i1", "j1")], W, H)
    return rows.select("frame", "det", "inst", R4(iou).alias("iou"))


def claims_sql(options: str, order: str, by: str) -> str:
    ks = by.split()
    key = ", ".join(ks)
    on = " and ".join(f"r.{k} = s.{k}" for k in ks)
    pick = "list_filter(r.options, lambda o: not list_contains(s.claimed, o))[1]"
    return f"""with recursive options as ({options}), ranked as (
  select {key}, det, list(inst order by iou desc, inst) options, row_number() over (partition by {key} order by {order}) n from options group by {key}, det, score
), step as (
  select {key}, det, n, options[1] pick, [options[1]] claimed from ranked where n = 1
  union all
  select {', '.join('r.' + k for k in ks)}, r.det, r.n, {pick}, case when {pick} is null then s.claimed else list_append(s.claimed, {pick}) end
  from step s join ranked r on {on} and r.n = s.n + 1
) select {key}, det, pick claimed from step where pick is not null"""


def instances(t: Tables) -> DataFrame:
    return t.lift("l_gt").select("frame", "label", "inst", *[F.col(a).alias(b) for a, b in zip(vision.BOX, ("i0", "j0", "i1", "j1"), strict=True)])


@query("j9_greedy_instances", claims_sql(f"select * from (select d.frame, d.label, d.det, d.score, i.inst, {iou_sql('d', 'i')} iou from l_near d join l_gt i on i.frame = d.frame and i.label = d.label) where iou > 0.1", "score desc, det", "frame label"))
def j9(t: Tables) -> DataFrame:
    dets = t.lift("l_near").withColumn("rank", -F.col("score"))
    return vision.claimed_instances(dets, instances(t), 0.10, ["frame", "label"], ["rank", "det"], strict=True)


@query("j10_prompt_outputs", claims_sql(f"select * from (select d.frame, d.det, d.score, i.inst, {iou_sql('d', 'i')} iou from l_near d join l_gt i on i.frame = d.frame) where iou >= 0.5", "det", "frame"))
def j10(t: Tables) -> DataFrame:
    return vision.claimed_instances(t.lift("l_near"), instances(t).drop("label"), 0.5, ["frame"], ["det"], strict=False)


DOMINANT = """select * from (select d.frame, d.label, d.det, 0 score, i.inst, greatest(0, least(d.x1, i.x1) - greatest(d.x0, i.x0)) * greatest(0, least(d.y1, i.y1) - greatest(d.y0, i.y0)) iou
from l_near d join l_gt i on i.frame = d.frame and i.label = d.label) where iou >= 2000"""


@query("j11_dominant_instance", claims_sql(DOMINANT, "det", "frame label"))
def j11(t: Tables) -> DataFrame:
    from vistaloom.operators import fold

    rows = t.lift("l_near").join(instances(t), ["frame", "label"])
    side = lambda a, b, c, d: F.greatest(g.num(0), F.least(a, b) - F.greatest(c, d))
    rows = rows.withColumn("px", side("x1", "i1", "x0", "i0") * side("y1", "j1", "y0", "j0")).where("px >= 2000")
    options = rows.groupBy("frame", "label", "det").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("px")).alias("r"), "inst"))), lambda o: o["inst"]).alias("options"))
    return fold.claims(options, ["frame", "label"], ["det"], "det", "options")


@query(
    "a9_cluster_and_vote",
    f"""with recursive ranked as (select *, row_number() over (partition by frame, canonical order by run, det) n from l_near), step as (
  select frame, canonical, n, det, 1 cluster, [{{'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1}}] founders from ranked where n = 1
  union all
  select frame, canonical, n, det, coalesce(fit, len(founders) + 1), case when fit is null then list_append(founders, {{'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1}}) else founders end from (
    select r.*, s.founders, list_position(list_transform(s.founders, lambda k: {iou_sql('k', 'r')} >= 0.5), true) fit
    from step s join ranked r on r.frame = s.frame and r.canonical = s.canonical and r.n = s.n + 1)
), placed as (select r.*, cluster from ranked r join step s using (frame, canonical, n)),
labels as (select frame, canonical, cluster, label from (select frame, canonical, cluster, label, count(*) c, min((run, det)) f from placed group by all) qualify row_number() over (partition by frame, canonical, cluster order by c desc, f) = 1)
select p.frame, p.canonical, p.cluster, l.label, count(distinct run) n_runs, round(avg(score) + 1e-9, 4) score, round(sum(score * x0) / sum(score), 3) x0, round(sum(score * y1) / sum(score), 3) y1
from placed p join labels l using (frame, canonical, cluster) group by p.frame, p.canonical, p.cluster, l.label having count(distinct run) >= 2""",
)
def a9(t: Tables) -> DataFrame:
    found = vision.cluster_votes(t.lift("l_near"), ["frame"], 2)
    return found.select("frame", "canonical", "cluster", "label", "n_runs", R4("score").alias("score"), F.round("x0", 3).alias("x0"), F.round("y1", 3).alias("y1"))


@query("x5_noop_detector", f"select scene_id, ord, k det, 'obj' || k label, round(1 - k * 0.01 + 1e-9, 4) score, round((k % 4 + 0.5) * 160.0 - 48 + 1e-9, 4) x0, round((k // 4 + 0.5) * 120.0 - 36 + 1e-9, 4) y0, round((k % 4 + 0.5) * 160.0 + 48 + 1e-9, 4) x1, round((k // 4 + 0.5) * 120.0 + 36 + 1e-9, 4) y1 from l_frames, range(16) t(k)")
def x5(t: Tables) -> DataFrame:
    made = vision.noop_detections(t.lift("l_frames").select("scene_id", "ord"), 4, W, H)
    return made.select("scene_id", "ord", F.col("det").cast("long").alias("det"), "label", *[R4(c).alias(c) for c in ("score", *vision.BOX)])


@query("x7_tight_boxes", "select scene_id, ord, inst_id, min(pu) x0, min(pv) y0, max(pu) + 1 x1, max(pv) + 1 y1, count(*) area from l_px group by all")
def x7(t: Tables) -> DataFrame:
    return vision.tight_boxes(t.lift("l_px"), ["scene_id", "ord", "inst_id"]).drop("cu", "cv")


@query("a10_mask_footprint", "select scene_id, ord, inst_id, count(*) area, round(avg(pu) + 1e-9, 4) cu, round(avg(pv) + 1e-9, 4) cv from l_px group by all")
def a10(t: Tables) -> DataFrame:
    return vision.tight_boxes(t.lift("l_px"), ["scene_id", "ord", "inst_id"]).select("scene_id", "ord", "inst_id", "area", R4("cu").alias("cu"), R4("cv").alias("cv"))


@query("a11_depth_coverage", "select scene_id, ord, inst_id, round(count(*) filter (valid) / count(*) + 1e-9, 4) coverage from l_px group by all")
def a11(t: Tables) -> DataFrame:
    return t.lift("l_px").groupBy("scene_id", "ord", "inst_id").agg(R4(F.avg(F.col("valid").cast("int"))).alias("coverage"))


@query("f32_mask_median_center", "select scene_id, ord, inst_id, floor(median(pu))::int u, floor(median(pv))::int v from l_px group by all")
def f32(t: Tables) -> DataFrame:
    return t.lift("l_px").groupBy("scene_id", "ord", "inst_id").agg(F.floor(F.median("pu")).cast("int").alias("u"), F.floor(F.median("pv")).cast("int").alias("v"))


@query("f20_canonical_span", """with classes as (select distinct p_brand c from part union select distinct left(p_type, 5) from part), parts as (select p_partkey, p_name || ' ' || p_type raw from part),
inner_ as (select p_partkey, c from parts join classes on contains(raw, c) qualify row_number() over (partition by p_partkey order by length(c) desc, c) = 1),
outer_ as (select p_partkey, c from parts join classes on contains(c, raw) qualify row_number() over (partition by p_partkey order by length(c) desc, c) = 1)
select p.p_partkey, coalesce(i.c, o.c, raw) canonical from parts p left join inner_ i using (p_partkey) left join outer_ o using (p_partkey)""")
def f20(t: Tables) -> DataFrame:
    classes = t.part.select("p_brand").union(t.part.select(F.substring("p_type", 1, 5))).distinct()
    names = sorted(r[0] for r in classes.collect())  # a vocabulary, as a file of classes would hold
    raw = F.concat_ws(" ", "p_name", "p_type")
    return t.part.select("p_partkey", vision.canonical(raw, F.array(*map(F.lit, names))).alias("canonical"))


@query("o4_score_order", "select frame, det, row_number() over (partition by frame order by score desc, det) place from l_dets")
def o4(t: Tables) -> DataFrame:
    return t.lift("l_dets").select("frame", "det", F.row_number().over(Window.partitionBy("frame").orderBy(F.desc("score"), "det")).cast("long").alias("place"))


@query("o6_top_detections", "select frame, det from l_dets qualify row_number() over (partition by frame order by score desc, det) <= 2")
def o6(t: Tables) -> DataFrame:
    return t.lift("l_dets").withColumn("place", F.row_number().over(Window.partitionBy("frame").orderBy(F.desc("score"), "det"))).where("place <= 2").select("frame", "det")
