"""Skill evidence over lifted matches, with its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vistaloom.operators import curate, skills
from vistaloom.plans.registry import Tables, query


def pairs(t: Tables) -> DataFrame:
    """Pairs whose target camera stands in the middle of the scene and looks along their yaw and pitch."""
    yaw, pitch = F.radians("yaw"), F.radians("pitch")
    place = {"center_x": F.lit(2.0), "center_y": F.lit(2.0), "center_z": F.lit(0.5), "axis_x": F.cos(pitch) * F.cos(yaw), "axis_y": F.cos(pitch) * F.sin(yaw), "axis_z": F.sin(pitch)}
    return t.lift("l_pairs").withColumns(place)


def listed(array: Column, line) -> Column:
    """Rows as text, so that both engines compare them whole."""
    return F.array_join(F.transform(array, lambda o: F.concat_ws("/", *[c.cast("string") for c in line(o)])), ",")


def numbers(array: str) -> Column:
    return F.array_join(F.col(array).cast("array<string>"), ",")


def d4(c: Column) -> Column:
    """Four places as a whole number, told from the last digits that engines disagree on."""
    return F.floor(c * 10000 + 0.5 + 1e-6).cast("long")


def sql_list(line: str, where: str = "true", order: str = "match_idx") -> str:
    return f"coalesce(string_agg({line}, ',' order by {order}) filter ({where}), '')"


def sql_d4(x: str) -> str:
    return f"floor(({x}) * 10000 + 0.5 + 1e-6)::bigint"


SHIFTED = "overlap between 0.15 and 0.30 and rotation between 20 and 100 and translation >= 0.6"


@query(
    "g1_cross_point",
    f"""select p.pair_id, count(*) filter (visible) n_visible_labeled, count(*) filter (not visible) n_occluded_candidates, {sql_list("match_idx || '/' || src_label || '/' || case when tgt_mask >= 0 then tgt_label else '' end || '/' || " + sql_d4('src_score'), 'visible')} matches,
  {sql_list("match_idx || '/' || src_label || '/' || case when tgt_mask >= 0 then tgt_label else '' end || '/' || " + sql_d4('src_score'), 'not visible')} occluded_matches, {sql_list('match_idx', 'not visible')} occluded_candidates, rotation, translation
from l_pairs p join l_matches m on m.pair_id = p.pair_id where {SHIFTED} and trim(src_label) <> '' and src_score >= 0.25 and coverage >= 0.6 group by p.pair_id, rotation, translation having count(*) filter (visible) > 0""",
)
def g1(t: Tables) -> DataFrame:
    found = skills.cross_point(pairs(t), t.lift("l_matches"))
    line = lambda o: (o["match_idx"], o["src_label"], o["tgt_label"], d4(o["score"]))
    return found.select(
        "pair_id", F.col("n_visible_labeled").cast("long").alias("n_visible_labeled"), F.col("n_occluded_candidates").cast("long").alias("n_occluded_candidates"), listed(F.col("matches"), line).alias("matches"),
        listed(F.col("occluded_matches"), line).alias("occluded_matches"), numbers("occluded_candidates").alias("occluded_candidates"), F.col("pair_rotation_deg").alias("rotation"), F.col("pair_translation_m").alias("translation"),
    )


@query(
    "g2_cross_object",
    f"""select p.pair_id, count(*) n, {sql_list("match_idx || '/' || trim(tgt_label) || '/' || src_label || '/' || round_even(u, 0)::int || '/' || round_even(v, 0)::int || '/' || floor(tgt_area / 307200 * 100000 + 0.5 + 1e-6)::bigint")} objects
from l_pairs p join l_matches m on m.pair_id = p.pair_id where {SHIFTED}
  and visible and tgt_mask >= 0 and trim(tgt_label) <> '' and tgt_score >= 0.25 and tgt_area / 307200 >= 0.0005 and u >= 0 and u < 640 and v >= 0 and v < 480 group by p.pair_id""",
)
def g2(t: Tables) -> DataFrame:
    found = skills.cross_object(pairs(t), t.lift("l_matches"), share=0.0005)
    line = lambda o: (o["match_idx"], o["tgt_label"], o["src_label"], F.get(o["point_tgt"], F.lit(0)), F.get(o["point_tgt"], F.lit(1)), F.floor(o["tgt_mask_area_frac"] * 100000 + 0.5).cast("long"))
    return found.select("pair_id", F.col("n_shared_objects").cast("long").alias("n"), listed(F.col("shared_objects"), line).alias("objects"))


@query(
    "g3_anchor",
    f"""select p.pair_id, count(*) n_shared, {sql_list("match_idx || '/' || src_label || '/' || tgt_label || '/' || " + sql_d4('tgt_area / src_area') + " || '/' || (tgt_area / src_area < 0.5 or tgt_area / src_area > 2)")} objects from l_pairs p join l_matches m on m.pair_id = p.pair_id
where overlap between 0.25 and 0.70 and not (translation < 0.6 and rotation < 35) and visible and tgt_mask >= 0 and src_area > 0 and tgt_area > 0
group by p.pair_id having count(*) filter (tgt_area / src_area < 0.5 or tgt_area / src_area > 2) > 0""",
)
def g3(t: Tables) -> DataFrame:
    line = lambda o: (o["match_idx"], o["src_label"], o["tgt_label"], d4(o["scale_ratio"]), o["non_trivial"])
    return skills.anchor(pairs(t), t.lift("l_matches")).select("pair_id", F.col("n_shared").cast("long").alias("n_shared"), listed(F.col("shared_objects"), line).alias("objects"))


@query(
    "g4_counting",
    """with p as (select pair_id from l_pairs where overlap between 0.15 and 0.60),
k as (select m.pair_id, side, mask, lower(trim(case when canonical <> '' then canonical else label end)) c from l_masks m join p using (pair_id)),
v as (select m.pair_id, match_idx, src_mask, tgt_mask from l_matches m join p using (pair_id) where visible),
found as (
  select v.pair_id, a.c, 'shared' kind, match_idx idx from v join k a on a.pair_id = v.pair_id and a.side = 'src' and a.mask = src_mask join k b on b.pair_id = v.pair_id and b.side = 'tgt' and b.mask = tgt_mask where a.c = b.c and a.c <> ''
  union all select pair_id, c, side, mask from k where c <> '' and side = 'src' and not exists (select 1 from v where v.pair_id = k.pair_id and v.src_mask = k.mask)
  union all select pair_id, c, side, mask from k where c <> '' and side = 'tgt' and not exists (select 1 from v where v.pair_id = k.pair_id and v.tgt_mask = k.mask)
), sums as (select pair_id, c, count(*) unique_total, count(*) filter (kind = 'shared') n, """
    + ", ".join(f"coalesce(string_agg(idx, ',' order by idx) filter (kind = '{k}'), '') {n}" for k, n in (("shared", "shared_idx"), ("src", "private_src"), ("tgt", "private_tgt")))
    + """ from found group by pair_id, c)
select pair_id, c category, unique_total, shared_idx, private_src, private_tgt from sums where unique_total between 3 and 15 and n > 0 and unique_total > n
qualify row_number() over (partition by pair_id order by abs(unique_total - 3), n desc, c) = 1""",
)
def g4(t: Tables) -> DataFrame:
    found = skills.counting(pairs(t), t.lift("l_matches"), t.lift("l_masks"))
    return found.select("pair_id", "category", F.col("unique_total").cast("long").alias("unique_total"), numbers("shared_match_idx").alias("shared_idx"), numbers("private_src_idx").alias("private_src"), numbers("private_tgt_idx").alias("private_tgt"))


@query(
    "g5_relative_distance",
    f"""with m as (select p.pair_id, match_idx, src_label, x, y, z from l_pairs p join l_matches m on m.pair_id = p.pair_id where overlap between 0.20 and 0.70 and visible and coverage >= 0.6 qualify count(*) over (partition by p.pair_id) >= 3),
d as (select a.pair_id, a.match_idx r, a.src_label rl, b.match_idx c, b.src_label l, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z)) d from m a join m b on a.pair_id = b.pair_id and a.match_idx <> b.match_idx),
k as (select *, row_number() over w k, lead(d) over w nxt from d window w as (partition by pair_id, r order by d desc, c)),
best as (select pair_id, r, rl, c far, d - nxt gap from k where k = 1 and d - nxt >= 0.5 qualify row_number() over (partition by pair_id order by r) = 1)
select b.pair_id, b.r reference, b.rl reference_label, far farthest, {sql_d4('any_value(gap)')} margin, string_agg(c || '/' || l || '/' || {sql_d4('d')}, ',' order by d desc, c) candidates from best b join d on d.pair_id = b.pair_id and d.r = b.r group by all""",
)
def g5(t: Tables) -> DataFrame:
    found = skills.relative_distance(pairs(t), t.lift("l_matches"), places=None)  # d4 rounds once
    line = lambda o: (o["match_idx"], o["label"], d4(o["distance_m"]))
    return found.select("pair_id", F.col("reference_match_idx").alias("reference"), "reference_label", F.col("farthest_match_idx").alias("farthest"), d4(F.col("margin_m")).alias("margin"), listed(F.col("candidates"), line).alias("candidates"))


@query(
    "j17_candidate_distances",
    """with m as (select p.pair_id, match_idx, x, y, z from l_pairs p join l_matches m on m.pair_id = p.pair_id where overlap between 0.20 and 0.70 and visible)
select a.pair_id, a.match_idx a, b.match_idx b, round(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z)), 4) d from m a join m b on a.pair_id = b.pair_id and a.match_idx <> b.match_idx""",
)
def j17(t: Tables) -> DataFrame:
    from vistaloom.functions import geometry as g

    m = pairs(t).where(skills.within(0.20, 0.70)).select("pair_id").join(t.lift("l_matches").where("visible"), "pair_id")
    a, b = m.alias("a"), m.alias("b")
    point = lambda s: tuple(F.col(f"{s}.{c}") for c in "xyz")
    rows = a.join(b, (F.col("a.pair_id") == F.col("b.pair_id")) & (F.col("a.match_idx") != F.col("b.match_idx")))
    return rows.select("a.pair_id", F.col("a.match_idx").alias("a"), F.col("b.match_idx").alias("b"), F.round(g.norm(g.minus(point("a"), point("b"))), 4).alias("d"))


DIRECTIONS = """m as (
  select p.pair_id, match_idx, src_label, x - 2 dx, y - 2 dy, z - 0.5 dz, cos(radians(pitch)) * cos(radians(yaw)) ax, cos(radians(pitch)) * sin(radians(yaw)) ay, overlap, translation, rotation
  from l_pairs p join l_matches m on m.pair_id = p.pair_id where visible
), a as (
  select *, degrees(atan2(ax * dy - ay * dx, ax * dx + ay * dy)) az, degrees(asin(greatest(cast(-1 as double), least(cast(1 as double), dz / sqrt(dx * dx + dy * dy + dz * dz))))) el, sqrt(dx * dx + dy * dy + dz * dz) far from m
), b as (
  select *, case when 180 - abs(az) <= 22.5 then case when 22.5 - (180 - abs(az)) >= 10 then 'back' end
    else (select name from (values ('back-right', 112.5), ('right', 67.5), ('front-right', 22.5), ('front', -22.5), ('front-left', -67.5), ('left', -112.5), ('back-left', -157.5)) v(name, low)
      where az >= low and az < low + 45 and az - low >= 10 and low + 45 - az >= 10) end bucket from a
)"""


@query("f17_azimuth_bucket", f"with {DIRECTIONS} select pair_id, match_idx, bucket from b")
def f17(t: Tables) -> DataFrame:
    az, _, _ = located()
    return pairs(t).join(t.lift("l_matches").where("visible"), "pair_id").select("pair_id", "match_idx", skills.azimuth_bucket(az).alias("bucket"))


def located():
    return skills.direction(tuple(F.col(c) for c in "xyz"), tuple(F.col(f"center_{c}") for c in "xyz"), tuple(F.col(f"axis_{c}") for c in "xyz"))


@query("f18_direction", f"with {DIRECTIONS} select pair_id, match_idx, round(az, 4) azimuth, round(el, 4) elevation, round(far, 4) distance from b")
def f18(t: Tables) -> DataFrame:
    az, el, far = (F.round(c, 4) for c in located())
    return pairs(t).join(t.lift("l_matches").where("visible"), "pair_id").select("pair_id", "match_idx", az.alias("azimuth"), el.alias("elevation"), far.alias("distance"))


@query(
    "g6_relative_direction",
    f"""with {DIRECTIONS}, c as (select *, round(az, 2) raz from b where overlap between 0.05 and 0.40 and translation >= 1 and rotation >= 20 and abs(el) <= 60 and bucket is not null and far >= 1e-6),
d as (select *, lead(raz) over (partition by pair_id order by raz, match_idx) - raz gap from c)
select pair_id, string_agg(match_idx || ':' || src_label || ':' || bucket, ',' order by match_idx) targets, string_agg({sql_d4('far')}, ',' order by match_idx) distances from d group by pair_id having max(gap) >= 30""",
)
def g6(t: Tables) -> DataFrame:
    found = skills.relative_direction(pairs(t), t.lift("l_matches"))
    return found.select("pair_id", F.array_join(F.transform("targets", lambda x: F.concat_ws(":", x["match_idx"].cast("string"), x["label"], x["bucket"])), ",").alias("targets"), listed(F.col("targets"), lambda x: (d4(x["distance_m"]),)).alias("distances"))


@query(
    "w13_widest_gap",
    f"with {DIRECTIONS}, d as (select *, lead(round(az, 2)) over (partition by pair_id order by round(az, 2), match_idx) - round(az, 2) gap from b) select pair_id, round(max(gap), 2) widest from d group by pair_id",
)
def w13(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    az, _, _ = located()
    rows = pairs(t).join(t.lift("l_matches").where("visible"), "pair_id").select("pair_id", "match_idx", F.bround(az, 2).alias("az"))
    gap = F.lead("az").over(Window.partitionBy("pair_id").orderBy("az", "match_idx")) - F.col("az")
    return rows.withColumn("gap", gap).groupBy("pair_id").agg(F.round(F.max("gap"), 2).alias("widest"))


@query(
    "g7_spatial_transformation",
    f"""select p.pair_id, {sql_list("match_idx || '/' || src_label || '/' || " + sql_d4('tgt_area / src_area'))} objects from l_pairs p join l_matches m on m.pair_id = p.pair_id
where rotation >= 30 and visible and tgt_mask >= 0 and src_area > 0 and tgt_area > 0 and (tgt_area / src_area < 0.6 or tgt_area / src_area > 1.67) group by p.pair_id""",
)
def g7(t: Tables) -> DataFrame:
    found = skills.spatial_transformation(pairs(t), t.lift("l_matches"))
    return found.select("pair_id", listed(F.col("transformed_objects"), lambda o: (o["match_idx"], o["label"], d4(o["scale_ratio"]))).alias("objects"))


@query(
    "g8_depth_variation",
    f"""select p.pair_id, {sql_d4('median(abs(depth_src - depth_obs))')} delta, {sql_list("match_idx || '/' || src_label || '/' || " + sql_d4('depth_src') + " || '/' || " + sql_d4('depth_obs'), 'abs(depth_src - depth_obs) >= 0.5')} objects, count(*) filter (abs(depth_src - depth_obs) >= 0.5 and depth_src > depth_obs) closer
from l_pairs p join l_matches m on m.pair_id = p.pair_id where ratio >= 1.3 and visible group by p.pair_id having count(*) filter (abs(depth_src - depth_obs) >= 0.5) > 0""",
)
def g8(t: Tables) -> DataFrame:
    found = skills.depth_variation(pairs(t), t.lift("l_matches"))
    closer = F.size(F.filter("varying_objects", lambda o: o["delta_m"] > 0)).cast("long")
    return found.select("pair_id", d4(F.col("pair_median_delta_m")).alias("delta"), listed(F.col("varying_objects"), lambda o: (o["match_idx"], o["label"], d4(o["depth_src"]), d4(o["depth_tgt"]))).alias("objects"), closer.alias("closer"))


@query("a12_evidence_median", "select pair_id, round(median(abs(depth_src - depth_obs)), 4) delta from l_matches where visible group by pair_id")
def a12(t: Tables) -> DataFrame:
    return t.lift("l_matches").where("visible").groupBy("pair_id").agg(F.round(F.median(F.abs(F.col("depth_src") - F.col("depth_obs"))), 4).alias("delta"))


@query(
    "g9_occlusion_visibility",
    f"""select p.pair_id, {sql_list('match_idx', 'visible')} seen, {sql_list('match_idx', 'not visible')} hidden, count(*) filter (visible) n_visible, count(*) filter (not visible) n_occluded from l_pairs p join l_matches m on m.pair_id = p.pair_id
where overlap >= 0.40 and occluded >= 0.15 and gap >= 100 group by p.pair_id having bool_or(visible) and bool_or(not visible)""",
)
def g9(t: Tables) -> DataFrame:
    found = skills.occlusion_visibility(pairs(t), t.lift("l_matches"))
    return found.select("pair_id", numbers("visible_match_idx").alias("seen"), numbers("occluded_match_idx").alias("hidden"), F.col("n_visible").cast("long").alias("n_visible"), F.col("n_occluded").cast("long").alias("n_occluded"))


BUCKETED = """with s as (select p.pair_id, match_idx, src_label, scale, dz, visible, spatial, depth, hidden from (
  select m.*, tgt_area / src_area scale, depth_src - depth_obs dz, rotation >= 30 and visible and tgt_mask >= 0 and src_area > 0 and tgt_area > 0 and (tgt_area / src_area < 0.6 or tgt_area / src_area > 1.67) spatial,
    ratio >= 1.3 and visible and abs(depth_src - depth_obs) >= 0.5 depth, overlap >= 0.40 and occluded >= 0.15 and gap >= 100 hidden from l_pairs p join l_matches m on m.pair_id = p.pair_id) p)
select pair_id, 'cross_spatial_transformation' skill, arg_min(src_label, match_idx) bucket from s where spatial group by pair_id
union all select pair_id, 'cross_depth_variation', case when arg_min(dz, match_idx) > 0 then 'closer' else 'farther' end from s where depth group by pair_id
union all select pair_id, 'cross_occlusion_visibility', 'vis=True/occ=True' from s where hidden group by pair_id having bool_or(visible) and bool_or(not visible)"""


@query("x21b_evidence_to_bucket", BUCKETED)
def x21b(t: Tables) -> DataFrame:
    """What the pose skills give, through JSON, is what balancing reads."""
    only = ("cross_depth_variation", "cross_occlusion_visibility", "cross_spatial_transformation")
    found = skills.evidence(pairs(t), t.lift("l_matches"), t.lift("l_masks"), only)
    return found.select("pair_id", "skill", curate.answer_bucket(F.col("skill"), skills.parsed(F.col("evidence"))).alias("bucket"))


@query("p14_overlap_window", "select pair_id from l_pairs where overlap between 0.15 and 0.30")
def p14(t: Tables) -> DataFrame:
    return pairs(t).where(skills.within(0.15, 0.30)).select("pair_id")


@query("p15_viewpoint_shift", "select pair_id, rotation <= 100 and rotation >= 20 and translation >= 0.6 both_, rotation <= 100 and (rotation >= 20 or translation >= 0.6) any_ from l_pairs")
def p15(t: Tables) -> DataFrame:
    return pairs(t).select("pair_id", skills.shifted().alias("both_"), skills.shifted(mode="or").alias("any_"))


@query("f19_canonical_label", "select pair_id, match_idx, lower(trim(coalesce(src_label, ''))) name from l_matches")
def f19(t: Tables) -> DataFrame:
    return t.lift("l_matches").select("pair_id", "match_idx", skills.name_of(F.col("src_label")).alias("name"))
