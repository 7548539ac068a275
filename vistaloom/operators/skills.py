"""Evidence of the nine skills: one row per pair that qualifies.

pairs: pair_id, overlap, occluded, rotation, translation, gap, ratio; for directions also center_* and axis_* of the target
camera. matches: pair_id, match_idx, visible, src_mask, tgt_mask (-1: none), labels, scores, box areas, mask area and depth
coverage, places. masks: pair_id, side ('src' or 'tgt'), mask, label, canonical: all masks of both frames. A skill is a
function of these; SKILLS holds them by name, and a new one is an entry.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vistaloom.functions import geometry as g

#: Compass buckets of an azimuth in the target camera's frame, by their lower edge; each is 45 degrees wide.
BUCKETS = (("front", -22.5), ("front-right", 22.5), ("right", 67.5), ("back-right", 112.5), ("front-left", -67.5), ("left", -112.5), ("back-left", -157.5))
#: The fields of evidence, as manifests and caches hold them.
EVIDENCE = """qualifying_matches array<int>, pair_rotation_deg double, pair_translation_m double,
n_visible_labeled int, n_occluded_candidates int, matches array<struct<match_idx:int,src_label:string,tgt_label:string,score:double>>, occluded_candidates array<int>,
occluded_matches array<struct<match_idx:int,src_label:string,tgt_label:string,score:double>>, n_shared_objects int, n_shared int,
shared_objects array<struct<match_idx:int,src_label:string,tgt_label:string,scale_ratio:double,non_trivial:boolean,point_tgt:array<int>,tgt_mask_area_frac:double,score:double>>,
category string, unique_total int, shared_match_idx array<int>, private_src_idx array<int>, private_tgt_idx array<int>,
reference_match_idx int, reference_label string, candidates array<struct<match_idx:int,label:string,distance_m:double>>, farthest_match_idx int, margin_m double,
targets array<struct<match_idx:int,label:string,azimuth_deg:double,elevation_deg:double,bucket:string,distance_m:double>>,
transformed_objects array<struct<match_idx:int,label:string,scale_ratio:double>>,
pair_median_delta_m double, varying_objects array<struct<match_idx:int,label:string,depth_src:double,depth_tgt:double,delta_m:double>>,
visible_match_idx array<int>, occluded_match_idx array<int>, n_visible int, n_occluded int"""


def within(low: float, high: float) -> Column:
    return F.col("overlap").between(low, high)


def name_of(label: Column) -> Column:
    return F.lower(F.trim(F.coalesce(label, F.lit(""))))


def sorted_list(x: Column, when: Column | None = None) -> Column:
    """Non-null values in order; those of rows that `when` holds for."""
    return F.array_sort(F.collect_list(x if when is None else F.when(when, x)))


def indices(rows: Column) -> Column:
    return F.transform(rows, lambda r: r["match_idx"])


def as_int(c: str) -> Column:
    return F.col(c).cast("int").alias(c)


def shifted(most_rotation: float = 100.0, rotation: float = 20.0, translation: float = 0.6, mode: str = "and") -> Column:
    """Whether the viewpoint moves enough, in rotation and (or) translation, and not too far."""
    r, t = F.col("rotation") >= rotation, F.col("translation") >= translation
    return (F.col("rotation") <= most_rotation) & ((r & t) if mode == "and" else (r | t))


def moved() -> tuple[Column, Column]:
    return F.col("rotation").cast("double").alias("pair_rotation_deg"), F.col("translation").cast("double").alias("pair_translation_m")


def cross_point(pairs: DataFrame, matches: DataFrame, masks: DataFrame | None = None, overlap=(0.15, 0.30), score: float = 0.25, coverage: float = 0.6, least: int = 1) -> DataFrame:
    """Labelled, well-scored matches with depth under their source mask; the occluded ones stand apart."""
    good = matches.where((name_of(F.col("src_label")) != "") & (F.col("src_score") >= score) & (F.col("coverage") >= coverage))
    rows = pairs.where(within(*overlap) & shifted()).join(good, "pair_id")
    row = F.struct(as_int("match_idx"), "src_label", F.when(F.col("tgt_mask") >= 0, F.col("tgt_label")).otherwise("").alias("tgt_label"), F.col("src_score").cast("double").alias("score"))
    found = rows.groupBy("pair_id", "rotation", "translation").agg(sorted_list(row, F.col("visible")).alias("matches"), sorted_list(row, ~F.col("visible")).alias("occluded_matches"))
    found = found.where(F.size("matches") >= least).withColumns({"qualifying_matches": indices(F.col("matches")), "occluded_candidates": indices(F.col("occluded_matches"))})
    return found.select("pair_id", "qualifying_matches", *moved(), F.size("matches").alias("n_visible_labeled"), F.size("occluded_matches").alias("n_occluded_candidates"), "matches", "occluded_candidates", "occluded_matches")


def cross_object(pairs: DataFrame, matches: DataFrame, masks: DataFrame | None = None, overlap=(0.15, 0.30), score: float = 0.25, share: float = 0.005, size=(640, 480), least: int = 1) -> DataFrame:
    """Matches whose target is labelled, well scored, large enough and inside the image."""
    u, v = F.col("u"), F.col("v")
    fraction = F.col("tgt_mask_area" if "tgt_mask_area" in matches.columns else "tgt_area") / (size[0] * size[1])
    good = matches.where("visible and tgt_mask >= 0").where((name_of(F.col("tgt_label")) != "") & (F.col("tgt_score") >= score) & (fraction >= share) & (u >= 0) & (u < size[0]) & (v >= 0) & (v < size[1]))
    rows = pairs.where(within(*overlap) & shifted()).join(good, "pair_id")
    shared = F.struct(
        as_int("match_idx"), F.trim("tgt_label").alias("tgt_label"), "src_label", F.array(F.rint(u).cast("int"), F.rint(v).cast("int")).alias("point_tgt"),
        F.bround(fraction, 5).alias("tgt_mask_area_frac"), F.col("tgt_score").cast("double").alias("score"),
    )
    found = rows.groupBy("pair_id", "rotation", "translation").agg(sorted_list(shared).alias("shared_objects")).where(F.size("shared_objects") >= least)
    return found.select("pair_id", indices(F.col("shared_objects")).alias("qualifying_matches"), *moved(), F.size("shared_objects").alias("n_shared_objects"), "shared_objects")


def anchor(pairs: DataFrame, matches: DataFrame, masks: DataFrame | None = None, overlap=(0.25, 0.70), translation: float = 0.6, rotation: float = 35.0, low: float = 0.5, high: float = 2.0, least: int = 1) -> DataFrame:
    """Shared objects of pairs that moved in one way at least, one of which changes its size."""
    still = (F.col("translation") < translation) & (F.col("rotation") < rotation)
    rows = pairs.where(within(*overlap) & ~still).join(matches.where("visible and tgt_mask >= 0 and src_area > 0 and tgt_area > 0"), "pair_id")
    scale = F.col("tgt_area") / F.col("src_area")
    shared = F.struct(as_int("match_idx"), "src_label", "tgt_label", scale.cast("double").alias("scale_ratio"), ((scale < low) | (scale > high)).alias("non_trivial"))
    found = rows.groupBy("pair_id", "rotation", "translation").agg(sorted_list(shared).alias("shared_objects"))
    found = found.where((F.size("shared_objects") >= least) & F.exists("shared_objects", lambda o: o["non_trivial"]))
    return found.select("pair_id", indices(F.col("shared_objects")).alias("qualifying_matches"), F.size("shared_objects").alias("n_shared"), *moved(), "shared_objects")


def counting(pairs: DataFrame, matches: DataFrame, masks: DataFrame, overlap=(0.15, 0.60), low: int = 3, high: int = 15) -> DataFrame:
    """Of each pair the category whose distinct objects in both views are countable and nearest to `low`.

    A mask that no visible match holds is private to its view, whether it was tried or not. Among equal categories the one
    with more shared objects wins, then the first name.
    """
    inside = pairs.where(within(*overlap)).select("pair_id")
    named = masks.join(inside, "pair_id", "left_semi").select("pair_id", "side", "mask", name_of(F.when(F.coalesce("canonical", F.lit("")) != "", F.col("canonical")).otherwise(F.col("label"))).alias("category")).where("category <> ''")
    seen = matches.join(inside, "pair_id", "left_semi").where("visible").select("pair_id", "match_idx", "src_mask", "tgt_mask")
    side = lambda s: named.where(F.col("side") == s).select("pair_id", F.col("mask").alias(f"{s}_mask"), F.col("category").alias(f"{s}_category"))
    both = seen.where("tgt_mask >= 0").join(side("src"), ["pair_id", "src_mask"]).join(side("tgt"), ["pair_id", "tgt_mask"]).where("src_category = tgt_category")
    shared = both.select("pair_id", F.col("src_category").alias("category"), F.lit("shared").alias("kind"), F.col("match_idx").cast("int").alias("idx"))
    held = seen.select("pair_id", F.inline(F.array(F.struct(F.lit("src").alias("side"), F.col("src_mask").alias("mask")), F.struct(F.lit("tgt").alias("side"), F.col("tgt_mask").alias("mask")))))
    private = named.join(held, ["pair_id", "side", "mask"], "left_anti").select("pair_id", "category", F.col("side").alias("kind"), F.col("mask").cast("int").alias("idx"))
    listed = lambda k: sorted_list(F.col("idx"), F.col("kind") == k)
    sums = shared.unionByName(private).groupBy("pair_id", "category").agg(listed("shared").alias("shared_match_idx"), listed("src").alias("private_src_idx"), listed("tgt").alias("private_tgt_idx"))
    n, lone = F.size("shared_match_idx"), F.size("private_src_idx") + F.size("private_tgt_idx")
    sums = sums.withColumn("unique_total", n + lone).where(F.col("unique_total").between(low, high) & (n > 0) & (lone > 0))
    place = F.row_number().over(Window.partitionBy("pair_id").orderBy(F.abs(F.col("unique_total") - low), F.desc(n), "category"))
    best = sums.withColumn("__p", place).where("__p = 1")
    return best.select("pair_id", F.col("shared_match_idx").alias("qualifying_matches"), "category", "unique_total", "shared_match_idx", "private_src_idx", "private_tgt_idx")


def relative_distance(pairs: DataFrame, matches: DataFrame, masks: DataFrame | None = None, overlap=(0.20, 0.70), objects: int = 3, margin: float = 0.5, coverage: float = 0.6, places: int | None = 4) -> DataFrame:
    """Of each pair the first reference whose farthest candidate is `margin` farther than the next, with all candidates, the farthest first.

    Distances are rounded to `places`, or left as they are for a caller that rounds by another rule.
    """
    rounded = lambda c: c if places is None else F.bround(c, places)
    good = pairs.where(within(*overlap)).select("pair_id").join(matches.where(F.col("visible") & (F.col("coverage") >= coverage)), "pair_id").select("pair_id", as_int("match_idx"), "src_label", "x", "y", "z")
    n = F.count(F.lit(1)).over(Window.partitionBy("pair_id"))
    good = good.withColumn("n", n).where(F.col("n") >= objects)
    a, b = good.alias("a"), good.alias("b")
    point = lambda s: tuple(F.col(f"{s}.{c}") for c in "xyz")
    far = g.norm(g.minus(point("b"), point("a")))
    rows = a.join(b, (F.col("a.pair_id") == F.col("b.pair_id")) & (F.col("a.match_idx") != F.col("b.match_idx"))).select(
        "a.pair_id", F.col("a.match_idx").alias("reference"), F.col("a.src_label").alias("reference_label"), F.struct((-far).alias("back"), F.col("b.match_idx").alias("match_idx"), F.col("b.src_label").alias("label")).alias("candidate")
    )
    found = rows.groupBy("pair_id", "reference", "reference_label").agg(F.array_sort(F.collect_list("candidate")).alias("c"))
    gap = F.get("c", F.lit(1))["back"] - F.get("c", F.lit(0))["back"]
    first = found.withColumn("margin", gap).where(F.col("margin") >= margin).groupBy("pair_id").agg(F.min(F.struct("reference", "reference_label", "c", "margin")).alias("r"))
    candidates = F.transform("r.c", lambda x: F.struct(x["match_idx"].alias("match_idx"), x["label"].alias("label"), rounded(-x["back"]).alias("distance_m")))
    rest = first.select("pair_id", "r.reference", "r.reference_label", "r.margin", candidates.alias("candidates"))
    return rest.select(
        "pair_id", F.concat(F.array("reference"), indices(F.col("candidates"))).alias("qualifying_matches"), F.col("reference").alias("reference_match_idx"), "reference_label", "candidates",
        F.get("candidates", F.lit(0))["match_idx"].alias("farthest_match_idx"), rounded(F.col("margin")).alias("margin_m"),
    )


def azimuth_bucket(azimuth: Column, hysteresis: float = 10.0) -> Column:
    """Compass bucket of degrees; null where an edge is nearer than the hysteresis."""
    a = F.pmod(azimuth + 180, g.num(360)) - 180
    behind = F.abs(F.abs(a) - 180)
    out = F.when(behind <= 22.5, F.when(22.5 - behind >= hysteresis, F.lit("back")))
    for name, low in BUCKETS:
        out = out.when((a >= low) & (a < low + 45), F.when((a - low >= hysteresis) & (low + 45 - a >= hysteresis), F.lit(name)))
    return out


def direction(point: g.Vector, center: g.Vector, axis: g.Vector) -> tuple[Column, Column, Column]:
    """(azimuth, elevation, distance) of a point seen from a camera on a floor whose up is +Z; counter-clockwise is positive."""
    d = g.minus(point, center)
    far = g.norm(d)
    elevation = F.degrees(F.asin(F.greatest(g.num(-1), F.least(g.num(1), d[2] / far))))
    azimuth = F.degrees(F.atan2(axis[0] * d[1] - axis[1] * d[0], axis[0] * d[0] + axis[1] * d[1]))
    return azimuth, elevation, far


def relative_direction(pairs: DataFrame, matches: DataFrame, masks: DataFrame | None = None, overlap=(0.05, 0.40), translation: float = 1.0, rotation: float = 20.0, elevation: float = 60.0, apart: float = 30.0) -> DataFrame:
    """Targets of pairs that lie in clear directions from the target camera, two of them far enough apart."""
    axis = tuple(F.col(f"axis_{c}") for c in "xyz")
    flat = F.sqrt(axis[0] * axis[0] + axis[1] * axis[1]) >= 1e-6
    rows = pairs.where(within(*overlap) & (F.col("translation") >= translation) & (F.col("rotation") >= rotation) & flat).join(matches.where("visible"), "pair_id")
    az, el, far = direction(tuple(F.col(c) for c in "xyz"), tuple(F.col(f"center_{c}") for c in "xyz"), axis)
    rows = rows.select("pair_id", "rotation", "translation", as_int("match_idx"), F.col("src_label").alias("label"), az.alias("azimuth"), el.alias("elevation"), far.alias("distance")).where((F.col("distance") >= 1e-6) & (F.abs("elevation") <= elevation))
    rows = rows.withColumn("bucket", azimuth_bucket(F.col("azimuth"))).where("bucket is not null").withColumn("azimuth_deg", F.bround("azimuth", 2))
    gap = F.lead("azimuth_deg").over(Window.partitionBy("pair_id").orderBy("azimuth_deg", "match_idx")) - F.col("azimuth_deg")
    target = F.struct("match_idx", "label", "azimuth_deg", F.bround("elevation", 2).alias("elevation_deg"), "bucket", F.bround("distance", 4).alias("distance_m"))
    found = rows.withColumn("gap", gap).groupBy("pair_id", "rotation", "translation").agg(F.max("gap").alias("widest"), sorted_list(target).alias("targets"))
    return found.where(F.col("widest") >= apart).select("pair_id", indices(F.col("targets")).alias("qualifying_matches"), *moved(), "targets")


def spatial_transformation(pairs: DataFrame, matches: DataFrame, masks: DataFrame | None = None, rotation: float = 30.0, low: float = 0.6, high: float = 1.67) -> DataFrame:
    scale = F.col("tgt_area") / F.col("src_area")
    good = matches.where("visible and tgt_mask >= 0 and src_area > 0 and tgt_area > 0").where((scale < low) | (scale > high))
    one = F.struct(as_int("match_idx"), F.col("src_label").alias("label"), scale.cast("double").alias("scale_ratio"))
    found = pairs.where(F.col("rotation") >= rotation).join(good, "pair_id").groupBy("pair_id", "rotation", "translation").agg(sorted_list(one).alias("transformed_objects"))
    return found.select("pair_id", indices(F.col("transformed_objects")).alias("qualifying_matches"), *moved(), "transformed_objects")


def depth_variation(pairs: DataFrame, matches: DataFrame, masks: DataFrame | None = None, ratio: float = 1.3, delta: float = 0.5) -> DataFrame:
    change = F.col("depth_src") - F.col("depth_obs")
    rows = pairs.where(F.col("ratio") >= ratio).join(matches.where("visible"), "pair_id")
    one = F.struct(as_int("match_idx"), F.col("src_label").alias("label"), F.bround("depth_src", 4).alias("depth_src"), F.bround("depth_obs", 4).alias("depth_tgt"), F.bround(change, 4).alias("delta_m"))
    found = rows.groupBy("pair_id").agg(F.bround(F.median(F.abs(change)), 4).alias("pair_median_delta_m"), sorted_list(one, F.abs(change) >= delta).alias("varying_objects"))
    return found.where(F.size("varying_objects") >= 1).select("pair_id", indices(F.col("varying_objects")).alias("qualifying_matches"), "pair_median_delta_m", "varying_objects")


def occlusion_visibility(pairs: DataFrame, matches: DataFrame, masks: DataFrame | None = None, overlap: float = 0.40, occluded: float = 0.15, gap: int = 100) -> DataFrame:
    rows = pairs.where((F.col("overlap") >= overlap) & (F.col("occluded") >= occluded) & (F.col("gap") >= gap)).join(matches.withColumn("match_idx", as_int("match_idx")), "pair_id")
    found = rows.groupBy("pair_id").agg(sorted_list(F.col("match_idx"), F.col("visible")).alias("visible_match_idx"), sorted_list(F.col("match_idx"), ~F.col("visible")).alias("occluded_match_idx"))
    n, m = F.size("visible_match_idx"), F.size("occluded_match_idx")
    return found.where((n > 0) & (m > 0)).select("pair_id", F.concat("visible_match_idx", "occluded_match_idx").alias("qualifying_matches"), "visible_match_idx", "occluded_match_idx", n.alias("n_visible"), m.alias("n_occluded"))


Gate = Callable[..., DataFrame]
SKILLS: dict[str, Gate] = {
    "anchor": anchor,
    "counting": counting,
    "cross_depth_variation": depth_variation,
    "cross_object_correspondence": cross_object,
    "cross_occlusion_visibility": occlusion_visibility,
    "cross_point_correspondence": cross_point,
    "cross_spatial_transformation": spatial_transformation,
    "relative_direction": relative_direction,
    "relative_distance": relative_distance,
}


def evidence(pairs: DataFrame, matches: DataFrame, masks: DataFrame, only: tuple[str, ...] | None = None) -> DataFrame:
    """(pair_id, skill, evidence): what each skill finds in each pair that qualifies for it, as JSON with the fields of EVIDENCE that the skill has."""
    out = None
    for name, f in SKILLS.items():
        if only is not None and name not in only:
            continue
        found = f(pairs, matches, masks)
        part = found.select("pair_id", F.lit(name).alias("skill"), F.to_json(F.struct(*[c for c in found.columns if c != "pair_id"])).alias("evidence"))
        out = part if out is None else out.unionByName(part)
    return out


def parsed(evidence: Column) -> Column:
    """Evidence as a struct with all fields of EVIDENCE."""
    return F.from_json(evidence, EVIDENCE)


def qualifying(pairs: DataFrame, matches: DataFrame, masks: DataFrame) -> DataFrame:
    """(pair_id, skills): the sorted skills that each pair qualifies for; pairs without any aren't in it."""
    return evidence(pairs, matches, masks).groupBy("pair_id").agg(F.array_sort(F.collect_set("skill")).alias("skills"))
