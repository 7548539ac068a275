"""What comes after detectors and segmenters: sizes, suppression, claims, clusters, and rule-based stand-ins for models.

Detections are rows (frame, det, label, score, x0, y0, x1, y1). Masks are run-length rows (frame, mask, v, u0, u1): row v
of the mask covers columns u0 up to, but without, u1. A band (v, v1, u0, u1) stands for equal runs of the rows from v up to v1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vistaloom.functions import geometry as g
from vistaloom.operators import fold

BOX = ("x0", "y0", "x1", "y1")


def box(of: Column | None = None) -> list[Column]:
    return [F.col(n) if of is None else of[n] for n in BOX]


def not_too_large(dets: DataFrame, width: float, height: float, most: float = 0.7) -> DataFrame:
    return dets.where(g.area(box()) / (width * height) <= most)


def suppressed(dets: DataFrame, by: list[str], most_overlap: float = 0.7, top: int = 30) -> DataFrame:
    """(by, det, score, box) of detections that overlap no better-scored kept one by more; the best `top` of each group."""
    rows = dets.withColumn("__rank", -F.col("score"))
    kept = fold.greedy(rows, by, ["__rank", "det"], ["__rank", "det", "score", *BOX], lambda acc, x: ~F.exists(acc, lambda k: g.box_iou(box(k), box(x)) > most_overlap))
    place = F.row_number().over(Window.partitionBy(*by).orderBy("__rank", "det"))
    return kept.withColumn("place", place).where(F.col("place") <= top).drop("__rank")


def mask_areas(runs: DataFrame, by: list[str]) -> DataFrame:
    return runs.groupBy(*by, "mask").agg(F.sum(F.col("u1") - F.col("u0")).alias("area"))


def mask_overlaps(a: DataFrame, b: DataFrame, by: list[str], same: bool = False, carry: tuple[str, ...] = (), outer: bool = False) -> DataFrame:
    """(by, mask_a, carry, mask_b, n_both, iou) of masks whose bands meet; `same` takes each unordered pair of one table once.

    outer keeps masks of a that meet none, once, with mask_b null. Bands that stand in one group meet there, and areas are
    summed over the group's rows, so one shuffle by the group is enough; runs, which are bands of one row, meet on that row.
    """
    left, right = (banded(x, by) for x in (a, b))
    left = left.select(*by, F.col("mask").alias("mask_a"), *carry, F.col("v").alias("r0"), F.col("v1").alias("r1"), F.col("u0").alias("p0"), F.col("u1").alias("p1"), F.col("area").alias("area_a"))
    right = right.select(*by, F.col("mask").alias("mask_b"), F.col("v").alias("s0"), F.col("v1").alias("s1"), F.col("u0").alias("q0"), F.col("u1").alias("q1"), F.col("area").alias("area_b"))
    left, right = left.alias("l"), right.alias("r")
    on = (F.col("p0") < F.col("q1")) & (F.col("q0") < F.col("p1")) & (F.col("r0") < F.col("s1")) & (F.col("s0") < F.col("r1"))
    if "v1" not in a.columns:
        on &= F.col("r0") == F.col("s0")
    if same:
        on &= F.col("mask_a") < F.col("mask_b") if not outer else F.col("mask_a") != F.col("mask_b")
    for c in by:
        on &= F.col(f"l.{c}") == F.col(f"r.{c}")
    rows = left.join(right, on, "left" if outer else "inner").select(*[F.col(f"l.{c}").alias(c) for c in by], "mask_a", *carry, "area_a", "mask_b", "area_b", ((F.least("p1", "q1") - F.greatest("p0", "q0")) * (F.least("r1", "s1") - F.greatest("r0", "s0"))).alias("px"))
    both = rows.groupBy(*by, "mask_a", *carry, "area_a", "mask_b", "area_b").agg(F.sum("px").alias("n_both"))
    return both.withColumn("iou", F.col("n_both") / (F.col("area_a") + F.col("area_b") - F.col("n_both"))).drop("area_a", "area_b")


def best_overlaps(a: DataFrame, b: DataFrame, by: list[str]) -> DataFrame:
    """(by, mask, iou): each mask of a with the IoU of the mask of b that it shares most with, 0 where it meets none."""
    pairs = mask_overlaps(a, b, by, outer=True)
    return pairs.groupBy(*by, F.col("mask_a").alias("mask")).agg(F.coalesce(F.max("iou"), F.lit(0.0)).alias("iou"))


def suppressed_masks(masks: DataFrame, by: list[str], least_overlap: float = 0.4) -> DataFrame:
    """(by, mask, place) of masks, the best first, that overlap no kept one by least_overlap or more; masks: bands with score."""
    pairs = mask_overlaps(masks, masks, by, same=True, carry=("score",), outer=True)
    foes = pairs.groupBy(*by, F.col("mask_a").alias("mask"), "score").agg(F.collect_set(F.when(F.col("iou") >= least_overlap, F.col("mask_b"))).alias("foes"))
    rows = foes.withColumn("__rank", -F.col("score"))
    kept = fold.greedy(rows, by, ["__rank", "mask"], ["__rank", "mask", "foes"], lambda acc, x: ~F.exists(acc, lambda k: F.array_contains(x["foes"], k["mask"])))
    return kept.select(*by, "mask", F.row_number().over(Window.partitionBy(*by).orderBy("__rank", "mask")).alias("place"))


def claimed_instances(dets: DataFrame, instances: DataFrame, least: float, by: list[str], order: list[str], strict: bool) -> DataFrame:
    """(by, det, claimed): each detection in order takes its best unclaimed instance (by, inst, i0, j0, i1, j1) above `least`."""
    iou = g.box_iou(box(), [F.col(n) for n in ("i0", "j0", "i1", "j1")])
    options = dets.join(instances, by).withColumn("iou", iou).where(F.col("iou") > least if strict else F.col("iou") >= least)
    best = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("iou")).alias("rank"), "inst"))), lambda o: o["inst"])
    grouped = options.groupBy(*by, "det", *[o for o in order if o != "det"]).agg(best.alias("options"))
    return fold.claims(grouped, by, order, "det", "options")


def cluster_votes(dets: DataFrame, by: list[str], least_runs: int, least_iou: float = 0.5) -> DataFrame:
    """One box per cluster of same-named detections over runs that enough runs hold.

    The box is the mean weighted by score (plain where scores sum to 0), the score the mean, the label the most common one,
    the first seen among equals. dets: by, canonical, run, det, label, score and box.
    """
    group = [*by, "canonical"]
    placed = fold.first_fit(dets, group, ["run", "det"], ["run", "det", "label", "score", *BOX], lambda c, x: g.box_iou(box(c), box(x)) >= least_iou)
    total = F.sum("score")
    mean = {n: F.when(total != 0, F.sum(F.col("score") * F.col(n)) / total).otherwise(F.avg(n)) for n in BOX}
    sums = placed.groupBy(*group, "cluster").agg(F.count_distinct("run").alias("n_runs"), F.avg("score").alias("score"), *[c.alias(n) for n, c in mean.items()])
    labels = placed.groupBy(*group, "cluster", "label").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("run", "det")).alias("first"))
    top = labels.groupBy(*group, "cluster").agg(F.min(F.struct((-F.col("n")).alias("t"), "first", "label")).alias("top")).select(*group, "cluster", F.col("top.label").alias("label"))
    return sums.where(F.col("n_runs") >= least_runs).join(top, [*group, "cluster"])


def rectangle(of: list[Column], width: int, height: int) -> list[Column]:
    """A box rounded half to even and clipped to the image, as whole numbers."""
    return [F.greatest(F.lit(0), F.least(F.lit(width if k % 2 == 0 else height), F.rint(c).cast("int"))) for k, c in enumerate(of)]


def mask_box_iou(mask: list[Column], of: list[Column], width: int, height: int) -> Column:
    """IoU of a rectangular mask in whole pixels and a box, which is rounded and clipped first."""
    r = rectangle(of, width, height)
    return g.box_iou([c.cast("double") for c in mask], [c.cast("double") for c in r])


def noop_detections(frames: DataFrame, n: int, width: int, height: int) -> DataFrame:
    """A grid of n by n boxes, each six tenths of its cell, whose scores fall by a hundredth; a detector for tests."""
    cell = F.sequence(F.lit(0), F.lit(n - 1))
    rows = frames.withColumn("j", F.explode(cell)).withColumn("i", F.explode(cell)).withColumn("k", F.col("j") * n + F.col("i"))
    cw, ch = width / n, height / n
    x, y = (F.col("i") + 0.5) * cw, (F.col("j") + 0.5) * ch
    made = {"det": F.col("k"), "label": F.concat(F.lit("obj"), "k"), "score": 1 - F.col("k") * 0.01, "x0": x - 0.3 * cw, "y0": y - 0.3 * ch, "x1": x + 0.3 * cw, "y1": y + 0.3 * ch}
    return rows.withColumns(made).drop("i", "j", "k")


def rectangle_masks(dets: DataFrame, width: int, height: int) -> DataFrame:
    """Detections with their rounded rectangle as mask: its sides, area and centre."""
    sides = dict(zip(("m0", "n0", "m1", "n1"), rectangle(box(), width, height), strict=True))
    rows = dets.withColumns(sides)
    return rows.withColumns({"area": F.greatest(F.lit(0), F.col("m1") - F.col("m0")) * F.greatest(F.lit(0), F.col("n1") - F.col("n0")), "cu": (F.col("m0") + F.col("m1")) / 2, "cv": (F.col("n0") + F.col("n1")) / 2})


def run_lengths(masks: DataFrame, by: list[str]) -> DataFrame:
    """Run-length rows of rectangular masks (by, mask, m0, n0, m1, n1)."""
    return masks.where("m1 > m0 and n1 > n0").select(*by, "mask", F.explode(F.sequence("n0", F.col("n1") - 1)).alias("v"), F.col("m0").alias("u0"), F.col("m1").alias("u1"))


def bands(masks: DataFrame, by: list[str], carry: tuple[str, ...] = (), empty: bool = False) -> DataFrame:
    """Rectangular masks as bands, rows v up to, but without, v1 that cover the same columns: one for each mask. empty keeps masks without pixels."""
    held = masks if empty else masks.where("m1 > m0 and n1 > n0")
    return held.select(*by, "mask", *carry, F.col("n0").alias("v"), F.col("n1").alias("v1"), F.col("m0").alias("u0"), F.col("m1").alias("u1"))


def banded(runs: DataFrame, by: list[str]) -> DataFrame:
    """Bands with the area of their mask; a run is a band of one row."""
    rows = runs if "v1" in runs.columns else runs.withColumn("v1", F.col("v") + 1)
    size = F.greatest(F.lit(0), F.col("u1") - F.col("u0")) * F.greatest(F.lit(0), F.col("v1") - F.col("v"))
    return rows.withColumn("area", F.sum(size).over(Window.partitionBy(*by, "mask")))


def tight_boxes(pixels: DataFrame, by: list[str]) -> DataFrame:
    """Box and area of each instance; the far sides lie one beyond the last pixel."""
    return pixels.groupBy(*by).agg(F.min("pu").alias("x0"), F.min("pv").alias("y0"), (F.max("pu") + 1).alias("x1"), (F.max("pv") + 1).alias("y1"), F.count(F.lit(1)).alias("area"), F.avg("pu").alias("cu"), F.avg("pv").alias("cv"))


def canonical(raw: Column, classes: Column) -> Column:
    """The longest class inside a name, else the longest that the name lies in, else the name; the first among equals.

    classes: an array of names in order, a vocabulary of bounded size.
    """

    def longest(a: Column) -> Column:
        return F.aggregate(a, F.lit(None).cast("string"), lambda best, c: F.when(best.isNull() | (F.length(c) > F.length(best)), c).otherwise(best))

    return F.coalesce(longest(F.filter(classes, lambda c: F.contains(raw, c))), longest(F.filter(classes, lambda c: F.contains(c, raw))), raw)


def nearest_mask(points: DataFrame, masks: DataFrame, by: list[str], point: str) -> DataFrame:
    """(by, point, mask, d2): of the masks that hold a point's pixel (u, v), the one whose centre is nearest; the lowest mask among equals.

    masks: bands with the mask's centre (cu, cv), or runs with it, which points meet on their row.
    """
    rows = masks if "v1" in masks.columns else masks.withColumn("v1", F.col("v") + 1)
    rows = rows.withColumnsRenamed({"v": "row_v"}).select(*by, "mask", "row_v", "v1", "u0", "u1", "cu", "cv")
    left, right = points.alias("l"), rows.alias("r")
    on = (F.col("u") >= F.col("u0")) & (F.col("u") < F.col("u1"))
    on &= (F.col("v") >= F.col("row_v")) & (F.col("v") < F.col("v1")) if "v1" in masks.columns else F.col("v") == F.col("row_v")
    for c in by:
        on &= F.col(f"l.{c}") == F.col(f"r.{c}")
    near = left.join(right, on).select(*[F.col(f"l.{c}").alias(c) for c in by], point, "mask", ((F.col("u") - F.col("cu")) ** 2 + (F.col("v") - F.col("cv")) ** 2).alias("d2"))
    return near.groupBy(*by, point).agg(F.min(F.struct("d2", "mask")).alias("m")).select(*by, point, F.col("m.mask").alias("mask"), F.col("m.d2").alias("d2"))
