"""From matches to records: first-wins voxels, pixels, caps, routing to skills, manifests and the rejection ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vistaloom.functions import geometry as g

#: Skills whose records may be occluded; the others take visible ones only.
BOTH_POLARITIES = ("counting", "cross_occlusion_visibility")


def first_in_voxel(matches: DataFrame, size: float = 0.05, order: tuple[str, ...] = ("pair_id", "match_idx")) -> DataFrame:
    """matches with `first`: whether a match is its scene's first in its voxel, visible and occluded ones apart."""
    key = [g.voxel(F.col(c), size) for c in "xyz"]
    return matches.withColumn("first", F.row_number().over(Window.partitionBy("scene_id", "visible", *key).orderBy(*order)) == 1)


def emitted(matches: DataFrame, width: int, height: int, cap: int | None, size: float = 0.05, order: tuple[str, ...] = ("pair_id", "match_idx")) -> DataFrame:
    """matches with both pixels (su, sv and u, v rounded and held inside) and `reason` (null: emitted), in the order given.

    A voxel is taken before the pixels are looked at, so a match outside the image still keeps later ones out of its voxel.
    The cap stops a scene after that many records: what comes later is neither emitted nor refused.
    """
    ends = {"psu": ("su", width), "psv": ("sv", height), "pu": ("u", width), "pv": ("v", height)}
    rows = first_in_voxel(matches, size, order).withColumns({n: g.round_clip(F.col(c), k) for n, (c, k) in ends.items()})
    outside = F.col("psu").isNull() | F.col("psv").isNull() | F.col("pu").isNull() | F.col("pv").isNull()
    rows = rows.withColumn("reason", F.when(~F.col("first"), "voxel_dup").when(outside, "out_of_bounds"))
    if cap is None:
        return rows
    before = F.coalesce(F.sum(F.when(F.col("reason").isNull(), 1).otherwise(0)).over(Window.partitionBy("scene_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("before", before).where(F.col("before") < cap).drop("before")


def accepting(visible: Column, skills: tuple[str, ...]) -> Column:
    """The skills that take a record of this polarity."""
    return F.when(visible, F.array(*map(F.lit, skills))).otherwise(F.array(*[F.lit(s) for s in skills if s in BOTH_POLARITIES]))


def routed(records: DataFrame, skills: tuple[str, ...]) -> DataFrame:
    """A row per record and skill that takes it, with polarity; `_all` has every record. records: tasks, visible."""
    into = F.concat(F.array(F.lit("_all")), F.array_intersect("tasks", accepting(F.col("visible"), skills)))
    return records.withColumn("skill", F.explode(into)).withColumn("polarity", F.when(F.col("visible"), "pos").otherwise("neg"))


def write_routed(records: DataFrame, skills: tuple[str, ...], path: str, mode: str = "overwrite") -> None:
    """One folder of JSON lines per skill and polarity."""
    routed(records, skills).write.mode(mode).partitionBy("skill", "polarity").json(path)


def rounded(df: DataFrame, columns: list[str], digits: int = 4) -> DataFrame:
    """Columns rounded half to even, as records are written."""
    return df.withColumns({c: F.bround(c, digits) for c in columns})


def manifests(pairs: DataFrame, matches: DataFrame, width: int, height: int) -> DataFrame:
    """pairs with `objects`, all matches of each in order, their pixels held inside the image."""
    inside = lambda c, n: F.greatest(F.lit(0), F.least(F.lit(n - 1), F.rint(c).cast("int")))
    one = F.struct("match_idx", "src_label", "tgt_label", "visible", inside("u", width).alias("u"), inside("v", height).alias("v"), F.bround("depth_src", 4).alias("depth_src"), F.bround("iou", 4).alias("iou"))
    objects = matches.groupBy("pair_id").agg(F.array_sort(F.collect_list(one)).alias("objects"))
    return pairs.join(objects, "pair_id", "left")


def attempts_resolved(attempts: DataFrame, by: list[str]) -> DataFrame:
    """(by, outcome, try, reason) of retried matches: the first accepted try, else the first occluded, else the last one's reason.

    attempts: by, try, outcome ('accepted', 'occluded' or 'rejected'), reason.
    """
    first = lambda o: F.min(F.when(F.col("outcome") == o, F.struct("try", "reason")))
    tries = attempts.groupBy(*by).agg(first("accepted").alias("yes"), first("occluded").alias("no"), F.max(F.struct("try", "reason")).alias("last"))
    pick = F.coalesce("yes", "no", "last")
    outcome = F.when(F.col("yes").isNotNull(), "accepted").when(F.col("no").isNotNull(), "occluded").otherwise("rejected")
    return tries.select(*by, outcome.alias("outcome"), pick["try"].alias("try"), pick["reason"].alias("reason"))
