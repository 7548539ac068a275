"""Lifts of the driver's tables to scenes, and the helpers that give them their shapes as DataFrames."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vistaloom.operators.pairs import Depths
from vistaloom.plans.registry import Tables, lift

#: Camera of the lifted frames: fx, fy, cx, cy; image and depth raster sizes.
K, IMAGE, CELLS = (500.0, 500.0, 320.0, 240.0), (640, 480), (64, 48)

lift(
    "l_seen",
    """
select concat('scene', lpad(cast(user_id as string), 4, '0')) scene_id, user_id, ord, 10 * ord frame_no, event_id, event_type, props, ts, value,
  round(2.5 + 2.0 * cos(radians(cast(ord * 9 + user_id * 31 as double))), 6) cx,
  round(2.5 + 2.0 * sin(radians(cast(ord * 9 + user_id * 31 as double))), 6) cy,
  cast(1.5 as double) + cast(event_id % 7 as double) * 0.01 cz,
  cast((ord * 11 + user_id * 17 + event_id % 9) % 360 as double) y,
  cast((event_id * 29) % 41 - 20 as double) p
from (select *, row_number() over (partition by user_id order by ts, event_id) ord from {events}) e0
""",
)
lift(
    "l_all",
    """
select scene_id, user_id, ord, frame_no, event_id, event_type, props, ts, value, cz,
  case when event_type = 'error' then cast('NaN' as double) else cx end cx, cy,
  round(cos(radians(p)) * cos(radians(y)), 6) ax, round(cos(radians(p)) * sin(radians(y)), 6) ay,
  round(sin(radians(p)), 6) az, round(sin(radians(y)), 6) rx, round(-cos(radians(y)), 6) ry
from l_seen
""",
)
lift("l_frames", "select * from l_all where event_type <> 'error'")


def frames(t: Tables) -> DataFrame:
    """All frames with their poses; those of `error` events have a pose that isn't finite."""
    return posed(t.lift("l_all")).select("scene_id", "ord", "frame_id", "event_id", "event_type", "props", "ts", "value", "user_id", "pose")


def unposed(t: Tables) -> DataFrame:
    """Frames with what posed() makes frame_id and pose from; those of `error` events are left out, since their pose isn't finite."""
    return t.lift("l_frames").select("scene_id", "ord", "frame_no", "event_id", "cx", "cy", "cz", "ax", "ay", "az", "rx", "ry")


def posed(f: DataFrame) -> DataFrame:
    """Lifted frames with frame_id and pose."""
    c = F.col
    down = (-c("az") * c("ry"), c("az") * c("rx"), c("ax") * c("ry") - c("ay") * c("rx"))
    zero, one = F.lit(0.0), F.lit(1.0)
    pose = F.array(c("rx"), down[0], c("ax"), c("cx"), c("ry"), down[1], c("ay"), c("cy"), zero, down[2], c("az"), c("cz"), zero, zero, zero, one)
    return f.withColumns({"frame_id": c("frame_no").cast("string"), "pose": pose})


def depth(event: Column, i: Column, j: Column) -> Column:
    """The lifted raster at a cell: a rule instead of stored values."""
    return F.when((i * 7 + j * 13 + event) % 17 == 0, F.lit(0.0)).otherwise(F.lit(1.0) + ((i * 3 + j * 5 + event * 11) % 300).cast("double") / 100)


def depth_of_pair(which: str, i: Column, j: Column) -> Column:
    return depth(F.col(f"event_id_{which}"), i, j)


def depth_of_event(event: np.ndarray | int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """depth over arrays."""
    return np.where((i * 7 + j * 13 + event) % 17 == 0, 0.0, 1.0 + (i * 3 + j * 5 + event * 11) % 300 / 100)


def depth_of_raster() -> Callable[[int], np.ndarray]:
    """The whole raster of an event; what doesn't depend on it is worked out once, and remainders are taken of sums of remainders."""
    i, j = (x.ravel() for x in np.meshgrid(np.arange(CELLS[0]), np.arange(CELLS[1]), indexing="ij"))
    hole, step, metres = (i * 7 + j * 13) % 17, (i * 3 + j * 5) % 300, 1.0 + np.arange(600) % 300 / 100
    return lambda event: np.where((hole == -event % 17), 0.0, metres[step + event * 11 % 300])


def arrays_of_depth(batch: pa.RecordBatch, which: str, rows: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """depth_of_pair over arrays of a batch's pairs."""
    return depth_of_event(batch.column(f"event_id_{which}").to_numpy()[rows], i, j)


depths_of_pair = Depths(arrays_of_depth)

#: The raster's rule in SQL, for an event and a cell.
DEPTH_SQL = "(case when ({i} * 7 + {j} * 13 + {e}) % 17 = 0 then 0.0 else 1.0 + cast(({i} * 3 + {j} * 5 + {e} * 11) % 300 as double) / 100 end)"


def depth_sql(e: str, i: str, j: str) -> str:
    return DEPTH_SQL.format(e=e, i=i, j=j)

lift(
    "l_px",
    """
select scene_id, ord, event_id, a.n_nationkey pu, b.n_nationkey pv, (a.n_nationkey / 4) ix, cast(floor(a.n_nationkey / 4.0) + 4 * floor(b.n_nationkey / 4.0) + (event_id % 5) * 3 as bigint) inst_id,
  (a.n_nationkey * 7 + b.n_nationkey * 13 + event_id) % 5 <> 0 and (floor(a.n_nationkey / 4.0) * 5 + floor(b.n_nationkey / 4.0) * 3 + event_id) % 3 <> 0 valid
from l_frames cross join (select n_nationkey from {nation} where n_nationkey < 16) a cross join (select n_nationkey from {nation} where n_nationkey < 12) b
""".replace("(a.n_nationkey / 4) ix, ", ""),
)


def pixels_of_residue(t: Tables) -> DataFrame:
    """(residue, inst_id, n_px, n_valid): the rule of l_px, which asks only for an event's remainder by 15, as footprints of each remainder."""
    n = t.nation.select("n_nationkey")
    cells = n.where("n_nationkey < 16").select(F.col("n_nationkey").alias("pu")).crossJoin(n.where("n_nationkey < 12").select(F.col("n_nationkey").alias("pv")))
    rows = t.spark.range(-14, 15, numPartitions=1).select(F.col("id").alias("residue")).crossJoin(F.broadcast(cells))
    e, u, v = F.col("residue"), F.col("pu"), F.col("pv")
    i, j = F.floor(u / 4), F.floor(v / 4)
    valid = ((u * 7 + v * 13 + e) % 5 != 0) & ((i * 5 + j * 3 + e) % 3 != 0)
    return rows.groupBy("residue", (i + 4 * j + e % 5 * 3).cast("long").alias("inst_id")).agg(F.count(F.lit(1)).alias("n_px"), F.count_if(valid).alias("n_valid"))


lift(
    "l_labels",
    """
select cast(n_nationkey as bigint) inst_id, case n_nationkey when 3 then 'wall' when 7 then ' Floor ' when 9 then 'Door Frame' when 5 then '' else concat('obj', cast(n_nationkey as string)) end label from {nation}
""",
)
lift("l_lines", "select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) line from {lineitem}")
lift(
    "l_dets",
    """
select l_orderkey frame, cast(line as int) det, line % 3 run, p_name label, lower(p_brand) canonical, round(1 - l_discount - l_tax, 4) score,
  cast((l_partkey * 13 + l_suppkey * 7) % 400 as double) x0, cast((l_partkey * 5 + l_suppkey * 11) % 300 as double) y0,
  cast((l_partkey * 13 + l_suppkey * 7) % 400 as double) + 60 + l_quantity * 4 x1, cast((l_partkey * 5 + l_suppkey * 11) % 300 as double) + 40 + p_size * 3 y1
from l_lines join {part} on l_partkey = p_partkey
""",
)
lift(
    "l_near",
    """
select l_orderkey frame, cast(line as int) det, line % 3 run, concat('c', cast(line % 2 as string)) canonical, concat('w', cast(l_suppkey % 3 as string)) label, round(1 - l_discount - l_tax, 4) score,
  cast(100 + (l_partkey % 4) * 25 as double) x0, cast(80 + (l_suppkey % 3) * 20 as double) y0, cast(220 + (l_partkey % 4) * 25 + l_quantity as double) x1, cast(190 + (l_suppkey % 3) * 20 + line as double) y1
from l_lines
""",
)
lift(
    "l_gt",
    """
select l_orderkey frame, cast(line as int) inst, concat('w', cast((l_suppkey + l_partkey) % 3 as string)) label,
  cast(90 + (l_suppkey % 4) * 28 as double) x0, cast(70 + (l_partkey % 3) * 22 as double) y0, cast(205 + (l_suppkey % 4) * 28 + l_quantity as double) x1, cast(185 + (l_partkey % 3) * 22 as double) y1
from l_lines where line <= 5
""",
)
lift(
    "l_matches",
    """
select concat('scene', lpad(cast(o_custkey % 40 as string), 4, '0')) scene_id, l_orderkey pair_id, cast(line as int) match_idx, l_returnflag <> 'R' visible,
  round(l_extendedprice / 20000 + 1e-9, 4) x, round(l_quantity / 12, 4) y, round(l_tax * 20, 4) z,
  round(1 + l_quantity / 15, 4) depth_src, round(1 + l_quantity / 15 + l_discount * 8 - 0.3, 4) depth_obs, round(l_discount * 5, 4) iou,
  l_suppkey % 4 src_cat, (l_suppkey + case when l_partkey % 5 = 0 then 1 else 0 end) % 4 tgt_cat, l_partkey % 9 src_mask, l_partkey % 9 + case when l_partkey % 7 = 0 then 0 - l_partkey % 9 - 1 else 0 end tgt_mask,
  round(0.2 + l_tax * 5 + l_discount, 4) src_score, round(0.15 + l_discount * 6, 4) tgt_score, round(0.45 + l_discount * 5, 4) coverage,
  cast(100 + l_quantity * 3 as double) src_area, cast(60 + (l_partkey % 50) * 8 as double) tgt_area,
  l_quantity * 13 - 5.5 u, (l_partkey % 100) * 5 - 6.25 v, (l_suppkey * 17) % 656 - 6.5 su, (l_partkey * 7) % 496 - 6.75 sv,
  case when l_suppkey % 11 = 0 then ' ' else concat('cat', cast(l_suppkey % 4 as string)) end src_label, case when l_suppkey % 13 = 0 then '' else concat('Cat', cast(l_suppkey % 4 as string)) end tgt_label
from l_lines join {orders} on l_orderkey = o_orderkey
""",
)
lift(
    "l_masks",
    """
select o_orderkey pair_id, side, cast(n_nationkey as int) mask, case when (o_orderkey + n_nationkey) % 13 = 0 then ' ' else concat('Cat', cast((o_custkey + n_nationkey) % 4 as string)) end label,
  case when (n_nationkey + o_custkey) % 3 = 0 then concat(' cat', cast((o_custkey + n_nationkey) % 4 as string)) else '' end canonical
from {orders} cross join (select n_nationkey from {nation} where n_nationkey < 11) n cross join (select case r_regionkey when 0 then 'src' else 'tgt' end side from {region} where r_regionkey < 2) s
""",
)
lift(
    "l_pairs",
    """
select concat('scene', lpad(cast(o_custkey % 40 as string), 4, '0')) scene_id, o_orderkey pair_id,
  round((o_orderkey % 90) / 100.0, 4) overlap, round((o_custkey % 40) / 100.0, 4) occluded, round(cast(o_orderkey % 120 as double), 4) rotation, round((o_custkey % 30) / 10.0, 4) translation,
  o_orderkey % 200 gap, round(1 + (o_orderkey % 17) / 10.0, 4) ratio, round(cast((o_orderkey * 37) % 360 as double), 4) yaw, round(cast((o_orderkey * 7) % 61 - 30 as double), 4) pitch
from {orders}
""",
)
#: The skills, in their sorted order.
SKILLS = (
    "anchor",
    "counting",
    "cross_depth_variation",
    "cross_object_correspondence",
    "cross_occlusion_visibility",
    "cross_point_correspondence",
    "cross_spatial_transformation",
    "relative_direction",
    "relative_distance",
)
lift(
    "l_manifests",
    "select o_orderkey id, concat('scene', cast(o_custkey % 50 as string)) scene_id, cast(10 * (o_orderkey % 97) as string) src, cast(10 * (o_custkey % 89) as string) tgt, case o_orderkey % 9 "
    + " ".join(f"when {k} then '{n}'" for k, n in enumerate(SKILLS))
    + " end skill, o_orderstatus status, o_orderpriority priority, o_totalprice total, o_custkey cust from {orders}",
)
lift(
    "l_runs",
    """
select doc_id frame, run, case (doc_id * 3 + run * (doc_id % 3)) % 8
  when 0 then concat('sharp view | YES') when 1 then concat('blurred', chr(10), ' dark  |  no ') when 2 then '' when 3 then 'there is no subject here' when 4 then 'looks fine to me'
  when 5 then concat('a | b | yes') when 6 then concat('nothing | maybe') else concat('ok |yes', chr(10)) end answer
from {documents} cross join (select r_regionkey run from {region}) r
""",
)
lift(
    "l_items",
    """
select doc_id frame, run, item, case (doc_id * 3 + run + item) % 7 when 0 then ' Chair ' when 1 then 'chair' when 2 then 'table lamp' when 3 then '' when 4 then 'Sofa' when 5 then 'lamp' else 'arm chair' end obj,
  case (doc_id * 3 + run + item) % 7 when 0 then 'chair' when 1 then ' Chair' when 2 then 'Lamp' when 3 then 'ghost' when 4 then '' when 5 then 'lamp' else 'Chair' end canon
from {documents} cross join (select r_regionkey run from {region}) r cross join (select n_nationkey item from {nation} where n_nationkey < 4) i
""",
)
lift(
    "l_json",
    """
select doc_id frame, case doc_id % 7
  when 0 then concat('[{"object": "chair", "canonical": "Chair"}, {"object": "t', cast(doc_id as string), '"}]')
  when 1 then concat('Sure!', chr(10), '```json', chr(10), '[{"object": " lamp ", "canonical": ""}, {"name": "x"}]', chr(10), '```')
  when 2 then '[{"object": "a[1]", "canonical": "b"}, {"object": "cut'
  when 3 then 'no array' when 4 then '[]' when 5 then concat('[{"object": "q', chr(92), '"]", "n": 1}] trailing ]') else '' end answer
from {documents}
""",
)
lift("l_verdicts", "select scene_id, ord, frame_no, case event_id % 6 when 0 then false when 1 then null else true end usable, concat('r', cast(event_id % 3 as string)) reason from l_frames where event_id % 7 <> 3")
