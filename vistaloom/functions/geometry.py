"""Camera geometry as column expressions. Poses are row-major 4x4 camera-to-world matrices, 16 doubles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Vector = tuple[Column, Column, Column]

#: The angle weight's foot, peak and far foot in degrees.
ANGLE_LOW, ANGLE_PEAK, ANGLE_HIGH = 10.0, 30.0, 80.0


def num(x: float) -> Column:
    return F.lit(float(x))


def at(pose: Column, row: int, col: int) -> Column:
    return F.get(pose, F.lit(row * 4 + col))


def camera_center(pose: Column) -> Vector:
    return at(pose, 0, 3), at(pose, 1, 3), at(pose, 2, 3)


def optical_axis(pose: Column) -> Vector:
    return at(pose, 0, 2), at(pose, 1, 2), at(pose, 2, 2)


def dot(a: Vector, b: Vector) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def minus(a: Vector, b: Vector) -> Vector:
    return a[0] - b[0], a[1] - b[1], a[2] - b[2]


def norm(a: Vector) -> Column:
    return F.sqrt(dot(a, a))


def clipped_acos(x: Column) -> Column:
    return F.degrees(F.acos(F.greatest(num(-1), F.least(num(1), x))))


def angle_between(a: Vector, b: Vector) -> Column:
    """Degrees; 0 where a vector is as good as zero."""
    na, nb = norm(a), norm(b)
    return F.when((na < 1e-9) | (nb < 1e-9), num(0)).otherwise(clipped_acos(dot(a, b) / (na * nb)))


def pose_deltas(center_a: Vector, axis_a: Vector, center_b: Vector, axis_b: Vector) -> tuple[Column, Column]:
    """Distance of the centres, angle of the axes."""
    return norm(minus(center_a, center_b)), angle_between(axis_a, axis_b)


def floor_yaw(axis: Vector) -> Column:
    """Degrees of the axis on the floor plane; 0 for an axis along the up direction."""
    return F.when((F.abs(axis[0]) < 1e-9) & (F.abs(axis[1]) < 1e-9), num(0)).otherwise(F.degrees(F.atan2(axis[1], axis[0])))


def circular_difference(a: Column, b: Column) -> Column:
    d = F.pmod(F.abs(a - b), num(360))
    return F.least(d, num(360) - d)


def angle_weight(angle: Column, low: float = ANGLE_LOW, peak: float = ANGLE_PEAK, high: float = ANGLE_HIGH) -> Column:
    """A triangle: 0 at and beyond the feet, 1 at the peak."""
    return (
        F.when((angle <= low) | (angle >= high), num(0))
        .when(angle <= peak, (angle - low) / (peak - low))
        .otherwise((high - angle) / (high - peak))
    )


def finite(x: Column) -> Column:
    """Spark orders NaN above all numbers, so it is told apart."""
    return ~F.isnan(x) & (F.abs(x) < num(float("inf")))


def finite_pose(pose: Column) -> Column:
    return pose.isNotNull() & F.forall(pose, finite)


def frame_gap(a: Column, b: Column) -> Column:
    """Difference of numeric frame ids; null where either isn't a whole number."""
    return F.abs(a.try_cast("int") - b.try_cast("int"))


def gap_passes(a: Column, b: Column, least: float | Column) -> Column:
    return F.coalesce(frame_gap(a, b) >= least, F.lit(True))


def unproject(u: Column, v: Column, z: Column, k: Sequence[float | Column], pose: Column) -> Vector:
    """The world point at a pixel: k is (fx, fy, cx, cy). Null where depth isn't positive."""
    x, y = (u - k[2]) / k[0] * z, (v - k[3]) / k[1] * z
    ok = lambda i: F.when(z > 0, at(pose, i, 0) * x + at(pose, i, 1) * y + at(pose, i, 2) * z + at(pose, i, 3))
    return ok(0), ok(1), ok(2)


def project(point: Vector, k: Sequence[float | Column], pose: Column, width: float | Column, height: float | Column) -> tuple[Column, Column, Column, Column]:
    """(u, v, depth, in bounds) of a world point in a rigidly placed camera; behind it (-1, -1, depth, false)."""
    d = minus(point, camera_center(pose))
    x, y, z = (dot(d, (at(pose, 0, i), at(pose, 1, i), at(pose, 2, i))) for i in range(3))
    front = z > 0
    u = F.when(front, k[2] + k[0] * x / z).otherwise(F.when(z.isNotNull(), num(-1)))
    v = F.when(front, k[3] + k[1] * y / z).otherwise(F.when(z.isNotNull(), num(-1)))
    return u, v, z, F.coalesce(front & (u >= 0) & (u < width) & (v >= 0) & (v < height), F.lit(False))


def voxel(x: Column, size: float = 0.05) -> Column:
    return F.floor(x / size).cast("long")


def area(box: Sequence[Column]) -> Column:
    return F.greatest(num(0), box[2] - box[0]) * F.greatest(num(0), box[3] - box[1])


def box_iou(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Intersection over union of (x0, y0, x1, y1) boxes; 0 where the union is empty."""
    w = F.greatest(num(0), F.least(a[2], b[2]) - F.greatest(a[0], b[0]))
    h = F.greatest(num(0), F.least(a[3], b[3]) - F.greatest(a[1], b[1]))
    union = area(a) + area(b) - w * h
    return F.when(union > 0, w * h / union).otherwise(num(0))


def round_clip(x: Column, size: Column | float, slack: float = 2.0) -> Column:
    """A pixel coordinate rounded half to even and held inside; null more than `slack` outside."""
    return F.when((x >= -slack) & (x <= size + slack - 1), F.greatest(num(0), F.least(F.lit(size) - 1 if not isinstance(size, Column) else size - 1, F.rint(x)))).cast("int")
