"""Axes, padding and camera projection."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_mesh_axes(x: Column, y: Column, z: Column) -> tuple[Column, Column, Column]:
    """World (X, Y, Z) with Y up to mesh (X, -Z, Y)."""
    return x, -z, y


def to_world_axes(x: Column, y: Column, z: Column) -> tuple[Column, Column, Column]:
    """Mesh (x, y, z) to world (x, z, -y)."""
    return x, z, -y


#: Order of paddings in world axes.
PADDINGS = ("px", "nx", "py", "ny", "pz", "nz")


def padding_defaults(given: dict[str, Column], common: Column) -> Column:
    """array(+X, -X, +Y, -Y, +Z, -Z): the given padding, else the common one."""
    return F.array(*[F.coalesce(given.get(k, F.lit(None).cast("double")), common) for k in PADDINGS])


Point = tuple[Column, Column, Column]


def camera_axes(point: Point, position: Point, rotation: tuple[Column, Column, Column, Column]) -> Point:
    """(right, up, depth) of a world point from a camera that looks along -Z.

    ``rotation`` is a unit quaternion (w, x, y, z), local to world; the point is turned back
    into the camera's axes.  Depth is positive in front.
    """
    w, x, y, z = rotation
    dx, dy, dz = (p - q for p, q in zip(point, position))
    # columns of the rotation matrix, so that the sums apply its transpose
    right = (1 - 2 * (y * y + z * z)) * dx + 2 * (x * y + w * z) * dy + 2 * (x * z - w * y) * dz
    up = 2 * (x * y - w * z) * dx + (1 - 2 * (x * x + z * z)) * dy + 2 * (y * z + w * x) * dz
    back = 2 * (x * z + w * y) * dx + 2 * (y * z - w * x) * dy + (1 - 2 * (x * x + y * y)) * dz
    return right, up, -back


def focal_lengths(hfov: float, vfov: float, width: int, height: int) -> tuple[float, float]:
    return width / (2 * math.tan(math.radians(hfov) / 2)), height / (2 * math.tan(math.radians(vfov) / 2))


def project_point(
    point: Point,
    position: Point,
    rotation: tuple[Column, Column, Column, Column],
    hfov: float = 86.0,
    vfov: float = 57.0,
    width: int = 640,
    height: int = 426,
) -> Column:
    """struct(u, v, depth): a world point in the image; v grows downwards."""
    right, up, depth = camera_axes(point, position, rotation)
    fx, fy = focal_lengths(hfov, vfov, width, height)
    safe = F.when(depth != 0, depth)
    return F.struct(
        (fx * right / safe + width / 2.0).alias("u"),
        (-fy * up / safe + height / 2.0).alias("v"),
        depth.alias("depth"),
    )


def sphere_in_view(
    center: Point,
    radius: Column,
    position: Point,
    rotation: tuple[Column, Column, Column, Column],
    hfov: float = 86.0,
    vfov: float = 57.0,
    width: int = 640,
    height: int = 426,
) -> Column:
    """Whether a ball may reach into the pyramid of view.

    False means that no point of it is both in front and inside the image's edges (the
    last column and row count as edges).  A ball beyond a corner of two planes may pass.
    """
    right, up, depth = camera_axes(center, position, rotation)
    fx, fy = focal_lengths(hfov, vfov, width, height)
    far = F.greatest(F.abs(right), F.abs(up), F.abs(depth))
    reach = radius * (1 + 1e-9) + far * 1e-9 + 1e-9  # rounding must not hide anything
    planes = [(fx * right, width / 2.0), (-fx * right, width / 2.0 - 1), (-fy * up, height / 2.0), (fy * up, height / 2.0 - 1)]
    inside = depth >= -reach
    for (side, edge), focal in zip(planes, (fx, fx, fy, fy)):
        inside = inside & ((side + edge * depth) / math.hypot(focal, edge) >= -reach)
    return inside
