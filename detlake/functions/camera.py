"""Camera columns: intrinsics, orthonormal bases, pin-hole projection."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Vec(NamedTuple):
    x: Column
    y: Column
    z: Column

    def as_struct(self) -> Column:
        return F.struct(self.x.alias("x"), self.y.alias("y"), self.z.alias("z"))


def vec(column: Column) -> Vec:
    return Vec(column["x"], column["y"], column["z"])


def dot(a: Vec, b: Vec) -> Column:
    return a.x * b.x + a.y * b.y + a.z * b.z


def cross(a: Vec, b: Vec) -> Vec:
    return Vec(a.y * b.z - a.z * b.y, a.z * b.x - a.x * b.z, a.x * b.y - a.y * b.x)


def plus(a: Vec, b: Vec) -> Vec:
    return Vec(a.x + b.x, a.y + b.y, a.z + b.z)


def times(a: Vec, k) -> Vec:
    return Vec(a.x * k, a.y * k, a.z * k)


def unit(a: Vec) -> Vec:
    n = F.sqrt(dot(a, a))
    return Vec(*(F.when(n > 0, c / n) for c in a))


def intrinsics(width: int, height: int, vertical_fov_deg: float) -> dict[str, float]:
    """Square pixels: one focal length for both axes."""
    focal = height / (2.0 * math.tan(math.radians(vertical_fov_deg) / 2.0))
    return {"fx": focal, "fy": focal, "cx": width / 2.0, "cy": height / 2.0,
            "fov_horizontal_deg": math.degrees(2.0 * math.atan(width / (2.0 * focal)))}


def intrinsics_columns(width: Column, height: Column, vertical_fov_deg: Column) -> dict[str, Column]:
    focal = height / (F.lit(2.0) * F.tan(F.radians(vertical_fov_deg) / 2))
    return {"fx": focal, "fy": focal, "cx": width / 2, "cy": height / 2,
            "fov_horizontal_deg": F.degrees(F.lit(2.0) * F.atan(width / (F.lit(2.0) * focal)))}


def basis_from_axes(raw: Column, keys=("axis_x", "axis_y", "axis_z")) -> tuple[Vec, Vec, Vec]:
    """(forward, up, right) of a struct that carries either the axis_* or the forward/up/right fields, else NULLs."""
    axes = [raw[k] for k in keys]
    dirs = [raw[k] for k in ("forward", "up", "right")]
    has_axes = axes[0].isNotNull() & axes[1].isNotNull() & axes[2].isNotNull()
    has_dirs = dirs[0].isNotNull() & dirs[1].isNotNull() & dirs[2].isNotNull()
    pick = [F.when(has_axes, a).when(has_dirs, d) for a, d in zip(axes, dirs)]
    return vec(pick[0]), vec(pick[1]), vec(pick[2])


def basis_from_angles(heading: Column, pitch: Column, bank: Column) -> tuple[Vec, Vec, Vec]:
    """(forward, up, right) in closed form. Heading turns about world up, pitch is negated, bank rolls about forward.

    After the heading the frame is f0=(cos h,0,sin h), u0=(0,1,0), r0=(-sin h,0,cos h). Pitch and bank turn within
    planes of that orthonormal frame, so no general rotation is needed. Angles up to 1e-9 count as zero.
    """
    zero = F.lit(0.0)
    p = F.when(F.abs(pitch) > 1e-9, -pitch).otherwise(zero)
    b = F.when(F.abs(bank) > 1e-9, bank).otherwise(zero)
    f0 = Vec(F.cos(heading), zero, F.sin(heading))
    u0 = Vec(zero, F.lit(1.0), zero)
    r0 = Vec(-F.sin(heading), zero, F.cos(heading))
    # turning about r0: r0 x f0 = u0 and r0 x u0 = -f0
    f1 = plus(times(f0, F.cos(p)), times(u0, F.sin(p)))
    u1 = plus(times(u0, F.cos(p)), times(f0, -F.sin(p)))
    # turning about f1: f1 x r0 = -u1 and f1 x u1 = r0
    r2 = plus(times(r0, F.cos(b)), times(u1, -F.sin(b)))
    u2 = plus(times(u1, F.cos(b)), times(r0, F.sin(b)))
    return f1, u2, r2


def basis_to_euler(forward: Vec, right: Vec) -> dict[str, Column]:
    level = F.sqrt(forward.x * forward.x + forward.z * forward.z)
    return {"yaw": F.degrees(F.atan2(forward.z, forward.x)),
            "pitch": F.degrees(F.atan2(forward.y, level)),
            "roll": F.degrees(F.atan2(right.y, F.lit(1.0)))}
