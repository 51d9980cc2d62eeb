"""Box geometry on DOUBLE columns. A box is four corner columns; boxes never travel as arrays between operators."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

def _zero() -> Column:
    return F.lit(0.0)



class Box(NamedTuple):
    x1: Column
    y1: Column
    x2: Column
    y2: Column

    def named(self, prefix: str = "") -> list[Column]:
        return [c.alias(prefix + n) for n, c in zip(("x1", "y1", "x2", "y2"), self)]

    def as_struct(self) -> Column:
        return F.struct(*self.named())


class Size(NamedTuple):
    w: Column
    h: Column


def _c(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _d(value) -> Column:
    return _c(value).cast("double")


def box(prefix: str = "") -> Box:
    return Box(*(F.col(prefix + n) for n in ("x1", "y1", "x2", "y2")))


def struct_box(column: Column) -> Box:
    return Box(*(column[n] for n in ("x1", "y1", "x2", "y2")))


def xywh_to_xyxy(x, y, w, h) -> Box:
    x, y = _d(x), _d(y)
    return Box(x, y, x + _d(w), y + _d(h))


def xyxy_to_xywh(b: Box) -> tuple[Column, Column, Column, Column]:
    return b.x1, b.y1, b.x2 - b.x1, b.y2 - b.y1


def _clamp(v: Column, limit) -> Column:
    return F.greatest(_zero(), F.least(v, _d(limit)))


def clip_box(b: Box, width, height) -> Box:
    return Box(_clamp(b.x1, width), _clamp(b.y1, height), _clamp(b.x2, width), _clamp(b.y2, height))


def box_area(b: Box) -> Column:
    return F.greatest(_zero(), b.x2 - b.x1) * F.greatest(_zero(), b.y2 - b.y1)


def scale_box(b: Box, sx, sy) -> Box:
    sx, sy = _c(sx), _c(sy)
    return Box(b.x1 * sx, b.y1 * sy, b.x2 * sx, b.y2 * sy)


def translate_box(b: Box, dx, dy) -> Box:
    dx, dy = _c(dx), _c(dy)
    return Box(b.x1 + dx, b.y1 + dy, b.x2 + dx, b.y2 + dy)


def overlap(a: Box, b: Box) -> Box:
    """Corner-wise overlap; inverted when the boxes are apart."""
    return Box(F.greatest(a.x1, b.x1), F.greatest(a.y1, b.y1), F.least(a.x2, b.x2), F.least(a.y2, b.y2))


def overlap_area(a: Box, b: Box) -> Column:
    return box_area(overlap(a, b))


def intersect_box(a: Box, b: Box) -> Box:
    """Overlap, NULL corners when the boxes are apart or only touch."""
    o = overlap(a, b)
    hit = (o.x1 < o.x2) & (o.y1 < o.y2)
    return Box(*(F.when(hit, c) for c in o))


def iou(a: Box, b: Box) -> Column:
    inter = overlap_area(a, b)
    union = box_area(a) + box_area(b) - inter
    return F.when(union > 0, inter / union).otherwise(_zero())


def ios(a: Box, b: Box) -> Column:
    inter = overlap_area(a, b)
    smaller = F.least(box_area(a), box_area(b))
    return F.when((inter > 0) & (smaller > 0), inter / smaller).otherwise(_zero())


def gap_distance(a: Box, b: Box) -> Column:
    dx = F.greatest(b.x1 - a.x2, a.x1 - b.x2, _zero())
    dy = F.greatest(b.y1 - a.y2, a.y1 - b.y2, _zero())
    return F.sqrt(dx * dx + dy * dy)


def union_box(a: Box, b: Box) -> Box:
    return Box(F.least(a.x1, b.x1), F.least(a.y1, b.y1), F.greatest(a.x2, b.x2), F.greatest(a.y2, b.y2))


def visible_ratio(reference: Box, visible: Box) -> Column:
    ref = box_area(reference)
    return F.when(ref > 0, F.least(F.lit(1.0), box_area(visible) / ref)).otherwise(_zero())


def is_valid_box(b: Box, min_area: float = 1.0) -> Column:
    return box_area(b) >= F.lit(float(min_area))


def aspect_ratio(b: Box) -> Column:
    w, h = b.x2 - b.x1, b.y2 - b.y1
    return F.when((w > 0) & (h > 0), F.greatest(w / h, h / w)).otherwise(F.lit(float("inf")))


def box_center(b: Box) -> tuple[Column, Column]:
    return (b.x1 + b.x2) * 0.5, (b.y1 + b.y2) * 0.5


def project_to_tile(source: Box, sx, sy, ox, oy, tile_size: int, threshold: float = 0.80,
                    min_area: float = 1.0) -> tuple[Box, Column, Column]:
    """(box in tile coordinates, visible ratio, kept?). The box is not clipped to the image first."""
    if tile_size <= 0:
        raise ValueError(f"tile_size must be positive, got {tile_size}")
    ox, oy = _d(ox), _d(oy)
    scaled = scale_box(source, sx, sy)
    hit = overlap(scaled, Box(ox, oy, ox + float(tile_size), oy + float(tile_size)))
    ratio = visible_ratio(scaled, hit)
    local = clip_box(translate_box(hit, -ox, -oy), tile_size, tile_size)
    kept = ((hit.x1 < hit.x2) & (hit.y1 < hit.y2) & (ratio >= F.lit(float(threshold)))
            & is_valid_box(local, min_area))
    return local, ratio, kept


def yolo_to_xyxy(cx, cy, w, h, width, height) -> Box:
    cx, w = _d(cx) * _c(width), _d(w) * _c(width)
    cy, h = _d(cy) * _c(height), _d(h) * _c(height)
    return Box(cx - w / 2, cy - h / 2, cx + w / 2, cy + h / 2)


def xyxy_to_yolo(b: Box, width, height) -> tuple[Column, Column, Column, Column]:
    width, height = _d(width), _d(height)
    w, h = b.x2 - b.x1, b.y2 - b.y1
    return (b.x1 + w / 2) / width, (b.y1 + h / 2) / height, w / width, h / height


def clip_box_hud(b: Box, width, height, ignore_bottom_px: int = 0) -> Box:
    """Clip to the picture without its bottom strip; NULL corners when nothing is left."""
    usable = F.greatest(F.lit(1.0), _d(height) - F.lit(float(max(0, ignore_bottom_px))))
    c = clip_box(b, width, usable)
    left = (c.x1 < c.x2) & (c.y1 < c.y2)
    return Box(*(F.when(left, v) for v in c))


def clip_with_truncation(b: Box, width, height) -> tuple[Box, Column]:
    c = clip_box(b, width, height)
    left = (c.x1 < c.x2) & (c.y1 < c.y2)
    moved = (c.x1 != b.x1) | (c.y1 != b.y1) | (c.x2 != b.x2) | (c.y2 != b.y2)
    return Box(*(F.when(left, v) for v in c)), moved | ~left


def pad_box(b: Box, pad: float, width, height, ignore_bottom_px: int = 0) -> Box:
    p = F.lit(float(pad))
    grown = clip_box_hud(Box(b.x1 - p, b.y1 - p, b.x2 + p, b.y2 + p), width, height, ignore_bottom_px)
    return Box(*(F.coalesce(g, o) for g, o in zip(grown, b)))


def box_agreement(candidate: Box, target: Box) -> dict[str, Column]:
    """How well a candidate box meets its target; NULL wherever one of them is missing."""
    both = candidate.x1.isNotNull() & target.x1.isNotNull()
    inter = overlap_area(candidate, target)
    union = box_area(candidate) + box_area(target) - inter
    (cx, cy), (tx, ty) = box_center(candidate), box_center(target)
    floor = F.lit(1e-6)
    t_area = box_area(target)
    return {
        "iou": F.when(both & (union > 0), inter / union),
        "center_error": F.when(both, F.hypot(cx - tx, cy - ty)),
        "width_ratio": F.when(both, (candidate.x2 - candidate.x1) / F.greatest(floor, target.x2 - target.x1)),
        "height_ratio": F.when(both, (candidate.y2 - candidate.y1) / F.greatest(floor, target.y2 - target.y1)),
        "area_ratio": F.when(both & (t_area > 0), box_area(candidate) / t_area),
    }


def _rounded_side(side, scale) -> Column:
    # half-even, as the reference results are
    return F.greatest(F.lit(1), F.bround(_d(side) * scale, 0).cast("int"))


def letterbox_plan(width, height, target: int) -> dict[str, Column]:
    if target <= 0:
        raise ValueError(f"target must be positive, got {target}")
    w, h = _d(width), _d(height)
    scale = F.least(F.lit(float(target)) / w, F.lit(float(target)) / h)
    new_w, new_h = _rounded_side(width, scale), _rounded_side(height, scale)
    return {
        "scale": scale,
        "new_width": new_w,
        "new_height": new_h,
        "pad_x": F.floor((F.lit(target) - new_w) / 2).cast("int"),
        "pad_y": F.floor((F.lit(target) - new_h) / 2).cast("int"),
    }


def letterbox_to_source(b: Box, scale: Column, pad_x: Column, pad_y: Column) -> Box:
    return Box((b.x1 - pad_x) / scale, (b.y1 - pad_y) / scale, (b.x2 - pad_x) / scale, (b.y2 - pad_y) / scale)


def source_to_letterbox(b: Box, scale: Column, pad_x: Column, pad_y: Column) -> Box:
    return Box(b.x1 * scale + pad_x, b.y1 * scale + pad_y, b.x2 * scale + pad_x, b.y2 * scale + pad_y)


def resize_plan(width, height, target_w: int, target_h: int, mode: str = "exact") -> dict[str, Column]:
    if target_w <= 0 or target_h <= 0:
        raise ValueError(f"target dimensions must be positive, got {target_w}x{target_h}")
    fx, fy = F.lit(float(target_w)) / _d(width), F.lit(float(target_h)) / _d(height)
    if mode == "exact":
        return {"dst_width": F.lit(target_w), "dst_height": F.lit(target_h), "scale_x": fx, "scale_y": fy}
    if mode == "fit_aspect":
        s = F.least(fx, fy)
        return {"dst_width": _rounded_side(width, s), "dst_height": _rounded_side(height, s),
                "scale_x": s, "scale_y": s}
    raise ValueError(f"unknown resize mode {mode!r}")
