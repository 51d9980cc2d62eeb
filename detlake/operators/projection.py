"""3-D objects to picture boxes, and grading, refinement and diagnosis of the boxes.

Frames carry the camera (`position`, `forward`, `up`, `right` structs and the picture size); objects carry their pose
and size. Frames are looked up by `image_id`, one object stays one row, so a frame with very many objects is just rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import product
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from detlake.functions.boxes import Box, box, box_agreement, box_area, box_center, clip_box_hud, clip_with_truncation, overlap_area, pad_box
from detlake.functions.camera import Vec, dot, vec

# fixed values: validation thresholds
MIN_SIDE_PX = 20.0
MIN_AREA_PX = 400.0
MAX_TRUNCATION = 0.80
FIXED_HEIGHT_M = 15.0
HEIGHT_TOLERANCE_M = 0.05
MIN_REFINED_AREA_PX = 16.0
IGNORE_BOTTOM_PX = 45
SHIP_PADDING_PX = 3
CORNER_SIGNS = tuple((x, y, z) for x in (-1, 1) for y in (-1, 1) for z in (-1, 1))


def centered_extent(length: Column, width: Column, height: Column) -> tuple[Vec, Vec]:
    """Local box of a solid centred at its origin: x is width, y height, z length."""
    half = Vec(width / 2, height / 2, length / 2)
    return Vec(-half.x, -half.y, -half.z), half


def _stage(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return df.select("*", *[c.alias(n) for n, c in columns.items()])


def project_corners(df: DataFrame, origin: Vec, axes: tuple[Vec, Vec, Vec], low: Vec, high: Vec, focal_x: Column, focal_y: Column,
                    center_x: Column, center_y: Column, width: Column, height: Column, near: float | None = None,
                    far: float | None = None) -> DataFrame:
    """Picture box of the eight corners of a local box `low..high` at `origin` along the world directions `axes`.

    The camera is in the struct columns `position, forward, up, right`. Origin and box edges are turned into camera
    space once; corners are their sums. Adds raw box `raw_x1..raw_y2`, clipped box `x1..y2` (null when invisible),
    `visible`, `truncated`, depth range and `reasons`. Only corners in front of the near plane count.
    """
    pos, fwd, up, right = (vec(F.col(c)) for c in ("position", "forward", "up", "right"))
    floor = max(1e-6, near or 1e-6)
    rel = Vec(origin.x - pos.x, origin.y - pos.y, origin.z - pos.z)
    view = {"x": right, "y": up, "z": fwd}
    turned = {f"_o{d}": dot(rel, v) for d, v in view.items()}
    for k, (axis, lo, hi) in enumerate(zip(axes, low, high)):
        for d, v in view.items():
            turned[f"_a{k}{d}"] = dot(axis, v)
        turned[f"_lo{k}"], turned[f"_hi{k}"] = lo, hi
    pts = _stage(df, turned)
    edges = {f"_{e}{k}{d}": F.col(f"_{e}{k}") * F.col(f"_a{k}{d}") for e in ("lo", "hi") for k in range(3) for d in "xyz"}
    pts = _stage(pts, edges)
    spots = {}
    for i, signs in enumerate(CORNER_SIGNS):
        for d in "xyz":
            spots[f"_{d}{i}"] = sum((F.col(f"_{'hi' if s > 0 else 'lo'}{k}{d}") for k, s in enumerate(signs)), F.col(f"_o{d}"))
    pts = _stage(pts, spots)
    picture = {}
    for i in range(8):
        z = F.col(f"_z{i}")
        ok = (z > floor) & (z < far) if far is not None else z > floor
        picture[f"_d{i}"] = F.when(ok, z)
        picture[f"_u{i}"] = F.when(ok, focal_x * (F.col(f"_x{i}") / z) + center_x)
        picture[f"_v{i}"] = F.when(ok, center_y - focal_y * (F.col(f"_y{i}") / z))
    pts = _stage(pts, picture)
    # least and greatest skip the corners that do not count
    every = {n: [F.col(f"_{n}{i}") for i in range(8)] for n in "duv"}
    out = _stage(pts, {"raw_x1": F.least(*every["u"]), "raw_y1": F.least(*every["v"]), "raw_x2": F.greatest(*every["u"]),
                       "raw_y2": F.greatest(*every["v"]), "depth_min": F.least(*every["d"]), "depth_max": F.greatest(*every["d"]),
                       "_n": sum((c.isNotNull().cast("int") for c in every["d"]), F.lit(0))})
    out = out.select(*df.columns, "raw_x1", "raw_y1", "raw_x2", "raw_y2", "depth_min", "depth_max", "_n")
    none = F.col("_n") == 0
    clipped, moved = clip_with_truncation(box("raw_"), width, height)
    cut = ~none & moved
    reasons = F.array_compact(F.array(
        F.when(none, F.lit("all_points_behind_camera")), F.when(cut, F.lit("bbox_clipped_to_image")),
        F.when(~none & (F.col("_n") < 8), F.lit("partial_geometry_behind_camera"))))
    out = out.select("*", *clipped.named(), F.coalesce(cut, F.lit(False)).alias("truncated"), reasons.alias("reasons"))
    return out.withColumn("visible", F.col("x1").isNotNull()).drop("_n")


def validate_projection(df: DataFrame) -> DataFrame:
    """Adds `width_px, height_px, area_px, truncation_pct, valid, invalid_reasons, tier` to projected objects."""
    b, raw = box(), box("raw_")
    w, h = b.x2 - b.x1, b.y2 - b.y1
    raw_area = F.greatest(F.lit(1.0), (raw.x2 - raw.x1) * (raw.y2 - raw.y1))
    out = df.withColumn("width_px", w).withColumn("height_px", h).withColumn("area_px", w * h)
    out = out.withColumn("truncation_pct", F.greatest(F.lit(0.0), F.lit(1.0) - w * h / raw_area))
    missing = F.col("x1").isNull()
    reasons = F.array_compact(F.array(
        F.when(missing, F.lit("bbox_missing")), F.when(F.col("width_px") < MIN_SIDE_PX, F.lit("bbox_too_narrow")),
        F.when(F.col("height_px") < MIN_SIDE_PX, F.lit("bbox_too_short")),
        F.when(F.col("area_px") < MIN_AREA_PX, F.lit("bbox_area_too_small")),
        F.when(F.col("truncation_pct") > MAX_TRUNCATION, F.lit("bbox_too_truncated"))))
    out = out.withColumn("invalid_reasons", reasons).withColumn("valid", F.size("invalid_reasons") == 0)
    tier = (F.when(~F.col("valid"), F.lit("reject")).when(F.col("class").isin("helicopters", "airplanes"), F.lit("approximate"))
            .otherwise(F.lit("strong")))
    return out.withColumn("tier", tier)


def grade_object(df: DataFrame) -> DataFrame:
    """Final `quality_tier` and `confidence_source` from validity, `geometry_source` and `basis_source`."""
    geo, basis, valid = F.col("geometry_source"), F.col("basis_source"), F.col("valid")
    measured = valid & geo.isin("bbox_cache", "desc_box")
    modelled = valid & geo.startswith("model_catalog") & basis.isin("snapshot_basis_raw", "snapshot_basis")
    tier = (F.when(measured | modelled, F.lit("strong")).when(valid, F.lit("approximate")).otherwise(F.col("tier")))
    known = basis.isin("snapshot_basis_raw", "snapshot_basis", "heading_pitch_bank")
    source = F.when(measured | known, geo).otherwise(F.lit("estimated"))
    return df.withColumn("quality_tier", tier).withColumn("confidence_source", source)


def frame_usability(frames: DataFrame, objects: DataFrame) -> DataFrame:
    """`usable` and `invalid_reasons` per frame from sync flags, camera height and its valid objects.

    Frames carry `tokens_equal, pause_ok, screenshot_fresh` and `height_asl_m`.
    """
    valid = objects.groupBy("image_id").agg(F.count_if("valid").alias("valid_objects"))
    out = frames.join(valid, "image_id", "left").withColumn("valid_objects", F.coalesce("valid_objects", F.lit(0)))
    sync = F.col("tokens_equal") & F.col("pause_ok") & F.col("screenshot_fresh")
    level = F.abs(F.col("height_asl_m") - F.lit(FIXED_HEIGHT_M)) <= F.lit(HEIGHT_TOLERANCE_M)
    reasons = F.array_compact(F.array(
        F.when(~sync, F.lit("sync_invalid")), F.when(~F.col("screenshot_fresh"), F.lit("stale_or_missing_screenshot")),
        F.when(~level, F.lit("camera_height_not_15m")), F.when(F.col("valid_objects") == 0, F.lit("no_valid_objects"))))
    return out.withColumn("invalid_reasons", reasons).withColumn("usable", sync & level & (F.col("valid_objects") > 0))


def _count_map(objects: DataFrame, column: str, name: str, only: Column | None = None) -> DataFrame:
    n = F.count(F.lit(1)) if only is None else F.count_if(only)
    rows = objects.groupBy("image_id", F.coalesce(F.col(column), F.lit("unknown")).alias("_k")).agg(n.alias("_n")).filter(F.col("_n") > 0)
    return rows.groupBy("image_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("_k", "_n")))).alias(name))


def object_stats(objects: DataFrame) -> DataFrame:
    """Totals per frame and counts by class, valid class, dimensions source and tier, as maps of a few entries."""
    total = objects.groupBy("image_id").agg(F.count(F.lit(1)).alias("total_objects"), F.count_if("valid").alias("valid_objects"))
    for m in (_count_map(objects, "class", "by_class"), _count_map(objects, "class", "valid_by_class", F.col("valid")),
              _count_map(objects, "dimensions_source", "by_dimensions_source"), _count_map(objects, "quality_tier", "by_quality_tier")):
        total = total.join(m, "image_id", "left")
    empty = F.create_map().cast("map<string,bigint>")
    return total.withColumn("valid_by_class", F.coalesce("valid_by_class", empty))


def apply_refined_boxes(objects: DataFrame, refined: DataFrame, width: int, height: int, fallback: bool = True) -> DataFrame:
    """Overlay refined boxes (`object_id, r_x1..r_y2, mask_area`) on objects.

    Refined and big enough: exact_visible. Not refined but valid: the geometry box clipped above the bottom strip. Else
    the object is rejected and loses its box.
    """
    b, r = box(), box("r_")
    out = objects.join(refined, "object_id", "left")
    has = F.col("r_x1").isNotNull()
    w, h = r.x2 - r.x1, r.y2 - r.y1
    good = has & (w >= 1) & (h >= 1) & (w * h >= MIN_REFINED_AREA_PX)
    hud = clip_box_hud(b, width, height, IGNORE_BOTTOM_PX)
    skipped = F.col("x1").isNull()
    back = ~has & F.lit(fallback) & F.col("valid") & hud.x1.isNotNull()
    status = (F.when(skipped, "skipped").when(has, "applied").when(back, "fallback_geometry").otherwise("failed"))
    out = out.select("*", status.alias("refinement"), good.alias("_good"), *hud.named("_h_"))
    is_ = lambda s: F.col("refinement") == s
    final = [F.when(is_("applied"), F.col(f"r_{c}")).when(is_("fallback_geometry"), F.col(f"_h_{c}")).alias(c)
             for c in ("x1", "y1", "x2", "y2")]
    tier = (F.when(is_("applied") & F.col("_good"), "exact_visible").when(is_("applied") | is_("failed"), "reject")
            .otherwise(F.col("quality_tier")))
    valid = F.when(is_("applied"), F.col("_good")).when(is_("fallback_geometry"), True).when(is_("failed"), False).otherwise(F.col("valid"))
    drop = ("x1", "y1", "x2", "y2", "valid", "quality_tier")
    keep = [c for c in objects.columns if c not in drop]
    return out.select(*keep, *final, valid.alias("valid"), tier.alias("quality_tier"), "refinement")


def refine_summary(objects: DataFrame, frames: DataFrame) -> DataFrame:
    """Whole-dataset totals after refinement: frames, refined and failed objects, usable frames."""
    per = objects.groupBy("image_id").agg(F.count_if(F.col("refinement") == "applied").alias("refined"),
                                          F.count_if(F.col("refinement").isin("failed", "skipped")).alias("failed"),
                                          F.count_if("valid").alias("valid_objects"))
    rows = frames.select("image_id", "frame_ok").join(per, "image_id", "left")
    return rows.agg(F.count(F.lit(1)).alias("frames"), F.coalesce(F.sum("refined"), F.lit(0)).alias("refined"),
                    F.coalesce(F.sum("failed"), F.lit(0)).alias("failed"),
                    F.count_if(F.col("frame_ok") & (F.coalesce("valid_objects", F.lit(0)) > 0)).alias("usable_frames"))


def component_relation(component: Box, geometry: Box) -> dict[str, Column]:
    (cx, cy), (gx, gy) = box_center(component), box_center(geometry)
    inter = overlap_area(component, geometry)
    return {"overlap_area": inter, "overlap_ratio_component": inter / F.greatest(F.lit(1.0), box_area(component)),
            "geometry_area": F.greatest(F.lit(1.0), box_area(geometry)), "center_distance": F.hypot(cx - gx, cy - gy)}


def select_components(components: DataFrame, objects: DataFrame, top: int = 8) -> DataFrame:
    """Pixel components that belong to an object's geometry box, joined to one box per object.

    `components`: `object_id, comp_id, c_x1..c_y2, area, cen_x, cen_y`. Of the `top` best scored ones per object (the
    reference's own rule) the best is the seed; others stay when they overlap the geometry, or lie near both the seed
    and the geometry.
    """
    geo = objects.select("object_id", *[F.col(c).alias(f"g_{c}") for c in ("x1", "y1", "x2", "y2")])
    rows = components.join(geo, "object_id")
    c, g = box("c_"), box("g_")
    gw, gh = g.x2 - g.x1, g.y2 - g.y1
    rows = rows.select("*", *[v.alias(n) for n, v in component_relation(c, g).items()])
    w, h = c.x2 - c.x1, c.y2 - c.y1
    too_big = (w > F.greatest(F.lit(120.0), gw * 4)) | (h > F.greatest(F.lit(120.0), gh * 4))
    longest = F.greatest(F.lit(1.0), gw, gh)
    limit = F.greatest(F.lit(8.0), longest * 0.45)
    touches = (F.col("overlap_area") > 0) | (F.col("overlap_ratio_component") >= 0.10)
    far = ~touches & (F.col("center_distance") > limit)
    a = F.col("area").cast("double")
    score = (a * (F.lit(0.4) + a / F.greatest(F.lit(1.0), w * h)) + F.col("overlap_area") * 4 + F.col("overlap_ratio_component") * a * 2
             - a * (F.col("center_distance") / F.greatest(F.lit(1.0), F.sqrt("geometry_area") * 0.5))
             - F.when(F.col("overlap_area") <= 0, a * 2).otherwise(F.lit(0.0)))
    best = Window.partitionBy("object_id").orderBy(F.col("score").desc(), F.col("comp_id"))
    ranked = rows.filter(~too_big & ~far).withColumn("score", score).withColumn("_touch", touches).withColumn("_limit", limit)
    ranked = ranked.withColumn("_rank", F.row_number().over(best)).filter(F.col("_rank") <= top)
    # at most `top` rows per object from here on
    seed = Window.partitionBy("object_id").orderBy("_rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = (ranked.withColumn("_st", F.first("_touch").over(seed)).withColumn("_sx", F.first("cen_x").over(seed))
              .withColumn("_sy", F.first("cen_y").over(seed)))
    near_seed = F.hypot(F.col("cen_x") - F.col("_sx"), F.col("cen_y") - F.col("_sy")) <= F.greatest(F.lit(12.0), F.greatest(gw, gh) * 0.60)
    near_geo = F.col("center_distance") <= F.col("_limit")
    keep = (F.col("_rank") == 1) | F.col("_touch") | (~F.col("_st") & near_seed & near_geo)
    return ranked.filter(keep).groupBy("object_id").agg(
        F.min("c_x1").alias("r_x1"), F.min("c_y1").alias("r_y1"), F.max("c_x2").alias("r_x2"), F.max("c_y2").alias("r_y2"),
        F.sum("area").alias("mask_area"), F.count(F.lit(1)).alias("num_components"))


def clamp_refined(df: DataFrame, width: int, height: int) -> DataFrame:
    """Keep a refined box (`r_*`) near its geometry box (`g_*`); fall back to the padded geometry when it cannot be.

    Adds `x1..y2`, `clamp_reasons`, ratios after clamping, and the plausibility and airborne-excess tests.
    """
    r, g = box("r_"), box("g_")
    one = F.lit(1.0)
    gw, gh = F.greatest(one, g.x2 - g.x1), F.greatest(one, g.y2 - g.y1)
    side, top, bottom = F.greatest(F.lit(40.0), gw * 0.15), F.greatest(F.lit(25.0), gh * 0.10), F.greatest(F.lit(45.0), gh * 0.20)
    limited = Box(F.greatest(r.x1, g.x1 - side), F.greatest(r.y1, g.y1 - top), F.least(r.x2, g.x2 + side), F.least(r.y2, g.y2 + bottom))
    out = df.select("*", *clip_box_hud(limited, width, height, IGNORE_BOTTOM_PX).named("_c_"),
                    *pad_box(g, SHIP_PADDING_PX, width, height, IGNORE_BOTTOM_PX).named("_f_"))
    c = box("_c_")
    lost = c.x1.isNull() | (box_area(c) < MIN_REFINED_AREA_PX)
    wide = (F.greatest(one, c.x2 - c.x1) / gw > 1.45) | (F.greatest(one, c.y2 - c.y1) / gh > 1.60)
    moved = (c.x1 != r.x1) | (c.y1 != r.y1) | (c.x2 != r.x2) | (c.y2 != r.y2)
    back = lost | F.coalesce(wide, F.lit(False))
    reasons = F.array_compact(F.array(F.when(~lost & moved, F.lit("ship_refinement_clamped_to_geometry")),
                                      F.when(back, F.lit("ship_refinement_fallback_geometry"))))
    final = [F.when(back, F.col(f"_f_{n}")).otherwise(F.col(f"_c_{n}")).alias(n) for n in ("x1", "y1", "x2", "y2")]
    rw, rh = r.x2 - r.x1, r.y2 - r.y1
    thin = ((g.x2 - g.x1 >= 100) & (rw < F.greatest(F.lit(20.0), (g.x2 - g.x1) * 0.10))) | (
        (g.y2 - g.y1 >= 80) & (rh < F.greatest(F.lit(20.0), (g.y2 - g.y1) * 0.15)))
    spills = (r.y1 < g.y1 - top) | (r.y2 > g.y2 + bottom) | (r.x1 < g.x1 - side) | (r.x2 > g.x2 + side)
    (rx, ry), (gx, gy) = box_center(r), box_center(g)
    excess = ((F.greatest(one, rw) / gw > 1.8) | (F.greatest(one, rh) / gh > 1.8)
              | (F.hypot(rx - gx, ry - gy) > F.greatest(F.lit(20.0), F.greatest(gw, gh) * 0.75)))
    out = out.select(*df.columns, *final, reasons.alias("clamp_reasons"), (~thin & ~spills).alias("plausible"), excess.alias("excessive"))
    return (out.withColumn("ratio_w", F.greatest(one, F.col("x2") - F.col("x1")) / gw)
            .withColumn("ratio_h", F.greatest(one, F.col("y2") - F.col("y1")) / gh))


# fixed values: axis orders with signs, and which raw axes the reordered coordinates run along
ORDER_VARIANTS = (
    ("x_y_z", (0, 1, 2), (1.0, 1.0, 1.0)),
    ("negx_y_z", (0, 1, 2), (-1.0, 1.0, 1.0)),
    ("x_y_negz", (0, 1, 2), (1.0, 1.0, -1.0)),
    ("negx_y_negz", (0, 1, 2), (-1.0, 1.0, -1.0)),
    ("z_y_x", (2, 1, 0), (1.0, 1.0, 1.0)),
    ("negz_y_x", (2, 1, 0), (-1.0, 1.0, 1.0)),
    ("z_y_negx", (2, 1, 0), (1.0, 1.0, -1.0)),
    ("negz_y_negx", (2, 1, 0), (-1.0, 1.0, -1.0)),
)
BASIS_VARIANTS = (
    ("axis_x_forward_axis_y_up_axis_z_right", (0, 1, 2)),
    ("axis_x_right_axis_y_up_axis_z_forward", (2, 1, 0)),
    ("axis_z_forward_axis_y_up_axis_x_right", (2, 1, 0)),
)
CURRENT_MAPPING = "axis_x_forward_axis_y_up_axis_z_right__x_y_z"


class CameraColumns(NamedTuple):
    fx: Column
    fy: Column
    cx: Column
    cy: Column
    width: Column
    height: Column


#: local sides that some variant mirrors
_MIRRORED = sorted({i for _, order, sign in ORDER_VARIANTS for i, s in zip(order, sign) if s < 0})


#: every view `axes, order, sign` that some variant shows, and the variants by number
_VARIANTS = [(axes, order, sign) for _, axes in BASIS_VARIANTS for _, order, sign in ORDER_VARIANTS]
_VIEWS = list(dict.fromkeys(_VARIANTS))
MAPPINGS = [f"{basis}__{order}" for basis, _ in BASIS_VARIANTS for order, _, _ in ORDER_VARIANTS]


def _shown(even: set[int]) -> Column:
    """Literal `view, variants` where the sides `even` of the local box are mirrored onto themselves: a change of sign there only
    swaps corners."""
    found: dict[int, list[int]] = {}
    for v, (axes, order, sign) in enumerate(_VARIANTS):
        found.setdefault(_VIEWS.index((axes, order, tuple(1.0 if i in even else s for i, s in zip(order, sign)))), []).append(v)
    return F.array(*[F.struct(F.lit(n).alias("view"), F.array(*map(F.lit, variants)).alias("variants")) for n, variants in found.items()])


def diagnose_views(objects: DataFrame, cam: CameraColumns) -> DataFrame:
    """Every object under every (basis, axis order) variant: projected box and agreement with the target `t_*`. A row may stand for
    several `variants`, `each_variant` makes them rows.

    Objects carry camera structs, `origin`, `axis_x/axis_y/axis_z` structs and local `low`/`high`. Variants that show the same
    corners are projected once: those of equal axes, and mirrored ones along a side on which the local box is even. They come from
    literal arrays, exploded per object.
    """
    lo, hi = (F.array(*[F.col(f"{v}.{d}") for d in "xyz"]) for v in ("low", "high"))
    even = [F.get(lo, k) == -F.get(hi, k) for k in _MIRRORED]
    shown = None
    for flags in product((True, False), repeat=len(_MIRRORED)):
        same = reduce(and_, (e for e, f in zip(even, flags) if f), F.lit(True))
        views = _shown({k for k, f in zip(_MIRRORED, flags) if f})
        shown = F.when(same, views) if shown is None else shown.when(same, views)
    rows = objects.select("*", F.inline(shown).alias("_view", "variants"))
    raw = F.array("axis_x", "axis_y", "axis_z")
    at = lambda part, k: F.get(F.array(*[F.lit(v[part][k]) for v in _VIEWS]), F.col("_view"))
    axes = tuple(vec(F.get(raw, at(0, k))) for k in range(3))
    low, high = (Vec(*(F.get(v, at(1, k)) * at(2, k) for k in range(3))) for v in (lo, hi))
    seen = project_corners(rows, vec(F.col("origin")), axes, low, high, *cam)
    agree = box_agreement(box(), box("t_"))
    return seen.select("image_id", "object_id", "class", "variants", *box().named(), *[c.alias(n) for n, c in agree.items()])


def each_variant(views: DataFrame) -> DataFrame:
    rest = [c for c in views.columns if c not in ("image_id", "object_id", "class", "variants")]
    out = views.withColumn("variant_ord", F.explode("variants"))
    return out.select("image_id", "object_id", "class", "variant_ord", F.get(F.array(*map(F.lit, MAPPINGS)), F.col("variant_ord")).alias("mapping"), *rest)


def diagnose_variants(objects: DataFrame, cam: CameraColumns) -> DataFrame:
    """`diagnose_views` with a row for every variant."""
    return each_variant(diagnose_views(objects, cam))


def best_variants(variants: DataFrame) -> DataFrame:
    """Best mapping per object (largest IoU, first of equals) next to the current mapping; 24 rows per object meet.

    The IoUs are plain maxima, which need no sort where the mapping is not asked for."""
    pick = F.struct((-F.col("iou")).alias("n"), "variant_ord", "mapping", "center_error")
    out = variants.groupBy("image_id", "object_id", "class").agg(
        F.min(F.when(F.col("iou").isNotNull(), pick)).alias("_b"), F.max("iou").alias("best_iou"),
        F.max(F.when(F.col("mapping") == CURRENT_MAPPING, F.col("iou"))).alias("current_iou"))
    return out.select("image_id", "object_id", "class", F.col("_b.mapping").alias("best_mapping"), "best_iou",
                      F.col("_b.center_error").alias("best_center_error"), "current_iou")


def variant_summary(best: DataFrame) -> DataFrame:
    """Per class: objects, mean IoUs, improvement and how often each mapping won. The objects are read once: sums per class and
    mapping, a few rows, make both the means and the counts."""
    parts = best.groupBy("class", F.coalesce("best_mapping", F.lit("none")).alias("m")).agg(F.count(F.lit(1)).alias("n"), *[
        f(c).alias(f"_{tag}_{c}") for c in ("current_iou", "best_iou") for tag, f in (("s", F.sum), ("n", F.count))])
    out = parts.groupBy("class").agg(
        F.sum("n").alias("objects"), *[(F.sum(f"_s_{c}") / F.nullif(F.sum(f"_n_{c}"), F.lit(0))).alias(f"avg_{c}") for c in ("current_iou", "best_iou")],
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("m", "n")))).alias("best_mapping_counts"))
    return out.select("class", "objects", "avg_current_iou", "avg_best_iou",
                      (F.col("avg_best_iou") - F.col("avg_current_iou")).alias("avg_iou_improvement"), "best_mapping_counts")


def skipped_objects(objects: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Objects that cannot be diagnosed, with the reason: no snapshot partner, or no basis or local box."""
    part = snapshots.select("object_id", F.lit(True).alias("_s"), (F.col("low").isNotNull() & F.col("high").isNotNull()).alias("_boxed"))
    rows = objects.join(part, "object_id", "left")
    whole = F.col("axis_x").isNotNull() & F.col("origin").isNotNull() & F.coalesce("_boxed", F.lit(False))
    reason = F.when(F.col("_s").isNull(), "missing_snapshot_object").when(~whole, "missing_basis_or_bbox")
    return rows.withColumn("reason", reason).filter(F.col("reason").isNotNull()).select("image_id", "object_id", "reason")
