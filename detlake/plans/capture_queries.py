"""Projection, refinement and capture report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from detlake.functions import camera
from detlake.operators import missions, projection
from detlake.plans.catalog import query
from detlake.plans.substrate import Tables

WIDTH, HEIGHT, FOV = 2560, 1440, 60.0
_CAM = camera.intrinsics(WIDTH, HEIGHT, FOV)
_FX = _CAM["fx"]


@query("camera_intrinsics", """
SELECT image_id, round(fy, 6) AS fx, width / 2.0::double AS cx, height / 2.0::double AS cy, round(degrees(2 * atan(width / (2 * fy))), 6) AS fov_horizontal_deg
FROM (SELECT *, height / (2 * tan(radians(40 + image_id % 30) / 2)) AS fy FROM sub_images)""")
def camera_intrinsics(t: Tables):
    cols = camera.intrinsics_columns(F.col("width"), F.col("height"), (F.lit(40) + F.col("image_id") % 30).cast("double"))
    return t.view("sub_images").select("image_id", F.round(cols["fx"], 6).alias("fx"), cols["cx"].alias("cx"), cols["cy"].alias("cy"),
                                       F.round(cols["fov_horizontal_deg"], 6).alias("fov_horizontal_deg"))


@query("basis_from_angles", """
SELECT image_id, round(cos(h) * cos(p), 6) + 0.0::double AS fx, round(sin(p), 6) + 0.0::double AS fy, round(sin(h) * cos(p), 6) + 0.0::double AS fz,
  round(-sin(h) * cos(b) + cos(h) * sin(p) * sin(b), 6) + 0.0::double AS rx, round(-cos(p) * sin(b), 6) + 0.0::double AS ry,
  round(-cos(h) * sin(p) * cos(b) - sin(h) * sin(b), 6) + 0.0::double AS ux, round(cos(p) * cos(b), 6) + 0.0::double AS uy,
  round(sin(h), 6) + 0.0::double AS yaw_sin, round(cos(h), 6) + 0.0::double AS yaw_cos, round(degrees(p), 5) AS pitch
FROM (SELECT image_id, radians(heading_deg) AS h, -radians(pitch_deg) AS p, radians((image_id % 7)::double) AS b FROM sub_frames)""")
def basis_from_angles(t: Tables):
    """Yaw as sine and cosine, which are the same for 180 and -180 degrees."""
    f, u, r = camera.basis_from_angles(F.radians("heading_deg"), F.radians("pitch_deg"), F.radians((F.col("image_id") % 7).cast("double")))
    euler = camera.basis_to_euler(f, r)
    six = lambda c, n: (F.round(c, 6) + 0.0).alias(n)
    yaw = F.radians(euler["yaw"])
    return t.view("sub_frames").select(
        "image_id", six(f.x, "fx"), six(f.y, "fy"), six(f.z, "fz"), six(r.x, "rx"), six(r.y, "ry"), six(u.x, "ux"), six(u.y, "uy"),
        six(F.sin(yaw), "yaw_sin"), six(F.cos(yaw), "yaw_cos"), F.round(euler["pitch"], 5).alias("pitch"))


@query("basis_from_axes", """
SELECT image_id, CASE image_id % 3 WHEN 0 THEN heading_deg WHEN 1 THEN heading_deg + 1 END AS forward_x, CASE image_id % 3 WHEN 0 THEN cam_x WHEN 1 THEN cam_x + 1 END AS right_z FROM sub_frames""")
def basis_from_axes(t: Tables):
    def v(x, z, on):
        return F.when(on, F.struct(x.alias("x"), F.lit(0.0).alias("y"), z.alias("z")))
    k = F.col("image_id") % 3
    h, c = F.col("heading_deg"), F.col("cam_x")
    raw = F.struct(*[v(h, c, k == 0).alias(n) for n in ("axis_x", "axis_y", "axis_z")], *[v(h + 1, c + 1, k == 1).alias(n) for n in ("forward", "up", "right")])
    df = t.view("sub_frames").withColumn("raw", raw)
    f, _, r = camera.basis_from_axes(F.col("raw"))
    return df.select("image_id", f.x.alias("forward_x"), r.z.alias("right_z"))


def _scene(t: Tables, boxes: str | None = None):
    """Objects with the camera of their frame: level camera at 15 m looking along +z. Their given boxes stay under the prefix `boxes`."""
    o, f = t.view("sub_frame_objects"), t.view("sub_frames")
    rows = o.join(f.select("image_id", "cam_x", "cam_z", "height_asl_m"), "image_id")

    def v(x, y, z):
        return F.struct(*[(c if not isinstance(c, float) else F.lit(c)).alias(n) for c, n in ((x, "x"), (y, "y"), (z, "z"))])

    rows = rows.withColumn("position", v(F.col("cam_x"), F.lit(15.0), F.col("cam_z") - 200)).withColumn("forward", v(0.0, 0.0, 1.0))
    rows = rows.withColumn("up", v(0.0, 1.0, 0.0)).withColumn("right", v(1.0, 0.0, 0.0)).drop("valid", "quality_tier")
    sides = ("x1", "y1", "x2", "y2")
    return rows.drop(*sides) if boxes is None else rows.withColumnsRenamed({c: boxes + c for c in sides})


def _projected(t: Tables):
    rows = _scene(t)
    one, zero = F.lit(1.0), F.lit(0.0)
    axes = (camera.Vec(one, zero, zero), camera.Vec(zero, one, zero), camera.Vec(zero, zero, one))
    # a solid lying along the picture: local x is its width, y its height, z its length
    low, high = projection.centered_extent(F.col("length_m"), F.col("width_m"), F.col("height_m"))
    origin = camera.Vec(F.col("world_x"), F.col("world_y"), F.col("world_z"))
    lit = {k: F.lit(v) for k, v in _CAM.items()}
    return projection.project_corners(rows, origin, axes, low, high, lit["fx"], lit["fy"], lit["cx"], lit["cy"], F.lit(WIDTH), F.lit(HEIGHT))


# corners of a box around (world_x, world_y, world_z): x spans the width, y the height, z the length
_RAW = f"""(SELECT *, least(n1, n2) AS dmin, greatest(n1, n2) AS dmax,
  CASE WHEN n1 > 1e-6 THEN least({_FX!r} * ((xl / n1)) + 1280, {_FX!r} * (xl / n2) + 1280) WHEN n2 > 1e-6 THEN {_FX!r} * (xl / n2) + 1280 END AS raw_x1,
  CASE WHEN n1 > 1e-6 THEN greatest({_FX!r} * (xh / n1) + 1280, {_FX!r} * (xh / n2) + 1280) WHEN n2 > 1e-6 THEN {_FX!r} * (xh / n2) + 1280 END AS raw_x2,
  CASE WHEN n1 > 1e-6 THEN least(720 - {_FX!r} * (yh / n1), 720 - {_FX!r} * (yh / n2)) WHEN n2 > 1e-6 THEN 720 - {_FX!r} * (yh / n2) END AS raw_y1,
  CASE WHEN n1 > 1e-6 THEN greatest(720 - {_FX!r} * (yl / n1), 720 - {_FX!r} * (yl / n2)) WHEN n2 > 1e-6 THEN 720 - {_FX!r} * (yl / n2) END AS raw_y2
FROM (SELECT o.object_id, o.image_id, class, world_x - width_m / 2 - cam_x AS xl, world_x + width_m / 2 - cam_x AS xh,
    world_y - o.height_m / 2 - 15 AS yl, world_y + o.height_m / 2 - 15 AS yh, world_z - length_m / 2 - (cam_z - 200) AS n1, world_z + length_m / 2 - (cam_z - 200) AS n2
  FROM sub_frame_objects o JOIN sub_frames f ON o.image_id = f.image_id))"""
_CLIPPED = f"""(SELECT *, CASE WHEN k THEN cx1 END AS x1, CASE WHEN k THEN cy1 END AS y1, CASE WHEN k THEN cx2 END AS x2, CASE WHEN k THEN cy2 END AS y2,
  coalesce(cx1 <> raw_x1 OR cy1 <> raw_y1 OR cx2 <> raw_x2 OR cy2 <> raw_y2 OR NOT k, false) AS truncated
FROM (SELECT *, cx1 < cx2 AND cy1 < cy2 AS k FROM (SELECT *, greatest(0::double, least(raw_x1, 2560)) AS cx1, greatest(0::double, least(raw_y1, 1440)) AS cy1,
  greatest(0::double, least(raw_x2, 2560)) AS cx2, greatest(0::double, least(raw_y2, 1440)) AS cy2 FROM {_RAW} WHERE raw_x1 IS NOT NULL)
  UNION ALL BY NAME SELECT *, NULL AS k FROM {_RAW} WHERE raw_x1 IS NULL))"""


@query("project_corners", f"""
SELECT object_id, round(raw_x1, 5) AS raw_x1, round(raw_y2, 5) AS raw_y2, round(x1, 5) AS x1, round(y1, 5) AS y1, round(x2, 5) AS x2, round(y2, 5) AS y2, x1 IS NOT NULL AS visible, truncated,
  concat_ws(',', CASE WHEN raw_x1 IS NULL THEN 'all_points_behind_camera' END, CASE WHEN raw_x1 IS NOT NULL AND truncated THEN 'bbox_clipped_to_image' END,
    CASE WHEN raw_x1 IS NOT NULL AND n1 <= 1e-6 THEN 'partial_geometry_behind_camera' END) AS reasons,
  round(CASE WHEN n1 > 1e-6 THEN n1 WHEN n2 > 1e-6 THEN n2 END, 6) AS depth_min
FROM {_CLIPPED}""")
def project_corners(t: Tables):
    return _projected(t).select("object_id", *[F.round(c, 5).alias(c) for c in ("raw_x1", "raw_y2", "x1", "y1", "x2", "y2")], "visible", "truncated",
                                F.array_join("reasons", ",").alias("reasons"), F.round("depth_min", 6).alias("depth_min"))


_VALID = f"""(SELECT *, CASE WHEN x1 IS NULL THEN 'bbox_missing' ELSE concat_ws(',', CASE WHEN x2 - x1 < 20 THEN 'bbox_too_narrow' END, CASE WHEN y2 - y1 < 20 THEN 'bbox_too_short' END,
    CASE WHEN (x2 - x1) * (y2 - y1) < 400 THEN 'bbox_area_too_small' END, CASE WHEN tp > 0.8::double THEN 'bbox_too_truncated' END) END AS why
  FROM (SELECT *, greatest(0::double, 1 - (x2 - x1) * (y2 - y1) / greatest(1::double, (raw_x2 - raw_x1) * (raw_y2 - raw_y1))) AS tp FROM {_CLIPPED}))"""


@query("validate_projection", f"""
SELECT object_id, why = '' AS valid, why AS reasons, round(CASE WHEN x1 IS NOT NULL THEN tp END, 5) AS truncation_pct,
  CASE WHEN why <> '' THEN 'reject' WHEN class IN ('helicopters', 'airplanes') THEN 'approximate' ELSE 'strong' END AS tier FROM {_VALID}""")
def validate_projection(t: Tables):
    out = projection.validate_projection(_projected(t))
    return out.select("object_id", "valid", F.array_join("invalid_reasons", ",").alias("reasons"),
                      F.round(F.when(F.col("x1").isNotNull(), F.col("truncation_pct")), 5).alias("truncation_pct"), "tier")


_GEO = ("bbox_cache", "desc_box", "model_catalog", "model_catalog_partial_match", "class_catalog")
_BASIS = ("snapshot_basis_raw", "snapshot_basis", "heading_pitch_bank", "guess")


def _graded(t: Tables):
    pick = lambda names, c: F.element_at(F.array(*[F.lit(n) for n in names]), (c % len(names)).cast("int") + 1)
    rows = projection.validate_projection(_projected(t))
    rows = rows.withColumn("geometry_source", pick(_GEO, F.col("object_id"))).withColumn("basis_source", pick(_BASIS, F.col("object_id")))
    return projection.grade_object(rows)


@query("grade_object", f"""
SELECT object_id, CASE WHEN why = '' AND g < 2 THEN 'strong' WHEN why = '' AND g IN (2, 3) AND b < 2 THEN 'strong' WHEN why = '' THEN 'approximate' ELSE 'reject' END AS quality_tier,
  CASE WHEN why = '' AND g < 2 OR b < 3 THEN ['bbox_cache', 'desc_box', 'model_catalog', 'model_catalog_partial_match', 'class_catalog'][g + 1] ELSE 'estimated' END AS confidence_source
FROM (SELECT *, object_id % 5 AS g, object_id % 4 AS b FROM {_VALID})""")
def grade_object(t: Tables):
    return _graded(t).select("object_id", "quality_tier", "confidence_source")


@query("frame_usability", """
SELECT image_id, sync AND fresh AND level AND v > 0 AS usable, concat_ws(',', CASE WHEN NOT (sync AND fresh) THEN 'sync_invalid' END, CASE WHEN NOT fresh THEN 'stale_or_missing_screenshot' END,
  CASE WHEN NOT level THEN 'camera_height_not_15m' END, CASE WHEN v = 0 THEN 'no_valid_objects' END) AS reasons
FROM (SELECT f.image_id, f.image_id % 17 <> 0 AND f.image_id % 19 <> 0 AS sync, f.image_id % 23 <> 0 AS fresh, abs(height_asl_m - 15) <= 0.05 AS level,
  (SELECT count(*) FROM sub_frame_objects o WHERE o.image_id = f.image_id AND valid) AS v FROM sub_frames f)""")
def frame_usability(t: Tables):
    ok = lambda n: F.col("image_id") % n != 0
    frames = t.view("sub_frames").select("image_id", "height_asl_m", ok(17).alias("tokens_equal"), ok(19).alias("pause_ok"), ok(23).alias("screenshot_fresh"))
    return projection.frame_usability(frames, t.view("sub_frame_objects")).select("image_id", "usable", F.array_join("invalid_reasons", ",").alias("reasons"))


@query("object_stats", """
SELECT image_id, count(*) AS total_objects, count(*) FILTER (WHERE valid) AS valid_objects, count(*) FILTER (WHERE class = 'ships') AS ships,
  count(*) FILTER (WHERE class = 'ships' AND valid) AS valid_ships, count(*) FILTER (WHERE quality_tier = 'strong') AS strong, count(*) FILTER (WHERE object_id % 2 = 0) AS by_catalog
FROM sub_frame_objects GROUP BY image_id""")
def object_stats(t: Tables):
    rows = t.view("sub_frame_objects").withColumn("dimensions_source", F.when(F.col("object_id") % 2 == 0, F.lit("model_catalog")))
    out = projection.object_stats(rows)
    at = lambda m, k, n: F.coalesce(F.try_element_at(m, F.lit(k)), F.lit(0)).alias(n)
    return out.select("image_id", "total_objects", "valid_objects", at("by_class", "ships", "ships"), at("valid_by_class", "ships", "valid_ships"),
                      at("by_quality_tier", "strong", "strong"), at("by_dimensions_source", "model_catalog", "by_catalog"))


def _refined_boxes(t: Tables):
    o = t.view("sub_frame_objects").filter("object_id % 3 = 0")
    shrink = F.when(F.col("object_id") % 5 == 0, F.lit(0.0)).otherwise(F.lit(10.0))
    return o.select("object_id", (F.col("x1") + 2).alias("r_x1"), (F.col("y1") + 2).alias("r_y1"), (F.col("x1") + 2 + shrink).alias("r_x2"),
                    (F.col("y2") - 2).alias("r_y2"), F.lit(50).alias("mask_area"))


def _overlaid(t: Tables):
    rows = t.view("sub_frame_objects").select("object_id", "image_id", "class", "valid", "quality_tier", "x1", "y1", "x2", "y2")
    return projection.apply_refined_boxes(rows, _refined_boxes(t), WIDTH, HEIGHT)


_OVERLAID = """(SELECT object_id, image_id, CASE WHEN object_id % 3 = 0 THEN 'applied' WHEN valid THEN 'fallback_geometry' ELSE 'failed' END AS refinement,
  CASE WHEN object_id % 3 = 0 THEN x1 + 2 WHEN valid THEN x1 END AS x1, CASE WHEN object_id % 3 = 0 THEN y2 - 2 WHEN valid THEN least(y2, 1395::double) END AS y2,
  CASE WHEN object_id % 3 = 0 THEN object_id % 5 <> 0 AND y2 - y1 - 4 >= 1.6::double ELSE valid END AS valid,
  CASE WHEN object_id % 3 = 0 THEN CASE WHEN object_id % 5 <> 0 AND y2 - y1 - 4 >= 1.6::double THEN 'exact_visible' ELSE 'reject' END WHEN valid THEN quality_tier ELSE 'reject' END AS quality_tier
FROM sub_frame_objects)"""


@query("apply_refined_boxes", f"SELECT object_id, refinement, x1, y2, valid, quality_tier FROM {_OVERLAID}")
def apply_refined_boxes(t: Tables):
    return _overlaid(t).select("object_id", "refinement", "x1", "y2", "valid", "quality_tier")


@query("refine_summary", f"""
SELECT count(*) AS frames, coalesce(sum(r), 0)::bigint AS refined, coalesce(sum(f), 0)::bigint AS failed, count(*) FILTER (WHERE image_id % 4 <> 0 AND v > 0) AS usable_frames FROM sub_frames LEFT JOIN (
  SELECT image_id, count(*) FILTER (WHERE refinement = 'applied') AS r, count(*) FILTER (WHERE refinement = 'failed') AS f, count(*) FILTER (WHERE valid) AS v FROM {_OVERLAID} GROUP BY image_id) USING (image_id)""")
def refine_summary(t: Tables):
    frames = t.view("sub_frames").select("image_id", (F.col("image_id") % 4 != 0).alias("frame_ok"))
    return projection.refine_summary(_overlaid(t), frames)


_PARTS = """SELECT object_id, k AS comp_id, x1 + dx AS c_x1, y1 + dy AS c_y1, x1 + dx + 12 AS c_x2, y1 + dy + 9 AS c_y2, cast(60 + k * 7 AS int) AS area,
  x1 + dx + 6 AS cen_x, y1 + dy + 5 AS cen_y, x1 AS g_x1, y1 AS g_y1, x2 AS g_x2, y2 AS g_y2 FROM (
  SELECT o.*, k, cast((object_id * (k + 3)) % 151 - 40 AS double) AS dx, cast((object_id * (k + 5)) % 97 - 30 AS double) AS dy FROM sub_frame_objects o
  CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2) ks) p"""


@query("select_components", f"""
WITH rel AS (SELECT *, greatest(0::double, least(c_x2, g_x2) - greatest(c_x1, g_x1)) * greatest(0::double, least(c_y2, g_y2) - greatest(c_y1, g_y1)) AS ov,
    (c_x2 - c_x1) * (c_y2 - c_y1) AS ca, greatest(1::double, (g_x2 - g_x1) * (g_y2 - g_y1)) AS ga,
    sqrt(power((c_x1 + c_x2) / 2 - (g_x1 + g_x2) / 2, 2) + power((c_y1 + c_y2) / 2 - (g_y1 + g_y2) / 2, 2)) AS cd, greatest(g_x2 - g_x1, g_y2 - g_y1) AS longest FROM ({_PARTS})),
 ok AS (SELECT *, ov > 0 AS touch, round(area * (0.4::double + area / ca) + ov * 4 + ov / ca * area * 2 - area * (cd / greatest(1::double, 0.5 * sqrt(ga))) - CASE WHEN ov <= 0 THEN area * 2 ELSE 0 END, 9) AS score
   FROM rel WHERE ov > 0 OR cd <= greatest(8::double, 0.45 * longest)),
 rk AS (SELECT *, row_number() OVER w AS r, first_value(touch) OVER w AS st, first_value(cen_x) OVER w AS sx, first_value(cen_y) OVER w AS sy FROM ok WINDOW w AS (PARTITION BY object_id ORDER BY score DESC, comp_id))
SELECT object_id, min(c_x1) AS r_x1, min(c_y1) AS r_y1, max(c_x2) AS r_x2, max(c_y2) AS r_y2, sum(area)::bigint AS mask_area, count(*) AS num_components FROM rk
WHERE r = 1 OR touch OR (NOT st AND sqrt(power(cen_x - sx, 2) + power(cen_y - sy, 2)) <= greatest(12::double, 0.6 * longest)) GROUP BY object_id""")
def select_components(t: Tables):
    parts = t.sql(_PARTS).drop("g_x1", "g_y1", "g_x2", "g_y2")
    return projection.select_components(parts, t.view("sub_frame_objects"))


@query("clamp_refined", """
WITH b AS (SELECT object_id, x1 AS gx1, y1 AS gy1, x2 AS gx2, y2 AS gy2, x1 - (object_id % 90) AS rx1, y1 - (object_id % 50) AS ry1, x2 + (object_id % 70) AS rx2, y2 + object_id % 80 AS ry2,
    x2 - x1 AS gw, y2 - y1 AS gh FROM sub_frame_objects),
 c AS (SELECT *, greatest(40::double, 0.15::double * gw) AS sx, greatest(25::double, 0.1::double * gh) AS st, greatest(45::double, 0.2::double * gh) AS sb FROM b),
 d AS (SELECT *, greatest(0::double, least(2560, greatest(rx1, gx1 - sx))) AS cx1, greatest(0::double, least(1395, greatest(ry1, gy1 - st))) AS cy1,
    greatest(0::double, least(2560, least(rx2, gx2 + sx))) AS cx2, greatest(0::double, least(1395, least(ry2, gy2 + sb))) AS cy2 FROM c),
 e AS (SELECT *, cx1 >= cx2 OR cy1 >= cy2 OR (cx2 - cx1) * (cy2 - cy1) < 16 AS lost, greatest(1, cx2 - cx1) / gw > 1.45::double OR greatest(1, cy2 - cy1) / gh > 1.6::double AS wide FROM d)
SELECT object_id, concat_ws(',', CASE WHEN NOT lost AND (cx1 <> rx1 OR cy1 <> ry1 OR cx2 <> rx2 OR cy2 <> ry2) THEN 'ship_refinement_clamped_to_geometry' END, CASE WHEN lost OR wide THEN 'ship_refinement_fallback_geometry' END) AS reasons,
  CASE WHEN lost OR wide THEN CASE WHEN gy1 - 3 < 1395 THEN greatest(0::double, gx1 - 3) ELSE gx1 END ELSE cx1 END AS x1,
  NOT (ry1 < gy1 - st OR ry2 > gy2 + sb OR rx1 < gx1 - sx OR rx2 > gx2 + sx) AS plausible,
  (rx2 - rx1) / gw > 1.8::double OR (ry2 - ry1) / gh > 1.8::double OR sqrt(power((rx1 + rx2) / 2 - (gx1 + gx2) / 2, 2) + power((ry1 + ry2) / 2 - (gy1 + gy2) / 2, 2)) > greatest(20::double, 0.75 * greatest(gw, gh)) AS excessive
FROM e""")
def clamp_refined(t: Tables):
    o, i = t.view("sub_frame_objects"), F.col("object_id")
    rows = o.select("object_id", *[F.col(c).alias(f"g_{c}") for c in ("x1", "y1", "x2", "y2")], (F.col("x1") - i % 90).alias("r_x1"),
                    (F.col("y1") - i % 50).alias("r_y1"), (F.col("x2") + i % 70).alias("r_x2"), (F.col("y2") + i % 80).alias("r_y2"))
    out = projection.clamp_refined(rows, WIDTH, HEIGHT)
    return out.select("object_id", F.array_join("clamp_reasons", ",").alias("reasons"), "x1", "plausible", "excessive")


def _views(t: Tables):
    rows = _scene(t, "t_").select("image_id", "object_id", "class", "position", "forward", "up", "right", "t_x1", "t_y1", "t_x2", "t_y2",
                            F.struct(F.col("world_x").alias("x"), F.col("world_y").alias("y"), F.col("world_z").alias("z")).alias("origin"),
                            *[F.struct(*[F.lit(1.0 if n == a else 0.0).alias(n) for n in ("x", "y", "z")]).alias(f"axis_{a}") for a in ("x", "y", "z")],
                            F.struct((-F.col("length_m") / 2).alias("x"), F.lit(0.0).alias("y"), (-F.col("width_m") / 3).alias("z")).alias("low"),
                            F.struct((F.col("length_m") / 2).alias("x"), F.col("height_m").alias("y"), (F.col("width_m") / 2).alias("z")).alias("high"))
    cam = projection.CameraColumns(*[F.lit(_CAM[k]) for k in ("fx", "fy", "cx", "cy")], F.lit(WIDTH), F.lit(HEIGHT))
    return projection.diagnose_views(rows, cam)


def _variants(t: Tables):
    return projection.each_variant(_views(t))


# the eight boxes that can come out: local x and z extents swapped or mirrored
_VARIANT_IOU = f"""(SELECT object_id, class, v, CASE WHEN x1 IS NOT NULL AND u > 0 THEN i / u END AS iou FROM (
  SELECT *, (x2 - x1) * (y2 - y1) + (tx2 - tx1) * (ty2 - ty1) - i AS u FROM (
   SELECT *, greatest(0::double, least(x2, tx2) - greatest(x1, tx1)) * greatest(0::double, least(y2, ty2) - greatest(y1, ty1)) AS i FROM (
    SELECT object_id, class, v, tx1, ty1, tx2, ty2, CASE WHEN k THEN cx1 END AS x1, CASE WHEN k THEN cy1 END AS y1, CASE WHEN k THEN cx2 END AS x2, CASE WHEN k THEN cy2 END AS y2 FROM (
     SELECT *, cx1 < cx2 AND cy1 < cy2 AS k FROM (
      SELECT *, greatest(0::double, least(rx1, 2560)) AS cx1, greatest(0::double, least(ry1, 1440)) AS cy1, greatest(0::double, least(rx2, 2560)) AS cx2, greatest(0::double, least(ry2, 1440)) AS cy2 FROM (
       SELECT *, CASE WHEN n1 > 1e-6 THEN least({_FX!r} * (xl / n1) + 1280, {_FX!r} * (xl / n2) + 1280) WHEN n2 > 1e-6 THEN {_FX!r} * (xl / n2) + 1280 END AS rx1,
         CASE WHEN n1 > 1e-6 THEN greatest({_FX!r} * (xh / n1) + 1280, {_FX!r} * (xh / n2) + 1280) WHEN n2 > 1e-6 THEN {_FX!r} * (xh / n2) + 1280 END AS rx2,
         CASE WHEN n1 > 1e-6 THEN least(720 - {_FX!r} * (yh / n1), 720 - {_FX!r} * (yh / n2)) WHEN n2 > 1e-6 THEN 720 - {_FX!r} * (yh / n2) END AS ry1,
         CASE WHEN n1 > 1e-6 THEN greatest(720 - {_FX!r} * (yl / n1), 720 - {_FX!r} * (yl / n2)) WHEN n2 > 1e-6 THEN 720 - {_FX!r} * (yl / n2) END AS ry2
       FROM (SELECT o.object_id, class, v, x1 AS tx1, y1 AS ty1, x2 AS tx2, y2 AS ty2, world_x + lx - cam_x AS xl, world_x + hx - cam_x AS xh, world_y - 15 AS yl, world_y + o.height_m - 15 AS yh,
               world_z + lz - (cam_z - 200) AS n1, world_z + hz - (cam_z - 200) AS n2
             FROM (SELECT *, CASE WHEN swap THEN zl ELSE xl END * 1 AS lx, CASE WHEN swap THEN zh ELSE xh END AS hx, CASE WHEN swap THEN xl ELSE zl END AS lz, CASE WHEN swap THEN xh ELSE zh END AS hz FROM (
               SELECT o.*, v, swap, CASE WHEN nx THEN -xb ELSE xa END AS xl, CASE WHEN nx THEN -xa ELSE xb END AS xh, CASE WHEN nz THEN -zb ELSE za END AS zl, CASE WHEN nz THEN -za ELSE zb END AS zh FROM (
                 SELECT o.*, v, swap, nx, nz, CASE WHEN rev THEN -width_m / 3 ELSE -length_m / 2 END AS xa, CASE WHEN rev THEN width_m / 2 ELSE length_m / 2 END AS xb,
                   CASE WHEN rev THEN -length_m / 2 ELSE -width_m / 3 END AS za, CASE WHEN rev THEN length_m / 2 ELSE width_m / 2 END AS zb
                 FROM sub_frame_objects o, (SELECT v, v >= 8 AS swap, v % 8 >= 4 AS rev, v % 2 = 1 AS nx, (v % 4) >= 2 AS nz FROM range(24) r(v))) o)) o
             JOIN sub_frames f ON o.image_id = f.image_id))))))))"""


@query("diagnose_variants", f"SELECT object_id, v::int AS variant_ord, round(iou, 6) AS iou FROM {_VARIANT_IOU}")
def diagnose_variants(t: Tables):
    # rounded once for all variants of a view
    views = _views(t).withColumn("iou", F.round("iou", 6))
    return projection.each_variant(views).select("object_id", "variant_ord", "iou")


@query("best_variants", f"SELECT object_id, round(max(iou), 6) AS best_iou, round(max(iou) FILTER (WHERE v = 0), 6) AS current_iou FROM {_VARIANT_IOU} GROUP BY object_id")
def best_variants(t: Tables):
    return projection.best_variants(_variants(t)).select("object_id", F.round("best_iou", 6).alias("best_iou"), F.round("current_iou", 6).alias("current_iou"))


@query("variant_summary", f"""
SELECT class, count(*) AS objects, round(avg(c), 6) AS avg_current_iou, round(avg(b), 6) AS avg_best_iou FROM (
  SELECT object_id, class, max(iou) AS b, max(iou) FILTER (WHERE v = 0) AS c FROM {_VARIANT_IOU} GROUP BY object_id, class) GROUP BY class""")
def variant_summary(t: Tables):
    return projection.variant_summary(projection.best_variants(_variants(t))).select(
        "class", "objects", F.round("avg_current_iou", 6).alias("avg_current_iou"), F.round("avg_best_iou", 6).alias("avg_best_iou"))


@query("skipped_objects", """
SELECT image_id, object_id, CASE WHEN object_id % 13 = 0 THEN 'missing_snapshot_object' ELSE 'missing_basis_or_bbox' END AS reason FROM sub_frame_objects WHERE object_id % 13 = 0 OR object_id % 17 = 0""")
def skipped_objects(t: Tables):
    o = t.view("sub_frame_objects")
    rows = o.select("image_id", "object_id", F.lit(1).alias("axis_x"), F.lit(1).alias("origin"))
    snaps = o.filter("object_id % 13 <> 0").select("object_id", F.when(F.col("object_id") % 17 != 0, F.lit(1)).alias("low"), F.lit(1).alias("high"))
    return projection.skipped_objects(rows, snaps)


@query("mission_report", """
WITH o AS (SELECT image_id, count(*) FILTER (WHERE class = 'buoys') AS fo, count(*) FILTER (WHERE class <> 'buoys' AND valid AND a < 1000) AS ti,
    count(*) FILTER (WHERE class <> 'buoys' AND valid AND a >= 1000 AND a / 3686400 > 0.008::double) AS hu,
    count(*) FILTER (WHERE class <> 'buoys' AND valid AND a >= 1000 AND a / 3686400 <= 0.008::double) AS go,
    count(*) FILTER (WHERE class = 'ships' AND valid AND a >= 1000 AND a / 3686400 <= 0.008::double) AS sh
  FROM (SELECT *, (x2 - x1) * (y2 - y1) AS a FROM sub_frame_objects) GROUP BY image_id)
SELECT *, invalid_frames + height_violations + pitch_violations + foreign_classes + huge_boxes + frames_without_bbox + (unique_camera_positions < 8)::bigint + (usable_frames < 8)::bigint AS num_errors,
  tiny_boxes + (frames_seen <> 10)::bigint AS num_warnings FROM (
 SELECT mission_id, count(*) AS frames_seen, count(*) FILTER (WHERE usable) AS usable_frames, count(*) FILTER (WHERE NOT usable) AS invalid_frames,
  count(*) FILTER (WHERE usable AND coalesce(go, 0) = 0) AS frames_without_bbox, count(*) FILTER (WHERE usable AND abs(height_asl_m - 15) > 1) AS height_violations,
  count(*) FILTER (WHERE usable AND abs(pitch_deg) > 2) AS pitch_violations, count(DISTINCT (round_even(cam_x, 0), round_even(height_asl_m, 0), round_even(cam_z, 0))) FILTER (WHERE usable) AS unique_camera_positions,
  coalesce(sum(fo) FILTER (WHERE usable), 0)::bigint AS foreign_classes, coalesce(sum(ti) FILTER (WHERE usable), 0)::bigint AS tiny_boxes, coalesce(sum(hu) FILTER (WHERE usable), 0)::bigint AS huge_boxes,
  coalesce(sum(go) FILTER (WHERE usable), 0)::bigint AS valid_objects, coalesce(sum(sh) FILTER (WHERE usable), 0)::bigint AS n_ships FROM sub_frames LEFT JOIN o USING (image_id) GROUP BY mission_id)""")
def mission_report(t: Tables):
    out = missions.mission_report(t.view("sub_frames"), t.view("sub_frame_objects"), max_ratio=0.008, min_area=1000.0)
    return out.drop("n_helicopters", "n_airplanes")


@query("presence_report", """
SELECT frame_id, CASE WHEN i AND NOT m THEN 'image without metadata' WHEN m AND NOT i THEN 'metadata without image' END AS finding FROM (
  SELECT frame_id, image_id % 20 <> 0 AS i, image_id % 30 <> 0 AS m FROM sub_frames) WHERE i <> m
UNION ALL SELECT frame_id, 'image without YOLO labels' FROM sub_frames WHERE image_id % 20 <> 0 AND image_id % 45 = 0""")
def presence_report(t: Tables):
    f = t.view("sub_frames")
    return missions.presence_report(f.filter("image_id % 20 <> 0"), f.filter("image_id % 30 <> 0"), f.filter("image_id % 45 <> 0"))


@query("static_dataset_report", """
WITH o AS (SELECT image_id, count(*) FILTER (WHERE class = 'buoys') AS fo, count(*) FILTER (WHERE g) AS go, min(a / 3686400) FILTER (WHERE g) AS rmin, max(a / 3686400) FILTER (WHERE g) AS rmax, min(world_z) FILTER (WHERE g) AS dmin,
  max(world_z) FILTER (WHERE g) AS dmax FROM (SELECT *, (x2 - x1) * (y2 - y1) AS a, class <> 'buoys' AND valid AS g FROM sub_frame_objects) GROUP BY image_id)
SELECT mission_id, count(*) AS frames, count(*) FILTER (WHERE NOT usable) AS unusable, count(*) FILTER (WHERE abs(height_asl_m - 15) > 0.1) AS bad_height, count(*) FILTER (WHERE abs(pitch_deg) > 0.25) AS bad_pitch,
  count(DISTINCT (round_even(cam_x, 1), round_even(height_asl_m, 1), round_even(cam_z, 1))) AS positions, coalesce(sum(fo), 0)::bigint AS "foreign", coalesce(sum(go), 0)::bigint AS valid_objects,
  count(*) FILTER (WHERE coalesce(go, 0) = 0) AS frames_without_bbox, min(rmin) AS ratio_min, max(rmax) AS ratio_max, min(dmin) AS distance_min, max(dmax) AS distance_max,
  count(*) FILTER (WHERE image_id % 9 = 0) AS empty_labels, count(*) FILTER (WHERE image_id % 9 <> 0 AND image_id % 7 = 0) AS bad_lines FROM sub_frames LEFT JOIN o USING (image_id) GROUP BY mission_id""")
def static_dataset_report(t: Tables):
    lines = t.view("sub_frames").filter("image_id % 9 <> 0").select("frame_id", F.when(F.col("image_id") % 7 == 0, F.lit("9 0 0 0 0")).otherwise(F.lit("0 0.5 0.5 0.1 0.1")).alias("line"))
    out = missions.static_dataset_report(t.view("sub_frames"), t.view("sub_frame_objects").withColumn("distance_m", F.col("world_z")), lines)
    return out.select("mission_id", "frames", "unusable", "bad_height", "bad_pitch", "positions", "foreign", "valid_objects", "frames_without_bbox", "ratio_min",
                      "ratio_max", "distance_min", "distance_max", "empty_labels", "bad_lines")
