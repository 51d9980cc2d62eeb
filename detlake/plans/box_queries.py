"""Box geometry and tiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from detlake.functions import boxes as B
from detlake.operators import enrich, tiling
from detlake.operators.splits import with_split
from detlake.plans.catalog import query
from detlake.plans.substrate import Tables

_PAIRS = """SELECT a.ann_id, a.x AS a_x1, a.y AS a_y1, a.x + a.w AS a_x2, a.y + a.h AS a_y2,
  b.x AS b_x1, b.y AS b_y1, b.x + b.w AS b_x2, b.y + b.h AS b_y2
  FROM sub_annotations a JOIN sub_annotations b ON a.image_id = b.image_id AND b.n = a.n + 1"""


@query("box_geometry", f"""
SELECT ann_id, CASE WHEN i > 0 THEN i / (aa + ba - i) ELSE 0::double END AS iou,
  CASE WHEN i > 0 THEN i / least(aa, ba) ELSE 0::double END AS ios, sqrt(dx * dx + dy * dy) AS gap,
  i AS overlap_area, CASE WHEN i > 0 THEN greatest(a_x1, b_x1) END AS ix1, least(a_x1, b_x1) AS ux1, greatest(a_y2, b_y2) AS uy2,
  greatest((a_x2 - a_x1) / (a_y2 - a_y1), (a_y2 - a_y1) / (a_x2 - a_x1)) AS aspect,
  least(1.0::double, i / aa) AS visible, aa >= 1000 AS valid
FROM (SELECT *, greatest(0::double, least(a_x2, b_x2) - greatest(a_x1, b_x1)) * greatest(0::double, least(a_y2, b_y2) - greatest(a_y1, b_y1)) AS i,
  (a_x2 - a_x1) * (a_y2 - a_y1) AS aa, (b_x2 - b_x1) * (b_y2 - b_y1) AS ba,
  greatest(b_x1 - a_x2, a_x1 - b_x2, 0::double) AS dx, greatest(b_y1 - a_y2, a_y1 - b_y2, 0::double) AS dy FROM ({_PAIRS}))""")
def box_geometry(t: Tables):
    a, b = B.box("a_"), B.box("b_")
    hit, hull = B.intersect_box(a, b), B.union_box(a, b)
    return t.sql(_PAIRS).select(
        "ann_id", B.iou(a, b).alias("iou"), B.ios(a, b).alias("ios"), B.gap_distance(a, b).alias("gap"),
        B.overlap_area(a, b).alias("overlap_area"), hit.x1.alias("ix1"), hull.x1.alias("ux1"), hull.y2.alias("uy2"),
        B.aspect_ratio(a).alias("aspect"), B.visible_ratio(a, B.overlap(a, b)).alias("visible"),
        B.is_valid_box(a, 1000.0).alias("valid"))


@query("box_transforms", """
SELECT ann_id, x + w AS x2, y + h AS y2, greatest(0::double, least(x * 1.5::double, 1000::double)) AS clip_x1,
  x * 1.5::double - 100 AS moved_x1, (x + w / 2) / width AS cx, (y + h / 2) / height AS cy, w / width AS wn, h / height AS hn,
  (x + w / 2) / width * width - w / width * width / 2 AS back_x1,
  CASE WHEN x < least(x + w, width) AND y < least(y + h, greatest(1, height - 45)) THEN least(y + h, height - 45::double) END AS hud_y2,
  (y + h > 700) OR (x + w > 1200) AS truncated,
  CASE WHEN y < height - 45 THEN greatest(0::double, x - 3) ELSE x END AS padded_x1,
  x + w * 0.5::double AS center_x
FROM (SELECT a.*, width, height FROM sub_annotations a JOIN sub_images i ON a.image_id = i.image_id)""")
def box_transforms(t: Tables):
    df = t.sql("SELECT a.*, width, height FROM sub_annotations a JOIN sub_images i ON a.image_id = i.image_id")
    w, h = F.col("width"), F.col("height")
    b = B.xywh_to_xyxy(F.col("x"), F.col("y"), F.col("w"), F.col("h"))
    cx, cy, wn, hn = B.xyxy_to_yolo(b, w, h)
    back = B.yolo_to_xyxy(cx, cy, wn, hn, w, h)
    return df.select(
        "ann_id", b.x2.alias("x2"), b.y2.alias("y2"), B.clip_box(B.scale_box(b, 1.5, 1.5), 1000, 1000).x1.alias("clip_x1"),
        B.translate_box(B.scale_box(b, 1.5, 1.5), -100.0, 0.0).x1.alias("moved_x1"), cx.alias("cx"), cy.alias("cy"),
        wn.alias("wn"), hn.alias("hn"), back.x1.alias("back_x1"), B.clip_box_hud(b, w, h, 45).y2.alias("hud_y2"),
        B.clip_with_truncation(b, 1200, 700)[1].alias("truncated"), B.pad_box(b, 3, w, h, 45).x1.alias("padded_x1"),
        B.box_center(b)[0].alias("center_x"))


@query("box_agreement", f"""
SELECT ann_id, CASE WHEN u > 0 THEN i / u END AS iou, round(sqrt(ex * ex + ey * ey), 6) AS center_error,
  (a_x2 - a_x1) / greatest(1e-6::double, b_x2 - b_x1) AS width_ratio, (a_y2 - a_y1) / greatest(1e-6::double, b_y2 - b_y1) AS height_ratio,
  aa / ba AS area_ratio
FROM (SELECT *, aa + ba - i AS u FROM (SELECT *,
  greatest(0::double, least(a_x2, b_x2) - greatest(a_x1, b_x1)) * greatest(0::double, least(a_y2, b_y2) - greatest(a_y1, b_y1)) AS i,
  (a_x2 - a_x1) * (a_y2 - a_y1) AS aa, (b_x2 - b_x1) * (b_y2 - b_y1) AS ba,
  (a_x1 + a_x2) * 0.5::double - (b_x1 + b_x2) * 0.5::double AS ex, (a_y1 + a_y2) * 0.5::double - (b_y1 + b_y2) * 0.5::double AS ey FROM ({_PAIRS})))""")
def box_agreement(t: Tables):
    cols = B.box_agreement(B.box("a_"), B.box("b_"))
    cols["center_error"] = F.round(cols["center_error"], 6)
    return t.sql(_PAIRS).select("ann_id", *[c.alias(n) for n, c in cols.items()])


@query("letterbox_plan", """
SELECT image_id, scale, nw AS new_width, nh AS new_height, (640 - nw) // 2 AS pad_x, (640 - nh) // 2 AS pad_y,
  1000 * scale + (640 - nw) // 2 AS box_x, round((1000 * scale + (640 - nw) // 2 - (640 - nw) // 2) / scale, 6) AS back_x
FROM (SELECT image_id, scale, greatest(1, round_even(width * scale, 0))::int AS nw, greatest(1, round_even(height * scale, 0))::int AS nh
  FROM (SELECT *, least(640::double / width, 640::double / height) AS scale FROM sub_images))""")
def letterbox_plan(t: Tables):
    plan = B.letterbox_plan(F.col("width"), F.col("height"), 640)
    df = t.view("sub_images").select("image_id", *[c.alias(n) for n, c in plan.items()])
    p = (F.col("scale"), F.col("pad_x"), F.col("pad_y"))
    k = F.lit(1000.0)
    there = B.source_to_letterbox(B.Box(k, k, k, k), *p)
    return df.select("*", there.x1.alias("box_x"), F.round(B.letterbox_to_source(there, *p).x1, 6).alias("back_x"))


@query("resize_plan", """
SELECT image_id, 1000::double / width AS exact_sx, 700::double / height AS exact_sy, s AS fit_scale,
  greatest(1, round_even(width * s, 0))::int AS fit_width, greatest(1, round_even(height * s, 0))::int AS fit_height
FROM (SELECT *, least(1000::double / width, 700::double / height) AS s FROM sub_images)""")
def resize_plan(t: Tables):
    exact = B.resize_plan(F.col("width"), F.col("height"), 1000, 700)
    fit = B.resize_plan(F.col("width"), F.col("height"), 1000, 700, "fit_aspect")
    return t.view("sub_images").select(
        "image_id", exact["scale_x"].alias("exact_sx"), exact["scale_y"].alias("exact_sy"), fit["scale_x"].alias("fit_scale"),
        fit["dst_width"].alias("fit_width"), fit["dst_height"].alias("fit_height"))


@query("generate_tiles", """
SELECT image_id, (yi * len(xs) + xi)::int AS crop_id, xs[xi + 1]::int AS ox, ys[yi + 1]::int AS oy,
  least(640, width - xs[xi + 1])::int AS cw, least(640, height - ys[yi + 1])::int AS ch,
  (640 - least(640, width - xs[xi + 1]))::int AS pad_r, (640 - least(640, height - ys[yi + 1]))::int AS pad_b
FROM (SELECT *, unnest(range(len(xs))) AS xi FROM (SELECT *, unnest(range(len(ys))) AS yi FROM (
  SELECT *, CASE WHEN width <= 640 THEN [0::bigint] ELSE list_sort(list_distinct(range(0, width - 640 + 1, 320) || [(width - 640)::bigint])) END AS xs,
    CASE WHEN height <= 640 THEN [0::bigint] ELSE list_sort(list_distinct(range(0, height - 640 + 1, 320) || [(height - 640)::bigint])) END AS ys
  FROM sub_images)))""")
def generate_tiles(t: Tables):
    return tiling.generate_tiles(t.view("sub_images")).select("image_id", "crop_id", "ox", "oy", "cw", "ch", "pad_r", "pad_b")


@query("scale_plan", "SELECT image_id, scale_ord, scale_name, scale_w, scale_h, sx, sy, crop FROM orc_plan")
def scale_plan(t: Tables):
    return tiling.scale_plan(t.view("sub_images")).select(
        "image_id", "scale_ord", "scale_name", "scale_w", "scale_h", "sx", "sy", "crop")


def _images(t: Tables):
    return with_split(t.view("sub_images")).select("image_id", "file_name", "width", "height", "split")


def _annotations(t: Tables):
    return t.view("sub_annotations").select("image_id", "ann_id", "category_id", "x", "y", "w", "h")


@query("tile_annotations", """
SELECT image_id, scale_name, crop_id::int AS crop_id, ox::int AS ox, oy::int AS oy, ann_id, x1, y1, x2, y2, visible_ratio FROM orc_pieces""")
def tile_annotations(t: Tables):
    return tiling.tile_annotations(_annotations(t), _images(t)).drop("scale_ord", "category_id")


@query("kept_tiles", """
SELECT image_id, scale_name, crop_id::int AS crop_id, count(*) AS num_kept FROM orc_pieces GROUP BY ALL""")
def kept_tiles(t: Tables):
    pieces = tiling.tile_annotations(_annotations(t), _images(t))
    return enrich.kept_counts(pieces).select(*enrich.TILE_KEY, "num_kept")


@query("dropped_tiles", """
SELECT image_id, split, scale_name, crop_id::int AS crop_id, ox::int AS ox, oy::int AS oy, 'all_objects_below_visible_threshold' AS reason,
  (SELECT count(*) FROM sub_annotations a WHERE a.image_id = t.image_id) AS num_objects_before_filter,
  0::bigint AS num_objects_after_filter
FROM orc_tiles t WHERE NOT EXISTS (SELECT 1 FROM orc_pieces p WHERE p.image_id = t.image_id AND p.scale_name = t.scale_name AND p.crop_id = t.crop_id)""")
def dropped_tiles(t: Tables):
    out = enrich.dropped_tiles(_images(t), _annotations(t), tiling.tile_annotations(_annotations(t), _images(t)))
    return out.select("image_id", "split", "scale_name", "crop_id", "ox", "oy", "reason", "num_objects_before_filter",
                      "num_objects_after_filter")


@query("whole_image_scale", """
SELECT p.image_id, scale_name, ann_id, category_id, x * sx AS x1, y * sy AS y1, (x + w) * sx AS x2, (y + h) * sy AS y2, 1.0::double AS visible_ratio
FROM orc_plan p JOIN sub_annotations a ON p.image_id = a.image_id WHERE NOT crop""")
def whole_image_scale(t: Tables):
    return enrich.whole_image_scale(_images(t), _annotations(t)).drop("scale_ord", "crop_id", "ox", "oy")


@query("background_images", """
SELECT image_id, split, 640::double / width AS sx, 640::double / height AS sy, scale,
  (640 - greatest(1, round_even(width * scale, 0))::int) // 2 AS pad_x, (640 - greatest(1, round_even(height * scale, 0))::int) // 2 AS pad_y
FROM (SELECT *, least(640::double / width, 640::double / height) AS scale FROM orc_split_images)
WHERE image_id NOT IN (SELECT image_id FROM sub_annotations)""")
def background_images(t: Tables):
    return enrich.background_images(_images(t), _annotations(t)).select("image_id", "split", "sx", "sy", "scale", "pad_x", "pad_y")


_PICTURES = """(
SELECT *, row_number() OVER (PARTITION BY split ORDER BY image_id, scale_ord, crop_id) AS new_image_id FROM (
  SELECT DISTINCT split, image_id, scale_ord, scale_name, crop_id FROM orc_pieces
  UNION ALL SELECT split, image_id, scale_ord, scale_name, -1 FROM orc_plan WHERE NOT crop AND image_id IN (SELECT image_id FROM sub_annotations)
  UNION ALL SELECT split, image_id, -1, 'background', -1 FROM orc_split_images WHERE image_id NOT IN (SELECT image_id FROM sub_annotations)))"""
_NEW_ANNOTATIONS = """(
SELECT *, row_number() OVER (PARTITION BY split ORDER BY image_id, scale_ord, crop_id, ann_id) AS new_annotation_id FROM (
  SELECT split, image_id, scale_ord, scale_name, crop_id, ann_id, visible_ratio, (x2 - x1) * (y2 - y1) AS area FROM orc_pieces
  UNION ALL SELECT split, p.image_id, scale_ord, scale_name, -1, ann_id, 1.0, ((x + w) * sx - x * sx) * ((y + h) * sy - y * sy)
    FROM orc_plan p JOIN sub_annotations a ON p.image_id = a.image_id WHERE NOT crop))"""


def _placed(t: Tables):
    images, annotations = _images(t), _annotations(t)
    return images, annotations, enrich.placed(images, annotations)


# eight digits at least, as many as the id has otherwise: lpad alone would cut longer ids
_NEW_ID = "lpad(new_image_id::varchar, greatest(8, length(new_image_id::varchar))::int, '0')"


@query("enriched_images", f"""
SELECT split, image_id, scale_name, crop_id::int AS crop_id, new_image_id,
  {_NEW_ID} || '_frame_' || lpad(image_id::varchar, 8, '0') || '_' || scale_name
  || CASE WHEN crop_id >= 0 THEN '_t' || lpad(crop_id::varchar, 3, '0') ELSE '' END || '.png' AS new_file_name
FROM {_PICTURES}""")
def enriched_images(t: Tables):
    return enrich.enriched_images(*_placed(t)).select("split", "image_id", "scale_name", "crop_id", "new_image_id", "new_file_name")


@query("enriched_annotations", f"""
SELECT split, ann_id, scale_name, crop_id::int AS crop_id, new_image_id, new_annotation_id, round(area, 6) AS area
FROM {_NEW_ANNOTATIONS} JOIN {_PICTURES} USING (split, image_id, scale_name, crop_id)""")
def enriched_annotations(t: Tables):
    return enrich.enriched_annotations(_placed(t)[2]).select("split", "ann_id", "scale_name", "crop_id", "new_image_id", "new_annotation_id",
                                                             F.round("area", 6).alias("area"))


@query("tile_manifest", f"""
SELECT p.split, p.image_id, p.scale_name, p.new_image_id, scale_name = 'background' AS is_background,
  coalesce((SELECT string_agg(ann_id::varchar, ',' ORDER BY ann_id) FROM new_a a WHERE a.split = p.split AND a.image_id = p.image_id AND a.scale_name = p.scale_name AND a.crop_id = p.crop_id), '') AS kept,
  coalesce((SELECT string_agg(new_annotation_id::varchar, ',' ORDER BY ann_id) FROM new_a a WHERE a.split = p.split AND a.image_id = p.image_id AND a.scale_name = p.scale_name AND a.crop_id = p.crop_id), '') AS kept_new,
  (SELECT count(*) FROM sub_annotations s WHERE s.image_id = p.image_id)
   - (SELECT count(*) FROM new_a a WHERE a.split = p.split AND a.image_id = p.image_id AND a.scale_name = p.scale_name AND a.crop_id = p.crop_id) AS num_dropped
FROM {_PICTURES} p""".replace("new_a a", _NEW_ANNOTATIONS + " a"))
def tile_manifest(t: Tables):
    out = enrich.tile_manifest(*_placed(t))
    return out.select("split", "image_id", "scale_name", "new_image_id", "is_background",
                      F.array_join("kept_source_annotation_ids", ",").alias("kept"),
                      F.array_join("kept_annotation_ids", ",").alias("kept_new"),
                      F.size("dropped_annotation_ids").cast("bigint").alias("num_dropped"))


@query("enrichment_summary", """
SELECT split, scale_name, count(n) AS num_images, coalesce(sum(n), 0)::bigint AS num_annotations, (count(*) - count(n))::bigint AS num_dropped_tiles
FROM (SELECT t.split, t.scale_name, n FROM orc_tiles t LEFT JOIN (
  SELECT image_id, scale_name, crop_id, count(*) AS n FROM orc_pieces GROUP BY ALL) k USING (image_id, scale_name, crop_id)) GROUP BY ALL
UNION ALL SELECT split, scale_name, count(DISTINCT p.image_id), count(*), 0::bigint FROM orc_plan p JOIN sub_annotations a ON p.image_id = a.image_id WHERE NOT crop GROUP BY ALL
UNION ALL SELECT split, 'background', count(*), 0::bigint, 0::bigint FROM orc_split_images WHERE image_id NOT IN (SELECT image_id FROM sub_annotations) GROUP BY ALL""")
def enrichment_summary(t: Tables):
    return enrich.enrichment_summary(_images(t), _annotations(t))


@query("enrich_dataset", """
SELECT split, scale_name, count(*) AS num_annotations, sum(category_id)::bigint AS sum_category FROM (
  SELECT split, scale_name, category_id FROM orc_pieces UNION ALL SELECT split, scale_name, category_id FROM orc_plan p JOIN sub_annotations a ON p.image_id = a.image_id WHERE NOT crop) GROUP BY ALL""")
def enrich_dataset(t: Tables):
    out = enrich.enrich_dataset(_images(t), _annotations(t))["annotations"]
    return out.groupBy("split", "scale_name").agg(F.count(F.lit(1)).alias("num_annotations"), F.sum("category_id").alias("sum_category"))
