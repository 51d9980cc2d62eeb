"""Ingest, migration and validation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from detlake.functions.text import bbox_from_json
from detlake.operators import ingest, quality
from detlake.operators.splits import with_split
from detlake.plans.catalog import query
from detlake.plans.substrate import Tables


def _images(t: Tables):
    return with_split(t.view("sub_images")).select("image_id", "dataset_id", "frame_id", "file_name", "width", "height", "split")


def _annotations(t: Tables):
    return t.view("sub_annotations").select("image_id", "ann_id", "category_id", "x", "y", "w", "h")


def _placed(t: Tables):
    return _annotations(t).join(_images(t).select("image_id", "dataset_id", "split"), "image_id")


_PLACED = "(SELECT a.*, i.dataset_id, i.split FROM sub_annotations a JOIN orc_split_images i ON a.image_id = i.image_id)"


@query("assign_split", "SELECT image_id, split FROM orc_split_images")
def assign_split(t: Tables):
    return _images(t).select("image_id", "split")


@query("split_dataset", f"SELECT image_id, ann_id, category_id, split FROM {_PLACED}")
def split_dataset(t: Tables):
    cats = t.view("sub_categories")
    return ingest.split_dataset(t.view("sub_images"), _annotations(t), cats)["annotations"].select("image_id", "ann_id", "category_id", "split")


@query("split_counts", f"""
SELECT coalesce(split, 'all') AS split, sum(i)::bigint AS num_images, sum(a)::bigint AS num_annotations FROM (
  SELECT split, count(*) AS i, sum((SELECT count(*) FROM sub_annotations a WHERE a.image_id = s.image_id)) AS a FROM orc_split_images s GROUP BY split)
GROUP BY ROLLUP (split)""")
def split_counts(t: Tables):
    return ingest.split_counts(_images(t), _placed(t))


@query("normalize_dataset", """
SELECT 'warning' AS severity, 'images' AS location, 'source image missing: ' || file_name AS message FROM sub_images WHERE image_id % 25 = 0""")
def normalize_dataset(t: Tables):
    files = t.view("sub_images").filter("image_id % 25 <> 0").select("file_name")
    frames = t.view("sub_frames").select("image_id", "mission_id", "usable")
    return ingest.normalize_dataset(t.view("sub_images"), _annotations(t), t.view("sub_categories"), frames, t.view("sub_frame_objects"), files)["warnings"]


def _frames(t: Tables):
    return t.view("sub_frames").withColumn("file_name", F.concat("frame_id", F.lit(".png"))).withColumn("width", F.lit(2560)).withColumn("height", F.lit(1440))


@query("capture_manifest", """
SELECT i.image_id, i.split, 'images/' || i.split || '/' || i.file_name AS source_image, f.image_id IS NOT NULL AS has_rich_metadata, f.mission_id,
  f.usable, CASE WHEN f.image_id IS NOT NULL THEN (SELECT count(*) FROM sub_frame_objects o WHERE o.image_id = i.image_id) END AS num_objects,
  (SELECT count(*) FROM sub_frame_objects o WHERE o.image_id = i.image_id AND quality_tier = 'strong' AND f.image_id IS NOT NULL) AS num_strong,
  (SELECT string_agg(quality_tier, ',' ORDER BY object_id) FROM sub_frame_objects o WHERE o.image_id = i.image_id AND f.image_id IS NOT NULL) AS tiers
FROM orc_split_images i LEFT JOIN (SELECT * FROM sub_frames WHERE image_id % 10 <> 0) f ON i.image_id = f.image_id""")
def capture_manifest(t: Tables):
    frames = t.view("sub_frames").filter("image_id % 10 <> 0").select("image_id", "mission_id", "usable")
    out = ingest.capture_manifest(_images(t), frames, t.view("sub_frame_objects"))
    strong = F.coalesce(F.try_element_at("quality_tiers", F.lit("strong")), F.lit(0))
    return out.select("image_id", "split", "source_image", "has_rich_metadata", "mission_id", "usable", "num_objects", strong.alias("num_strong"), F.array_join("object_quality_tiers", ",").alias("tiers"))


_EXPORT = """(SELECT o.*, f.frame_id, f.usable, valid AND quality_tier IN ('exact_visible', 'exact', 'strong', 'approximate') AND class <> 'buoys' AS ok,
  CASE class WHEN 'ships' THEN 0 WHEN 'helicopters' THEN 1 WHEN 'airplanes' THEN 2 END AS category_id FROM sub_frame_objects o JOIN sub_frames f ON o.image_id = f.image_id)"""


@query("frames_to_coco", f"""
SELECT object_id, row_number() OVER (ORDER BY frame_id, object_id) AS coco_annotation_id, pos AS coco_image_id, category_id, (x2 - x1) * (y2 - y1) AS area
FROM {_EXPORT} JOIN (SELECT frame_id AS fid, row_number() OVER (ORDER BY frame_id) AS pos FROM sub_frames WHERE usable) ON fid = frame_id
WHERE ok AND usable""")
def frames_to_coco(t: Tables):
    return ingest.frames_to_coco(_frames(t), t.view("sub_frame_objects"))["annotations"].select(
        "object_id", "coco_annotation_id", "coco_image_id", "category_id", "area")


@query("export_stats", f"""
SELECT (SELECT count(*) FROM sub_frames) AS frames_seen, (SELECT count(*) FROM sub_frames WHERE usable) AS frames_exported,
  (SELECT count(*) FROM sub_frames WHERE NOT usable) AS frames_skipped,
  (SELECT count(*) FROM {_EXPORT} WHERE usable AND ok) AS annotations_exported, (SELECT count(*) FROM {_EXPORT} WHERE usable AND NOT ok) AS objects_skipped""")
def export_stats(t: Tables):
    return ingest.export_stats(_frames(t), t.view("sub_frame_objects"))


@query("export_yolo", f"""
SELECT frame_id, object_id, printf('%d %.6f %.6f %.6f %.6f', category_id, (x1 + (x2 - x1) / 2) / 2560, (y1 + (y2 - y1) / 2) / 1440, (x2 - x1) / 2560, (y2 - y1) / 1440) AS line
FROM {_EXPORT} WHERE ok AND usable""")
def export_yolo(t: Tables):
    return ingest.yolo_rows(_frames(t), t.view("sub_frame_objects"))


@query("yolo_files", f"""
SELECT f.frame_id, coalesce(n, 0) AS num_lines, coalesce(first, '') AS first_line FROM sub_frames f LEFT JOIN (
  SELECT frame_id, count(*) AS n, min_by(printf('%d %.6f %.6f %.6f %.6f', category_id, (x1 + (x2 - x1) / 2) / 2560, (y1 + (y2 - y1) / 2) / 1440, (x2 - x1) / 2560, (y2 - y1) / 1440), object_id) AS first
  FROM {_EXPORT} WHERE ok AND usable GROUP BY frame_id) USING (frame_id)""")
def yolo_files(t: Tables):
    frames = _frames(t)
    files = ingest.yolo_files(frames, ingest.yolo_rows(frames, t.view("sub_frame_objects")))
    n = F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", "\n")))
    return files.select("frame_id", n.cast("bigint").alias("num_lines"), F.substring_index("text", "\n", 1).alias("first_line"))


@query("classify_category_set", """
SELECT dataset_id, CASE WHEN s = '0ships,1helicopters,2airplanes' THEN 'canonical' WHEN s = '0ships,1buoys,2helicopters,3airplanes' THEN 'legacy4' ELSE 'unknown' END AS kind
FROM (SELECT dataset_id, string_agg(category_id::varchar || name, ',' ORDER BY category_id) AS s FROM sub_categories GROUP BY dataset_id)""")
def classify_category_set(t: Tables):
    return ingest.classify_category_set(t.view("sub_categories"))


@query("remap_categories", """
SELECT ann_id, image_id, CASE category_id WHEN 0 THEN 0 WHEN 2 THEN 1 ELSE 2 END AS category_id FROM sub_legacy WHERE category_id <> 1""")
def remap_categories(t: Tables):
    return ingest.remap_categories(t.view("sub_legacy"))[0].select("ann_id", "image_id", "category_id")


@query("remap_counts", """
SELECT category_id AS old_id, (CASE WHEN category_id = 1 THEN 0 ELSE count(*) END)::bigint AS kept, (CASE WHEN category_id = 1 THEN count(*) ELSE 0 END)::bigint AS dropped
FROM sub_legacy GROUP BY category_id""")
def remap_counts(t: Tables):
    return ingest.remap_categories(t.view("sub_legacy"))[1]


def _old_rows(t: Tables):
    images = _images(t)
    old = F.col("dataset_id").isin("ds_2", "ds_3")
    rows = t.view("sub_annotations").join(images.select("image_id", "dataset_id", "split"), "image_id")
    rows = rows.withColumn("category_id", F.when(old, (F.col("k1") % 4).cast("int")).otherwise(F.col("category_id")))
    return images, rows.select("dataset_id", "split", "image_id", "ann_id", "category_id", "x", "y", "w", "h")


@query("migrate_dataset", """
SELECT dataset_id, split, CASE WHEN dataset_id IN ('ds_2', 'ds_3') THEN 'legacy4' WHEN dataset_id = 'ds_4' THEN 'unknown' ELSE 'canonical' END AS kind,
  CASE WHEN dataset_id = 'ds_4' THEN 'unknown' ELSE 'migrate' END AS action, count(DISTINCT i.image_id) AS num_images,
  count(a.ann_id) FILTER (WHERE dataset_id <> 'ds_4' AND NOT (dataset_id IN ('ds_2', 'ds_3') AND k1 % 4 = 1)) AS num_annotations,
  count(a.ann_id) FILTER (WHERE dataset_id = 'ds_4' OR dataset_id IN ('ds_2', 'ds_3') AND k1 % 4 = 1) AS dropped
FROM orc_split_images i LEFT JOIN sub_annotations a ON a.image_id = i.image_id GROUP BY dataset_id, split""")
def migrate_dataset(t: Tables):
    return ingest.migrate_dataset(*_old_rows(t), t.view("sub_categories"))[1]


@query("migrate_again", """
SELECT i.dataset_id, CASE i.dataset_id WHEN 'ds_0' THEN 'keep' WHEN 'ds_1' THEN 'migrate' WHEN 'ds_2' THEN 'keep' WHEN 'ds_3' THEN 'refuse' ELSE 'unknown' END AS action,
  count(a.ann_id) FILTER (WHERE i.dataset_id = 'ds_1') AS written
FROM orc_split_images i LEFT JOIN sub_annotations a ON a.image_id = i.image_id GROUP BY i.dataset_id""")
def migrate_again(t: Tables):
    """A second migration onto stored results: of ds_0 and ds_2 as they are, of ds_3 with one class changed, of ds_1 none."""
    images, rows = _old_rows(t)
    stored = ingest.migrate_dataset(images, rows, t.view("sub_categories"))[0]["annotations"].filter("dataset_id <> 'ds_1'")
    stored = stored.withColumn("category_id", F.when((F.col("dataset_id") == "ds_3") & (F.col("ann_id") % 1000 < 500), 2).otherwise(F.col("category_id")))
    tables, report = ingest.migrate_dataset(images, rows, t.view("sub_categories"), stored)
    written = tables["annotations"].groupBy("dataset_id").agg(F.count("*").alias("written"))
    return report.select("dataset_id", "action").distinct().join(written, "dataset_id", "left").select("dataset_id", "action", F.coalesce("written", F.lit(0)).alias("written"))


_TYPES = """SELECT ann_id, CASE k1 % 9 WHEN 0 THEN 'Arleigh_Burke' WHEN 1 THEN 'UH-1H' WHEN 2 THEN 'F-16C bl.50' WHEN 3 THEN 'Su-25T' WHEN 4 THEN 'kilo'
  WHEN 5 THEN 'MiG-29A' WHEN 6 THEN 'tanker' WHEN 7 THEN 'Oil Ship--XL' ELSE NULL END AS type_name FROM sub_annotations"""


@query("infer_class", """
SELECT ann_id, CASE WHEN k1 % 9 IN (0, 4, 7) THEN 'ships' WHEN k1 % 9 = 1 THEN 'helicopters' WHEN k1 % 9 IN (2, 3, 5) THEN 'airplanes' END AS class FROM sub_annotations""")
def infer_class(t: Tables):
    return t.sql(_TYPES).select("ann_id", ingest.infer_class(F.col("type_name")).alias("class"))


@query("lookup_dimensions", """
SELECT ann_id, CASE k1 % 9 WHEN 0 THEN 'model_catalog_partial_match' WHEN 1 THEN 'class_catalog' WHEN 2 THEN 'class_catalog' WHEN 3 THEN 'model_catalog_normalized'
  WHEN 4 THEN 'model_catalog' WHEN 5 THEN 'model_catalog_partial_match' WHEN 7 THEN 'class_catalog' END AS dimensions_source,
  CASE k1 % 9 WHEN 0 THEN 155.0 WHEN 1 THEN 17.0 WHEN 2 THEN 15.0 WHEN 3 THEN 16.0 WHEN 4 THEN 74.0 WHEN 5 THEN 17.5 WHEN 7 THEN 100.0 END::double AS length FROM sub_annotations""")
def lookup_dimensions(t: Tables):
    cat = [(0, "ships", 100.0), (1, "helicopters", 17.0), (2, "airplanes", 15.0), (3, "burke", 155.0), (4, "kilo", 74.0), (5, "mig-29", 17.5), (6, "su 25t", 16.0)]
    catalog = t.spark.createDataFrame([(o, k, n, n / 5, n / 6) for o, k, n in cat], "ord int, key string, length double, width double, height double")
    types = t.sql(_TYPES).withColumn("class", ingest.infer_class(F.col("type_name")))
    named = types.withColumn("type_name", F.coalesce("type_name", F.lit(""))).withColumn("class", F.coalesce("class", F.lit("unknown")))
    return ingest.lookup_dimensions(named, catalog).select("ann_id", "dimensions_source", "length")


@query("image_rows", """
SELECT dataset_id || ':' || split || ':' || image_id AS image_id, split, 'images/' || split || '/' || file_name AS storage_path,
  image_id IN (SELECT image_id FROM sub_annotations) AS has_objects, frame_id AS source_frame_id FROM orc_split_images""")
def image_rows(t: Tables):
    return ingest.image_rows(_images(t), _annotations(t)).select("image_id", "split", "storage_path", "has_objects", "source_frame_id")


@query("annotation_rows", f"""
SELECT dataset_id || ':' || split || ':ann:' || ann_id AS annotation_id, dataset_id || ':' || split || ':' || image_id AS image_id, category_id, w * h AS area, 4::bigint AS bbox_len
FROM {_PLACED}""")
def annotation_rows(t: Tables):
    out = ingest.annotation_rows(_placed(t))
    return out.select("annotation_id", "image_id", "category_id", "area", F.size(bbox_from_json(F.col("bbox_xywh"))).cast("bigint").alias("bbox_len"))


@query("limit_per_split", """
SELECT image_id, split FROM (SELECT *, row_number() OVER (PARTITION BY split ORDER BY image_id) AS r FROM orc_split_images) WHERE r <= 5""")
def limit_per_split(t: Tables):
    return ingest.limit_per_split(_images(t), 5).select("image_id", "split")


@query("index_by_image", """
SELECT image_id, coalesce(string_agg(ann_id::varchar, ',' ORDER BY ann_id), '') AS ids FROM (
  SELECT i.image_id, ann_id FROM sub_images i FULL JOIN (SELECT ann_id, image_id FROM sub_faulty_annotations) a ON i.image_id = a.image_id WHERE i.image_id IS NOT NULL
  UNION ALL SELECT image_id, ann_id FROM sub_faulty_annotations WHERE image_id < 0) GROUP BY image_id""")
def index_by_image(t: Tables):
    out = ingest.index_by_image(t.view("sub_images"), t.view("sub_faulty_annotations"))
    return out.select("image_id", F.array_join("ann_ids", ",").alias("ids"))


@query("num_classes", """
SELECT dataset_id, coalesce(n, 3)::bigint AS num_classes FROM (SELECT DISTINCT dataset_id FROM sub_images) LEFT JOIN (
  SELECT dataset_id, count(DISTINCT category_id) AS n FROM sub_categories WHERE dataset_id <> 'ds_1' GROUP BY dataset_id) USING (dataset_id)""")
def num_classes(t: Tables):
    out = ingest.num_classes(t.view("sub_categories").filter("dataset_id <> 'ds_1'"), t.view("sub_images"))
    return out.withColumn("num_classes", F.col("num_classes").cast("bigint"))


# ---- validation ------------------------------------------------------------------------------------------------------

def _faulty(t: Tables):
    bad = t.view("sub_faulty_annotations")
    four = F.array("x", "y", "w", "h")
    return bad.select("ann_id", "image_id", "category_id", F.when(F.col("short"), F.slice(four, 1, 3)).otherwise(four).alias("bbox"),
                      (F.col("w") * F.col("h")).alias("area"), "iscrowd")


def _classes(t: Tables):
    """Categories the annotations may use, from the data itself."""
    return t.view("sub_categories").filter("dataset_id = 'ds_0'").select("category_id", "name")


_ISSUES = {
    "required_fields": "SELECT 'error' AS severity, 'images[' || image_id || ']' AS location, 'missing height' AS message FROM sub_faulty_images WHERE height IS NULL "
                       "UNION ALL SELECT 'error', 'annotations[' || ann_id || ']', 'missing category_id' FROM sub_faulty_annotations WHERE category_id IS NULL",
    "value_rules": "SELECT 'error' AS severity, 'images[' || image_id || ']' AS location, 'non-positive dimensions 0x' || height AS message FROM sub_faulty_images WHERE height IS NOT NULL AND width = 0 "
                   "UNION ALL SELECT 'error', 'images[' || image_id || ']', 'empty file_name' FROM sub_faulty_images WHERE height IS NOT NULL AND trim(file_name) = '' "
                   "UNION ALL SELECT 'error', 'annotations[' || ann_id || ']', 'bbox must be [x,y,w,h]' FROM sub_faulty_annotations WHERE category_id IS NOT NULL AND short "
                   "UNION ALL SELECT 'error', 'annotations[' || ann_id || ']', 'non-positive bbox size' FROM sub_faulty_annotations WHERE category_id IS NOT NULL AND NOT short AND w <= 0 "
                   "UNION ALL SELECT 'warning', 'annotations[' || ann_id || ']', 'area is non-positive' FROM sub_faulty_annotations WHERE category_id IS NOT NULL AND NOT short AND w * h <= 0 "
                   "UNION ALL SELECT 'warning', 'annotations[' || ann_id || ']', 'iscrowd missing, defaulting to 0' FROM sub_faulty_annotations WHERE category_id IS NOT NULL AND NOT short AND iscrowd IS NULL",
    "duplicate_ids": "SELECT 'error' AS severity, 'annotations[' || ann_id || ']' AS location, 'duplicate id' AS message FROM (SELECT ann_id, row_number() OVER (PARTITION BY ann_id) AS r FROM sub_faulty_annotations WHERE category_id IS NOT NULL) WHERE r > 1",
    "dangling_refs": "SELECT 'error' AS severity, 'annotations[' || ann_id || ']' AS location, 'image_id ' || image_id || ' not in images' AS message FROM sub_faulty_annotations WHERE category_id IS NOT NULL AND image_id NOT IN (SELECT image_id FROM sub_faulty_images) "
                     "UNION ALL SELECT 'error', 'annotations[' || ann_id || ']', 'category_id ' || category_id || ' not in categories' FROM sub_faulty_annotations WHERE category_id NOT IN (SELECT category_id FROM sub_categories WHERE dataset_id = 'ds_0')",
}


@query("required_fields", _ISSUES["required_fields"])
def required_fields(t: Tables):
    return quality.required_fields(t.view("sub_faulty_images"), "images", "image_id", quality.IMAGE_FIELDS).unionByName(
        quality.required_fields(_faulty(t), "annotations", "ann_id", quality.ANNOTATION_FIELDS))


@query("value_rules", _ISSUES["value_rules"])
def value_rules(t: Tables):
    return quality.value_rules(t.view("sub_faulty_images"), _faulty(t))


@query("duplicate_ids", _ISSUES["duplicate_ids"])
def duplicate_ids(t: Tables):
    return quality.duplicate_ids(_faulty(t).filter("category_id IS NOT NULL"), "annotations", "ann_id").select(*quality.ISSUE)


@query("dangling_refs", _ISSUES["dangling_refs"])
def dangling_refs(t: Tables):
    return quality.dangling_refs(_faulty(t), t.view("sub_faulty_images"), _classes(t))


@query("missing_files", """
SELECT 'error' AS severity, 'images[' || image_id || ']' AS location, 'file does not exist: ' || file_name AS message FROM sub_images WHERE image_id % 40 = 0""")
def missing_files(t: Tables):
    files = t.view("sub_images").filter("image_id % 40 <> 0").select("file_name")
    return quality.missing_files(t.view("sub_images"), files)


@query("validate_coco", " UNION ALL ".join(_ISSUES.values()))
def validate_coco(t: Tables):
    return quality.validate_coco(t.view("sub_faulty_images"), _faulty(t), _classes(t))


@query("severity_totals", "SELECT severity, count(*) AS n FROM (" + " UNION ALL ".join(_ISSUES.values()) + ") GROUP BY severity")
def severity_totals(t: Tables):
    return quality.severity_totals(validate_coco(t))


@query("class_contract", """
SELECT 'error' AS severity, 'categories' AS location, 'category ' || category_id || ' ' || name || ' is not canonical' AS message FROM sub_categories
WHERE concat(category_id, name) NOT IN ('0ships', '1helicopters', '2airplanes')
UNION ALL SELECT DISTINCT 'error', 'annotations', 'category id ' || category_id || ' is outside the canonical set' FROM sub_faulty_annotations WHERE category_id NOT IN (0, 1, 2)""")
def class_contract(t: Tables):
    return quality.class_contract(t.view("sub_categories"), t.view("sub_faulty_annotations"))


_LEAKY = "(SELECT image_id, file_name, split FROM orc_split_images UNION ALL SELECT image_id, file_name, 'test' FROM orc_split_images WHERE image_id % 50 = 0)"


def _leaky(t: Tables):
    base = _images(t).select("image_id", "file_name", "split")
    return base.unionByName(base.filter("image_id % 50 = 0").withColumn("split", F.lit("test")))


@query("cross_split_ids", f"""
SELECT 'warning' AS severity, 'images:' || split AS location, 'id ' || image_id || ' also in another split' AS message, count(*) AS n
FROM {_LEAKY} o WHERE EXISTS (SELECT 1 FROM {_LEAKY} e WHERE e.image_id = o.image_id AND list_position(['train', 'val', 'test'], e.split) < list_position(['train', 'val', 'test'], o.split))
GROUP BY split, image_id""")
def cross_split_ids(t: Tables):
    return quality.cross_split_ids(_leaky(t), "images", "image_id", "warning")


@query("split_leakage", f"""
SELECT frame_id, splits FROM (SELECT replace(file_name, '.png', '') AS frame_id, string_agg(DISTINCT split, ',' ORDER BY split) AS splits, count(DISTINCT split) AS n FROM {_LEAKY} GROUP BY 1) WHERE n > 1""")
def split_leakage(t: Tables):
    return quality.split_leakage(_leaky(t)).select("frame_id", F.array_join("splits", ",").alias("splits"))


@query("category_set_equal", f"""
SELECT split, (SELECT count(*) FROM (SELECT DISTINCT category_id FROM sub_categories WHERE dataset_id = 'ds_2') d WHERE category_id NOT IN (SELECT category_id FROM {_PLACED} p WHERE p.split = s.split AND category_id <> 0)) AS missing,
  0::bigint AS extra FROM (SELECT DISTINCT split FROM orc_split_images) s""")
def category_set_equal(t: Tables):
    used = _placed(t).filter("category_id <> 0").select("split", "category_id")
    return quality.category_set_equal(used, t.view("sub_categories").filter("dataset_id = 'ds_2'"))


@query("count_reconcile", f"""
SELECT 'error' AS severity, 'splits.' || split AS location, 'num_images: declared ' || (n + 1) || ', found ' || n AS message FROM (SELECT split, count(*) AS n FROM orc_split_images GROUP BY split) WHERE split = 'val'
UNION ALL SELECT 'warning', 'dataset_info', 'missing key ' || k FROM (VALUES ('num_annotations'), ('num_classes')) v(k)""")
def count_reconcile(t: Tables):
    actual = ingest.split_counts(_images(t), _placed(t))
    declared = actual.withColumn("num_images", F.col("num_images") + F.when(F.col("split") == "val", 1).otherwise(0))
    declared = declared.withColumn("num_annotations", F.when(F.col("split") != "all", F.col("num_annotations"))).withColumn("num_classes", F.lit(None).cast("int"))
    return quality.count_reconcile(declared, actual)


@query("manifest_coverage", "SELECT split, count(*) AS missing_frames FROM orc_split_images WHERE image_id % 30 = 0 GROUP BY split")
def manifest_coverage(t: Tables):
    return quality.manifest_coverage(_images(t), _images(t).filter("image_id % 30 <> 0"))


@query("validate_raw_dataset", f"""
SELECT severity, location, count(*) AS n FROM (
  SELECT 'error' AS severity, 'split_leakage' AS location FROM (SELECT file_name FROM {_LEAKY} GROUP BY 1 HAVING count(DISTINCT split) > 1)
  UNION ALL SELECT 'warning', 'images:' || split FROM (SELECT split, image_id FROM {_LEAKY} o WHERE EXISTS (SELECT 1 FROM {_LEAKY} e WHERE e.image_id = o.image_id AND list_position(['train', 'val', 'test'], e.split) < list_position(['train', 'val', 'test'], o.split)) GROUP BY ALL)
  UNION ALL SELECT 'warning', 'capture_manifest' FROM (SELECT DISTINCT split FROM {_LEAKY} WHERE image_id % 30 = 0)
  UNION ALL SELECT 'warning', 'annotations[' || ann_id || ']' FROM sub_annotations WHERE n % 5 = 0
  UNION ALL SELECT 'error', 'images[' || image_id || ']' FROM (SELECT image_id, row_number() OVER (PARTITION BY image_id) AS r FROM {_LEAKY}) WHERE r > 1)
GROUP BY severity, location""")
def validate_raw_dataset(t: Tables):
    images = t.view("sub_images").select("image_id", "width", "height").join(_leaky(t), "image_id")
    a = t.view("sub_annotations").join(_images(t).select("image_id", "split"), "image_id")
    anns = a.select("ann_id", "image_id", "category_id", F.array("x", "y", "w", "h").alias("bbox"), (F.col("w") * F.col("h")).alias("area"),
                    F.when(F.col("n") % 5 != 0, 0).alias("iscrowd"), "split")
    counts = ingest.split_counts(images, anns)
    manifest = images.filter("image_id % 30 <> 0").select("split", F.regexp_replace("file_name", ".png", "").alias("frame_id"))
    issues = quality.validate_raw_dataset(images, anns, _classes(t), counts, manifest, counts)
    return issues.groupBy("severity", "location").agg(F.count(F.lit(1)).alias("n"))


@query("yolo_line_valid", """
SELECT ann_id, k1 % 6 IN (0, 5) AND w < 1280 AND category_id < 3 AS valid FROM sub_annotations""")
def yolo_line_valid(t: Tables):
    line = F.when(F.col("k1") % 6 == 0, F.format_string("%d 0.5 0.25 %.6f 0.1", "category_id", F.col("w") / 2560))
    line = (line.when(F.col("k1") % 6 == 1, F.lit("0 0.5 0.5 0.6 0.1")).when(F.col("k1") % 6 == 2, F.lit("7 0.5 0.5 0.1 0.1"))
            .when(F.col("k1") % 6 == 3, F.lit("0 0.5 x 0.1 0.1")).when(F.col("k1") % 6 == 4, F.lit("0 0.5 0.5 0.1"))
            .otherwise(F.lit("2  1.0 0.0 0.4999 0.2 ")))
    return t.view("sub_annotations").select("ann_id", quality.yolo_line_valid(line).alias("valid"))


@query("diff_tables", """
SELECT image_id, '' AS path, 'only_left' AS kind FROM sub_frames WHERE image_id % 70 = 0
UNION ALL SELECT -image_id - 1, '', 'only_right' FROM sub_frames WHERE image_id % 70 = 0
UNION ALL SELECT image_id, 'cam_x', 'changed' FROM sub_frames WHERE image_id % 70 <> 0 AND image_id % 11 = 0
UNION ALL SELECT image_id, 'mission_id', 'changed' FROM sub_frames WHERE image_id % 70 <> 0 AND image_id % 13 = 0""")
def diff_tables(t: Tables):
    left = t.view("sub_frames").select("image_id", "mission_id", "usable", "cam_x", "height_asl_m")
    hit = lambda n: F.col("image_id") % n == 0
    right = left.select(F.when(hit(70), -F.col("image_id") - 1).otherwise(F.col("image_id")).alias("image_id"),
                        F.when(hit(13), F.lit("m_x")).otherwise(F.col("mission_id")).alias("mission_id"), "usable",
                        F.when(hit(11), F.col("cam_x") + 0.5).otherwise(F.col("cam_x")).alias("cam_x"), (F.col("height_asl_m") + 1e-8).alias("height_asl_m"))
    return quality.diff_tables(left, right, ["image_id"], ["mission_id", "usable", "cam_x", "height_asl_m"])


@query("diff_label_lines", """
SELECT ann_id AS file, 0 AS line_no, CASE k1 % 6 WHEN 0 THEN 'format_only' WHEN 1 THEN 'class_id' WHEN 2 THEN 'value' WHEN 3 THEN 'token_count' WHEN 4 THEN 'only_left' END AS kind
FROM sub_annotations WHERE k1 % 6 < 5""")
def diff_label_lines(t: Tables):
    base = t.view("sub_annotations").select(F.col("ann_id").alias("file"), F.lit(0).alias("line_no"), "k1")
    k = F.col("k1") % 6
    other = (F.when(k == 0, "1 0.50 0.25 0.1 0.1").when(k == 1, "2 0.5 0.25 0.1 0.1").when(k == 2, "1 0.5 0.26 0.1 0.1")
             .when(k == 3, "1 0.5 0.25 0.1").otherwise("1 0.5 0.25 0.1 0.1"))
    left = base.withColumn("line", F.lit("1 0.5 0.25 0.1 0.1")).drop("k1")
    right = base.withColumn("line", other).filter(k != 4).drop("k1")
    return quality.diff_label_lines(left, right)
