"""Queries from tile predictions to evaluated detections, sources and sinks."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from detlake.operators import evalmap, metrics
from detlake.operators.splits import SPLITS, with_split
from detlake.plans.catalog import query
from detlake.plans.substrate import Tables
from detlake.session import work_folder
from detlake.sources import readers, sinks, versions


def _truth(t: Tables):
    cats = t.view("sub_categories").filter("dataset_id = 'ds_0'").select("category_id", "name")
    return evalmap.build_gt(t.view("sub_annotations"), cats)


@query("build_gt", """
SELECT gt_id, image_id, class_id, class_name, x1, y1, x2, y2, false AS difficult FROM orc_gt JOIN orc_classes USING (class_id)""")
def build_gt(t: Tables):
    return _truth(t)


_EVAL_TILES = """(SELECT image_id, width, height, replace(scale_name, 'original', 'original_crops') AS scale_name, scale_w, scale_h, ox::int AS ox, oy::int AS oy FROM orc_eval_tiles
UNION ALL SELECT image_id, width, height, 'final_640', 640, 640, 0, 0 FROM sub_images UNION ALL SELECT image_id, width, height, 'full_source', width, height, 0, 0 FROM sub_images)"""


@query("tile_plan", f"""
SELECT image_id, scale_name, scale_w, scale_h, ox, oy, CASE WHEN scale_name = 'full_source' THEN width ELSE least(640, scale_w - ox) END AS cw, scale_name = 'full_source' AS letterbox FROM {_EVAL_TILES}""")
def tile_plan(t: Tables):
    return evalmap.tile_plan(t.view("sub_images")).select("image_id", "scale_name", "scale_w", "scale_h", "ox", "oy", "cw", "letterbox")


def _stored(t: Tables):
    """Stored predictions: detections of an image, put at the tile (0,0) of a scale or at no scale."""
    d = t.view("sub_detections")
    name = F.when(F.col("det_id") % 3 == 0, F.lit("original_crops")).when(F.col("det_id") % 3 == 1, F.lit("full_source"))
    dets = d.select("image_id", name.alias("scale_name"), F.lit(0).alias("ox"), F.lit(0).alias("oy"), "class_id", "confidence", "det_id",
                    *[F.col(c).alias(f"b_{c}") for c in ("x1", "y1", "x2", "y2")])
    keys = t.view("sub_images").filter("image_id % 2 = 0").select("image_id", F.lit("original_crops").alias("scale_name"), F.lit(0).alias("ox"), F.lit(0).alias("oy"))
    return dets, keys.unionByName(dets.select("image_id", "scale_name", "ox", "oy").filter("scale_name IS NOT NULL").distinct())


_STORED = "(SELECT *, CASE det_id % 3 WHEN 0 THEN 'original_crops' WHEN 1 THEN 'full_source' END AS sn FROM sub_detections)"
_FOUND = f"""(SELECT p.*, det_id, class_id, confidence, x1, y1, x2, y2 FROM {_EVAL_TILES} p JOIN {_STORED} d ON p.image_id = d.image_id AND p.ox = 0 AND p.oy = 0 AND (d.sn = p.scale_name OR (d.sn IS NULL
  AND NOT (p.scale_name = 'original_crops' AND p.image_id % 2 = 0) AND NOT EXISTS (SELECT 1 FROM {_STORED} e WHERE e.image_id = p.image_id AND e.sn = p.scale_name))))"""


@query("lookup_predictions", f"SELECT image_id, scale_name, det_id FROM {_FOUND}")
def lookup_predictions(t: Tables):
    dets, keys = _stored(t)
    return evalmap.lookup_predictions(evalmap.tile_plan(t.view("sub_images")), keys, dets).select("image_id", "scale_name", "det_id")


@query("detections_to_source", f"""
SELECT image_id, scale_name, det_id, round(x1, 6) AS x1, round(y1, 6) AS y1, round(x2, 6) AS x2, round(y2, 6) AS y2 FROM (
 SELECT image_id, scale_name, det_id, greatest(0::double, least(width, CASE WHEN f THEN (x1 - px) / s ELSE x1 * (width::double / scale_w) END)) AS x1, greatest(0::double, least(height, CASE WHEN f THEN (y1 - py) / s ELSE y1 * (height::double / scale_h) END)) AS y1,
  greatest(0::double, least(width, CASE WHEN f THEN (x2 - px) / s ELSE x2 * (width::double / scale_w) END)) AS x2, greatest(0::double, least(height, CASE WHEN f THEN (y2 - py) / s ELSE y2 * (height::double / scale_h) END)) AS y2
 FROM (SELECT *, scale_name = 'full_source' AS f, (640 - greatest(1, round_even(width * s, 0))::int) // 2 AS px, (640 - greatest(1, round_even(height * s, 0))::int) // 2 AS py FROM (
   SELECT *, least(640::double / width, 640::double / height) AS s FROM {_FOUND}))) WHERE x2 > x1 AND y2 > y1""")
def detections_to_source(t: Tables):
    dets, keys = _stored(t)
    out = evalmap.detections_to_source(evalmap.lookup_predictions(evalmap.tile_plan(t.view("sub_images")), keys, dets))
    return out.select("image_id", "scale_name", "det_id", *[F.round(c, 6).alias(c) for c in ("x1", "y1", "x2", "y2")])


@query("score_tiles", f"""
SELECT image_id, scale_name, ox, oy, (image_id % 3)::int AS class_id, 0.5::double AS confidence FROM {_EVAL_TILES} WHERE (image_id + ox + oy) % 7 = 0""")
def score_tiles(t: Tables):
    def predict(batches):
        for b in batches:
            hit = b[(b["image_id"] + b["ox"] + b["oy"]) % 7 == 0]
            yield hit[["image_id", "scale_name", "ox", "oy"]].assign(class_id=(hit["image_id"] % 3).astype("int32"), confidence=0.5)
    return evalmap.score_tiles(evalmap.tile_plan(t.view("sub_images")), predict, "image_id bigint, scale_name string, ox int, oy int, class_id int, confidence double")


@query("evaluate", """
SELECT class_id, count(*) AS num_pred FROM (SELECT c.image_id, c.class_id, c.component FROM orc_components c GROUP BY ALL
  HAVING count(*) = 1 OR (greatest((max(x2) - min(x1)) / (max(y2) - min(y1)), (max(y2) - min(y1)) / (max(x2) - min(x1))) <= 30 AND (max(x2) - min(x1)) * (max(y2) - min(y1)) / sum((x2 - x1) * (y2 - y1)) <= 50)
  UNION ALL SELECT c.image_id, c.class_id, c.det_id FROM orc_components c JOIN (SELECT image_id, class_id, component FROM orc_components GROUP BY ALL
    HAVING count(*) > 1 AND NOT (greatest((max(x2) - min(x1)) / (max(y2) - min(y1)), (max(y2) - min(y1)) / (max(x2) - min(x1))) <= 30 AND (max(x2) - min(x1)) * (max(y2) - min(y1)) / sum((x2 - x1) * (y2 - y1)) <= 50)) USING (image_id, class_id, component)) GROUP BY class_id""")
def evaluate(t: Tables):
    return evalmap.evaluate(t.view("sub_detections"), evalmap.build_gt(t.view("sub_annotations")), results=("per_class",))["per_class"].select("class_id", "num_pred")


@query("evaluation_report")
def evaluation_report(t: Tables):
    results = evalmap.evaluate(t.view("sub_detections"), evalmap.build_gt(t.view("sub_annotations")), results=("fusion_counts", "overall"))
    return evalmap.run_summary(results, t.view("sub_images").count())


@query("timing_summary", """
SELECT count(DISTINCT run_id) AS num_images, round(1000 * sum(iter) FILTER (WHERE stage = 'train') / count(DISTINCT run_id)::double, 6) AS avg_inference_ms,
  round(count(DISTINCT run_id) / (sum(iter) FILTER (WHERE stage = 'evaluate_model'))::double, 9) AS fps FROM sub_run_events""")
def timing_summary(t: Tables):
    stage = F.when(F.col("stage") == "train", "inference").when(F.col("stage") == "evaluate_model", "end_to_end").otherwise("preprocessing")
    rows = t.view("sub_run_events").select(F.col("run_id").alias("image_id"), stage.alias("stage"), F.col("iter").cast("double").alias("seconds"))
    out = metrics.timing_summary(rows)
    return out.select("num_images", F.round("avg_inference_ms", 6).alias("avg_inference_ms"), F.round("fps", 9).alias("fps"))


@query("coco_results", "SELECT image_id, class_id AS category_id, x1 AS x, x2 - x1 AS w, y2 - y1 AS h, confidence AS score FROM sub_detections")
def coco_results(t: Tables):
    out = sinks.coco_results(t.view("sub_detections"))
    return out.select("image_id", "category_id", F.get("bbox", 0).alias("x"), F.get("bbox", 2).alias("w"), F.get("bbox", 3).alias("h"), "score")


@query("manifest_round_trip", "SELECT image_id, split, file_name FROM orc_split_images")
def manifest_round_trip(t: Tables):
    root = work_folder(t.spark)
    rows = with_split(t.view("sub_images")).select("image_id", "split", "file_name")
    sinks.append_manifest(rows, f"{root}/manifest")
    return readers.read_manifest(t.spark, f"{root}/manifest", "image_id bigint, split string, file_name string")


@query("tolerant_events", "SELECT (seq % 1000)::bigint AS total, run_id::varchar AS run_id, status FROM sub_run_events WHERE seq % 20 <> 0")
def tolerant_events(t: Tables):
    root = work_folder(t.spark)
    e = t.view("sub_run_events")
    line = F.to_json(F.struct(F.col("run_id").cast("string").alias("run_id"), "status", (F.col("seq") % 1000).alias("total")))
    torn = F.when(F.col("seq") % 20 == 0, F.substring(line, 1, 15)).otherwise(line)
    e.select(torn.alias("value")).write.text(f"{root}/log")
    return readers.read_events_tolerant(t.spark, f"{root}/log")[0].select("total", "run_id", "status")


# image ids that share one JSON document
BLOCK = 20_000

_ENTRIES = """WITH a AS (SELECT a.*, i.split FROM sub_annotations a JOIN orc_split_images i ON a.image_id = i.image_id),
s AS (SELECT unnest(['train', 'val', 'test']) AS split)
SELECT 'annotation' AS kind, ann_id AS id, image_id, category_id, x, y, w, h, w * h + 0.5::double AS area, (ann_id % 2)::int AS iscrowd, CASE WHEN ann_id % 3 = 0 THEN 'strong' END AS extra, split FROM a
UNION ALL SELECT 'image', image_id, NULL, NULL, NULL, NULL, width::double, height::double, NULL, NULL, file_name, split FROM orc_split_images
UNION ALL SELECT 'category', category_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, name, split FROM sub_categories, s WHERE dataset_id = 'ds_0'"""


@query("coco_round_trip", _ENTRIES)
def coco_round_trip(t: Tables):
    """Documents written and read back, all three tables: given areas and flags and unknown fields stay. A document holds the
    images of a block of ids with their boxes, so documents keep their size as the table grows."""
    root = work_folder(t.spark)
    images = with_split(t.view("sub_images")).select("split", "image_id", "file_name", "width", "height").withColumn(
        "split", F.concat_ws("-", "split", F.floor(F.col("image_id") / BLOCK).cast("string")))
    anns = t.view("sub_annotations").join(images.select("image_id", "split"), "image_id").select(
        "split", "ann_id", "image_id", "category_id", "x", "y", "w", "h", (F.col("w") * F.col("h") + 0.5).alias("area"), (F.col("ann_id") % 2).cast("int").alias("iscrowd"),
        F.when(F.col("ann_id") % 3 == 0, F.to_json(F.struct(F.lit("strong").alias("quality_tier")))).alias("props"))
    cats = images.select("split").distinct().join(t.view("sub_categories").filter("dataset_id = 'ds_0'").select("category_id", "name", F.lit(0).alias("one")).withColumn("one", F.lit(True)), F.col("one"))
    sinks.write_coco_documents(sinks.coco_documents(images, anns, cats.drop("one")), f"{root}/coco")
    back = readers.read_coco_entries(t.spark, f"{root}/coco", "part-*").filter("kind <> 'categories'")
    box, none, split = F.col("kind") == "annotations", F.lit(None).cast("double"), F.substring_index("split", "-", 1).alias("split")
    side = lambda n, other: F.when(box, F.get("annotations.bbox", n)).otherwise(other).alias("xywh"[n])
    rows = back.select(
        F.when(box, "annotation").otherwise("image").alias("kind"), F.coalesce("annotations.id", "images.id").alias("id"), F.col("annotations.image_id").alias("image_id"),
        F.col("annotations.category_id").alias("category_id"), side(0, none), side(1, none), side(2, F.col("images.width").cast("double")), side(3, F.col("images.height").cast("double")),
        F.col("annotations.area").alias("area"), F.col("annotations.iscrowd").alias("iscrowd"),
        F.when(box, F.get_json_object("props", "$.quality_tier")).otherwise(F.col("images.file_name")).alias("extra"), split)
    # the documents of a split repeat its categories
    classes = readers.read_coco_categories(t.spark, f"{root}/coco", "part-*").select(
        F.lit("category").alias("kind"), F.col("category_id").cast("bigint").alias("id"), F.lit(None).cast("bigint").alias("image_id"), F.lit(None).cast("int").alias("category_id"),
        *[none.alias(c) for c in ("x", "y", "w", "h", "area")], F.lit(None).cast("int").alias("iscrowd"), F.col("name").alias("extra"), split).distinct()
    return rows.unionByName(classes)


@query("count_records", "SELECT count(*) AS n FROM sub_images")
def count_records(t: Tables):
    root = work_folder(t.spark)
    t.view("sub_images").select("image_id").write.json(f"{root}/lines")
    return t.spark.range(1).select(F.lit(readers.count_records(t.spark, f"{root}/lines")).cast("bigint").alias("n"))


@query("listed_files", "SELECT split || '.csv' AS kind, count(*) AS rows FROM orc_split_images GROUP BY split")
def listed_files(t: Tables):
    """A listing with contents of files written here: rows by folder."""
    root = work_folder(t.spark)
    with_split(t.view("sub_images")).select("split", "file_name").write.partitionBy("split").csv(f"{root}/files")
    files = readers.list_files(t.spark, f"{root}/files", ("*.csv",), content=True)
    n = F.size(F.split(F.col("content").cast("string"), "\n")) - 1
    return files.groupBy(F.concat(F.regexp_extract("relpath", "split=([^/]+)/", 1), F.lit(".csv")).alias("kind")).agg(F.sum(n).alias("rows"))


@query("label_lines", """
SELECT ann_id AS box_id, category_id AS class_id, x / 4096 AS cx, y / 4096 AS cy, w / 4096 AS w, row_number() OVER (PARTITION BY image_id ORDER BY ann_id) > 1 AS later FROM sub_annotations""")
def label_lines(t: Tables):
    """Label files of many lines written as text and read back: every box, its height holding its id. Lines of an image stand
    one after the other, and `later` tells of each line whether another one of its image stands before it."""
    root = work_folder(t.spark)
    boxes = t.view("sub_annotations")
    line = F.concat_ws(" ", "category_id", *[(F.col(c) / 4096).cast("string") for c in ("x", "y", "w")], F.col("ann_id").cast("string"))
    boxes.repartition("image_id").sortWithinPartitions("image_id", "ann_id").select(line.alias("value")).write.text(f"{root}/labels")
    read = readers.read_yolo_labels(t.spark, f"{root}/labels").select("file", "line_no", F.col("h").cast("bigint").alias("box_id"), "class_id", "cx", "cy", "w")
    place = read.join(boxes.select(F.col("ann_id").alias("box_id"), "image_id"), "box_id")
    first = place.groupBy("file", "image_id").agg(F.min("line_no").alias("_first"))
    return place.join(first, ["file", "image_id"]).select("box_id", "class_id", "cx", "cy", "w", (F.col("line_no") > F.col("_first")).alias("later"))


@query("stored_tile_predictions", "SELECT image_id, class_id, confidence, x1 AS b_x1, y2 AS b_y2, 320 AS ox FROM sub_detections")
def stored_tile_predictions(t: Tables):
    """Tile predictions written as JSON documents, one for each block of image ids, and read back."""
    root = work_folder(t.spark)
    det = F.struct("class_id", "confidence", F.array("x1", "y1", "x2", "y2").alias("bbox_crop"))
    tiles = t.view("sub_detections").groupBy("image_id").agg(F.collect_list(det).alias("detections"))
    tile = F.struct(F.lit("s").alias("scale_name"), F.array(F.lit(320), F.lit(0)).alias("crop_offset"), "detections")
    docs = tiles.groupBy(F.floor(F.col("image_id") / BLOCK).alias("part")).agg(F.to_json(F.struct(F.collect_list(F.struct("image_id", F.array(tile).alias("tiles"))).alias("images"))).alias("value"))
    docs.repartition("part").write.partitionBy("part").text(f"{root}/predictions")
    return readers.read_tile_predictions(t.spark, f"{root}/predictions", "part-*")[1].select("image_id", "class_id", "confidence", "b_x1", "b_y2", "ox")


@query("metric_tables", "SELECT category_id::varchar AS class_id, count(*)::varchar AS n FROM sub_annotations GROUP BY category_id")
def metric_tables(t: Tables):
    root = work_folder(t.spark)
    per = t.view("sub_annotations").groupBy(F.col("category_id").alias("class_id")).agg(F.count("*").alias("n"))
    sinks.write_metric_tables(per, per, per, f"{root}/metrics")
    return t.spark.read.option("header", True).csv(f"{root}/metrics/per_class_metrics")


@query("materialized_once", "SELECT dataset_id, count(*) AS images FROM sub_images GROUP BY dataset_id")
def materialized_once(t: Tables):
    """Built once, then read: the second build would give other rows."""
    root = work_folder(t.spark)
    counts = t.view("sub_images").groupBy("dataset_id").agg(F.count("*").alias("images"))
    sinks.materialize_once(t.spark, f"{root}/cache", lambda: counts)
    return sinks.materialize_once(t.spark, f"{root}/cache", lambda: counts.limit(0))[0]


def _cache_rows(t: Tables):
    """Image rows with their splits, and hashes of table, splits and settings."""
    rows = with_split(t.view("sub_images")).select("image_id", "dataset_id", "split")
    mark = rows.agg(F.sum(F.xxhash64("image_id", "dataset_id", "split").cast("decimal(38,0)")).cast("string").alias("m")).first()["m"]
    digest = hashlib.sha256(str(mark).encode()).hexdigest()
    return rows, {"dataset_hash": digest, "split_hash": digest, "tile_config_hash": digest}


_CACHED = "SELECT image_id, dataset_id, split, '{}' AS status, (SELECT count(*) FROM orc_split_images WHERE split = 'train') AS num_train FROM orc_split_images"


def _cached(built):
    rows, info = built
    return rows.select("image_id", "dataset_id", "split", F.lit(info["status"]).alias("status"), F.lit(info["num_train_tiles"]).cast("bigint").alias("num_train"))


@query("cache_reused", _CACHED.format("reused"))
def cache_reused(t: Tables):
    """A complete cache with the same hashes is read; the second build would give no rows."""
    root, (rows, hashes) = work_folder(t.spark), _cache_rows(t)
    versions.build_or_reuse(t.spark, root, hashes, lambda: rows)
    return _cached(versions.build_or_reuse(t.spark, root, hashes, lambda: rows.limit(0)))


@query("cache_rebuilt", _CACHED.format("rebuilt"))
def cache_rebuilt(t: Tables):
    """A cache of the same id whose full split hash differs is built anew."""
    root, (rows, hashes) = work_folder(t.spark), _cache_rows(t)
    versions.build_or_reuse(t.spark, root, {**hashes, "split_hash": hashes["split_hash"][:12] + "0" * 52}, lambda: rows.limit(0))
    return _cached(versions.build_or_reuse(t.spark, root, hashes, lambda: rows))


@query("cache_forced", _CACHED.format("rebuilt"))
def cache_forced(t: Tables):
    """A valid cache is replaced on demand, by rows read from the one before."""
    root, (rows, hashes) = work_folder(t.spark), _cache_rows(t)
    first, _ = versions.build_or_reuse(t.spark, root, hashes, lambda: rows)
    return _cached(versions.build_or_reuse(t.spark, root, hashes, lambda: first, force=True))


@query("registry_tables", "SELECT image_id::varchar AS image_id, dataset_id, split FROM orc_split_images")
def registry_tables(t: Tables):
    """Registry tables created, replaced by a version with rows, and read back."""
    root = work_folder(t.spark)
    sinks.init_registry(t.spark, f"{root}/registry")
    empty = readers.read_registry(t.spark, f"{root}/registry", "images")
    rows = with_split(t.view("sub_images")).select(F.col("image_id").cast("string").alias("image_id"), "dataset_id", "split", "file_name", "width", "height")
    sinks.publish_registry(empty.unionByName(rows, allowMissingColumns=True), f"{root}/registry", "images")
    return readers.read_registry(t.spark, f"{root}/registry", "images").select("image_id", "dataset_id", "split")
