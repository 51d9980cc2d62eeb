"""Readers: COCO documents, manifests, event logs, frames, file listings, label files, tile predictions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from detlake.functions.text import file_name, file_stem
from detlake.schemas import COCO, EVENT, FRAME, REGISTRY, TILE_PREDICTIONS

CORRUPT = "_corrupt_record"
# what the id of an entry is called
COCO_IDS = {"images": {"id": "image_id"}, "annotations": {"id": "ann_id"}, "categories": {"id": "category_id"}}


def _documents(spark: SparkSession, path: str, schema: str, pattern: str = "*.json") -> DataFrame:
    """One row per JSON document with its path; unreadable ones carry their text in `_corrupt_record`."""
    full = f"{schema}, {CORRUPT} string"
    text = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(path, wholetext=True)
            .select(F.col("_metadata.file_path").alias("path"), "value"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return text.select("path", F.from_json("value", full, options).alias("_r")).select("path", "_r.*")


def read_coco(spark: SparkSession, path: str, pattern: str = "*.json") -> dict[str, DataFrame]:
    """`images`, `annotations`, `categories` of all documents under `path`, with the document they came from, its split (by
    file name or folder) and, as `props`, a JSON object of the entry's other fields (null without any).

    A document that is no object or lacks one of the three arrays is an error. A document is one JSON value, so it is
    parsed by one task; a large dataset belongs in the table form `write_coco` makes.
    """
    docs = _documents(spark, path, _coco_texts(COCO), pattern)
    bad = docs.filter(_coco_hole()).select("path").limit(1).collect()
    if bad:
        raise ValueError(f"not a COCO document: {bad[0][0]}")
    return {name: _coco_part(docs.select("path", _coco_split(), F.explode(name).alias("_e")), name) for name in COCO}


def _coco_texts(names: Iterable[str]) -> str:
    return ", ".join(f"{name} array<string>" for name in names)


def _coco_hole() -> Column:
    return F.col("images").isNull() | F.col("annotations").isNull() | F.col("categories").isNull()


def _coco_split() -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(file_name(F.col("path")), r"instances_(\w+)\.json$", 1), F.lit("")),
                      F.regexp_extract("path", r"/split=([^/]+)/", 1)).alias("split")


def _coco_fields(name: str) -> tuple[Column, Column]:
    """Known fields of an entry `_e`, and the others as a JSON object; only entries that have others are read for them."""
    known = [field.split(" ")[0] for field in COCO[name].split(", ")]
    other = F.map_filter(F.from_json("_e", "map<string,variant>"), lambda k, _: ~k.isin(known))
    odd = F.size(F.array_except(F.json_object_keys("_e"), F.array(*map(F.lit, known)))) > 0
    return F.from_json("_e", COCO[name]), F.when(odd, F.to_json(other))


def _coco_part(entries: DataFrame, name: str) -> DataFrame:
    fields, props = _coco_fields(name)
    rows = entries.select("path", "split", fields.alias("_f"), props.alias("props"))
    return rows.select("path", "split", "_f.*", "props").withColumnsRenamed(COCO_IDS[name])


def read_coco_entries(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """The entries of `read_coco` as one table, every document parsed once for all of them: `path`, `split`, `kind` (images, annotations
    or categories), the fields of that kind as the struct of its name (else null), and `props`. What is no COCO document fails the job
    that reads it."""
    docs = _documents(spark, path, _coco_texts(COCO), pattern)
    whole = F.when(~_coco_hole(), F.array(*[F.struct(F.lit(name).alias("kind"), F.col(name).alias("_l")) for name in COCO])).otherwise(
        F.raise_error(F.concat(F.lit("not a COCO document: "), "path")))
    rows = docs.select("path", _coco_split(), F.inline(whole)).select("path", "split", "kind", F.explode("_l").alias("_e"))
    parts = {name: _coco_fields(name) for name in COCO}
    props = F.coalesce(*[F.when(F.col("kind") == name, p) for name, (_, p) in parts.items()])
    return rows.select("path", "split", "kind", *[F.when(F.col("kind") == name, f).alias(name) for name, (f, _) in parts.items()], props.alias("props"))


def read_coco_categories(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """`categories` of `read_coco` alone; the other entries are passed over unparsed."""
    docs = _documents(spark, path, _coco_texts(["categories"]), pattern)
    return _coco_part(docs.select("path", _coco_split(), F.explode("categories").alias("_e")), "categories")


def read_manifest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Strict JSON lines: blank lines are skipped, a malformed one fails the job."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    return lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("_r")).select("_r.*")


def read_events_tolerant(spark: SparkSession, path: str, schema: str = EVENT) -> tuple[DataFrame, DataFrame]:
    """(readable events, quarantined lines). Torn or foreign lines do not stop the reader."""
    lines = spark.read.text(path).filter(F.trim("value") != "").select("value", F.col("_metadata.file_name").alias("file"))
    full = f"{schema}, {CORRUPT} string"
    parsed = lines.withColumn("_r", F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    torn = F.col("_r").isNull() | F.col(f"_r.{CORRUPT}").isNotNull()
    return parsed.filter(~torn).select("file", "_r.*").drop(CORRUPT), parsed.filter(torn).select("file", "value")


def tail(events: DataFrame, order: str, n: int) -> DataFrame:
    """Last `n` events in order; all of them for n = 0."""
    return events.orderBy(order) if n <= 0 else events.orderBy(F.col(order).desc()).limit(n).orderBy(order)


def count_records(spark: SparkSession, path: str) -> int:
    """Non-blank lines; 0 when nothing is there."""
    try:
        return spark.read.text(path).filter(F.trim("value") != "").count()
    except Exception as exc:
        if "PATH_NOT_FOUND" in str(exc):
            return 0
        raise


def read_frames(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(frames, quarantined documents) of a folder of per-frame JSON."""
    docs = _documents(spark, path, FRAME)
    bad = F.col(CORRUPT).isNotNull()
    return docs.filter(~bad).drop(CORRUPT), docs.filter(bad).select("path", CORRUPT)


def frame_tables(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(frames, objects) as flat tables keyed by frame_id."""
    fid = F.coalesce("frame_id", file_stem(F.col("path")))
    frames = docs.select(
        fid.alias("frame_id"), "usable", F.col("image.file_name").alias("file_name"), F.col("image.width").alias("width"),
        F.col("image.height").alias("height"), "scene.*", F.col("timestamp_utc").alias("captured_at"),
        F.col("sync.strict_sync_valid").alias("sync_valid"), F.col("camera.height_asl_m").alias("height_asl_m"),
        F.col("camera.euler_deg.pitch").alias("pitch_deg"), F.col("camera.world_position_m.x").alias("cam_x"),
        F.col("camera.world_position_m.z").alias("cam_z"))
    o = docs.select(fid.alias("frame_id"), F.posexplode("objects").alias("object_pos", "o"))
    bb = F.col("o.projection.bbox_xyxy_px")
    objects = o.select("frame_id", "object_pos", F.col("o.id").alias("object_id"), F.col("o.class").alias("class"),
                       F.col("o.type_name").alias("type_name"), F.col("o.quality_tier").alias("quality_tier"),
                       F.col("o.dimensions_source").alias("dimensions_source"), F.col("o.validation.valid").alias("valid"),
                       F.col("o.distance_to_camera_m").alias("distance_m"),
                       *[F.get(bb, i).alias(c) for i, c in enumerate(("x1", "y1", "x2", "y2"))])
    return frames, objects


def list_files(spark: SparkSession, root: str, patterns: tuple[str, ...] = ("*",), content: bool = False) -> DataFrame:
    """Recursive listing: `path, relpath, length, modified_at` (and `content` only when asked for)."""
    out = None
    for p in patterns:
        one = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", p).load(root)
        out = one if out is None else out.unionByName(one)
    base = root.rstrip("/").removeprefix("file:") + "/"
    rel = F.element_at(F.split("path", base.replace("\\", "\\\\"), 2), -1)
    cols = ["path", rel.alias("relpath"), "length", F.col("modificationTime").alias("modified_at")]
    listed = out.select(*cols, *(["content"] if content else []))
    return listed if len(patterns) == 1 else listed.dropDuplicates(["path"])


def read_yolo_labels(spark: SparkSession, path: str) -> DataFrame:
    """`file, line_no, class_id, cx, cy, w, h, line`; numbers are null where a line is malformed."""
    text = spark.read.option("pathGlobFilter", "*.txt").text(path, wholetext=True)
    lines = text.select(F.col("_metadata.file_name").alias("file"), F.posexplode(F.split("value", "\r?\n")).alias("line_no", "line"))
    parts = F.split(F.trim("line"), r"\s+")
    return lines.filter(F.trim("line") != "").select(
        "file", "line_no", F.get(parts, 0).try_cast("int").alias("class_id"),
        *[F.get(parts, i).try_cast("double").alias(n) for i, n in enumerate(("cx", "cy", "w", "h"), 1)], "line")


def read_tile_predictions(spark: SparkSession, path: str, pattern: str = "*.json") -> tuple[DataFrame, DataFrame]:
    """(entry keys, detections) of stored tile predictions; a document without `images` is an error."""
    docs = _documents(spark, path, TILE_PREDICTIONS, pattern)
    bad = docs.filter(F.col("images").isNull()).select("path").limit(1).collect()
    if bad:
        raise ValueError(f"predictions must have an 'images' field: {bad[0][0]}")
    tiles = docs.select(F.inline("images")).select("image_id", F.inline("tiles"))
    at = [F.coalesce(F.get("crop_offset", i), F.lit(0)).alias(n) for i, n in enumerate(("ox", "oy"))]
    keyed = tiles.select("image_id", "scale_name", *at, "detections")
    boxes = keyed.select("image_id", "scale_name", "ox", "oy", F.inline("detections"))
    corners = [F.get("bbox_crop", i).alias(f"b_{c}") for i, c in enumerate(("x1", "y1", "x2", "y2"))]
    return keyed.drop("detections"), boxes.select("image_id", "scale_name", "ox", "oy", "class_id", "confidence", *corners)


def read_registry(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A registry table; newer columns of later writes are merged in, a missing table is empty."""
    try:
        return spark.read.option("mergeSchema", True).parquet(f"{root}/{name}")
    except Exception as exc:
        if "PATH_NOT_FOUND" in str(exc):
            return spark.createDataFrame([], REGISTRY[name])
        raise
