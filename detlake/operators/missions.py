"""Capture reports per mission and over a whole static dataset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from detlake.functions.boxes import box, box_area
from detlake.operators.metrics import CLASSES
from detlake.operators.quality import yolo_line_valid


def _rounded_position(digits: int) -> Column:
    return F.struct(*[F.bround(F.coalesce(F.col(c), F.lit(0.0)), digits).alias(c) for c in ("cam_x", "height_asl_m", "cam_z")])


def mission_report(frames: DataFrame, objects: DataFrame, expected_frames: int = 10, min_usable: int = 8, min_positions: int = 8,
                   height_m: float = 15.0, height_tol: float = 1.0, max_pitch: float = 2.0, max_ratio: float = 0.60,
                   min_area: float = 64.0, width: int = 2560, height: int = 1440) -> DataFrame:
    """One row per mission. Unusable frames are counted and then ignored; foreign classes, tiny and huge boxes do not
    count as valid objects. Class counts are one column per class; all sums combine before the shuffle."""
    known = F.col("class").isin(list(CLASSES))
    area = box_area(box())
    ratio = area / F.lit(float(width) * float(height))
    shown = known & F.col("valid") & F.col("x1").isNotNull()
    tiny, huge = shown & (area < min_area), shown & (area >= min_area) & (ratio > max_ratio)
    good = shown & ~(area < min_area) & ~(ratio > max_ratio)
    per_frame = objects.groupBy("image_id").agg(
        F.count_if(~known).alias("foreign"), F.count_if(tiny).alias("tiny"), F.count_if(huge).alias("huge"), F.count_if(good).alias("good"),
        *[F.count_if(good & (F.col("class") == c)).alias(f"n_{c}") for c in CLASSES])
    names = ["foreign", "tiny", "huge", "good", *[f"n_{c}" for c in CLASSES]]
    rows = frames.join(per_frame, "image_id", "left").select("*", *[F.coalesce(n, F.lit(0)).alias(f"_{n}") for n in names]).drop(*names)
    use = F.col("usable")
    bad_height = use & (F.abs(F.coalesce("height_asl_m", F.lit(0.0)) - height_m) > height_tol)
    bad_pitch = use & (F.abs(F.coalesce("pitch_deg", F.lit(0.0))) > max_pitch)
    out = rows.groupBy("mission_id").agg(
        F.count(F.lit(1)).alias("frames_seen"), F.count_if(use).alias("usable_frames"), F.count_if(~use).alias("invalid_frames"),
        F.count_if(use & (F.col("_good") == 0)).alias("frames_without_bbox"), F.count_if(bad_height).alias("height_violations"),
        F.count_if(bad_pitch).alias("pitch_violations"), F.count_distinct(F.when(use, _rounded_position(0))).alias("unique_camera_positions"),
        *[F.sum(F.when(use, F.col(f"_{n}")).otherwise(0)).alias(n) for n in names])
    out = out.withColumnsRenamed({"foreign": "foreign_classes", "tiny": "tiny_boxes", "huge": "huge_boxes", "good": "valid_objects"})
    total = ["invalid_frames", "height_violations", "pitch_violations", "foreign_classes", "huge_boxes", "frames_without_bbox"]
    few = (F.col("unique_camera_positions") < min_positions).cast("bigint") + (F.col("usable_frames") < min_usable).cast("bigint")
    errors = few
    for t in total:
        errors = errors + F.col(t)
    warnings = F.col("tiny_boxes") + (F.col("frames_seen") != expected_frames).cast("bigint")
    return out.withColumn("num_errors", errors).withColumn("num_warnings", warnings)


def presence_report(images: DataFrame, metadata: DataFrame, labels: DataFrame) -> DataFrame:
    """Frames lacking one of picture, metadata, label file, with the finding."""
    both = (images.select("frame_id").distinct().withColumn("_i", F.lit(True))
            .join(metadata.select("frame_id").distinct().withColumn("_m", F.lit(True)), "frame_id", "full")
            .join(labels.select("frame_id").distinct().withColumn("_l", F.lit(True)), "frame_id", "full"))
    i, m, y = (F.col(c).isNotNull() for c in ("_i", "_m", "_l"))
    found = F.array_compact(F.array(F.when(m & ~i, F.lit("metadata without image")), F.when(i & ~m, F.lit("image without metadata")),
                                    F.when(i & ~y, F.lit("image without YOLO labels"))))
    return both.select("frame_id", F.explode(found).alias("finding"))


def static_dataset_report(frames: DataFrame, objects: DataFrame, label_lines: DataFrame, expected_per_mission: int = 10,
                          width: int = 2560, height: int = 1440) -> DataFrame:
    """One row per mission: frames, sync, height and pitch failures, positions, box ratio and distance range, label
    lines that break the format, and whether the mission passes."""
    ratio = box_area(box()) / F.lit(float(width * height))
    known = F.col("class").isin(list(CLASSES))
    good = known & F.col("valid") & F.col("x1").isNotNull() & (box_area(box()) > 0)
    per_frame = objects.groupBy("image_id").agg(
        F.count_if(~known).alias("foreign"), F.count_if(good).alias("good"), F.count_if(good & (ratio >= 0.50)).alias("huge"),
        F.count_if(good & (ratio <= 0.00005)).alias("small"), F.min(F.when(good, ratio)).alias("rmin"), F.max(F.when(good, ratio)).alias("rmax"),
        F.min(F.when(good, F.col("distance_m"))).alias("dmin"), F.max(F.when(good, F.col("distance_m"))).alias("dmax"))
    lines = label_lines.filter(F.trim("line") != "").groupBy("frame_id").agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(~yolo_line_valid(F.col("line"))).alias("bad_lines"))
    rows = frames.join(per_frame, "image_id", "left").join(lines, "frame_id", "left")
    off_height = F.coalesce(F.isnan("height_asl_m") | (F.abs(F.col("height_asl_m") - 15.0) > 0.10), F.lit(True))
    off_pitch = F.coalesce(F.isnan("pitch_deg") | (F.abs("pitch_deg") > 0.25), F.lit(True))
    zero = F.lit(0)
    out = rows.groupBy("mission_id").agg(
        F.count(F.lit(1)).alias("frames"), F.count_if(~F.col("usable")).alias("unusable"), F.count_if(off_height).alias("bad_height"),
        F.count_if(off_pitch).alias("bad_pitch"), F.count_distinct(_rounded_position(1)).alias("positions"),
        F.coalesce(F.sum("foreign"), zero).alias("foreign"), F.coalesce(F.sum("good"), zero).alias("valid_objects"),
        F.coalesce(F.sum("huge"), zero).alias("huge"), F.coalesce(F.sum("small"), zero).alias("small"),
        F.count_if(F.coalesce("good", zero) == 0).alias("frames_without_bbox"), F.min("rmin").alias("ratio_min"), F.max("rmax").alias("ratio_max"),
        F.min("dmin").alias("distance_min"), F.max("dmax").alias("distance_max"), F.count_if(F.coalesce("lines", zero) == 0).alias("empty_labels"),
        F.coalesce(F.sum("bad_lines"), zero).alias("bad_lines"))
    passes = (F.col("frames") == expected_per_mission) & (F.col("positions") == expected_per_mission)
    for c in ("unusable", "bad_height", "bad_pitch", "foreign", "huge", "frames_without_bbox", "empty_labels", "bad_lines"):
        passes = passes & (F.col(c) == 0)
    broad = F.coalesce((F.col("distance_min") < 250) | (F.col("distance_max") > 900), F.lit(False))
    return out.withColumn("valid", passes).withColumn("broad_distance", broad)
