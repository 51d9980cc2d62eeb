"""From tile predictions to detections in source pictures, and the whole evaluation job."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from detlake.functions.boxes import Box, box, clip_box, letterbox_plan, letterbox_to_source, scale_box, translate_box
from detlake.operators import fragments, matching, metrics, suppress
from detlake.operators.metrics import CLASSES
from detlake.operators.tiling import CROP, STRIDE, Scale, generate_tiles, scale_plan
from detlake.session import durable, written

# fixed values: default evaluation scales; the full source is one letterboxed input
FULL_SOURCE = "full_source"
EVAL_SCALES = (Scale("original_crops"), Scale("full_hd_crops", 1920, 1080), Scale("intermediate_crops", 1536, 864),
               Scale("final_640", 640, 640, crop=False))


class EvalSettings(NamedTuple):
    scales: Sequence[Scale] = EVAL_SCALES
    full_source: bool = True
    crop: int = CROP
    stride: int = STRIDE
    edges: bool = True
    method: str = "class_aware_nms"
    iou: float = 0.50
    score: float = 0.25
    max_detections: int | None = 300
    fusion: fragments.Fusion = fragments.Fusion()


def tile_plan(images: DataFrame, cfg: EvalSettings = EvalSettings()) -> DataFrame:
    """Predictor inputs: `image_id, scale_name, scale_w, scale_h, ox, oy, cw, ch, letterbox` and the picture size."""
    for s in cfg.scales:
        if not s.crop and (s.width, s.height) != (cfg.crop, cfg.crop):
            raise ValueError(f"uncropped scale {s.name!r} must be {cfg.crop}x{cfg.crop}")
    base = images.select("image_id", "width", "height")
    cols = ["image_id", "width", "height", "scale_name", "scale_w", "scale_h", "ox", "oy", "cw", "ch", "letterbox"]
    plan = scale_plan(base, cfg.scales)
    tiles = generate_tiles(plan.filter("crop"), "scale_w", "scale_h", cfg.crop, cfg.stride, cfg.edges).withColumn("letterbox", F.lit(False))
    zero = F.lit(0)

    def single(df: DataFrame, letterbox: bool) -> DataFrame:
        return df.select("*", zero.alias("ox"), zero.alias("oy"), F.col("scale_w").alias("cw"), F.col("scale_h").alias("ch"),
                         F.lit(letterbox).alias("letterbox")).select(*cols)

    out = tiles.select(*cols).unionByName(single(plan.filter(~F.col("crop")), False))
    if cfg.full_source:
        full = base.select("*", F.lit(FULL_SOURCE).alias("scale_name"), F.col("width").alias("scale_w"), F.col("height").alias("scale_h"))
        out = out.unionByName(single(full, True))
    return out


def score_tiles(plan: DataFrame, predict: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """Run a user's predictor over the plan, batch by batch; `predict` yields rows of `schema`."""
    return plan.mapInPandas(predict, schema)


def lookup_predictions(plan: DataFrame, entries: DataFrame, detections: DataFrame) -> DataFrame:
    """Stored detections of each input: those keyed by its scale, or, only when no such entry exists, those keyed by a
    null scale. `entries` lists the keys that exist (also empty ones), `detections` their boxes."""
    key = ["image_id", "scale_name", "ox", "oy"]
    named = entries.filter(F.col("scale_name").isNotNull()).select(*key).distinct()
    direct = plan.join(detections.filter(F.col("scale_name").isNotNull()), key)
    loose = detections.filter(F.col("scale_name").isNull()).drop("scale_name")
    fallback = plan.join(named, key, "left_anti").join(loose, ["image_id", "ox", "oy"])
    return direct.unionByName(fallback.select(*direct.columns))


def detections_to_source(found: DataFrame, crop: int = CROP, classes: Sequence[str] = CLASSES) -> DataFrame:
    """Tile boxes `b_x1..b_y2` into source coordinates, clipped; boxes left without area go."""
    b = box("b_")
    lb = letterbox_plan(F.col("width"), F.col("height"), crop)
    boxed = letterbox_to_source(b, lb["scale"], lb["pad_x"], lb["pad_y"])
    moved = scale_box(translate_box(b, F.col("ox"), F.col("oy")), F.col("width") / F.col("scale_w"), F.col("height") / F.col("scale_h"))
    src = Box(*(F.when(F.col("letterbox"), p).otherwise(q) for p, q in zip(boxed, moved)))
    names = F.array(*[F.lit(c) for c in classes])
    keep = [c for c in found.columns if not c.startswith("b_")]
    out = found.select(*keep, *clip_box(src, F.col("width"), F.col("height")).named())
    out = out.filter((F.col("x2") > F.col("x1")) & (F.col("y2") > F.col("y1")))
    return out.withColumn("class_name", F.when(F.col("class_id") >= 0, F.get(names, F.col("class_id"))))


def build_gt(annotations: DataFrame, categories: DataFrame | None = None) -> DataFrame:
    """Ground truth, with class names where `categories` are given, which must name each id once. Evaluation needs no names."""
    rows = annotations.select("image_id", F.col("ann_id").alias("gt_id"), F.col("category_id").alias("class_id"), F.col("x").alias("x1"),
                              F.col("y").alias("y1"), (F.col("x") + F.col("w")).alias("x2"), (F.col("y") + F.col("h")).alias("y2"),
                              (F.col("iscrowd") if "iscrowd" in annotations.columns else F.lit(0)).cast("boolean").alias("difficult"))
    if categories is None:
        return rows
    return rows.join(categories.select(F.col("category_id").alias("class_id"), F.col("name").alias("class_name")), "class_id", "left")


RESULTS = ("detections", "fusion_counts", "per_class", "overall", "pr_curve", "confusion", "false_examples", "error_taxonomy")


def evaluate(detections: DataFrame, truth: DataFrame, cfg: EvalSettings = EvalSettings(), classes: Sequence[str] = CLASSES,
             results: Sequence[str] = RESULTS) -> dict[str, DataFrame]:
    """Suppression, fragment fusion and the asked-for metric tables; the suppression IoU is also the matching threshold."""
    # tables that feed several results are written once
    truth = written(truth.select("image_id", "class_id", "gt_id", "x1", "y1", "x2", "y2"))
    kept = written(suppress.postprocess(detections, cfg.method, cfg.iou, cfg.score, max_detections=cfg.max_detections))
    merged = written(fragments.merge_fragments(kept, cfg.fusion, pinned=True))
    steps = sorted({cfg.iou, *matching.THRESHOLDS})
    all_matches = written(matching.match_same_class(merged, truth, steps).select("class_id", "threshold", "det_id", "gt_id"))
    matches = all_matches.filter(F.col("threshold") == F.lit(cfg.iou))
    labelled = matching.labelled_detections(merged, matches)
    out: dict[str, DataFrame] = {}
    if "detections" in results:
        out["detections"] = merged
    if "fusion_counts" in results:
        out["fusion_counts"] = fragments.fusion_counts(detections, kept, merged)
    if "per_class" in results or "overall" in results:
        scored = all_matches.filter(F.col("threshold").isin(list(matching.THRESHOLDS))).select("det_id", "threshold")
        by_class = metrics.class_ap(durable(metrics.average_precision(merged, truth, scored, classes=classes)))
        per_class = metrics.matched_class_metrics(merged, truth, matches, classes)
        out["per_class"] = per_class.join(by_class.drop("class_name"), "class_id", "left")
        means = metrics.mean_average_precision(by_class, truth)
        out["overall"] = metrics.overall_metrics(per_class).select("*", *[means.select(c).scalar().alias(c) for c in ("map50", "map5095")])
    if "pr_curve" in results:
        out["pr_curve"] = metrics.pr_curve(labelled, truth)
    if "false_examples" in results:
        out["false_examples"] = matching.false_examples(merged, truth, matches)
    if "confusion" in results or "error_taxonomy" in results:
        any_class = written(matching.match_any_class(merged, truth, cfg.iou))
        out["confusion"] = metrics.confusion_matrix(merged, truth, any_class, classes)
        out["error_taxonomy"] = matching.error_taxonomy(merged, truth, any_class)
    return out


def run_summary(results: dict[str, DataFrame], num_images: int, backend: str = "precomputed") -> DataFrame:
    """(key, value) rows of a finished evaluation."""
    counts = results["fusion_counts"].agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(f"num_predictions_{c}")
                                            for c in ("before_nms", "after_nms", "after_merge")])
    over = results["overall"]
    one = counts.select(F.lit(backend).alias("backend"), F.lit(num_images).alias("num_images"), "*", *[
        over.select(c).scalar().alias(n) for c, n in (("precision", "overall_precision"), ("recall", "overall_recall"), ("f1", "overall_f1"),
                                                      ("detection_accuracy", "overall_detection_accuracy"), ("map50", "mAP@50"), ("map5095", "mAP@50:95"))])
    return metrics.key_values(one)
