"""Precision, recall, average precision, PR curve and confusion matrix on top of matchings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from detlake.functions.text import f1_score, safe_div
from detlake.operators.matching import THRESHOLDS, with_classes
from detlake.operators.ordering import binned_sums, sums_along
from detlake.session import durable, written

# fixed values: canonical classes in id order, and the name of the no-object class
CLASSES = ("ships", "helicopters", "airplanes")
BACKGROUND = "background"
AP_POINTS = 101


def class_table(df: DataFrame, classes: Sequence[str] = CLASSES) -> DataFrame:
    rows = ", ".join(f"({i}, '{n}')" for i, n in enumerate(classes))
    return df.sparkSession.sql(f"SELECT cast(id AS int) AS class_id, name AS class_name FROM VALUES {rows} AS t(id, name)")


def _rates(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    p, r = safe_div(tp, tp + fp), safe_div(tp, tp + fn)
    return {"precision": p, "recall": r, "f1": f1_score(p, r), "detection_accuracy": safe_div(tp, tp + fp + fn)}


def _class_rates(counts: Sequence[DataFrame], classes: Sequence[str]) -> DataFrame:
    rows = class_table(counts[0], classes)
    for c in counts:
        rows = rows.join(c, "class_id", "left")
    rows = rows.select("class_id", "class_name", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
                                                   for c in ("num_gt", "num_pred", "tp")])
    rows = rows.withColumn("fp", F.col("num_pred") - F.col("tp")).withColumn("fn", F.col("num_gt") - F.col("tp"))
    return rows.select("*", *[c.alias(n) for n, c in _rates(F.col("tp"), F.col("fp"), F.col("fn")).items()])


def _of_class(df: DataFrame, name: str) -> DataFrame:
    return df.groupBy("class_id").agg(F.count(F.lit(1)).alias(name))


def per_class_metrics(labelled: DataFrame, truth: DataFrame, classes: Sequence[str] = CLASSES) -> DataFrame:
    """Counts and rates of every listed class; classes outside the list are left out, empty ones show zeros."""
    det = labelled.groupBy("class_id").agg(F.count(F.lit(1)).alias("num_pred"), F.sum("is_tp").alias("tp"))
    return _class_rates([det, _of_class(truth, "num_gt")], classes)


def matched_class_metrics(detections: DataFrame, truth: DataFrame, matches: DataFrame, classes: Sequence[str] = CLASSES) -> DataFrame:
    """The same from a one-threshold matching of these detections by class. Each is matched once at most, so its hits are counted
    where they are and not joined back."""
    return _class_rates([_of_class(detections, "num_pred"), _of_class(matches, "tp"), _of_class(truth, "num_gt")], classes)


def overall_metrics(per_class: DataFrame) -> DataFrame:
    """Micro totals over the listed classes."""
    sums = per_class.agg(*[F.sum(c).alias(c) for c in ("num_gt", "num_pred", "tp", "fp", "fn")])
    return sums.select("*", *[c.alias(n) for n, c in _rates(F.col("tp"), F.col("fp"), F.col("fn")).items()])


def _point_below(recall: Column) -> Column:
    """Largest k with k*0.01 <= recall, compared in the same doubles as the reference points."""
    guess = F.floor(recall * 100).cast("int")
    up = (guess + 1).cast("double") * F.lit(0.01) <= recall
    down = guess.cast("double") * F.lit(0.01) > recall
    return F.least(F.lit(AP_POINTS - 1), F.when(up, guess + 1).when(down, guess - 1).otherwise(guess))


def average_precision(detections: DataFrame, truth: DataFrame, matches: DataFrame,
                      thresholds: Sequence[float] = THRESHOLDS, classes: Sequence[str] = CLASSES) -> DataFrame:
    """101-point AP per (class, threshold); 0 without ground truth or predictions. Any number of thresholds.

    Detections of the listed classes are ranked once, by bins of confidence (`binned_sums`), over four narrow columns; no
    order of all rows is made. Only hits go on, one row each, and are counted along the ranks for all thresholds at once. The interpolated
    precision at point t is the best precision at any recall >= t, so each true positive goes to the last point it reaches,
    and a suffix maximum over at most 101 points finishes.
    """
    index = F.array_position(F.array(*[F.lit(float(t)) for t in thresholds]), F.col("threshold")) - 1
    known = class_table(detections, classes)
    det = detections.filter(F.col("class_id").between(0, len(classes) - 1)).select("class_id", "confidence", "image_id", "det_id")
    ranked = binned_sums(det, ["class_id"], "confidence", ["image_id", "det_id"])
    # one row a detection, with the thresholds it is hit at (no more than there are thresholds)
    own = [c for c in ("image_id", "class_id") if c in matches.columns]  # matches are dealt by these already
    found = matches.groupBy(*own, "det_id").agg(F.array_sort(F.collect_set(index.cast("int"))).alias("_at"))
    # the ranks are made once, for the counts of blocks and for the rows
    hits = durable(found.select("det_id", "_at").join(ranked.select("det_id", "class_id", "rank"), "det_id").select("class_id", "rank", "_at"))
    at = [F.array_contains("_at", i) for i in range(len(thresholds))]
    counted = sums_along(hits, ["class_id"], "rank", {f"_tp{i}": a.cast("bigint") for i, a in enumerate(at)})
    scored = counted.select("class_id", "rank", F.inline(F.array_compact(F.array(*[
        F.when(a, F.struct(F.lit(i).alias("threshold_ord"), F.col(f"_tp{i}").alias("_tp"))) for i, a in enumerate(at)]))))
    num_gt = truth.groupBy("class_id").agg(F.count(F.lit(1)).alias("_gt"))
    # one row per class, and no more classes than rows of the class table
    scored = scored.join(F.broadcast(known.join(num_gt, "class_id", "left")), "class_id")
    scored = scored.select("class_id", "threshold_ord", _point_below(F.col("_tp") / F.col("_gt")).alias("_point"),
                           (F.col("_tp") / F.col("rank")).alias("_precision"))
    best = scored.groupBy("class_id", "threshold_ord", "_point").agg(F.max("_precision").alias("_best"))
    grid = class_table(detections, classes).select("*", F.explode(F.array(*[
        F.struct(F.lit(i).alias("threshold_ord"), F.lit(float(t)).alias("threshold")) for i, t in enumerate(thresholds)
    ])).alias("_g")).select("class_id", "class_name", "_g.*")
    points = grid.withColumn("_point", F.explode(F.sequence(F.lit(0), F.lit(AP_POINTS - 1))))
    filled = points.join(best, ["class_id", "threshold_ord", "_point"], "left")
    ahead = Window.partitionBy("class_id", "threshold_ord").orderBy("_point").rowsBetween(0, Window.unboundedFollowing)
    filled = filled.withColumn("_p", F.coalesce(F.max("_best").over(ahead), F.lit(0.0)))
    return filled.groupBy("class_id", "class_name", "threshold").agg((F.sum("_p") / F.lit(float(AP_POINTS))).alias("ap"))


def class_ap(ap: DataFrame, thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """`ap50` (AP at the first threshold, whatever it is) and `ap5095` (mean over thresholds) per class."""
    first = F.max(F.when(F.col("threshold") == F.lit(float(thresholds[0])), F.col("ap")))
    return ap.groupBy("class_id", "class_name").agg(first.alias("ap50"), F.avg("ap").alias("ap5095"))


def mean_average_precision(ap_by_class: DataFrame, truth: DataFrame) -> DataFrame:
    """Means over the classes that have ground truth."""
    present = truth.select("class_id").distinct()
    means = ap_by_class.join(present, "class_id", "left_semi").agg(F.avg("ap50").alias("map50"), F.avg("ap5095").alias("map5095"))
    return means.select(*[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("map50", "map5095")])


def pr_curve(labelled: DataFrame, truth: DataFrame) -> DataFrame:
    """Overall cumulative precision and recall, one row per prediction; unlisted classes count too."""
    slim = written(labelled.select("confidence", "image_id", "det_id", "is_tp"))
    ranked = binned_sums(slim, [], "confidence", ["image_id", "det_id"], {"tp_cum": F.col("is_tp").cast("bigint")})
    total = truth.agg(F.count(F.lit(1))).scalar()
    out = ranked.withColumn("_gt", total).filter(F.col("_gt") > 0)
    return out.select("rank", "det_id", "confidence", (F.col("tp_cum") / F.col("_gt")).alias("recall"),
                      (F.col("tp_cum") / F.col("rank")).alias("precision"))


def confusion_matrix(detections: DataFrame, truth: DataFrame, matches: DataFrame,
                     classes: Sequence[str] = CLASSES) -> DataFrame:
    """(gt_class, pred_class, n) over the full grid; the last class is the background. `matches` are those of these two tables.

    Unmatched rows are all rows of a class without its matched ones: three counts by class, no join of rows.
    """
    bg = len(classes)

    def known(c: str) -> Column:
        return F.when(F.col(c).between(0, bg - 1), F.col(c)).otherwise(F.lit(bg)).cast("int")

    def counted(df: DataFrame, gt_class: Column, pred_class: Column) -> DataFrame:
        return df.groupBy(gt_class.alias("gt_class"), pred_class.alias("pred_class")).agg(F.count(F.lit(1)).alias("n"))

    def cell(gt_class: Column, pred_class: Column, n: Column) -> Column:
        return F.struct(gt_class.alias("gt_class"), pred_class.alias("pred_class"), n.alias("n"))

    none, g, p, n = F.lit(bg), F.col("gt_class"), F.col("pred_class"), F.col("n")
    hits = counted(with_classes(detections, truth, matches), known("gt_class"), known("class_id"))
    hits = hits.select(F.inline(F.array(cell(g, p, n), cell(none, p, -n), cell(g, none, -n))))
    every = counted(detections, none, known("class_id")).unionByName(counted(truth, known("class_id"), none))
    counts = hits.unionByName(every).groupBy("gt_class", "pred_class").agg(F.sum("n").alias("n"))
    names = F.array(*[F.lit(n) for n in (*classes, BACKGROUND)])
    grid = detections.sparkSession.range(bg + 1).select(F.col("id").cast("int").alias("gt_class"),
                                                        F.explode(F.sequence(F.lit(0), F.lit(bg))).alias("pred_class"))
    out = grid.join(counts, ["gt_class", "pred_class"], "left")
    return out.select("gt_class", F.element_at(names, F.col("gt_class") + 1).alias("gt_name"), "pred_class",
                      F.element_at(names, F.col("pred_class") + 1).alias("pred_name"), F.coalesce("n", F.lit(0)).alias("n"))


def normalize_confusion(matrix: DataFrame, mode: str = "row") -> DataFrame:
    keys = {"row": "gt_class", "col": "pred_class"}
    if mode == "none":
        return matrix.withColumn("share", F.col("n").cast("double"))
    if mode not in keys:
        raise ValueError(f"unknown normalisation {mode!r}")
    total = F.sum("n").over(Window.partitionBy(keys[mode]))  # a class has as many rows as there are classes
    return matrix.withColumn("share", safe_div(F.col("n"), total))


def confusion_wide(matrix: DataFrame, classes: Sequence[str] = CLASSES) -> DataFrame:
    return (matrix.groupBy("gt_class", "gt_name").pivot("pred_name", [*classes, BACKGROUND]).agg(F.sum("n")))


def timing_summary(timings: DataFrame) -> DataFrame:
    """Average milliseconds per image and stage, and images per second, from `image_id, stage, seconds`."""
    stages = ("preprocessing", "inference", "postprocessing", "stitch_merge", "end_to_end")
    n = F.greatest(F.lit(1), F.count_distinct("image_id"))
    out = timings.agg(F.count_distinct("image_id").alias("num_images"), *[
        (F.lit(1000.0) * F.coalesce(F.sum(F.when(F.col("stage") == s, F.col("seconds"))), F.lit(0.0)) / n).alias(f"avg_{s}_ms")
        for s in stages])
    return out.withColumn("fps", safe_div(F.lit(1000.0), F.col("avg_end_to_end_ms")))


def key_values(one_row: DataFrame) -> DataFrame:
    """(key, value) rows of a one-row table."""
    pairs = F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value")) for c in one_row.columns])
    return one_row.select(F.inline(pairs))
