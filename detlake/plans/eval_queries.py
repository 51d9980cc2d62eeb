"""Suppression, fusion, matching and metric queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from detlake.operators import fragments, matching, metrics, suppress
from detlake.plans.catalog import query
from detlake.plans.substrate import Tables
from detlake.session import written

_SCORE = 0.25


def _dets(t: Tables):
    return t.view("sub_detections")


def _truth(t: Tables):
    a = t.view("sub_annotations")
    return a.select("image_id", F.col("category_id").alias("class_id"), F.col("ann_id").alias("gt_id"), F.col("x").alias("x1"),
                    F.col("y").alias("y1"), (F.col("x") + F.col("w")).alias("x2"), (F.col("y") + F.col("h")).alias("y2"))


def _matches(t: Tables, thresholds=(0.5,)):
    return matching.match_same_class(_dets(t), _truth(t), thresholds)


def _nms(t: Tables, cap=None):
    return suppress.nms(_dets(t), 0.5, _SCORE, cap)


@query("nms", "SELECT image_id, class_id, det_id, confidence, x1, y1, x2, y2 FROM orc_nms")
def nms(t: Tables):
    return _nms(t)


@query("nms_capped", """
SELECT image_id, class_id, det_id, confidence FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY confidence DESC, det_id) AS r FROM orc_nms) WHERE r <= 3""")
def nms_capped(t: Tables):
    return _nms(t, 3).select("image_id", "class_id", "det_id", "confidence")


def _iou_sql(a: str, b: str) -> str:
    wide = f"greatest(0, least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1))"
    high = f"greatest(0, least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1))"
    area = lambda k: f"({k}.x2 - {k}.x1) * ({k}.y2 - {k}.y1)"
    return f"(CASE WHEN {wide} * {high} > 0 THEN {wide} * {high} / ({area(a)} + {area(b)} - {wide} * {high}) ELSE 0::double END)"


# one turn for each member: the best living entry leaves, what it overlaps fades
_SOFT = f"""
WITH l AS (SELECT image_id, class_id, list({{neg: -confidence, det_id: det_id, x1: x1, y1: y1, x2: x2, y2: y2}} ORDER BY confidence DESC, det_id) AS l FROM sub_detections GROUP BY image_id, class_id),
t AS (SELECT image_id, class_id, unnest(list_reduce(list_prepend({{alive: l, gone: l[1:0]}}, list_transform(l, lambda e: {{alive: l[1:0], gone: l[1:0]}})),
  lambda s, x: list_transform([list_sort(s.alive)[1]], lambda b: {{
    alive: list_transform(list_filter(s.alive, lambda e: e.det_id <> b.det_id), lambda e: {{
      neg: CASE WHEN {_iou_sql("b", "e")} > 0.5::double THEN e.neg * exp(-({_iou_sql("b", "e")} * {_iou_sql("b", "e")}) / 0.5::double) ELSE e.neg END,
      det_id: e.det_id, x1: e.x1, y1: e.y1, x2: e.x2, y2: e.y2}}),
    gone: s.gone || [b]}})[1]).gone) AS g FROM l)
SELECT image_id, class_id, g.det_id AS det_id, round(-g.neg, 6) AS confidence, g.x1 AS x1, g.y1 AS y1, g.x2 AS x2, g.y2 AS y2 FROM t WHERE -g.neg >= 0.001::double"""


@query("soft_nms", _SOFT)
def soft_nms(t: Tables):
    return suppress.postprocess(_dets(t), "soft_nms", 0.5, 0.001).withColumn("confidence", F.round("confidence", 6))


_SIDES = ("x1", "y1", "x2", "y2")
_OPENED = "{{n: 1, conf: -{e}.neg, ids: [{e}.det_id], " + ", ".join(f"{c}: {{e}}.{c}, w{c}: {{e}}.{c} * -{{e}}.neg, p{c}: {{e}}.{c}" for c in _SIDES) + "}}"
_JOINED = ("{n: k.n + 1, conf: k.conf - x.e.neg, ids: k.ids || [x.e.det_id], " + ", ".join(
    f"{c}: CASE WHEN k.conf - x.e.neg > 0 THEN (k.w{c} + x.e.{c} * -x.e.neg) / (k.conf - x.e.neg) ELSE (k.p{c} + x.e.{c}) / (k.n + 1) END, "
    f"w{c}: k.w{c} + x.e.{c} * -x.e.neg, p{c}: k.p{c} + x.e.{c}" for c in _SIDES) + "}")
# the first cluster that reaches the threshold takes a detection, else it opens one
_WBF = f"""
WITH l AS (SELECT image_id, class_id, list({{neg: -confidence, det_id: det_id, x1: x1, y1: y1, x2: x2, y2: y2}} ORDER BY confidence DESC, det_id) AS l
  FROM sub_detections WHERE confidence >= {_SCORE}::double GROUP BY image_id, class_id),
t AS (SELECT image_id, class_id, unnest(list_reduce(list_prepend({{ks: [{_OPENED.format(e="l[1]")}][1:0], e: l[1]}}, list_transform(l, lambda e: {{ks: [{_OPENED.format(e="e")}][1:0], e: e}})),
  lambda s, x: {{ks: list_transform([coalesce(list_position(list_transform(s.ks, lambda k: {_iou_sql("k", "x.e")} >= 0.55::double), true), 0)], lambda p:
    CASE WHEN p = 0 THEN s.ks || [{_OPENED.format(e="x.e")}] ELSE list_transform(s.ks, lambda k, i: CASE WHEN i = p THEN {_JOINED} ELSE k END) END)[1], e: x.e}}).ks) AS k FROM l)
SELECT image_id, class_id, k.ids[1] AS det_id, round(k.conf / k.n, 6) AS confidence, {", ".join(f"round(k.{c}, 6) AS {c}" for c in _SIDES)}, 'wbf' AS source, array_to_string(k.ids, ',') AS merged_from FROM t"""


@query("wbf", _WBF)
def wbf(t: Tables):
    out = suppress.postprocess(_dets(t), "wbf", 0.55, _SCORE)
    return out.select("image_id", "class_id", "det_id", *[F.round(c, 6).alias(c) for c in ("confidence", *_SIDES)], "source", F.array_join(F.col("merged_from").cast("array<string>"), ",").alias("merged_from"))


_EDGES = "SELECT image_id, class_id, src, dst FROM orc_edges"


@query("fragment_edges", _EDGES)
def fragment_edges(t: Tables):
    return fragments.fragment_edges(_nms(t))


def _components(t: Tables):
    return fragments.near_components(_nms(t))


@query("fragment_components", """
SELECT image_id, class_id, det_id, component FROM orc_components""")
def fragment_components(t: Tables):
    return _components(t).select("image_id", "class_id", "det_id", "component")


@query("fuse_components", """
WITH f AS (SELECT image_id, class_id, component, first(det_id ORDER BY confidence DESC, det_id) AS head, count(*) AS n, max(confidence) AS confidence, min(x1) AS x1, min(y1) AS y1, max(x2) AS x2, max(y2) AS y2,
    sum((x2 - x1) * (y2 - y1)) AS sa FROM orc_components GROUP BY ALL),
 g AS (SELECT *, n = 1 OR (greatest((x2 - x1) / (y2 - y1), (y2 - y1) / (x2 - x1)) <= 30 AND (x2 - x1) * (y2 - y1) / sa <= 50) AS good FROM f)
SELECT image_id, class_id, head AS det_id, confidence, x1, y1, x2, y2, CASE WHEN n > 1 THEN 'merged' ELSE 'tile' END AS source, n AS num_members FROM g WHERE good
UNION ALL SELECT c.image_id, c.class_id, c.det_id, c.confidence, c.x1, c.y1, c.x2, c.y2, 'tile', 1 FROM orc_components c JOIN g USING (image_id, class_id, component) WHERE NOT good""")
def fuse_components(t: Tables):
    return fragments.fuse_components(_components(t)).drop("inference_time", "component")


@query("merged_from", """
WITH f AS (SELECT image_id, class_id, component, first(det_id ORDER BY confidence DESC, det_id) AS head, count(*) AS n, min(x1) AS x1, min(y1) AS y1, max(x2) AS x2, max(y2) AS y2,
    sum((x2 - x1) * (y2 - y1)) AS sa FROM orc_components GROUP BY ALL)
SELECT c.image_id, c.class_id, head AS det_id, c.det_id AS member_id FROM orc_components c JOIN f USING (image_id, class_id, component)
WHERE n > 1 AND greatest((f.x2 - f.x1) / (f.y2 - f.y1), (f.y2 - f.y1) / (f.x2 - f.x1)) <= 30 AND (f.x2 - f.x1) * (f.y2 - f.y1) / sa <= 50""")
def merged_from(t: Tables):
    members = _components(t)
    return fragments.merged_from(members, fragments.fuse_components(members))


@query("fusion_counts", """
SELECT image_id, coalesce(b, 0) AS before_nms, coalesce(n, 0) AS after_nms, coalesce(m, 0) AS after_merge FROM
 (SELECT image_id, count(*) AS b FROM sub_detections GROUP BY ALL) FULL JOIN (SELECT image_id, count(*) AS n FROM orc_nms GROUP BY ALL) USING (image_id)
 FULL JOIN (SELECT image_id, sum(CASE WHEN good THEN 1 ELSE n END)::bigint AS m FROM (
   SELECT image_id, count(*) AS n, count(*) = 1 OR (greatest((max(x2) - min(x1)) / (max(y2) - min(y1)), (max(y2) - min(y1)) / (max(x2) - min(x1))) <= 30
     AND (max(x2) - min(x1)) * (max(y2) - min(y1)) / sum((x2 - x1) * (y2 - y1)) <= 50) AS good
   FROM orc_components GROUP BY image_id, class_id, component) GROUP BY ALL) USING (image_id)""")
def fusion_counts(t: Tables):
    # written once for the counts and the fusion
    kept = written(_nms(t))
    return fragments.fusion_counts(_dets(t), kept, fragments.merge_fragments(kept, pinned=True))


@query("iou_pairs", "SELECT image_id, class_id, det_id, gt_id, iou FROM orc_pairs WHERE class_id = gt_class")
def iou_pairs(t: Tables):
    return matching.iou_pairs(_dets(t), _truth(t), 0.5).select("image_id", "class_id", "det_id", "gt_id", "iou")


@query("match_same_class", "SELECT image_id, class_id, threshold, det_id, gt_id FROM orc_match WHERE threshold IN (0.5, 0.75)")
def match_same_class(t: Tables):
    return _matches(t, (0.5, 0.75)).drop("iou")


@query("match_any_class", "SELECT image_id, det_id, gt_id FROM orc_match_any")
def match_any_class(t: Tables):
    return matching.match_any_class(_dets(t), _truth(t)).select("image_id", "det_id", "gt_id")


@query("false_examples", """
WITH m AS MATERIALIZED (SELECT det_id, gt_id FROM orc_match WHERE threshold = 0.5)
SELECT 'fp' AS kind, image_id, class_id, det_id AS box_id, confidence, x1, y1, x2, y2 FROM sub_detections d WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.det_id = d.det_id)
UNION ALL SELECT 'fn', image_id, class_id, gt_id, NULL, x1, y1, x2, y2 FROM orc_gt g WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.gt_id = g.gt_id)""")
def false_examples(t: Tables):
    return matching.false_examples(_dets(t), _truth(t), _matches(t))


@query("error_taxonomy", """
SELECT d.image_id, d.class_id, d.det_id AS box_id, CASE WHEN m.gt_id IS NULL THEN 'FP' WHEN g.class_id = d.class_id THEN 'TP' ELSE 'WC' END AS tag
FROM sub_detections d LEFT JOIN orc_match_any m USING (det_id) LEFT JOIN orc_gt g USING (gt_id)
UNION ALL SELECT image_id, class_id, gt_id, 'FN' FROM orc_gt WHERE gt_id NOT IN (SELECT gt_id FROM orc_match_any)""")
def error_taxonomy(t: Tables):
    dets, truth = _dets(t), _truth(t)
    return matching.error_taxonomy(dets, truth, matching.match_any_class(dets, truth))


_RATES = """CASE WHEN p + r > 0 THEN 2.0::double * p * r / (p + r) ELSE 0::double END AS f1,
  CASE WHEN num_gt + num_pred - tp > 0 THEN tp::double / (num_gt + num_pred - tp) ELSE 0::double END AS detection_accuracy"""


@query("per_class_metrics", f"""
SELECT class_id, class_name, num_gt, num_pred, tp, num_pred - tp AS fp, num_gt - tp AS fn, p AS "precision", r AS recall, {_RATES}
FROM (SELECT *, "precision" AS p, recall AS r FROM orc_per_class)""")
def per_class_metrics(t: Tables):
    return metrics.matched_class_metrics(_dets(t), _truth(t), _matches(t))


@query("overall_metrics", f"""
SELECT num_gt, num_pred, tp, num_pred - tp AS fp, num_gt - tp AS fn, p AS "precision", r AS recall, {_RATES}
FROM (SELECT *, tp::double / num_pred AS p, tp::double / num_gt AS r FROM (
  SELECT sum(num_gt)::bigint AS num_gt, sum(num_pred)::bigint AS num_pred, sum(tp)::bigint AS tp FROM orc_per_class))""")
def overall_metrics(t: Tables):
    return metrics.overall_metrics(per_class_metrics(t))


def _ap(t: Tables):
    dets, truth = _dets(t), _truth(t)
    return metrics.average_precision(dets, truth, matching.match_same_class(dets, truth, matching.THRESHOLDS)), truth


@query("average_precision", "SELECT class_id, threshold, round(ap, 9) AS ap FROM orc_ap")
def average_precision(t: Tables):
    return _ap(t)[0].select("class_id", "threshold", F.round("ap", 9).alias("ap"))


@query("mean_average_precision", """
SELECT round(avg(ap50), 9) AS map50, round(avg(ap5095), 9) AS map5095 FROM (
  SELECT class_id, max(ap) FILTER (WHERE threshold = 0.5) AS ap50, avg(ap) AS ap5095 FROM orc_ap GROUP BY class_id)""")
def mean_average_precision(t: Tables):
    ap, truth = _ap(t)
    out = metrics.mean_average_precision(metrics.class_ap(ap), truth)
    return out.select(F.round("map50", 9).alias("map50"), F.round("map5095", 9).alias("map5095"))


@query("pr_curve", """
SELECT count(*) OVER w AS rank, det_id, confidence, (sum(hit) OVER w)::double / (SELECT count(*) FROM orc_gt) AS recall,
  (sum(hit) OVER w)::double / (count(*) OVER w) AS "precision"
FROM (SELECT d.*, CASE WHEN m.det_id IS NULL THEN 0 ELSE 1 END AS hit FROM sub_detections d LEFT JOIN orc_match m ON m.det_id = d.det_id AND threshold = 0.5)
WINDOW w AS (ORDER BY confidence DESC, image_id, det_id ROWS UNBOUNDED PRECEDING)""")
def pr_curve(t: Tables):
    return metrics.pr_curve(matching.labelled_detections(_dets(t), _matches(t)), _truth(t))


_CONFUSION = """SELECT gt_class, pred_class, count(*) AS n FROM (
  SELECT coalesce(g.class_id, 3) AS gt_class, d.class_id AS pred_class FROM sub_detections d LEFT JOIN orc_match_any m USING (det_id) LEFT JOIN orc_gt g USING (gt_id)
  UNION ALL SELECT class_id, 3 FROM orc_gt WHERE gt_id NOT IN (SELECT gt_id FROM orc_match_any)) GROUP BY ALL"""


def _confusion(t: Tables):
    dets, truth = _dets(t), _truth(t)
    return metrics.confusion_matrix(dets, truth, matching.match_any_class(dets, truth))


@query("confusion_matrix", f"""
SELECT gt_class, pred_class, coalesce(n, 0) AS n FROM (SELECT a::int AS gt_class, b::int AS pred_class FROM range(4) x(a), range(4) y(b)) LEFT JOIN ({_CONFUSION}) USING (gt_class, pred_class)""")
def confusion_matrix(t: Tables):
    return _confusion(t).select("gt_class", "pred_class", "n")


@query("normalize_confusion", f"""
SELECT gt_class, pred_class, CASE WHEN s > 0 THEN coalesce(n, 0)::double / s ELSE 0::double END AS share FROM (
 SELECT *, sum(n) OVER (PARTITION BY gt_class) AS s FROM (SELECT a::int AS gt_class, b::int AS pred_class FROM range(4) x(a), range(4) y(b)) LEFT JOIN ({_CONFUSION}) USING (gt_class, pred_class))""")
def normalize_confusion(t: Tables):
    return metrics.normalize_confusion(_confusion(t)).select("gt_class", "pred_class", "share")


@query("confusion_wide", f"""
SELECT gt_class, coalesce(sum(n) FILTER (WHERE pred_class = 0), 0)::bigint AS ships, coalesce(sum(n) FILTER (WHERE pred_class = 1), 0)::bigint AS helicopters,
  coalesce(sum(n) FILTER (WHERE pred_class = 2), 0)::bigint AS airplanes, coalesce(sum(n) FILTER (WHERE pred_class = 3), 0)::bigint AS background
FROM (SELECT a::int AS gt_class FROM range(4) x(a)) LEFT JOIN ({_CONFUSION}) USING (gt_class) GROUP BY gt_class""")
def confusion_wide(t: Tables):
    return metrics.confusion_wide(_confusion(t)).drop("gt_name")
