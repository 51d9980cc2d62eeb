"""Input views derived from the given tables: images, annotations, detections, runs, events, frames, files.

The texts run unchanged in Spark SQL and in DuckDB, so a query and its oracle start from the same rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from detlake.session import apply_runtime, spread

RAW = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")

VIEWS: dict[str, str] = {
    "sub_images": """
        SELECT o_orderkey AS image_id, concat('ds_', cast(o_custkey % 5 AS string)) AS dataset_id,
          concat('frame_', lpad(cast(o_orderkey AS string), 8, '0')) AS frame_id,
          concat('frame_', lpad(cast(o_orderkey AS string), 8, '0'), '.png') AS file_name,
          cast(CASE o_orderkey % 3 WHEN 0 THEN 2560 WHEN 1 THEN 1920 ELSE 1280 END AS int) AS width,
          cast(CASE o_orderkey % 3 WHEN 0 THEN 1440 WHEN 1 THEN 1080 ELSE 720 END AS int) AS height,
          o_orderdate AS captured_at
        FROM orders
    """,
    "sub_li": """
        SELECT *, cast(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
          l_shipdate, l_quantity, l_extendedprice) AS bigint) AS n
        FROM lineitem
    """,
    "sub_annotations": """
        SELECT l_orderkey * 100 + n AS ann_id, l_orderkey AS image_id, cast(l_suppkey % 3 AS int) AS category_id,
          cast((l_partkey * 37 + n * 211) % (width - 221) AS double) AS x,
          cast((l_suppkey * 53 + n * 97) % (height - 164) AS double) AS y,
          cast(20 AS double) + l_quantity * cast(4 AS double) AS w,
          cast(16 + (l_partkey % 50) * 3 AS double) AS h,
          l_partkey AS k1, l_suppkey AS k2, n, l_linenumber AS ln, l_quantity AS qty, l_returnflag AS flag, l_discount AS disc
        FROM sub_li JOIN sub_images ON l_orderkey = image_id
    """,
    "sub_detections": """
        SELECT det_id, image_id, class_id, confidence, x1, y1, x1 + dw AS x2, y1 + h AS y2 FROM (
          SELECT ann_id * 10 + k AS det_id, image_id,
            cast(CASE WHEN k2 % 11 = 0 THEN (category_id + 1) % 3 ELSE category_id END AS int) AS class_id,
            cast(30 + 7 * ((k1 + n) % 10) - 5 * k AS double) / cast(100 AS double) AS confidence,
            x + cast((k1 % 9) - 4 + 3 * (k % 2) AS double) + CASE WHEN k = 2 THEN w ELSE cast(0 AS double) END AS x1,
            y + cast((k2 % 7) - 3 AS double) AS y1,
            w * CASE WHEN k = 2 THEN cast(0.5 AS double) ELSE cast(1 AS double) END AS dw, h
          FROM sub_annotations CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2) ks
          WHERE (k = 0 AND NOT (flag = 'R' AND ln % 3 = 0)) OR (k = 1 AND ln % 2 = 0) OR (k = 2 AND qty >= 40)) d
    """,
    "sub_runs": """
        SELECT concat('run_', lpad(cast(c_custkey AS string), 6, '0')) AS run_id, concat('ds_', cast(c_custkey % 5 AS string)) AS dataset_id,
          CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE concat('tc_', cast(c_custkey % 40 AS string)) END AS tile_cache_id,
          CASE c_custkey % 4 WHEN 0 THEN 'failed' WHEN 1 THEN 'running' ELSE 'success' END AS status, started_at
        FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS started_at FROM orders GROUP BY o_custkey) o ON c_custkey = o_custkey
    """,
    "sub_reports": """
        SELECT o_orderkey AS report_id, concat('run_', lpad(cast(o_custkey AS string), 6, '0')) AS run_id, o_orderdate AS created_at,
          CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS primary_metric_value
        FROM orders
    """,
    "sub_caches": """
        SELECT concat('tc_', cast(p_partkey AS string)) AS tile_cache_id, concat('ds_', cast(p_partkey % 5 AS string)) AS dataset_id,
          p_size AS created_seq
        FROM part
    """,
    "sub_staging": """
        SELECT concat('stage_', cast(s_suppkey AS string)) AS path, cast(1704067200 + s_suppkey * 1800 AS double) AS mtime_epoch
        FROM supplier
    """,
    "sub_run_events": """
        SELECT event_id AS seq, user_id AS run_id, ts,
          CASE event_type WHEN 'signup' THEN 'validate_raw_dataset' WHEN 'view' THEN 'build_or_reuse_tile_cache' WHEN 'click' THEN 'train'
            WHEN 'purchase' THEN 'evaluate_model' ELSE 'register_artifacts' END AS stage,
          CASE WHEN event_type = 'error' AND event_id % 4 = 0 THEN 'failed' WHEN event_id % 3 = 0 THEN 'success' ELSE 'running' END AS status,
          cast(event_id % 500 AS int) AS iter, CASE WHEN event_id % 6 = 0 THEN NULL ELSE value END AS loss, props
        FROM events
    """,
    "sub_files": """
        SELECT source AS root, concat(lang, '/', lpad(cast(doc_id AS string), 10, '0'), '.txt') AS relpath, text AS content, n_chars
        FROM documents
    """,
    "sub_frames": """
        SELECT o_orderkey AS image_id, concat('frame_', lpad(cast(o_orderkey AS string), 8, '0')) AS frame_id,
          concat('m_', cast(o_custkey % 50 AS string)) AS mission_id, o_orderstatus <> 'P' AS usable,
          cast(15 AS double) + cast((o_orderkey % 41) - 20 AS double) * cast(0.0625 AS double) AS height_asl_m,
          cast((o_orderkey % 31) - 15 AS double) * cast(0.15625 AS double) AS pitch_deg,
          cast((o_orderkey % 13) * 37 AS double) AS cam_x, cast((o_custkey % 17) * 29 AS double) AS cam_z,
          cast(o_orderkey % 360 AS double) AS heading_deg
        FROM orders
    """,
    "sub_frame_objects": """
        SELECT ann_id AS object_id, image_id,
          CASE WHEN k1 % 97 = 0 THEN 'buoys' WHEN category_id = 0 THEN 'ships' WHEN category_id = 1 THEN 'helicopters' ELSE 'airplanes' END AS class,
          CASE WHEN flag = 'R' THEN 'approximate' WHEN flag = 'A' THEN 'strong' ELSE 'exact_visible' END AS quality_tier,
          disc >= cast(0.02 AS double) AS valid, x AS x1, y AS y1, x + w AS x2, y + h AS y2,
          cast((k1 % 800) - 400 AS double) AS world_x, cast(k2 % 40 AS double) AS world_y, cast(150 AS double) + qty * cast(12 AS double) AS world_z,
          cast(10 + k1 % 60 AS double) AS length_m, cast(4 + k2 % 12 AS double) AS width_m, cast(3 + n % 15 AS double) AS height_m
        FROM sub_annotations
    """,
    "sub_legacy": """
        SELECT a.ann_id, a.image_id, dataset_id, cast(k1 % 4 AS int) AS category_id, x, y, w, h
        FROM sub_annotations a JOIN sub_images i ON a.image_id = i.image_id
    """,
    "sub_categories": """
        SELECT DISTINCT dataset_id, category_id, CASE WHEN dataset_id = 'ds_4' THEN concat('kind_', cast(category_id AS string))
            WHEN dataset_id IN ('ds_2', 'ds_3') THEN CASE category_id WHEN 0 THEN 'ships' WHEN 1 THEN 'buoys' WHEN 2 THEN 'helicopters' ELSE 'airplanes' END
            ELSE CASE category_id WHEN 0 THEN 'ships' WHEN 1 THEN 'helicopters' ELSE 'airplanes' END END AS name
        FROM (SELECT dataset_id, CASE WHEN dataset_id IN ('ds_2', 'ds_3') THEN category_id ELSE cast(ann_id % 3 AS int) END AS category_id FROM sub_legacy) c
    """,
    "sub_faulty_images": """
        SELECT image_id, CASE WHEN image_id % 89 = 0 THEN ' ' ELSE file_name END AS file_name,
          CASE WHEN image_id % 97 = 0 THEN 0 ELSE width END AS width, CASE WHEN image_id % 83 = 0 THEN NULL ELSE height END AS height
        FROM sub_images
    """,
    "sub_faulty_annotations": """
        SELECT CASE WHEN k1 % 101 = 0 THEN image_id * 100 + 1 ELSE ann_id END AS ann_id,
          CASE WHEN k2 % 89 = 0 THEN -image_id ELSE image_id END AS image_id,
          CASE WHEN k1 % 67 = 0 THEN NULL WHEN k1 % 53 = 0 THEN category_id + 7 ELSE category_id END AS category_id,
          x, y, CASE WHEN k1 % 83 = 0 THEN cast(0 AS double) ELSE w END AS w, h, k1 % 71 = 0 AS short,
          CASE WHEN k1 % 7 = 0 THEN NULL ELSE 0 END AS iscrowd
        FROM sub_annotations
    """,
    "sub_artifacts": """
        SELECT concat('run_', lpad(cast(p_partkey % 50 AS string), 6, '0')) AS run_id,
          CASE p_partkey % 5 WHEN 0 THEN 'checkpoints' WHEN 1 THEN 'reports' WHEN 2 THEN 'exports' WHEN 3 THEN 'visualizations' ELSE 'other' END AS area,
          concat('/store/', CASE p_partkey % 5 WHEN 0 THEN concat(CASE p_partkey % 3 WHEN 0 THEN 'best' WHEN 1 THEN concat('epoch_', cast(p_partkey AS string)) ELSE 'draft' END, '_ckpt.pth')
            WHEN 1 THEN concat('r', cast(p_partkey AS string), CASE p_partkey % 2 WHEN 0 THEN '.json' ELSE '.txt' END)
            ELSE concat('f', cast(p_partkey AS string), '.png') END) AS path, p_size AS length, p_partkey AS k
        FROM part
    """,
    "sub_updates": """
        SELECT run_id, seq, ts, CASE WHEN seq % 10 = 0 THEN 'success' WHEN seq % 15 = 0 THEN NULL WHEN seq % 7 = 0 THEN 'lost' ELSE 'running' END AS status,
          CASE WHEN seq % 5 = 0 THEN stage END AS phase, CASE WHEN seq % 3 = 0 THEN loss END AS loss
        FROM sub_run_events
    """,
}

# views only the oracle texts use
ORACLE_VIEWS: dict[str, str] = {
    "orc_split_images": """
        SELECT i.*, CASE WHEN bucket < 7000 THEN 'train' WHEN bucket < 8500 THEN 'val' ELSE 'test' END AS split FROM (
          SELECT *, list_reduce(list_transform(string_split(sha256(frame_id), ''),
                                               lambda c: cast(strpos('0123456789abcdef', c) - 1 AS bigint)),
                                lambda a, d: (a * 16 + d) % 10000) AS bucket FROM sub_images) i
    """,
    "orc_scales": """
        SELECT * FROM (VALUES (0, 'original', NULL, NULL, true), (1, 'full_hd', 1920, 1080, true),
          (2, 'intermediate', 1536, 864, true), (3, 'final_640', 640, 640, false)) AS t(scale_ord, scale_name, w0, h0, crop)
    """,
    "orc_plan": """
        SELECT i.*, scale_ord, scale_name, crop, coalesce(w0, width) AS scale_w, coalesce(h0, height) AS scale_h,
          coalesce(w0, width)::double / width AS sx, coalesce(h0, height)::double / height AS sy
        FROM orc_split_images i, orc_scales
    """,
    "orc_tiles": """
        SELECT p.*, yi * len(xs) + xi AS crop_id, xs[xi + 1] AS ox, ys[yi + 1] AS oy FROM (
          SELECT p.*, unnest(range(len(xs))) AS xi FROM (
            SELECT p.*, unnest(range(len(ys))) AS yi FROM (
              SELECT p.*,
                CASE WHEN scale_w <= 640 THEN [0::bigint] ELSE list_distinct(range(0, scale_w - 640 + 1, 320) || [(scale_w - 640)::bigint]).list_sort() END AS xs,
                CASE WHEN scale_h <= 640 THEN [0::bigint] ELSE list_distinct(range(0, scale_h - 640 + 1, 320) || [(scale_h - 640)::bigint]).list_sort() END AS ys
              FROM orc_plan p WHERE crop AND image_id IN (SELECT image_id FROM sub_annotations)) p) p) p
    """,
    "orc_eval_tiles": """
        SELECT p.*, xs[xi + 1] AS ox, ys[yi + 1] AS oy FROM (
          SELECT p.*, unnest(range(len(xs))) AS xi FROM (
            SELECT p.*, unnest(range(len(ys))) AS yi FROM (
              SELECT p.*,
                CASE WHEN scale_w <= 640 THEN [0::bigint] ELSE list_distinct(range(0, scale_w - 640 + 1, 320) || [(scale_w - 640)::bigint]).list_sort() END AS xs,
                CASE WHEN scale_h <= 640 THEN [0::bigint] ELSE list_distinct(range(0, scale_h - 640 + 1, 320) || [(scale_h - 640)::bigint]).list_sort() END AS ys
              FROM (SELECT i.*, n AS scale_name, coalesce(w0, width) AS scale_w, coalesce(h0, height) AS scale_h FROM sub_images i,
                (VALUES ('original', NULL, NULL), ('full_hd_crops', 1920, 1080), ('intermediate_crops', 1536, 864)) AS v(n, w0, h0)) p) p) p) p
    """,
    "orc_pieces": """
        SELECT * FROM (
          SELECT split, image_id, scale_ord, scale_name, crop_id, ox, oy, ann_id, category_id,
            greatest(bx1, ox) - ox AS x1, greatest(by1, oy) - oy AS y1, least(bx2, ox + 640) - ox AS x2, least(by2, oy + 640) - oy AS y2,
            least(1.0::double, (least(bx2, ox + 640) - greatest(bx1, ox)) * (least(by2, oy + 640) - greatest(by1, oy)) / ((bx2 - bx1) * (by2 - by1))) AS visible_ratio
          FROM (SELECT t.split, t.image_id, scale_ord, scale_name, crop_id, ox::double AS ox, oy::double AS oy, ann_id, category_id,
                  x * sx AS bx1, y * sy AS by1, (x + w) * sx AS bx2, (y + h) * sy AS by2
                FROM orc_tiles t JOIN sub_annotations a ON t.image_id = a.image_id)
          WHERE greatest(bx1, ox) < least(bx2, ox + 640) AND greatest(by1, oy) < least(by2, oy + 640))
        WHERE visible_ratio >= 0.8::double AND (x2 - x1) * (y2 - y1) >= 1
    """,
    "orc_nms": """
        SELECT d.* FROM sub_detections d JOIN (
          SELECT unnest(list_reduce(list_transform(list({det_id: det_id, x1: x1, y1: y1, x2: x2, y2: y2} ORDER BY confidence DESC, det_id), lambda d: [d]),
            lambda kept, c: CASE WHEN len(list_filter(kept, lambda k:
              greatest(0, least(k.x2, c[1].x2) - greatest(k.x1, c[1].x1)) * greatest(0, least(k.y2, c[1].y2) - greatest(k.y1, c[1].y1))
              > 0.5::double * ((k.x2 - k.x1) * (k.y2 - k.y1) + (c[1].x2 - c[1].x1) * (c[1].y2 - c[1].y1)
                - greatest(0, least(k.x2, c[1].x2) - greatest(k.x1, c[1].x1)) * greatest(0, least(k.y2, c[1].y2) - greatest(k.y1, c[1].y1))))) > 0
              THEN kept ELSE kept || c END)).det_id AS det_id
          FROM sub_detections WHERE confidence >= 0.25::double GROUP BY image_id, class_id) k ON d.det_id = k.det_id
    """,
    "orc_edges": """
        SELECT a.image_id, a.class_id, a.det_id AS src, b.det_id AS dst FROM orc_nms a JOIN orc_nms b
        ON a.image_id = b.image_id AND a.class_id = b.class_id AND a.det_id < b.det_id
        WHERE sqrt(power(greatest(b.x1 - a.x2, a.x1 - b.x2, 0), 2) + power(greatest(b.y1 - a.y2, a.y1 - b.y2, 0), 2)) <= 50
    """,
    "orc_reach": """
        SELECT det_id, det_id AS other FROM orc_nms
        UNION SELECT r.det_id, e.b FROM orc_reach r JOIN (SELECT src AS a, dst AS b FROM orc_edges UNION ALL SELECT dst, src FROM orc_edges) e ON e.a = r.other
    """,
    "orc_components": """
        SELECT d.*, component FROM orc_nms d JOIN (SELECT det_id, min(other) AS component FROM orc_reach GROUP BY det_id) c ON d.det_id = c.det_id
    """,
    "orc_gt": """
        SELECT image_id, category_id AS class_id, ann_id AS gt_id, x AS x1, y AS y1, x + w AS x2, y + h AS y2 FROM sub_annotations
    """,
    "orc_pairs": """
        SELECT * FROM (
          SELECT d.image_id, d.class_id, g.class_id AS gt_class, det_id, confidence, gt_id,
            CASE WHEN inter > 0 THEN inter / (da + ga - inter) ELSE 0::double END AS iou
          FROM (SELECT d.*, gt_id, g.class_id AS gclass,
                  greatest(0, least(d.x2, g.x2) - greatest(d.x1, g.x1)) * greatest(0, least(d.y2, g.y2) - greatest(d.y1, g.y1)) AS inter,
                  (d.x2 - d.x1) * (d.y2 - d.y1) AS da, (g.x2 - g.x1) * (g.y2 - g.y1) AS ga
                FROM sub_detections d JOIN orc_gt g ON d.image_id = g.image_id) d
          JOIN orc_gt g USING (gt_id))
        WHERE iou >= 0.5::double
    """,
    "orc_match": """
        SELECT image_id, class_id, threshold, m.det_id AS det_id, m.gt_id AS gt_id FROM (
          SELECT image_id, class_id, threshold, unnest(list_reduce(
            list_transform(list({det_id: det_id, c: c} ORDER BY confidence DESC, det_id),
              lambda d: [{det_id: d.det_id, gt_id: cast(NULL AS bigint), c: d.c}]),
            lambda acc, d: acc || [{det_id: d[1].det_id,
              gt_id: list_filter(d[1].c, lambda g: NOT list_contains(list_transform(acc, lambda a: a.gt_id), g))[1], c: d[1].c}],
            [{det_id: cast(NULL AS bigint), gt_id: cast(NULL AS bigint), c: cast([] AS bigint[])}])) AS m
          FROM (SELECT image_id, class_id, threshold, det_id, confidence, list(gt_id ORDER BY iou DESC, gt_id) AS c
                FROM orc_pairs, (SELECT round(0.5 + 0.05 * i, 2)::double AS threshold FROM range(10) r(i))
                WHERE class_id = gt_class AND iou >= threshold GROUP BY ALL)
          GROUP BY image_id, class_id, threshold)
        WHERE m.gt_id IS NOT NULL
    """,
    "orc_match_any": """
        SELECT image_id, m.det_id AS det_id, m.gt_id AS gt_id FROM (
          SELECT image_id, unnest(list_reduce(
            list_transform(list({det_id: det_id, c: c} ORDER BY confidence DESC, det_id),
              lambda d: [{det_id: d.det_id, gt_id: cast(NULL AS bigint), c: d.c}]),
            lambda acc, d: acc || [{det_id: d[1].det_id,
              gt_id: list_filter(d[1].c, lambda g: NOT list_contains(list_transform(acc, lambda a: a.gt_id), g))[1], c: d[1].c}],
            [{det_id: cast(NULL AS bigint), gt_id: cast(NULL AS bigint), c: cast([] AS bigint[])}])) AS m
          FROM (SELECT image_id, det_id, confidence, list(gt_id ORDER BY iou DESC, gt_id) AS c
                FROM orc_pairs GROUP BY ALL)
          GROUP BY image_id)
        WHERE m.gt_id IS NOT NULL
    """,
    "orc_classes": """
        SELECT * FROM (VALUES (0, 'ships'), (1, 'helicopters'), (2, 'airplanes')) AS t(class_id, class_name)
    """,
    "orc_per_class": """
        SELECT *, CASE WHEN num_pred > 0 THEN tp::double / num_pred ELSE 0::double END AS "precision",
          CASE WHEN num_gt > 0 THEN tp::double / num_gt ELSE 0::double END AS recall FROM (
          SELECT class_id, class_name, (SELECT count(*) FROM orc_gt g WHERE g.class_id = c.class_id) AS num_gt,
            (SELECT count(*) FROM sub_detections d WHERE d.class_id = c.class_id) AS num_pred,
            (SELECT count(*) FROM orc_match m WHERE m.class_id = c.class_id AND threshold = 0.5) AS tp
          FROM orc_classes c)
    """,
    "orc_ap": """
        SELECT class_id, threshold, sum(coalesce(p, 0::double)) / 101 AS ap FROM (
          SELECT g.class_id, g.threshold, k, max("precision") FILTER (WHERE recall >= k * 0.01::double) AS p
          FROM (SELECT class_id, round(0.5 + 0.05 * i, 2)::double AS threshold, k FROM orc_classes, range(10) r(i), range(101) s(k)) g
          LEFT JOIN (
            SELECT DISTINCT class_id, threshold, recall, max("precision") OVER (PARTITION BY class_id, threshold, recall) AS "precision" FROM (
              SELECT d.class_id, d.threshold, (sum(hit) OVER w)::double / (SELECT count(*) FROM orc_gt q WHERE q.class_id = d.class_id) AS recall,
                (sum(hit) OVER w)::double / (count(*) OVER w) AS "precision"
              FROM (SELECT d.class_id, d.confidence, d.image_id, d.det_id, t.threshold, CASE WHEN m.det_id IS NULL THEN 0 ELSE 1 END AS hit
                    FROM sub_detections d CROSS JOIN (SELECT round(0.5 + 0.05 * i, 2)::double AS threshold FROM range(10) r(i)) t
                    LEFT JOIN orc_match m ON m.det_id = d.det_id AND m.threshold = t.threshold) d
              WINDOW w AS (PARTITION BY d.class_id, d.threshold ORDER BY d.confidence DESC, d.image_id, d.det_id ROWS UNBOUNDED PRECEDING))) c
          ON c.class_id = g.class_id AND c.threshold = g.threshold
          GROUP BY ALL)
        GROUP BY class_id, threshold
    """,
}

_ALL = {**VIEWS, **ORACLE_VIEWS}
_NAME = re.compile(r"\b(?:sub|orc)_\w+\b")
_COPIES = "CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2) ks"


def _needed(text: str, seen: list[str], open_: tuple[str, ...] = ()) -> list[str]:
    for name in _NAME.findall(text):
        if name in _ALL and name not in seen and name not in open_:
            _needed(_ALL[name], seen, (*open_, name))
            if name not in seen:
                seen.append(name)
    return seen


def with_views(text: str, once: bool = False) -> str:
    """`text` behind a WITH clause of every view it uses, directly or not. `once`: in DuckDB's words, each view is computed
    one time, however often it is used."""
    names = _needed(text, [])
    if not names:
        return text.strip()
    ctes = ",\n".join(f"{n} AS {'MATERIALIZED ' if once and n != 'orc_reach' else ''}({_ALL[n].strip()})" for n in names)
    body = text.strip()
    head = "WITH RECURSIVE" if "orc_reach" in names else "WITH"
    return f"{head} {ctes},\n{body[5:]}" if body[:5].upper() == "WITH " else f"{head} {ctes}\n{body}"


class Tables:
    """The given tables of one folder, and the views over them."""

    def __init__(self, spark: SparkSession, folder: str):
        apply_runtime(spark)
        self.spark, self.folder = spark, folder
        # the footers tell
        spread(spark, self.raw("lineitem").count())

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        # the three copies of an annotation come from a generator in Spark, not from a join
        full = with_views(text).replace(_COPIES, "LATERAL VIEW explode(array(0, 1, 2)) ks AS k")
        for name in RAW:
            if re.search(rf"\b{name}\b", full):
                self.raw(name).createOrReplaceTempView(name)
        return self.spark.sql(full)

    def view(self, name: str) -> DataFrame:
        return self.sql(f"SELECT * FROM {name}")
