"""Registry, hashing and retention queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from detlake.functions import text
from detlake.operators import hashing, ingest, registry, retention
from detlake.operators.splits import with_split
from detlake.plans.catalog import query
from detlake.plans.substrate import Tables
from detlake.schemas import REGISTRY


def _runs(t: Tables):
    return t.view("sub_runs")


_CHANGED = """(SELECT run_id, 'ds_9' AS dataset_id, tile_cache_id, 'success' AS status, started_at FROM sub_runs WHERE run_id LIKE '%5'
UNION ALL SELECT 'new_' || run_id, dataset_id, tile_cache_id, status, started_at FROM sub_runs WHERE run_id LIKE '%7')"""


def _changes(t: Tables):
    r = _runs(t)
    a = r.filter("run_id LIKE '%5'").withColumn("dataset_id", F.lit("ds_9")).withColumn("status", F.lit("success"))
    return a.unionByName(r.filter("run_id LIKE '%7'").withColumn("run_id", F.concat(F.lit("new_"), "run_id")))


@query("upsert_dataset", f"""
SELECT run_id, dataset_id, tile_cache_id, status, started_at FROM sub_runs WHERE run_id NOT LIKE '%5' UNION ALL SELECT * FROM {_CHANGED}""")
def upsert_dataset(t: Tables):
    return registry.upsert(_runs(t), _changes(t), ["run_id"])


@query("upsert_latest_wins", """
SELECT tile_cache_id, dataset_id, max(created_seq) AS created_seq FROM (SELECT concat('tc_', p_partkey % 40) AS tile_cache_id, 'ds_x' AS dataset_id, p_size * 1000 + p_partkey AS created_seq FROM part) GROUP BY ALL
UNION ALL SELECT * FROM sub_caches WHERE tile_cache_id NOT IN (SELECT concat('tc_', p_partkey % 40) FROM part)""")
def upsert_latest_wins(t: Tables):
    base = t.view("sub_caches").withColumn("created_seq", F.col("created_seq").cast("bigint"))
    new = t.sql("SELECT concat('tc_', cast(p_partkey % 40 AS string)) AS tile_cache_id, 'ds_x' AS dataset_id, cast(p_size * 1000 + p_partkey AS bigint) AS created_seq FROM part")
    return registry.replace_rows(base, new, ["tile_cache_id"], ["created_seq"])


@query("key_clashes", "SELECT run_id FROM sub_runs WHERE run_id LIKE '%5'")
def key_clashes(t: Tables):
    return registry.key_clashes(_runs(t), _changes(t), ["run_id"])


@query("insert_unique", f"SELECT run_id, status FROM sub_runs UNION ALL SELECT run_id, status FROM {_CHANGED} WHERE run_id LIKE 'new%'")
def insert_unique(t: Tables):
    fresh = _changes(t).filter("run_id LIKE 'new%'")
    return registry.insert_unique(_runs(t), fresh, ["run_id"]).select("run_id", "status")


@query("patch_run", """
SELECT run_id, dataset_id, CASE WHEN run_id LIKE '%3' THEN 'failed' ELSE status END AS status, CASE WHEN run_id LIKE '%3' OR run_id LIKE '%4' THEN 'tc_new' ELSE tile_cache_id END AS tile_cache_id FROM sub_runs""")
def patch_run(t: Tables):
    r = _runs(t).filter("run_id LIKE '%3' OR run_id LIKE '%4'")
    changes = r.select("run_id", F.when(F.col("run_id").endswith("3"), F.lit("failed")).alias("status"), F.lit("tc_new").alias("tile_cache_id"))
    return registry.patch(_runs(t), changes, "run_id", ["status", "tile_cache_id"]).select("run_id", "dataset_id", "status", "tile_cache_id")


@query("fk_violations", """
SELECT run_id, dataset_id FROM sub_runs WHERE dataset_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM sub_images i WHERE i.dataset_id = sub_runs.dataset_id AND i.dataset_id <> 'ds_2')""")
def fk_violations(t: Tables):
    """Runs of datasets that a registry without ds_2 does not know: their references are orphans."""
    known = t.view("sub_images").filter("dataset_id <> 'ds_2'").select("dataset_id").distinct()
    return registry.fk_violations(_runs(t), "dataset_id", known, "dataset_id").select("run_id", "dataset_id")


@query("delete_by_key", "SELECT run_id, dataset_id FROM sub_runs WHERE dataset_id NOT IN ('ds_1', 'ds_3')")
def delete_by_key(t: Tables):
    return registry.delete_by_key(_runs(t), "dataset_id", ["ds_1", "ds_3"]).select("run_id", "dataset_id")


@query("list_runs", "SELECT run_id, started_at, status FROM sub_runs ORDER BY started_at NULLS FIRST, run_id")
def list_runs(t: Tables):
    return registry.listing(_runs(t), "pipeline_runs").select("run_id", "started_at", "status")


@query("reports_by_run", "SELECT report_id, created_at, primary_metric_value FROM sub_reports WHERE run_id = 'run_000007' ORDER BY created_at, report_id")
def reports_by_run(t: Tables):
    return registry.listing(t.view("sub_reports"), "evaluation_reports", "run_000007").select("report_id", "created_at", "primary_metric_value")


@query("images_by_split", "SELECT image_id, file_name FROM orc_split_images WHERE dataset_id = 'ds_2' AND split = 'val'")
def images_by_split(t: Tables):
    return registry.images_by_split(with_split(t.view("sub_images")), "ds_2", "val").select("image_id", "file_name")


@query("get_by_id", "SELECT run_id, dataset_id, status FROM sub_runs WHERE run_id = 'run_000011'")
def get_by_id(t: Tables):
    return registry.get_by_id(_runs(t), "pipeline_runs", "run_000011").select("run_id", "dataset_id", "status")


@query("add_columns", "SELECT run_id, status, cast(NULL AS varchar) AS current_stage FROM sub_runs")
def add_columns(t: Tables):
    return registry.add_columns(_runs(t), {"current_stage": "string", "status": "string"}).select("run_id", "status", "current_stage")


@query("register_dataset", """
SELECT dataset_id, split, count(DISTINCT i.image_id) AS num_images, count(a.ann_id) AS num_annotations FROM orc_split_images i LEFT JOIN sub_annotations a ON a.image_id = i.image_id GROUP BY ALL""")
def register_dataset(t: Tables):
    images = with_split(t.view("sub_images")).select("image_id", "dataset_id", "file_name", "width", "height", "split")
    anns = t.view("sub_annotations").select("image_id", "ann_id", "category_id", "x", "y", "w", "h")
    placed = anns.join(images.select("image_id", "dataset_id", "split"), "image_id")
    empty = {n: t.spark.createDataFrame([], s) for n, s in REGISTRY.items()}
    rows = images.select("dataset_id").distinct()
    sets = registry.add_columns(rows, dict(empty["datasets"].dtypes))
    return registry.register_dataset(empty, sets, ingest.image_rows(images, anns), ingest.annotation_rows(placed))[1]


@query("register_artifacts", """
SELECT run_id, CASE WHEN area = 'checkpoints' THEN 'checkpoint' WHEN area = 'reports' THEN 'report_file' WHEN area = 'exports' THEN 'export' ELSE 'visualization' END AS artifact_type,
  run_id || ':' || CASE WHEN area = 'checkpoints' THEN '' WHEN area = 'reports' THEN 'report_file:' WHEN area = 'exports' THEN 'export:' ELSE 'visualization:' END || replace(path, '/store/', '') AS registry_id,
  CASE WHEN area = 'checkpoints' THEN CASE k % 3 WHEN 0 THEN 'best' WHEN 1 THEN 'every_n' ELSE 'unknown' END END AS checkpoint_type, CASE WHEN area = 'checkpoints' AND k % 3 = 1 THEN k END::int AS epoch
FROM sub_artifacts WHERE area <> 'other' AND NOT (area = 'reports' AND k % 2 = 1)""")
def register_artifacts(t: Tables):
    return registry.classify_artifacts(t.view("sub_artifacts")).select("run_id", "artifact_type", "registry_id", "checkpoint_type", "epoch")


@query("checkpoint_rows", """
SELECT run_id || ':' || replace(path, '/store/', '') AS checkpoint_id, CASE k % 3 WHEN 0 THEN 'best' WHEN 1 THEN 'every_n' ELSE 'unknown' END AS checkpoint_type,
  CASE WHEN m IS NOT NULL THEN 'ap50_95' END AS metric_name, m AS metric_value
FROM sub_artifacts LEFT JOIN (SELECT run_id, max(primary_metric_value) AS m FROM sub_reports GROUP BY run_id) USING (run_id) WHERE area = 'checkpoints'""")
def checkpoint_rows(t: Tables):
    files = t.view("sub_artifacts").withColumn("sha256", F.sha2(F.col("path").cast("binary"), 256)).withColumn("modified_at", F.lit(None).cast("timestamp"))
    s = t.view("sub_reports").groupBy("run_id").agg(F.max("primary_metric_value").alias("map5095")).filter("map5095 IS NOT NULL")
    s = s.select("run_id", F.lit(0.5).alias("map50"), "map5095", F.lit("m").alias("metrics_path"), F.lit("r").alias("report_path"), F.lit(None).cast("timestamp").alias("created_at"))
    return registry.register_artifacts(files, s)["model_checkpoints"].select("checkpoint_id", "checkpoint_type", "metric_name", "metric_value")


@query("create_run", """
SELECT run_id, dataset_id, status FROM sub_runs UNION ALL SELECT 'new_' || run_id, CASE WHEN dataset_id IN ('ds_0', 'ds_1', 'ds_2') THEN dataset_id END, status FROM sub_runs WHERE run_id LIKE '%7'""")
def create_run(t: Tables):
    wanted = _changes(t)
    known = _runs(t).select("dataset_id").distinct().filter("dataset_id IN ('ds_0', 'ds_1', 'ds_2')")
    return registry.create_runs(_runs(t), wanted, known).select("run_id", "dataset_id", "status")


@query("close_run", """
SELECT run_id, CASE WHEN run_id LIKE '%1' THEN 'failed' WHEN run_id LIKE '%2' THEN 'running' ELSE status END AS status, CASE WHEN run_id LIKE '%1' THEN timestamp '2024-01-01 00:00:00' END AS finished_at FROM sub_runs""")
def close_run(t: Tables):
    runs = _runs(t).withColumn("finished_at", F.lit(None).cast("timestamp_ntz")).withColumn("error", F.lit(None).cast("string"))
    changes = _runs(t).filter("run_id LIKE '%1' OR run_id LIKE '%2'").select("run_id", F.when(F.col("run_id").endswith("1"), "failed").otherwise("running").alias("status"),
                                                                            F.lit(None).cast("timestamp_ntz").alias("finished_at"))
    now = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return registry.close_runs(runs, changes, now).select("run_id", "status", "finished_at")


@query("next_run_id", """
SELECT '2024_05_06_' || lpad(min(n)::varchar, 3, '0') AS run_id FROM range(1, 1000) r(n) WHERE n NOT IN (SELECT c_custkey % 120 + 1 FROM customer WHERE c_custkey % 120 <> 77)""")
def next_run_id(t: Tables):
    used = t.sql("SELECT concat('2024_05_06_', lpad(cast(c_custkey % 120 + 1 AS string), 3, '0')) AS run_id FROM customer WHERE c_custkey % 120 <> 77")
    return registry.next_run_id(used, dt.date(2024, 5, 6))


@query("run_id_parts", """
SELECT c_custkey, c_custkey % 4 <> 0 AS valid, CASE WHEN c_custkey % 4 <> 0 THEN make_date(2024, (1 + c_custkey % 12)::int, (1 + c_custkey % 28)::int) END AS day, CASE WHEN c_custkey % 4 <> 0 THEN c_custkey % 1000 END::int AS number FROM customer""")
def run_id_parts(t: Tables):
    rid = F.format_string("2024_%02d_%02d_%03d", 1 + F.col("c_custkey") % 12, 1 + F.col("c_custkey") % 28, F.col("c_custkey") % 1000)
    rid = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("x"), rid)).otherwise(rid)
    return t.raw("customer").select("c_custkey", text.is_run_id(rid).alias("valid"), text.run_id_date(rid).alias("day"), text.run_id_number(rid).alias("number"))


@query("iso_times", """
SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN date_trunc('second', ts) END AS parsed, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS written FROM events""")
def iso_times(t: Tables):
    e = t.raw("events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"))
    iso = text.format_iso(F.col("ts").cast("timestamp"))
    dirty = F.when(F.col("event_id") % 5 == 0, F.lit("soon")).when(F.col("event_id") % 5 == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise(iso)
    return e.select("event_id", text.parse_iso(dirty).cast("timestamp_ntz").alias("parsed"), iso.alias("written"))


@query("best_metric_per_run", "SELECT r.run_id, m AS best_metric FROM sub_runs r LEFT JOIN (SELECT run_id, max(primary_metric_value) AS m FROM sub_reports GROUP BY run_id) USING (run_id)")
def best_metric_per_run(t: Tables):
    return registry.best_metric_per_run(_runs(t), t.view("sub_reports")).select("run_id", "best_metric")


@query("flatten_params", """
SELECT run_id, u.param AS param, u.value AS value FROM (SELECT o_orderkey AS run_id, unnest([{param: 'train.lr', value: (o_custkey % 10)::varchar}, {param: 'train.aug.flip', value: CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END},
  {param: 'size', value: o_custkey::varchar || ',' || o_orderkey::varchar}, {param: 'name', value: CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END}]) AS u FROM orders) WHERE u.value IS NOT NULL""")
def flatten_params(t: Tables):
    cfg = F.struct(F.struct((F.col("o_custkey") % 10).alias("lr"), F.struct((F.col("o_orderkey") % 2 == 0).alias("flip")).alias("aug")).alias("train"),
                   F.array("o_custkey", "o_orderkey").alias("size"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")).alias("name"))
    return registry.flatten_params(t.raw("orders").select(F.col("o_orderkey").alias("run_id"), cfg.alias("cfg")), "run_id", "cfg")


@query("log_metrics", "SELECT event_id, user_id AS run_id, 'loss' AS name, value FROM events WHERE event_id % 4 <> 0 AND value IS NOT NULL")
def log_metrics(t: Tables):
    e = t.raw("events").select("event_id", F.col("user_id").alias("run_id"), F.lit("loss").alias("name"),
                               F.when(F.col("event_id") % 4 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("value"))
    return registry.log_metrics(e)


# ---- hashing ---------------------------------------------------------------------------------------------------------

@query("file_hash", "SELECT root, relpath, sha256(content) AS sha256 FROM sub_files")
def file_hash(t: Tables):
    return hashing.file_hash(t.view("sub_files")).select("root", "relpath", "sha256")


def _tree_sql(rows: str, key: str, line: str, order: tuple[str, ...]) -> str:
    """The hash tree as SQL: leaves by the MD5 of the key, then one digest over all leaves."""
    by = ", ".join(order)
    leaves = f"SELECT {key}, substr(md5(concat_ws(chr(31), {by})), 1, 3) AS leaf, sha256(string_agg({line}, '' ORDER BY {by})) AS digest FROM {rows} GROUP BY ALL"
    return f"(SELECT {key}, sha256(string_agg(leaf || ':' || digest || chr(10), '' ORDER BY leaf)) AS sha256 FROM ({leaves}) GROUP BY {key})"


@query("directory_hash", f"SELECT root, sha256, '{hashing.ALGORITHM}' AS algorithm FROM {_tree_sql('sub_files', 'root', 'relpath || chr(0) || sha256(content) || chr(10)', ('relpath',))}")
def directory_hash(t: Tables):
    return hashing.directory_hash(t.view("sub_files"))


_SPLIT_LINE = "split || chr(0) || file_name || chr(10)"


@query("split_hash", f"SELECT dataset_id, sha256 AS split_hash, '{hashing.ALGORITHM}' AS algorithm FROM {_tree_sql('orc_split_images', 'dataset_id', _SPLIT_LINE, (_SPLIT_LINE,))}")
def split_hash(t: Tables):
    return hashing.split_hash(with_split(t.view("sub_images")))


def _hash_inputs(t: Tables):
    images = with_split(t.view("sub_images"))
    files = images.select("dataset_id", F.concat("split", F.lit("/"), "file_name").alias("relpath"), (F.col("width") * F.col("height")).alias("length"))
    anns = t.view("sub_annotations").join(images.select("image_id", "dataset_id", "split"), "image_id")
    row = F.concat_ws(";", *[F.col(c).cast("bigint").cast("string") for c in ("ann_id", "image_id", "category_id", "x", "y", "w", "h")])
    return files, anns.select("dataset_id", "split", "ann_id", row.alias("row_json"))


def _both_sql(annotation: str, image: str) -> str:
    rows = """(SELECT i.dataset_id, split, ann_id, concat_ws(';', ann_id, a.image_id, category_id, x::bigint, y::bigint, w::bigint, h::bigint) AS row_json
      FROM sub_annotations a JOIN orc_split_images i ON a.image_id = i.image_id)"""
    files = "(SELECT dataset_id, split || '/' || file_name AS relpath, width * height AS length FROM orc_split_images)"
    return (f"(SELECT dataset_id, a.sha256 AS h1, i.sha256 AS h2, '{hashing.ALGORITHM}' AS algorithm FROM {_tree_sql(rows, 'dataset_id', annotation, ('split', 'ann_id'))} a "
            f"JOIN {_tree_sql(files, 'dataset_id', image, ('relpath',))} i USING (dataset_id))")


_TAGGED = _both_sql("'ANN:' || split || row_json || chr(10)", "'IMG:' || relpath || length || chr(10)")
_BARE = _both_sql("row_json", "relpath || length")


@query("dataset_hash", f"SELECT dataset_id, sha256(h1 || '|' || h2) AS dataset_hash, algorithm FROM {_TAGGED}")
def dataset_hash(t: Tables):
    return hashing.dataset_hash(*_hash_inputs(t))


@query("migration_hash", f"SELECT dataset_id, sha256(h1 || h2) AS content_hash, algorithm FROM {_BARE}")
def migration_hash(t: Tables):
    return hashing.migration_hash(*_hash_inputs(t))


def _configs(t: Tables):
    cfg = F.struct((F.col("c_custkey") % 3 * 320 + 320).cast("int").alias("crop_size"), F.lit(True).alias("include_edge_tiles"),
                   (F.lit(0.8) + (F.col("c_custkey") % 4).cast("double") * 1e-8).alias("visible_area_threshold"), F.col("c_custkey").alias("note"))
    return t.raw("customer").select("c_custkey", cfg.alias("cfg"))


@query("config_hash", """
SELECT c_custkey, sha256('{"config":{"crop_size":' || (c_custkey % 3 * 320 + 320) || ',"include_edge_tiles":true,"visible_area_threshold":0.8},"tiling_algorithm_version":1}') AS config_hash FROM customer""")
def config_hash(t: Tables):
    kinds = {"crop_size": "int", "include_edge_tiles": "boolean", "visible_area_threshold": "double"}
    return _configs(t).select("c_custkey", hashing.config_hash(F.col("cfg"), kinds).alias("config_hash"))


@query("cache_id", """
SELECT c_custkey, sha256(c_custkey::varchar)[:12] || '__' || sha256(c_mktsegment)[:12] || '__' || sha256((c_custkey % 3)::varchar)[:12] AS tile_cache_id, sha256('{"a":' || c_custkey || '}') AS config_sha FROM customer""")
def cache_id(t: Tables):
    h = lambda c: hashing.sha_text(c.cast("string"))
    k = F.col("c_custkey")
    return t.raw("customer").select("c_custkey", hashing.cache_id(h(k), h(F.col("c_mktsegment")), h(k % 3)).alias("tile_cache_id"),
                                    hashing.config_sha(F.to_json(F.struct(k.alias("a")))).alias("config_sha"))


def _wanted(t: Tables):
    h = lambda s: F.concat(F.lit(s), F.col("tile_cache_id"))
    return t.view("sub_caches").select("tile_cache_id", "created_seq", F.when(F.col("created_seq") % 10 == 0, F.lit(hashing.EMPTY_SHA256)).otherwise(h("d")).alias("dataset_hash"),
                                       h("s").alias("split_hash"), h("t").alias("tile_config_hash"))


def _meta(t: Tables):
    seq = F.col("created_seq")
    splits = F.when(seq % 7 == 0, F.array(F.lit("train"), F.lit("val"))).otherwise(F.array(F.lit("train"), F.lit("val"), F.lit("test")))
    return _wanted(t).filter(seq % 3 != 0).select(
        "tile_cache_id", "dataset_hash", F.when(seq % 11 == 0, F.lit("old")).otherwise(F.col("split_hash")).alias("split_hash"), "tile_config_hash",
        F.when(seq % 5 == 1, "building").otherwise("complete").alias("status"), F.lit(1).alias("schema_version"), F.lit(1).alias("layout_version"),
        splits.alias("splits"), F.concat(F.lit("/tiles/"), "tile_cache_id").alias("storage_path"))


@query("build_or_reuse", """
SELECT tile_cache_id, CASE WHEN created_seq % 10 = 0 THEN 'refused_empty' WHEN created_seq % 3 <> 0 AND created_seq % 5 <> 1 AND created_seq % 7 <> 0 AND created_seq % 11 <> 0 THEN 'reused' ELSE 'rebuild' END AS state FROM sub_caches""")
def build_or_reuse(t: Tables):
    return hashing.cache_state(_wanted(t), _meta(t)).select("tile_cache_id", "state")


@query("resolve_cache", "SELECT tile_cache_id, CASE WHEN created_seq % 3 <> 0 THEN '/tiles/' || tile_cache_id END AS storage_path FROM sub_caches")
def resolve_cache(t: Tables):
    return hashing.resolve_cache(_wanted(t), _meta(t)).select("tile_cache_id", "storage_path")


@query("cache_counts", """
SELECT dataset_id AS tile_cache_id, count(*) FILTER (WHERE split = 'train') AS num_train_tiles, count(*) FILTER (WHERE split = 'val') AS num_val_tiles, count(*) FILTER (WHERE split = 'test') AS num_test_tiles FROM orc_split_images GROUP BY dataset_id""")
def cache_counts(t: Tables):
    return hashing.cache_counts(with_split(t.view("sub_images")).withColumnRenamed("dataset_id", "tile_cache_id"))


# ---- retention -------------------------------------------------------------------------------------------------------

_POLICY = retention.Policy(max_age_days=30)
_NOW, _EPOCH = "1998-08-10 00:00:00", 1704240000.0
_ENRICHED = "(SELECT r.*, m AS best_metric FROM sub_runs r LEFT JOIN (SELECT run_id, max(primary_metric_value) AS m FROM sub_reports GROUP BY run_id) USING (run_id))"
_KEEP = f"""(SELECT run_id FROM (SELECT run_id FROM sub_runs ORDER BY started_at DESC NULLS LAST, run_id LIMIT 20)
UNION SELECT run_id FROM (SELECT run_id FROM {_ENRICHED} WHERE best_metric IS NOT NULL ORDER BY best_metric DESC, run_id LIMIT 5)
UNION SELECT run_id FROM sub_runs WHERE started_at >= timestamp '{_NOW}' - INTERVAL 30 DAY)"""
_KEEP_CACHES = f"""(SELECT tile_cache_id FROM sub_caches WHERE tile_cache_id IN (SELECT tile_cache_id FROM sub_runs WHERE tile_cache_id IS NOT NULL AND run_id IN {_KEEP})
UNION SELECT tile_cache_id FROM (SELECT *, row_number() OVER (PARTITION BY dataset_id ORDER BY created_seq DESC NULLS LAST, tile_cache_id) AS r FROM sub_caches
  WHERE tile_cache_id NOT IN (SELECT tile_cache_id FROM sub_runs WHERE tile_cache_id IS NOT NULL AND run_id IN {_KEEP})) WHERE r <= 3)"""


def _state(t: Tables):
    return registry.best_metric_per_run(_runs(t), t.view("sub_reports")), t.view("sub_caches"), t.view("sub_staging")


def _now():
    return F.lit(_NOW).cast("timestamp_ntz")


@query("keep_runs", f"SELECT run_id FROM {_KEEP}")
def keep_runs(t: Tables):
    return retention.keep_runs(_state(t)[0], _POLICY, _now())


@query("keep_caches", f"SELECT tile_cache_id FROM {_KEEP_CACHES}")
def keep_caches(t: Tables):
    runs, caches, _ = _state(t)
    return retention.keep_caches(caches, runs, retention.keep_runs(runs, _POLICY, _now()), _POLICY)


@query("staging_expired", f"SELECT path, mtime_epoch FROM sub_staging WHERE mtime_epoch < {_EPOCH} - 86400")
def staging_expired(t: Tables):
    return retention.staging_expired(t.view("sub_staging"), _POLICY, F.lit(_EPOCH))


_PLAN = f"""(SELECT 'run' AS kind, run_id AS id, 'not in keep-last / keep-best / max-age window' AS reason FROM sub_runs WHERE run_id NOT IN {_KEEP}
UNION ALL SELECT 'tile_cache', tile_cache_id, 'orphan: no kept run references it' FROM sub_caches WHERE tile_cache_id NOT IN {_KEEP_CACHES}
UNION ALL SELECT 'staging', path, 'older than 24h' FROM sub_staging WHERE mtime_epoch < {_EPOCH} - 86400)"""


def _plan(t: Tables):
    return retention.plan_retention(*_state(t), _POLICY, _now(), F.lit(_EPOCH))


@query("plan_retention", f"SELECT kind, id, reason FROM {_PLAN}")
def plan_retention(t: Tables):
    return _plan(t)


@query("directory_sizes", "SELECT root, count(*) AS num_files, sum(n_chars)::bigint AS bytes FROM sub_files GROUP BY root")
def directory_sizes(t: Tables):
    return retention.directory_sizes(t.view("sub_files"), "root", "n_chars")


@query("retention_summary", f"""
SELECT kind, count(*) AS planned, count(*) FILTER (WHERE length(id) % 4 = 0) AS refused, coalesce(sum(length(id) * 10) FILTER (WHERE length(id) % 4 <> 0), 0)::bigint AS freed_bytes FROM {_PLAN} GROUP BY kind""")
def retention_summary(t: Tables):
    runs, caches, staging = _state(t)
    ids = (runs.select(F.lit("run").alias("kind"), F.col("run_id").alias("id")).unionByName(caches.select(F.lit("tile_cache").alias("kind"), F.col("tile_cache_id").alias("id")))
           .unionByName(staging.select(F.lit("staging").alias("kind"), F.col("path").alias("id"))))
    root = F.when(F.length("id") % 4 == 0, "/s/datasets/raw/").otherwise("/s/datasets/raw2/")
    paths = ids.withColumn("path", F.concat(root, "kind", F.lit("/"), "id"))
    sizes = paths.select("path", (F.length("id") * 10).cast("bigint").alias("bytes"))
    return retention.retention_summary(_plan(t), paths, sizes)
