"""Registry tables: upserts, unique inserts, patches, foreign keys, listings and run identifiers.

A registry table is a DataFrame; writing operators return the new table, `sinks.publish` stores it. Bulk throughout.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from detlake.functions.text import RUN_ID, checkpoint_epoch, checkpoint_kind, file_name, uid
from detlake.schemas import FOREIGN_KEYS, PRIMARY_KEYS

TERMINAL = ("success", "failed", "stopped")


class IntegrityError(ValueError):
    pass


def _once(rows: DataFrame, keys: Sequence[str]) -> None:
    """Raise for a key that comes twice."""
    twice = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).limit(1).collect()
    if twice:
        raise IntegrityError(f"duplicate key {tuple(twice[0])[:len(keys)]}")


def upsert(table: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Table with changed rows replaced as a whole. `order` ranks several changes of one key, the last one wins; the
    winner is an aggregate, so a key with very many changes combines before the shuffle. Without `order` a key that comes
    twice is an error."""
    keys = list(keys)
    rest = [c for c in table.columns if c not in keys]
    latest = changes
    if not order:
        _once(changes, keys)
    else:
        best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
        latest = changes.groupBy(*keys).agg(best).select(*keys, "_row.*")
    kept = table.join(latest.select(*keys), keys, "left_anti")
    return kept.unionByName(latest.select(*table.columns))


replace_rows = upsert


def insert_unique(table: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Append; a key that exists already, or twice among the new rows, is an error."""
    clash = rows.join(table.select(*keys), list(keys), "left_semi").select(*keys).limit(1).collect()
    if clash:
        raise IntegrityError(f"duplicate key {tuple(clash[0])[:len(keys)]}")
    _once(rows, keys)
    return table.unionByName(rows.select(*table.columns))


def key_clashes(table: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of `rows` that cannot be inserted, as a report instead of an error."""
    return rows.join(table.select(*keys).distinct(), list(keys), "left_semi").select(*keys).distinct()


def patch(table: DataFrame, changes: DataFrame, key: str, columns: Sequence[str], strict: bool = True) -> DataFrame:
    """Overwrite only the columns a change provides (not null). A change for an unknown key is an error.

    A key with two changes is an error. Null cannot be set.
    """
    _once(changes, [key])
    if strict:
        lost = changes.join(table.select(key), key, "left_anti").select(key).limit(1).collect()
        if lost:
            raise KeyError(f"no row with {key}={lost[0][0]!r}")
    new = changes.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    out = table.join(new, key, "left")
    return out.select(*[F.coalesce(f"_{c}", c).alias(c) if c in columns else F.col(c) for c in table.columns])


def fk_violations(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose reference exists nowhere; null references are fine."""
    keys = parent.select(F.col(key).alias(column)).distinct()
    return child.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")


def fk_check(tables: Mapping[str, DataFrame]) -> None:
    """Raise on the first violation of the registry's foreign keys among the given tables."""
    for child, column, parent, key in FOREIGN_KEYS:
        if child in tables and parent in tables:
            bad = fk_violations(tables[child], column, tables[parent], key).select(column).limit(1).collect()
            if bad:
                raise IntegrityError(f"{child}.{column}={bad[0][0]!r} not in {parent}")


def delete_by_key(table: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return table.filter(~F.col(column).isin(list(values)) | F.col(column).isNull())


def get_by_id(table: DataFrame, name: str, value: str) -> DataFrame:
    return table.filter(F.col(PRIMARY_KEYS[name]) == value)


def images_by_split(images: DataFrame, dataset_id: str, split: str | None = None) -> DataFrame:
    out = images.filter(F.col("dataset_id") == dataset_id)
    return (out.filter(F.col("split") == split) if split else out).orderBy("image_id")


def annotations_by_image(annotations: DataFrame, image_id: str) -> DataFrame:
    return annotations.filter(F.col("image_id") == image_id).orderBy("annotation_id")


# fixed values: listing order per table
LISTING = {"datasets": ("created_at", "dataset_id"), "pipeline_runs": ("started_at", "run_id"), "tile_caches": ("created_at", "tile_cache_id"),
           "artifacts": ("created_at", "artifact_id"), "model_checkpoints": ("epoch", "checkpoint_id"),
           "evaluation_reports": ("created_at", "report_id")}


def listing(table: DataFrame, name: str, run_id: str | None = None) -> DataFrame:
    """Ordered listing, nulls first; optionally of one run."""
    rows = table.filter(F.col("run_id") == run_id) if run_id is not None else table
    return rows.orderBy(*[F.col(c).asc_nulls_first() for c in LISTING[name]])


def add_columns(table: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add missing columns as nulls; existing ones stay as they are."""
    have = set(table.columns)
    return table.select("*", *[F.lit(None).cast(t).alias(n) for n, t in columns.items() if n not in have])


def register_dataset(tables: Mapping[str, DataFrame], dataset: DataFrame, image_rows: DataFrame, annotation_rows: DataFrame,
                     replace: bool = False) -> tuple[dict[str, DataFrame], DataFrame]:
    """(new datasets/images/annotations tables, counts per dataset and split)."""
    images, annotations = tables["images"], tables["annotations"]
    if replace:
        ids = dataset.select("dataset_id").distinct()
        images, annotations = images.join(ids, "dataset_id", "left_anti"), annotations.join(ids, "dataset_id", "left_anti")
    out = {
        "datasets": upsert(tables["datasets"], dataset, ["dataset_id"]),
        "images": insert_unique(images, image_rows, ["image_id"]),
        "annotations": insert_unique(annotations, annotation_rows, ["annotation_id"]),
    }
    per = image_rows.groupBy("dataset_id", "split").agg(F.count(F.lit(1)).alias("num_images"))
    ann = annotation_rows.groupBy("dataset_id", F.element_at(F.split("annotation_id", ":"), -3).alias("split")).agg(
        F.count(F.lit(1)).alias("num_annotations"))
    summary = per.join(ann, ["dataset_id", "split"], "left").withColumn("num_annotations", F.coalesce("num_annotations", F.lit(0)))
    return out, summary


def classify_artifacts(files: DataFrame) -> DataFrame:
    """Files (`run_id, area, path, sha256, modified_at`) to registry kinds. `area` is the top folder: checkpoints,
    reports, exports or visualizations; other files and suffixes are not registered."""
    name = file_name(F.col("path"))
    area = F.col("area")
    kind = (F.when((area == "checkpoints") & name.endswith(".pth"), "checkpoint")
            .when((area == "reports") & name.rlike(r"\.(json|csv|png|jsonl)$"), "report_file")
            .when(area == "exports", "export").when(area == "visualizations", "visualization"))
    rows = files.withColumn("name", name).withColumn("artifact_type", kind).filter(F.col("artifact_type").isNotNull())
    ck = F.col("artifact_type") == "checkpoint"
    rid = F.when(ck, uid(F.col("run_id"), F.col("name"))).otherwise(uid(F.col("run_id"), F.col("artifact_type"), F.col("name")))
    return rows.withColumn("registry_id", rid).withColumn("checkpoint_type", F.when(ck, checkpoint_kind(F.col("name")))).withColumn(
        "epoch", F.when(ck, checkpoint_epoch(F.col("name"))))


def register_artifacts(files: DataFrame, summaries: DataFrame) -> dict[str, DataFrame]:
    """Registry rows of checkpoints, reports and artifacts. `summaries` has `run_id, map50, map5095, metrics_path,
    report_path, created_at` of the runs that have a report."""
    rows = classify_artifacts(files)
    ck = F.col("artifact_type") == "checkpoint"
    metric = summaries.select("run_id", F.col("map5095").cast("double").alias("metric_value"), F.lit("ap50_95").alias("metric_name"))
    checkpoints = rows.filter(ck).join(metric, "run_id", "left").select(
        F.col("registry_id").alias("checkpoint_id"), "run_id", "checkpoint_type", "epoch", "metric_name", "metric_value",
        F.col("path").alias("storage_path"), F.col("modified_at").alias("created_at"))
    artifacts = rows.filter(~ck).select(F.col("registry_id").alias("artifact_id"), "run_id", "artifact_type",
                                        F.col("path").alias("storage_path"), F.col("modified_at").alias("created_at"),
                                        F.col("sha256").alias("content_hash"))
    reports = summaries.select(
        uid(F.col("run_id"), "report").alias("report_id"), "run_id", F.lit(None).cast("string").alias("checkpoint_id"),
        F.coalesce("metrics_path", "report_path").alias("metrics_path"), "report_path", "created_at",
        F.when(F.col("map50").isNotNull(), "mAP@50").alias("primary_metric_name"), F.col("map50").cast("double").alias("primary_metric_value"))
    return {"model_checkpoints": checkpoints, "artifacts": artifacts, "evaluation_reports": reports}


def create_runs(runs: DataFrame, wanted: DataFrame, datasets: DataFrame, replace: bool = False) -> DataFrame:
    """Runs table with the wanted runs: existing ones stay unless `replace`; unknown dataset ids become null."""
    known = datasets.select("dataset_id").distinct().withColumn("_known", F.lit(True))
    linked = wanted.join(known, "dataset_id", "left").withColumn("dataset_id", F.when(F.col("_known"), F.col("dataset_id")))
    fresh = linked.select(*[F.col(c) if c in wanted.columns else F.lit(None).cast(t).alias(c) for c, t in runs.dtypes])
    if replace:
        return upsert(runs, fresh, ["run_id"])
    return runs.unionByName(fresh.join(runs.select("run_id"), "run_id", "left_anti").select(*runs.columns))


def close_runs(runs: DataFrame, changes: DataFrame, now: Column, stamp: bool = True) -> DataFrame:
    """Patch `status` and `error`; terminal states get `finished_at` when asked and not given."""
    done = F.col("status").isin(list(TERMINAL))
    given = F.col("finished_at") if "finished_at" in changes.columns else F.lit(None).cast("timestamp")
    stamped = changes.withColumn("finished_at", F.coalesce(given, F.when(done & F.lit(stamp), now)))
    if "error" not in stamped.columns:
        stamped = stamped.withColumn("error", F.lit(None).cast("string"))
    return patch(runs, stamped, "run_id", ["status", "finished_at", "error"])


def next_run_id(runs: DataFrame, today: date) -> DataFrame:
    """One row: the smallest unused identifier of the day, null when all 999 are used."""
    prefix = today.strftime("%Y_%m_%d")
    used = runs.filter(F.col("run_id").startswith(prefix + "_") & F.col("run_id").rlike(RUN_ID)).select(
        F.element_at(F.split("run_id", "_"), -1).cast("int").alias("n")).distinct()
    free = runs.sparkSession.range(1, 1000).select(F.col("id").cast("int").alias("n")).join(used, "n", "left_anti")
    return free.agg(F.min("n").alias("n")).select(
        F.when(F.col("n").isNotNull(), F.format_string(prefix + "_%03d", "n")).alias("run_id"))


def best_metric_per_run(runs: DataFrame, reports: DataFrame) -> DataFrame:
    best = reports.groupBy("run_id").agg(F.max("primary_metric_value").alias("best_metric"))
    return runs.join(best, "run_id", "left")


def _leaves(schema: T.StructType, prefix: str) -> list[tuple[str, Column]]:
    out = []
    for f in schema.fields:
        path = f"{prefix}.{f.name}" if prefix else f.name
        if isinstance(f.dataType, T.StructType):
            out += _leaves(f.dataType, path)
        elif isinstance(f.dataType, T.ArrayType):
            out.append((path, F.array_join(F.transform(F.col(path), lambda v: v.cast("string")), ",")))
        else:
            out.append((path, F.col(path).cast("string")))
    return out


def flatten_params(df: DataFrame, key: str, column: str) -> DataFrame:
    """Nested settings (a struct column) to `key, param, value` rows with dotted names; lists are comma-joined, absent
    values give no row."""
    leaves = _leaves(df.schema[column].dataType, column)
    cut = len(column) + 1
    pairs = F.array(*[F.struct(F.lit(n[cut:]).alias("param"), c.alias("value")) for n, c in leaves])
    return df.select(key, F.inline(pairs)).filter(F.col("value").isNotNull())


def log_metrics(df: DataFrame) -> DataFrame:
    """`run_id, name, step, value` rows whose value is a number."""
    number = F.col("value").try_cast("double")
    return df.withColumn("value", number).filter(number.isNotNull())
