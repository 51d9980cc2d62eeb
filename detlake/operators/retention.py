"""What to keep and what to delete of runs, tile caches and staging folders (planning only, nothing is deleted)."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from detlake.functions.text import under_protected_root


class Policy(NamedTuple):
    # fixed values: default retention
    keep_last: int = 20
    keep_best: int = 5
    max_age_days: int | None = 90
    caches_per_dataset: int = 3
    staging_hours: int = 24


# fixed values
RUN_REASON = "not in keep-last / keep-best / max-age window"
CACHE_REASON = "orphan: no kept run references it"


def keep_runs(runs: DataFrame, policy: Policy, now: Column) -> DataFrame:
    """Ids of runs to keep: the last N, the best K, and those young enough (`run_id, started_at, best_metric`).

    Top-N without a group is a limit after a sort, which Spark runs as a per-task top-N.
    """
    recent = runs.orderBy(F.col("started_at").desc_nulls_last(), F.col("run_id")).limit(max(0, policy.keep_last)).select("run_id")
    best = (runs.filter(F.col("best_metric").isNotNull()).orderBy(F.col("best_metric").desc(), F.col("run_id"))
            .limit(max(0, policy.keep_best)).select("run_id"))
    out = recent.unionByName(best)
    if policy.max_age_days is not None:
        cutoff = now - F.make_dt_interval(F.lit(policy.max_age_days))
        out = out.unionByName(runs.filter(F.col("started_at") >= cutoff).select("run_id"))
    return out.distinct()


def keep_caches(caches: DataFrame, runs: DataFrame, kept: DataFrame, policy: Policy) -> DataFrame:
    """Ids of caches a kept run uses, plus the newest K unused ones of each dataset."""
    used = runs.join(kept, "run_id", "left_semi").filter(F.col("tile_cache_id").isNotNull()).select("tile_cache_id").distinct()
    newest = Window.partitionBy("dataset_id").orderBy(F.col("created_seq").desc_nulls_last(), F.col("tile_cache_id"))
    spare = caches.join(used, "tile_cache_id", "left_anti").withColumn("_r", F.row_number().over(newest))
    spare = spare.filter(F.col("_r") <= policy.caches_per_dataset).select("tile_cache_id")
    return caches.join(used, "tile_cache_id", "left_semi").select("tile_cache_id").unionByName(spare).distinct()


def staging_expired(staging: DataFrame, policy: Policy, now_epoch: Column) -> DataFrame:
    return staging.filter(F.col("mtime_epoch") < now_epoch - F.lit(policy.staging_hours * 3600))


def plan_retention(runs: DataFrame, caches: DataFrame, staging: DataFrame, policy: Policy, now: Column, now_epoch: Column) -> DataFrame:
    """`kind, id, reason` of everything to delete."""
    kept = keep_runs(runs, policy, now)
    alive = keep_caches(caches, runs, kept, policy)
    gone_runs = runs.join(kept, "run_id", "left_anti").select(F.lit("run").alias("kind"), F.col("run_id").alias("id"), F.lit(RUN_REASON).alias("reason"))
    gone_caches = caches.join(alive, "tile_cache_id", "left_anti").select(
        F.lit("tile_cache").alias("kind"), F.col("tile_cache_id").alias("id"), F.lit(CACHE_REASON).alias("reason"))
    gone_staging = staging_expired(staging, policy, now_epoch).select(
        F.lit("staging").alias("kind"), F.col("path").alias("id"), F.lit(f"older than {policy.staging_hours}h").alias("reason"))
    return gone_runs.unionByName(gone_caches).unionByName(gone_staging)


def directory_sizes(files: DataFrame, root: str = "root", length: str = "length") -> DataFrame:
    return files.groupBy(root).agg(F.count(F.lit(1)).alias("num_files"), F.sum(length).alias("bytes"))


def retention_summary(plan: DataFrame, paths: DataFrame, sizes: DataFrame) -> DataFrame:
    """Per kind: planned deletions, bytes freed, and how many are refused because they lie under the raw datasets.

    `paths`: `kind, id, path`; `sizes`: `path, bytes`.
    """
    rows = plan.join(paths, ["kind", "id"], "left").join(sizes, "path", "left")
    refused = F.coalesce(under_protected_root(F.col("path")), F.lit(False))
    return rows.groupBy("kind").agg(F.count(F.lit(1)).alias("planned"), F.count_if(refused).alias("refused"),
                                    F.sum(F.when(~refused, F.coalesce("bytes", F.lit(0))).otherwise(0)).alias("freed_bytes"))
