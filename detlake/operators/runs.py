"""Run monitoring over event tables: stage states, progress, throughput, trends, folded status.

Events: `run_id, seq, stage, status` and, where used, `message, epoch, max_epoch, iter, max_iter, loss, lr,
eta_seconds, ts`. `seq` orders the events of a run. Everything per (run, stage) is an aggregate that combines before
the shuffle; looking back inside a run goes through `ordering.look_back`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from detlake.operators.ordering import look_back

# fixed values: stages in order, and event names that stand for a stage
STAGES = ("validate_config", "init_metadata_db", "create_pipeline_run", "dcs_capture", "validate_raw_dataset", "register_dataset",
          "build_or_reuse_tile_cache", "train_yolox", "evaluate_model", "export_onnx", "export_trt_fp16", "export_trt_int8",
          "register_artifacts", "update_pipeline_run_status")
ALIASES = {"train": "train_yolox"}
TRAIN = "train_yolox"
CLEANUP = ("update_pipeline_run_status",)


def canonical_stage(stage: Column, stages: Sequence[str] = STAGES) -> Column:
    named = stage
    for alias, name in ALIASES.items():
        named = F.when(stage == alias, F.lit(name)).otherwise(named)
    return F.when(named.isin(list(stages)), named)


def latest_event_per_stage(events: DataFrame, stages: Sequence[str] = STAGES) -> DataFrame:
    known = events.select("run_id", "seq", canonical_stage(F.col("stage"), stages).alias("stage"), "status")
    known = known.filter(F.col("stage").isNotNull() & (F.coalesce("status", F.lit("")) != ""))
    return known.groupBy("run_id", "stage").agg(F.max_by("status", "seq").alias("status"))


def run_heads(events: DataFrame) -> DataFrame:
    """Overall status and current stage of runs that have no status table: those of their last event."""
    last = F.max_by(F.struct("status", canonical_stage(F.col("stage")).alias("current_stage")), "seq").alias("_l")
    return events.groupBy("run_id").agg(last).select("run_id", "_l.status", "_l.current_stage")


def stage_states(heads: DataFrame, latest: DataFrame, stages: Sequence[str] = STAGES) -> DataFrame:
    """failed / done / active / pending per run and stage, in stage order. `heads`: `run_id, status, current_stage`."""
    listed = F.array(*[F.struct(F.lit(i).alias("stage_index"), F.lit(s).alias("stage")) for i, s in enumerate(stages)])
    grid = heads.select("run_id", F.col("status").alias("_overall"), F.col("current_stage").alias("_current"), F.inline(listed))
    at = F.array_position(F.array(*[F.lit(s) for s in stages]), F.col("_current")) - 1
    rows = grid.withColumn("_at", at).join(latest.withColumnRenamed("status", "_event"), ["run_id", "stage"], "left")
    ev, overall = F.col("_event"), F.col("_overall")
    here = F.coalesce(F.col("stage") == F.col("_current"), F.lit(False))
    state = (F.when(ev == "failed", "failed").when(ev == "success", "done")
             .when(here & (overall == "failed"), "failed").when(here & (overall == "success"), "done").when(here, "active")
             .when((ev == "running") & (overall == "running"), "active")
             .when((F.col("_at") >= 0) & (F.col("stage_index") < F.col("_at")), "done").otherwise("pending"))
    return rows.select("run_id", "stage_index", "stage", state.alias("state"))


def progress_line(heads: DataFrame, events: DataFrame) -> DataFrame:
    """Latest known training figures of runs whose current stage is training; the time left is the most recent given."""
    train = events.filter(canonical_stage(F.col("stage")) == TRAIN)
    fields = [c for c in ("epoch", "max_epoch", "iter", "max_iter", "loss", "lr", "eta_seconds") if c in events.columns]
    figures = train.groupBy("run_id").agg(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("seq"))).alias(c) for c in fields])
    return heads.filter(F.col("current_stage") == TRAIN).select("run_id").join(figures, "run_id", "left")


def train_fraction(epoch: Column, max_epoch: Column, it: Column, max_iter: Column) -> Column:
    total = max_epoch * max_iter
    return F.when(total > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((epoch - 1) * max_iter + it) / total)))


def overall_progress(states: DataFrame, progress: DataFrame, stages: Sequence[str] = STAGES) -> DataFrame:
    """Percent per run: finished stages plus the running training's fraction."""
    done = states.groupBy("run_id").agg(F.count_if(F.col("state") == "done").alias("done"))
    part = progress.select("run_id", train_fraction(*[F.col(c) for c in ("epoch", "max_epoch", "iter", "max_iter")]).alias("_f"))
    pct = F.least(F.lit(100.0), (F.col("done") + F.coalesce("_f", F.lit(0.0))) / F.lit(float(len(stages))) * 100)
    return done.join(part, "run_id", "left").select("run_id", "done", pct.alias("percent"))


def throughput(events: DataFrame, seconds: Column | None = None, block_rows: int | None = None) -> DataFrame:
    """Iterations per second between successive readings of a run, where both differences are positive."""
    t = seconds if seconds is not None else F.col("ts").cast("double")
    base = events.filter(F.col("iter").isNotNull()).select("run_id", "seq", "iter", t.alias("_t"))
    options = {} if block_rows is None else {"block_rows": block_rows}
    rows = look_back(base, ["run_id"], ["seq"], 1, lambda w: {
        "_di": F.col("iter") - F.lag("iter").over(w), "_dt": F.col("_t") - F.lag("_t").over(w)}, **options)
    return rows.filter((F.col("_di") > 0) & (F.col("_dt") > 0)).select("run_id", "seq", (F.col("_di") / F.col("_dt")).alias("iters_per_second"))


def loss_trend(events: DataFrame, block_rows: int | None = None) -> DataFrame:
    """`warming` for the first four losses of a run, then `down` when below all of the four before, else `noisy`."""
    options = {} if block_rows is None else {"block_rows": block_rows}
    rows = look_back(events.filter(F.col("loss").isNotNull()).select("run_id", "seq", "loss"), ["run_id"], ["seq"], 4, lambda w: {
        "_low": F.min("loss").over(w.rowsBetween(-4, -1)), "_n": F.count("loss").over(w.rowsBetween(-4, -1))}, **options)
    trend = F.when(F.col("_n") < 4, "warming").when(F.col("loss") < F.col("_low"), "down").otherwise("noisy")
    return rows.select("run_id", "seq", "loss", trend.alias("trend"))


def last_message_per_stage(events: DataFrame) -> DataFrame:
    stage = canonical_stage(F.col("stage"))
    said = events.filter(stage.isNotNull() & (F.coalesce("message", F.lit("")) != "")).withColumn("stage", stage)
    return said.groupBy("run_id", "stage").agg(F.max_by("message", "seq").alias("message"))


def latest_run(runs: DataFrame) -> DataFrame:
    """The one run with the greatest (updated_at, mtime, name)."""
    return runs.agg(F.max_by("run_id", F.struct(F.coalesce(F.col("updated_at").cast("string"), F.lit("")), "mtime", "run_id")).alias("run_id"))


def stage_percent(current: Column, total: Column) -> Column:
    return F.when(total > 0, F.bround(F.lit(100.0) * current / total, 1))


def remaining_epochs(epoch: Column, max_epoch: Column) -> Column:
    return F.greatest(F.lit(0), max_epoch - epoch)


def fold_status(updates: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One status per run from partial updates: every (also nested, dotted) field keeps its last provided value."""
    def leaf(name: str) -> Column:
        return F.max_by(F.col(name), F.when(F.col(name).isNotNull(), F.col("seq"))).alias(name.replace(".", "_"))
    return updates.groupBy("run_id").agg(*[leaf(f) for f in fields])


def run_outcome(results: DataFrame, cleanup: Sequence[str] = CLEANUP) -> DataFrame:
    """A run succeeds unless a stage other than clean-up failed (`run_id, stage, succeeded`)."""
    fine = F.col("succeeded") | F.col("stage").isin(list(cleanup))
    return results.groupBy("run_id").agg(F.count(F.lit(1)).alias("stages"), F.count_if(~F.col("succeeded")).alias("failed_stages"),
                                         F.bool_and(fine).alias("success"))
