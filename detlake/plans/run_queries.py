"""Run monitoring queries, batch and streaming."""

from __future__ import annotations

from pyspark.sql import functions as F

from detlake.functions import text
from detlake.operators import runs
from detlake.plans.catalog import query
from detlake.plans.substrate import Tables
from detlake.session import work_folder
from detlake.sources.readers import tail
from detlake.streaming import events as live

_MAP = "CASE stage WHEN 'train' THEN 'train_yolox' ELSE stage END"
_LIST = "['" + "', '".join(runs.STAGES) + "']"


def _events(t: Tables):
    e = t.view("sub_run_events")
    seq = F.col("seq")
    return e.withColumn("message", F.when(seq % 4 == 0, F.concat(F.lit("m"), seq.cast("string")))).withColumn("epoch", (seq % 12 + 1).cast("int")).withColumn(
        "max_epoch", F.lit(12)).withColumn("max_iter", F.lit(500)).withColumn("lr", (seq % 9).cast("double") / 1000).withColumn(
        "eta_seconds", F.when(seq % 3 == 0, (seq % 10000).cast("double")))


_LATEST = f"(SELECT run_id, {_MAP} AS stage, max_by(status, seq) AS status FROM sub_run_events GROUP BY ALL)"
_HEADS = f"(SELECT run_id, max_by(status, seq) AS status, max_by({_MAP}, seq) AS current_stage FROM sub_run_events GROUP BY run_id)"
_STATES = f"""(SELECT run_id, i::int AS stage_index, stage, CASE WHEN ev = 'failed' THEN 'failed' WHEN ev = 'success' THEN 'done' WHEN stage = current_stage THEN CASE overall WHEN 'failed' THEN 'failed' WHEN 'success' THEN 'done' ELSE 'active' END
   WHEN ev = 'running' AND overall = 'running' THEN 'active' WHEN i < list_position({_LIST}, current_stage) - 1 THEN 'done' ELSE 'pending' END AS state
 FROM (SELECT h.run_id, h.status AS overall, current_stage, i, {_LIST}[i + 1] AS stage, l.status AS ev FROM {_HEADS} h CROSS JOIN range(14) r(i) LEFT JOIN {_LATEST} l ON l.run_id = h.run_id AND l.stage = {_LIST}[i + 1]))"""


@query("latest_event_per_stage", f"SELECT run_id, stage, status FROM {_LATEST}")
def latest_event_per_stage(t: Tables):
    return runs.latest_event_per_stage(t.view("sub_run_events"))


def _states(t: Tables):
    e = t.view("sub_run_events")
    return runs.stage_states(runs.run_heads(e), runs.latest_event_per_stage(e))


@query("stage_states", f"SELECT run_id, stage_index, stage, state FROM {_STATES}")
def stage_states(t: Tables):
    return _states(t)


_PROGRESS = f"""(SELECT run_id, epoch, iter, loss, eta_seconds FROM {_HEADS} JOIN (SELECT run_id, max_by((seq % 12 + 1)::int, seq) AS epoch, max_by(iter, seq) AS iter, max_by(loss, seq) FILTER (WHERE loss IS NOT NULL) AS loss,
   max_by((seq % 10000)::double, seq) FILTER (WHERE seq % 3 = 0) AS eta_seconds FROM sub_run_events WHERE stage = 'train' GROUP BY run_id) USING (run_id) WHERE current_stage = 'train_yolox')"""


@query("progress_line", f"SELECT run_id, epoch, iter, loss, eta_seconds FROM {_PROGRESS}")
def progress_line(t: Tables):
    e = _events(t)
    return runs.progress_line(runs.run_heads(e), e).select("run_id", "epoch", "iter", "loss", "eta_seconds")


@query("eta_format", f"""
SELECT run_id, coalesce(lpad((s // 3600)::varchar, 2, '0') || ':' || lpad((s % 3600 // 60)::varchar, 2, '0') || ':' || lpad((s % 60)::varchar, 2, '0'), '?') AS eta FROM (SELECT run_id, eta_seconds::bigint AS s FROM {_PROGRESS})""")
def eta_format(t: Tables):
    return progress_line(t).select("run_id", text.eta_clock(F.col("eta_seconds")).alias("eta"))


@query("overall_progress", f"""
SELECT run_id, done, least(100.0::double, (done + coalesce(f, 0)) / 14.0::double * 100) AS percent FROM (SELECT run_id, count(*) FILTER (WHERE state = 'done') AS done FROM {_STATES} GROUP BY run_id)
LEFT JOIN (SELECT run_id, least(1.0::double, greatest(0.0::double, ((epoch - 1) * 500 + iter) / 6000.0::double)) AS f FROM {_PROGRESS}) USING (run_id)""")
def overall_progress(t: Tables):
    e = _events(t)
    return runs.overall_progress(_states(t), runs.progress_line(runs.run_heads(e), e))


@query("throughput", """
SELECT run_id, seq, (iter - li) / (epoch_us(ts) - lt) * 1000000.0::double AS iters_per_second FROM (SELECT *, lag(iter) OVER w AS li, lag(epoch_us(ts)) OVER w AS lt FROM sub_run_events WINDOW w AS (PARTITION BY run_id ORDER BY seq))
WHERE iter > li AND epoch_us(ts) > lt""".replace("(iter - li) / (epoch_us(ts) - lt) * 1000000.0::double", "round((iter - li)::double / ((epoch_us(ts) - lt) / 1000000.0::double), 9)"))
def throughput(t: Tables):
    e = t.view("sub_run_events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    rows = runs.throughput(e, micros)
    return rows.select("run_id", "seq", F.round(F.col("iters_per_second") * 1e6, 9).alias("iters_per_second"))


@query("loss_trend", """
SELECT run_id, seq, loss, CASE WHEN n < 4 THEN 'warming' WHEN loss < low THEN 'down' ELSE 'noisy' END AS trend FROM (
 SELECT run_id, seq, loss, count(*) OVER w AS n, min(loss) OVER w AS low FROM sub_run_events WHERE loss IS NOT NULL WINDOW w AS (PARTITION BY run_id ORDER BY seq ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING))""")
def loss_trend(t: Tables):
    return runs.loss_trend(t.view("sub_run_events"))


@query("last_message_per_stage", f"SELECT run_id, {_MAP} AS stage, 'm' || max(seq) AS message FROM sub_run_events WHERE seq % 4 = 0 GROUP BY ALL")
def last_message_per_stage(t: Tables):
    return runs.last_message_per_stage(_events(t))


@query("latest_run", "SELECT run_id FROM sub_runs ORDER BY coalesce(started_at::varchar, '') DESC, length(run_id) DESC, run_id DESC LIMIT 1")
def latest_run(t: Tables):
    return runs.latest_run(t.view("sub_runs").select("run_id", F.col("started_at").alias("updated_at"), F.length("run_id").alias("mtime")))


@query("stage_percent", """
SELECT seq, round_even(100.0::double * iter / 500, 1) AS stage_percent, greatest(0, 12 - (seq % 15))::int AS remaining FROM sub_run_events""")
def stage_percent(t: Tables):
    seq = F.col("seq")
    return t.view("sub_run_events").select("seq", runs.stage_percent(F.col("iter"), F.lit(500)).alias("stage_percent"),
                                           runs.remaining_epochs((seq % 15).cast("int"), F.lit(12)).alias("remaining"))


@query("fold_status", """
SELECT run_id, max_by(status, seq) AS status, max_by(stage, seq) FILTER (WHERE seq % 5 = 0) AS phase, max_by(loss, seq) FILTER (WHERE loss IS NOT NULL) AS metrics_loss FROM sub_run_events GROUP BY run_id""")
def fold_status(t: Tables):
    u = t.view("sub_run_events").select("run_id", "seq", "status", F.when(F.col("seq") % 5 == 0, F.col("stage")).alias("phase"), F.struct("loss").alias("metrics"))
    return runs.fold_status(u, ["status", "phase", "metrics.loss"])


@query("run_outcome", """
SELECT run_id, count(*) AS stages, count(*) FILTER (WHERE status = 'failed') AS failed_stages, bool_and(status <> 'failed' OR stage = 'register_artifacts') AS success
FROM (SELECT run_id, stage, max_by(status, seq) AS status FROM sub_run_events GROUP BY ALL) GROUP BY run_id""")
def run_outcome(t: Tables):
    latest = t.view("sub_run_events").groupBy("run_id", "stage").agg(F.max_by("status", "seq").alias("status"))
    return runs.run_outcome(latest.withColumn("succeeded", F.col("status") != "failed"), ("register_artifacts",))


@query("tail_events", "SELECT seq, run_id, status FROM sub_run_events ORDER BY seq DESC LIMIT 25")
def tail_events(t: Tables):
    return tail(t.view("sub_run_events"), "seq", 25).select("seq", "run_id", "status")


# ---- streaming: the event table is written as a log first, then followed until used up -------------------------------

def _replay(t: Tables, df, name: str):
    """`df` as a folder of JSON lines in the shared work folder, and a stream over it."""
    root = work_folder(t.spark)
    df.write.json(f"{root}/{name}")
    return root, t.spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 64).json(f"{root}/{name}")


def _shuffled(t: Tables, df, name: str, stretches: int = 8):
    """As `_replay`, but in several batches out of order: stretches of the log are swapped in pairs, and a mark ends it. With
    the stream the lateness that covers this."""
    root = work_folder(t.spark)
    first, last = df.agg(F.min("seq"), F.max("seq")).first()
    size = ((last or 0) - (first or 0)) // stretches + 1
    for k in range(stretches):
        df.filter(F.floor((F.col("seq") - F.lit(first or 0)) / size) == (k ^ 1)).write.mode("append").json(f"{root}/{name}")
    live.mark(t.spark, (last or 0) + 4 * size, df).write.mode("append").json(f"{root}/{name}")
    files = max(1, t.spark.sparkContext.defaultParallelism)
    return root, t.spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).json(f"{root}/{name}"), 3 * size


def _seconds():
    return (F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)).alias("t")


@query("stream_stage_states", f"SELECT run_id, stage_index, stage, state FROM {_STATES}")
def stream_stage_states(t: Tables):
    root, stream = _replay(t, t.view("sub_run_events").select("run_id", "seq", "stage", "status"), "events")
    live.partials_log(stream, f"{root}/latest", live.latest_stages).awaitTermination()
    return live.live_stage_states(live.compact(t.spark, f"{root}/latest", live.merge_stages, f"{root}/compact"))


@query("stream_events", """
SELECT run_id::varchar AS run_id, stage, status, CASE WHEN seq % 3 = 0 THEN 'm' || seq END AS message, CASE WHEN seq % 5 = 0 THEN 'p' || seq END AS note FROM sub_run_events WHERE seq % 7 <> 3""")
def stream_events(t: Tables):
    """The event log as JSON lines, every seventh one torn, followed as a stream; fields inside `payload` by their path."""
    root = work_folder(t.spark)
    seq = F.col("seq")
    whole = F.to_json(F.struct(F.col("run_id").cast("string").alias("run_id"), "stage", "status", F.when(seq % 3 == 0, F.concat(F.lit("m"), seq.cast("string"))).alias("message"),
                               F.struct(F.when(seq % 5 == 0, F.concat(F.lit("p"), seq.cast("string"))).alias("note")).alias("payload")))
    t.view("sub_run_events").select(F.when(seq % 7 == 3, F.substring(whole, 1, 25)).otherwise(whole).alias("value")).write.text(f"{root}/events")
    schema = "run_id string, stage string, status string, message string, payload struct<note:string>"
    live.to_change_log(live.stream_events(t.spark, f"{root}/events", schema), f"{root}/log", "append").awaitTermination()
    return live.read_log(t.spark, f"{root}/log").select("run_id", "stage", "status", "message", F.col("payload.note").alias("note"))


# a fold over each run's events in order; the state is the time of the last one kept
@query("throttle_progress", """
WITH l AS (SELECT run_id, list({seq: seq, iter: iter, t: epoch_us(ts) / 1000000.0::double} ORDER BY seq) AS l FROM sub_run_events WHERE iter IS NOT NULL GROUP BY run_id),
k AS (SELECT run_id, unnest(list_reduce(list_prepend({e: l[1], last: '-infinity'::double, kept: l[1:0]}, list_transform(l, lambda e: {e: e, last: 0::double, kept: l[1:0]})),
  lambda s, x: CASE WHEN x.e.iter % 50 = 0 OR x.e.t - s.last >= 259200 THEN {e: x.e, last: x.e.t, kept: s.kept || [x.e]} ELSE {e: x.e, last: s.last, kept: s.kept} END).kept) AS k FROM l)
SELECT run_id, k.seq AS seq, k.iter::bigint AS iter, k.t AS t FROM k""")
def throttle_progress(t: Tables):
    root, stream, lateness = _shuffled(t, t.view("sub_run_events").select("run_id", "seq", "iter", _seconds()), "events")
    live.to_change_log(live.throttle_progress(stream, 50, 86400.0 * 3, lateness), f"{root}/kept", "append").awaitTermination()
    return live.read_log(t.spark, f"{root}/kept").drop("batch")


@query("stream_throughput", """
SELECT run_id, seq, round((iter - li)::double / (epoch_us(ts) / 1000000.0::double - lt), 6) AS iters_per_second FROM (SELECT *, lag(iter) OVER w AS li, lag(epoch_us(ts) / 1000000.0::double) OVER w AS lt FROM sub_run_events WINDOW w AS (PARTITION BY run_id ORDER BY seq))
WHERE iter > li AND epoch_us(ts) / 1000000.0::double > lt""")
def stream_throughput(t: Tables):
    root, stream, lateness = _shuffled(t, t.view("sub_run_events").select("run_id", "seq", "iter", _seconds()), "events")
    live.to_change_log(live.stream_throughput(stream, lateness), f"{root}/rates", "append").awaitTermination()
    return live.read_log(t.spark, f"{root}/rates").select("run_id", "seq", F.round("iters_per_second", 6).alias("iters_per_second"))


@query("stream_status", """
SELECT run_id, max_by(status, seq) FILTER (WHERE status IS NOT NULL) AS status, max_by(phase, seq) FILTER (WHERE phase IS NOT NULL) AS phase, max_by(loss, seq) FILTER (WHERE loss IS NOT NULL) AS loss,
  min_by(epoch_us(ts), seq) FILTER (WHERE status = 'success') AS finished_us FROM sub_updates WHERE status IS NULL OR status <> 'lost' GROUP BY run_id""")
def stream_status(t: Tables):
    root, stream = _replay(t, t.view("sub_updates").withColumn("ts", F.unix_micros(F.col("ts").cast("timestamp"))), "updates")
    fields = ["phase", "loss"]
    live.partials_log(stream, f"{root}/status", lambda batch: live.status_parts(batch, fields)).awaitTermination()
    return live.merge_status(live.read_log(t.spark, f"{root}/status"), fields).withColumnRenamed("finished_at", "finished_us")


@query("ingest_commands", """
SELECT concat('c', lpad(c_custkey::varchar, 8, '0'), '.command.json') AS file_name, c_custkey % 6 >= 2 AS accepted,
  CASE c_custkey % 6 WHEN 0 THEN 'malformed' WHEN 1 THEN 'missing: dataset_id, mission_path' END AS problem, CASE WHEN c_custkey % 6 >= 2 THEN 'run_' || c_custkey END AS run_id FROM customer""")
def ingest_commands(t: Tables):
    k = F.col("c_custkey")
    rest = '"dcs_config_path":"c","dcs_source_dataset_dir":"s","target_dataset_dir":"t"}'
    doc = F.concat(F.lit('{"run_id":"run_'), k.cast("string"), F.when(k % 6 == 1, '",').otherwise('","dataset_id":"d","mission_path":"m",'), F.lit(rest))
    files = t.raw("customer").select(F.concat(F.lit("c"), F.lpad(k.cast("string"), 8, "0"), F.lit(".command.json")).alias("file_name"),
                                     F.when(k % 6 == 0, F.lit('{"run_id": ')).otherwise(doc).alias("text"))
    root, stream = _replay(t, files, "commands")
    live.ingest_commands(stream, f"{root}/judged").awaitTermination()
    out = live.read_log(t.spark, f"{root}/judged")
    return out.select("file_name", "accepted", "problem", F.when(F.col("accepted"), F.col("command.run_id")).alias("run_id"))
