"""Live run monitoring. Results go to a change log of idempotent batch folders. Latest stages and merged statuses are folds of
each batch that are folded again on reading, without state; readings that depend on the one before wait in state until the
watermark has passed them, so batches and file order change nothing."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from detlake.operators.runs import STAGES, canonical_stage, run_heads, stage_states
from detlake.schemas import COMMAND, EVENT, STATUSES

TERMINAL = ("success", "failed", "stopped")
# fixed values: fields a command must have
COMMAND_FIELDS = ("run_id", "dataset_id", "mission_path", "dcs_config_path", "dcs_source_dataset_dir", "target_dataset_dir")
# default size of one micro-batch, which bounds what a single run can bring into one task
BATCH_BYTES = 256 * 1024 * 1024
# how many positions behind the newest one a row of the log may come
LATENESS = 100_000


def stream_events(spark: SparkSession, path: str, schema: str = EVENT, max_bytes: int = BATCH_BYTES) -> DataFrame:
    """Follow a folder of JSON-lines files; undecodable lines are dropped."""
    lines = spark.readStream.option("maxBytesPerTrigger", max_bytes).text(path).filter(F.trim("value") != "")
    parsed = lines.select(F.from_json("value", f"{schema}, _corrupt_record string").alias("_r"))
    return parsed.filter(F.col("_r").isNotNull() & F.col("_r._corrupt_record").isNull()).select("_r.*").drop("_corrupt_record")


def to_change_log(df: DataFrame, target: str, mode: str = "update", order: Sequence[str] = ()) -> StreamingQuery:
    """Run until the available input is used up. A repeated batch overwrites its own folder, so retries change nothing."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.orderBy(*order) if order else batch
        rows.write.mode("overwrite").parquet(f"{target}/rows/batch={batch_id}")

    return (df.writeStream.outputMode(mode).option("checkpointLocation", f"{target}/progress").trigger(availableNow=True)
            .foreachBatch(write).start())


def read_log(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(f"{target}/rows")


def newest(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    rest = [c for c in log.columns if c not in keys and c != "batch"]
    return log.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_n")).select(*keys, "_n.*")


def partials_log(df: DataFrame, target: str, fold: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Run until the available input is used up, each batch folded on its own and added to the change log. Folds of folds are
    the result (`merge_stages`, `merge_status`), so no state is kept between batches: nothing has to expire when runs end, and
    rows may come late by any time. A repeated batch overwrites its own folder."""
    def write(batch: DataFrame, batch_id: int) -> None:
        fold(batch).write.mode("overwrite").parquet(f"{target}/rows/batch={batch_id}")

    return df.writeStream.outputMode("append").option("checkpointLocation", f"{target}/progress").trigger(availableNow=True).foreachBatch(write).start()


def compact(spark: SparkSession, target: str, fold: Callable[[DataFrame], DataFrame], into: str) -> DataFrame:
    """The log folded into one table in a folder of its own, so that readers of a long log need not fold all its batches."""
    fold(read_log(spark, target).drop("batch")).write.mode("overwrite").parquet(into)
    return spark.read.parquet(into)


def latest_stages(events: DataFrame) -> DataFrame:
    """Latest status per (run, stage) of some events, with its position: a fold that `merge_stages` folds on."""
    known = events.withColumn("stage", canonical_stage(F.col("stage")))
    return merge_stages(known.filter(F.col("stage").isNotNull() & (F.coalesce("status", F.lit("")) != "")))


def merge_stages(rows: DataFrame) -> DataFrame:
    return rows.groupBy("run_id", "stage").agg(F.max_by("status", "seq").alias("status"), F.max("seq").alias("seq"))


def live_stage_states(latest: DataFrame, stages: Sequence[str] = STAGES) -> DataFrame:
    """Stage states from the newest (run, stage, status, seq) rows."""
    return stage_states(run_heads(latest), latest.select("run_id", "stage", "status"), stages)


class InOrder(StatefulProcessor):
    """Readings in order of `seq`, across batches. A key is a bucket of runs, so that a call, a value of state and a fold serve many
    rows at once. Rows wait in state, a block of positions a value, until the watermark has passed them; then a fold takes what
    the bucket has, in order. One timer a bucket stands at its earliest waiting row; with no row left only the fold's memory of
    its runs stays."""

    def __init__(self, fold: Callable[[pd.DataFrame, dict], pd.DataFrame], memory: pa.Schema, block: int):
        self.fold, self.memory, self.block = fold, memory, block

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "block bigint", "first bigint, rows binary")
        self.last = handle.getValueState("last", "runs binary")

    def _release(self, new: pd.DataFrame, watermark: int) -> Iterator[pd.DataFrame]:
        """Fold what the watermark has passed; the rest waits."""
        newest = watermark // 1000 - 1  # the last position it has passed
        first = {k[0]: v[0] for k, v in self.waiting.iterator()}
        ready = [new[new["seq"] <= newest]]
        rest = {block: [rows] for block, rows in new[new["seq"] > newest].groupby(new["seq"] // self.block)}
        for block in {*rest, *(k for k, seq in first.items() if seq <= newest)}:
            known = _unpacked(self.waiting.getValue((block,))[1]).to_pandas() if block in first else _NONE
            ready.append(known[known["seq"] <= newest])
            rows = pd.concat([known[known["seq"] > newest], *rest.get(block, [])])
            if len(rows):
                first[block] = int(rows["seq"].min())
                self.waiting.updateValue((block,), (first[block], _packed(pa.RecordBatch.from_pandas(rows, READINGS, preserve_index=False))))
            else:
                del first[block]
                self.waiting.removeKey((block,))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if first:
            self.handle.registerTimer(_millis(min(first.values())))
        rows = pd.concat(ready).sort_values("seq", ignore_index=True)
        if len(rows):
            memory = self._remembered()
            out = self.fold(rows, memory)
            self.last.update((_packed(pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip([list(memory), *zip(*memory.values())], self.memory)], schema=self.memory)),))
            yield out

    def _remembered(self) -> dict:
        if not self.last.exists():
            return {}
        runs, *values = _unpacked(self.last.get()[0]).to_pydict().values()
        return dict(zip(runs, zip(*values)))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        if key[0] < 0:  # marks of progress, which only move the watermark
            return
        new = pd.concat([part[READINGS.names] for part in rows]).astype({"seq": "int64", "iter": "int64", "t": "float64"})
        yield from self._release(new, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._release(_NONE, timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


READING = "seq bigint, iter bigint, t double"
READINGS = pa.schema([("run_id", pa.string()), ("seq", pa.int64()), ("iter", pa.int64()), ("t", pa.float64())])
_NONE = READINGS.empty_table().to_pandas()
# buckets of runs; part of the state, so a running query keeps their number
BUCKETS = 256
# blocks of waiting rows over the lateness
BLOCKS = 8


def _packed(rows: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write_batch(rows)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(bytes(data)).read_all()


def _millis(seq: int) -> int:
    """Event time of a position of the log: a second a position, from 1 on."""
    return (seq + 1) * 1000


def _ordered(events: DataFrame, fold, memory: dict[str, pa.DataType], columns: str, lateness: int) -> DataFrame:
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    run = events.schema["run_id"].dataType.simpleString()
    typed = events.select("run_id", F.col("seq").cast("bigint"), F.col("iter").cast("bigint"), F.col("t").cast("double"),
                          F.timestamp_seconds(F.col("seq") + 1).alias("at")).withWatermark("at", f"{lateness} seconds")
    # the condition names the event time, so that rows without a reading move the watermark before they go
    rows = typed.filter(F.col("at").isNotNull() & F.col("iter").isNotNull() | F.col("run_id").isNull())
    # runs are text: beside a mark, which has none, pandas would turn whole numbers into floats, and those name no state
    rows = rows.withColumn("run_id", F.col("run_id").cast("string"))
    bucket = F.when(F.col("run_id").isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64("run_id"), F.lit(BUCKETS)).cast("int"))
    keyed = rows.withColumn("bucket", bucket).groupBy("bucket")
    processor = InOrder(fold, pa.schema([("run_id", pa.string()), *memory.items()]), max(1, lateness // BLOCKS))
    out = keyed.transformWithStateInPandas(processor, f"run_id string, {columns}", "Append", "EventTime")
    return out.withColumn("run_id", F.col("run_id").cast(run))


def mark(spark: SparkSession, seq: int, like: DataFrame) -> DataFrame:
    """A row of no run that says the log has reached `seq`; it lets waiting rows go that nothing else would follow."""
    values = {"seq": F.lit(seq)}
    return spark.range(1).select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in like.schema])


def _throttle(every: int, seconds: float):
    def fold(rows: pd.DataFrame, memory: dict) -> pd.DataFrame:
        out, none = [], (float("-inf"),)
        for i, (run, it, t) in enumerate(zip(rows["run_id"].tolist(), rows["iter"].tolist(), rows["t"].tolist())):
            if it % every == 0 or t - memory.get(run, none)[0] >= seconds:
                memory[run] = (t,)
                out.append(i)
        return rows.loc[out, ["run_id", "seq", "iter", "t"]]
    return fold


def throttle_progress(events: DataFrame, every: int, seconds: float, lateness: int = LATENESS) -> DataFrame:
    """Progress events worth logging: every n-th iteration, or when long enough since the last one that was logged.

    Events: `run_id, seq, iter, t` (seconds); they may come up to `lateness` positions behind the newest one and are judged in
    order of `seq` whatever the batches. Rows behind that are late and dropped (`numRowsDroppedByWatermark` counts them). State
    of a bucket of runs: rows that still wait, and the time of each run's last logged event.
    """
    return _ordered(events, _throttle(every, seconds), {"last": pa.float64()}, READING, lateness).select("run_id", "seq", "iter", "t")


def _rates(rows: pd.DataFrame, memory: dict) -> pd.DataFrame:
    runs, names = pd.factorize(rows["run_id"])
    order = np.argsort(runs, kind="stable")
    runs, seq, it, t = runs[order], *[rows[c].to_numpy()[order] for c in ("seq", "iter", "t")]
    head = np.append(True, runs[1:] != runs[:-1])
    known = [memory.get(n, (0, float("nan"))) for n in names]
    was_it, was_t = np.roll(it, 1), np.roll(t, 1)
    was_it[head], was_t[head] = [k[0] for k in known], [k[1] for k in known]
    last = np.append(head[1:], True)
    memory.update(zip(names, zip(it[last].tolist(), t[last].tolist())))
    d_it, d_t = it - was_it, t - was_t
    ok = (d_it > 0) & (d_t > 0)
    return pd.DataFrame({"run_id": np.asarray(names, object)[runs[ok]], "seq": seq[ok], "iters_per_second": d_it[ok] / d_t[ok]})


def stream_throughput(events: DataFrame, lateness: int = LATENESS) -> DataFrame:
    """Iterations per second between successive readings of a run, in order of `seq` as in `throttle_progress`; state is what
    waits and the last reading."""
    return _ordered(events, _rates, {"iter": pa.int64(), "t": pa.float64()}, "seq bigint, iters_per_second double", lateness).select("run_id", "seq", "iters_per_second")


def valid_status(status: Column) -> Column:
    return status.isNull() | status.isin(list(STATUSES))


def status_parts(updates: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One partial status per run: for each field its last value that is not null, with its position, and the first end.

    `updates` has `run_id, seq, ts, status` and `fields`; rows with an unknown status are rejected."""
    def last(name: str) -> Column:
        return F.max(F.when(F.col(name).isNotNull(), F.struct("seq", F.col(name).alias("value")))).alias(name)

    ended = F.min(F.when(F.col("status").isin(list(TERMINAL)), F.struct("seq", F.col("ts").alias("value")))).alias("finished_at")
    return updates.filter(valid_status(F.col("status"))).groupBy("run_id").agg(last("status"), *[last(f) for f in fields], ended)


def merge_parts(parts: DataFrame, fields: Sequence[str]) -> DataFrame:
    return parts.groupBy("run_id").agg(*[F.max(c).alias(c) for c in ("status", *fields)], F.min("finished_at").alias("finished_at"))


def merge_status(parts: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One merged status per run: nulls never overwrite; the first terminal update stamps `finished_at`."""
    merged = merge_parts(parts, fields)
    return merged.select("run_id", *[F.col(c)["value"].alias(c) for c in ("status", *fields, "finished_at")])


def judge_commands(files: DataFrame) -> DataFrame:
    """Command documents (`file_name, text`) with `accepted` and, if not, `problem`; parsed fields in `command`."""
    parsed = files.withColumn("command", F.from_json("text", COMMAND, {"mode": "PERMISSIVE"}))
    broken = F.try_parse_json("text").isNull()
    missing = F.array_compact(F.array(*[F.when(F.get_json_object("text", f"$.{f}").isNull(), F.lit(f)) for f in COMMAND_FIELDS]))
    problem = F.when(broken, F.lit("malformed")).when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ", ")))
    return parsed.withColumn("problem", problem).withColumn("accepted", problem.isNull())


def stream_command_files(spark: SparkSession, path: str) -> DataFrame:
    """Each new `*.command.json` once, as `file_name, text`."""
    files = spark.readStream.option("pathGlobFilter", "*.command.json").text(path, wholetext=True)
    return files.select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("text"))


def ingest_commands(files: DataFrame, target: str) -> StreamingQuery:
    """Accepted and quarantined commands to the change log, each batch in file name order."""
    return to_change_log(judge_commands(files), target, "append", ["file_name"])
