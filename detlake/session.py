"""Session defaults and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# settings every query relies on, also changeable in a running session
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    # the JVM never compiles methods above 8000 bytes of bytecode; wide arithmetic then runs faster without whole-stage
    # code, split into small methods (12x on the corner projection)
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # file sizes say little of rows that generators multiply or texts that lengthen them: only measured sizes choose a broadcast
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    # generators make ten rows of one after a shuffle, so tasks start from little
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4MB",
    # a scan counts keys before it shuffles, so what one task scans must not grow with the table
    "spark.sql.files.maxPartitionBytes": "8MB",
}
# rows of the largest table to one partition of a shuffle, before small ones are joined
PARTITION_ROWS = 50_000
DEFAULTS = {
    **RUNTIME,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of finished rounds go away with their DataFrames
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(app: str = "detlake", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_runtime(spark: SparkSession) -> None:
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)


def spread(spark: SparkSession, rows: int) -> None:
    """Shuffles start with so many partitions that a task's share stays the same however many rows the largest table has."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(max(least, rows // PARTITION_ROWS)))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder of the session; a private one only in local mode where none is set."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return configured


def durable(df: DataFrame) -> DataFrame:
    """Materialise in the checkpoint folder: survives executor loss and pins non-deterministic values."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """As `durable`, for tables of many rows: compressed columns in the shared folder, a fraction of a checkpoint's bytes. The files
    stay as long as the folder."""
    folder = f"{work_folder(df.sparkSession)}/table"
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.parquet(folder)


def work_folder(spark: SparkSession) -> str:
    """A new folder in the shared checkpoint folder, for tables and stream progress of one job."""
    return f"{ensure_checkpoint_dir(spark)}/work-{uuid.uuid4().hex}"
