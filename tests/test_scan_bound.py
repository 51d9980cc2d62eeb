"""What one task scans stays the same however large a table is."""

from pyspark.sql import functions as F

from detlake.operators import quality
from detlake.session import apply_runtime


def test_scans_are_cut_by_size(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        apply_runtime(spark)
        spark.range(0, 3_000_000, 1, 1).select(F.rand(1).alias("x")).write.option("parquet.block.size", 1 << 20).parquet(path)
        assert spark.read.parquet(path).rdd.getNumPartitions() >= 3
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")


def test_annotations_do_not_meet_by_category(spark):
    """A dataset has few categories, so a task would hold a share of all annotations: they are looked up where they lie."""
    apply_runtime(spark)
    images = spark.createDataFrame([(1,)], "image_id long")
    notes = spark.createDataFrame([(1, 1, 0), (2, 1, 7), (3, 2, 0), (4, 2, 7), (5, None, 7), (6, 1, None)], "ann_id long, image_id long, category_id int")
    notes = notes.withColumn("bbox", F.array(*[F.lit(1.0)] * 4))
    lost = quality.dangling_refs(notes, images, spark.createDataFrame([(0,), (0,), (1,)], "category_id int"))
    assert sorted((r["location"], r["message"]) for r in lost.collect()) == [
        ("annotations[2]", "category_id 7 not in categories"), ("annotations[3]", "image_id 2 not in images"),
        ("annotations[4]", "category_id 7 not in categories"), ("annotations[4]", "image_id 2 not in images")]
    plan = lost._jdf.queryExecution().sparkPlan().toString().split("\n")
    assert [line for line in plan if "BroadcastHashJoin" in line and "category_id" in line]
