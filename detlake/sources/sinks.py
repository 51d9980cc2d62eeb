"""Writers. Tables are the product; single JSON documents are explicit exports at the edge."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from detlake.schemas import PARTITIONS, REGISTRY

#: folders of a label table
LABEL_PARTS = 256

def _path(spark: SparkSession, text: str):
    return spark._jvm.org.apache.hadoop.fs.Path(text)


def _fs(spark: SparkSession, text: str):
    return _path(spark, text).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def publish(df: DataFrame, target: str, partition_by: list[str] | None = None) -> None:
    """Replace a table by a new version: write beside it, then swap by rename, so the old one may be an input and a
    failed write leaves it untouched."""
    spark = df.sparkSession
    building, old = target.rstrip("/") + ".building", target.rstrip("/") + ".old"
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(building)
    fs = _fs(spark, target)
    fs.delete(_path(spark, old), True)
    if exists(spark, target) and not fs.rename(_path(spark, target), _path(spark, old)):
        raise OSError(f"cannot move {target} aside")
    if not fs.rename(_path(spark, building), _path(spark, target)):
        raise OSError(f"cannot publish {target}")
    fs.delete(_path(spark, old), True)


def publish_registry(df: DataFrame, root: str, name: str) -> None:
    publish(df, f"{root}/{name}", PARTITIONS.get(name))


def init_registry(spark: SparkSession, root: str) -> list[str]:
    """Create the missing registry tables; existing ones are left alone."""
    made = [n for n in REGISTRY if not exists(spark, f"{root}/{n}")]
    for name in made:
        spark.createDataFrame([], REGISTRY[name]).write.parquet(f"{root}/{name}")
    return made


def materialize_once(spark: SparkSession, target: str, build: Callable[[], DataFrame], partition_by: list[str] | None = None) -> tuple[DataFrame, str]:
    """Content-addressed reuse: a published `target` is read back, otherwise `build` runs and is published. A crash while
    building leaves only the unpublished folder, which the next build overwrites."""
    if exists(spark, f"{target}/_SUCCESS"):
        return spark.read.parquet(target), "reused"
    publish(build(), target, partition_by)
    return spark.read.parquet(target), "created"


#: copies of one entry that are made from one row
COPIES = 65_536


def append_manifest(df: DataFrame, path: str) -> int:
    """Append JSON lines and tell how many, counted while writing."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").json(path)
    return seen.get["n"]


def write_coco(images: DataFrame, annotations: DataFrame, categories: DataFrame, path: str) -> None:
    """The dataset as JSON-lines tables, partitioned by split."""
    for name, df in (("images", images), ("annotations", annotations), ("categories", categories)):
        df.write.mode("overwrite").partitionBy("split").json(f"{path}/{name}")


def coco_entries(images: DataFrame, annotations: DataFrame, categories: DataFrame) -> DataFrame:
    """`split, part, id, entry`: every entry of the splits' COCO documents as JSON text (part 0 images, 1 annotations,
    2 categories). Fields in a `props` column come back; `area` and `iscrowd` stay as given, else they are w * h and 0."""
    def pack(df: DataFrame, part: int, key: str, *cols) -> DataFrame:
        text = F.to_json(F.struct(F.col(key).alias("id"), *cols))
        if "props" in df.columns:
            text = F.when(F.col("props").isNull() | (F.col("props") == "{}"), text).otherwise(
                F.concat(F.left(text, F.length(text) - 1), F.lit(","), F.substring("props", 2, 2 ** 31 - 1)))
        return df.select("split", F.lit(part).alias("part"), F.col(key).cast("bigint").alias("id"), text.alias("entry"))

    area = F.coalesce("area", F.col("w") * F.col("h")) if "area" in annotations.columns else F.col("w") * F.col("h")
    crowd = F.coalesce("iscrowd", F.lit(0)) if "iscrowd" in annotations.columns else F.lit(0)
    return (pack(images, 0, "image_id", "file_name", "width", "height")
            .unionByName(pack(annotations, 1, "ann_id", "image_id", "category_id", F.array("x", "y", "w", "h").alias("bbox"), area.alias("area"), crowd.alias("iscrowd")))
            .unionByName(pack(categories, 2, "category_id", "name")))


def coco_documents(images: DataFrame, annotations: DataFrame, categories: DataFrame) -> DataFrame:
    """`split, document`: one COCO JSON text per split, for exchange with tools that read one file. One document is one
    value; `coco_document_lines` makes documents of any size."""
    entries = coco_entries(images, annotations, categories)

    def part(n: int):
        # no entry of the list is null, entries without an id go first
        rows = F.sort_array(F.collect_list(F.when(F.col("part") == n, F.struct("id", "entry"))))
        return F.array_join(F.transform(rows, lambda e: e["entry"]), ",")

    text = F.concat(F.lit('{"images":['), part(0), F.lit('],"annotations":['), part(1), F.lit('],"categories":['), part(2), F.lit("]}"))
    return entries.groupBy("split").agg(text.alias("document"))


def coco_document_lines(images: DataFrame, annotations: DataFrame, categories: DataFrame) -> DataFrame:
    """`split, line` in the order of the documents: range-partitioned, so that the part files of a split, one after the
    other, are its JSON document, whatever its size."""
    entries = coco_entries(images, annotations, categories)
    # how often each entry stands there, and the smallest one of each array with its number: the first copy has no comma
    counted = entries.groupBy("split", "part", "id", "entry").agg(F.count(F.lit(1)).alias("n"))
    first = counted.groupBy("split", "part").agg(F.min(F.struct(F.col("id").isNotNull(), "id", "entry", "n")).alias("first")).select("split", "part", "first.id", "first.entry", "first.n")
    others = entries.join(first.select("split", "part", F.col("id").alias("_id"), F.col("entry").alias("_entry")), ["split", "part"]).filter(
        ~(F.col("id").eqNullSafe(F.col("_id")) & (F.col("entry") == F.col("_entry")))).select("split", "part", "id", F.concat(F.lit(","), "entry").alias("line"))
    blocks = first.withColumn("_b", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / COPIES))))
    copies = blocks.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.least(F.lit(COPIES - 1), F.col("n") - 1 - F.col("_b") * COPIES)))).select(
        "split", "part", "id", F.concat(F.when((F.col("_b") == 0) & (F.col("_i") == 0), F.lit("")).otherwise(F.lit(",")), "entry").alias("line"),
        ((F.col("_b") > 0) | (F.col("_i") > 0)).alias("_late"))
    lines = others.withColumn("_late", F.lit(True)).unionByName(copies).withColumn("part", F.col("part") * 2 + 1)
    marks = entries.select("split").distinct().select("split", F.explode(F.array(*[
        F.struct(F.lit(n).alias("part"), F.lit(None).cast("bigint").alias("id"), F.lit(mark).alias("line"))
        for n, mark in ((0, '{"images":['), (2, '],"annotations":['), (4, '],"categories":['), (6, "]}"))])).alias("m")).select("split", "m.*")
    rows = lines.unionByName(marks.withColumn("_late", F.lit(False)))
    order = [F.col("split"), F.col("part"), F.col("_late"), F.col("id"), F.col("line")]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).select("split", "line")


def write_coco_documents(documents: DataFrame, path: str) -> None:
    """Documents (or their lines) as text, a folder for each split."""
    documents.write.mode("overwrite").partitionBy("split").text(path)


def write_yolo_labels(files: DataFrame, path: str) -> None:
    """`frame_id, text` as Parquet, by a hash of the frame, so millions of frames make no more folders than `LABEL_PARTS`."""
    part = F.format_string("%03d", F.pmod(F.xxhash64("frame_id"), F.lit(LABEL_PARTS)))
    files.select("frame_id", "text", part.alias("part")).repartition("part").write.mode("overwrite").partitionBy("part").parquet(path)


def export_yolo_labels(files: DataFrame, path: str) -> None:
    """One folder with a text file for each frame: the exchange form, for small sets of frames."""
    files.select("frame_id", F.col("text").alias("value")).write.mode("overwrite").partitionBy("frame_id").text(path)


def write_metric_tables(summary: DataFrame, per_class: DataFrame, confusion: DataFrame, path: str) -> None:
    for name, df in (("summary", summary), ("per_class_metrics", per_class), ("confusion_matrix", confusion)):
        df.write.mode("overwrite").option("header", True).csv(f"{path}/{name}")


def coco_results(detections: DataFrame) -> DataFrame:
    """Detections in COCO results form: image, category, xywh box, score."""
    return detections.select("image_id", F.col("class_id").alias("category_id"), F.array(
        "x1", "y1", F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")).alias("bbox"), F.col("confidence").alias("score"))


def write_predictions(tiles: DataFrame, stitched: DataFrame, path: str) -> None:
    """Raw tile predictions, stitched detections and COCO results as JSON lines, one row per detection; rows of one
    image lie together."""
    tiles.write.mode("overwrite").json(f"{path}/raw_tiles")
    stitched.write.mode("overwrite").json(f"{path}/stitched")
    coco_results(stitched).write.mode("overwrite").json(f"{path}/coco")
