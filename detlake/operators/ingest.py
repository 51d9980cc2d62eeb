"""Bringing captured frames and foreign datasets into split tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from detlake.functions.boxes import box, xyxy_to_yolo
from detlake.functions.text import file_stem, fixed_six, name_tokens, uid
from detlake.operators.metrics import CLASSES
from detlake.operators.ordering import global_index, nested_index
from detlake.operators.skew import nest
from detlake.operators.splits import DEFAULT_RATIOS, SPLITS, assign_split
from detlake.session import durable

# fixed values: old class ids and their canonical ids (None drops the class), class sets, exportable quality tiers
LEGACY_REMAP = {0: 0, 1: None, 2: 1, 3: 2}
CANONICAL_SET = {0: "ships", 1: "helicopters", 2: "airplanes"}
LEGACY_SET = {0: "ships", 1: "buoys", 2: "helicopters", 3: "airplanes"}
QUALITY_TIERS = ("exact_visible", "exact", "strong", "approximate")
# fixed values: type name fragments of each class, first match wins
CLASS_TOKENS = (
    ("ships", ("burke", "ticonderoga", "cg-47", "kilo", "ship", "frigate", "destroyer", "carrier")),
    ("helicopters", ("uh-1", "mi-8", "ka-50", "mi-24", "ah-64", "helicopter", "helo", "uh-60")),
    ("airplanes", ("f-16", "a-10", "su-25", "f/a-18", "aircraft", "plane", "mig-")),
)


def split_dataset(images: DataFrame, annotations: DataFrame, categories: DataFrame,
                  ratios: Mapping[str, float] = DEFAULT_RATIOS) -> dict[str, DataFrame]:
    """Images get their split from the frame id, annotations follow, categories go to every split."""
    placed = images.withColumn("split", assign_split(file_stem(F.col("file_name")), ratios))
    return {
        "images": placed,
        "annotations": annotations.join(placed.select("image_id", "split"), "image_id"),
        "categories": categories.withColumn("split", F.explode(F.array(*[F.lit(s) for s in SPLITS]))),
    }


def split_counts(images: DataFrame, annotations: DataFrame) -> DataFrame:
    """`split` (`all` for the total), images and annotations."""
    i = images.groupBy("split").agg(F.count(F.lit(1)).alias("num_images"))
    a = annotations.groupBy("split").agg(F.count(F.lit(1)).alias("num_annotations"))
    both = i.join(a, "split", "full").select("split", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("num_images", "num_annotations")])
    return _with_total(both)


def _with_total(per_split: DataFrame) -> DataFrame:
    out = per_split.rollup("split").agg(F.grouping("split").alias("_total"), F.sum("num_images").alias("num_images"),
                                        F.sum("num_annotations").alias("num_annotations"))
    return out.select(F.when(F.col("_total") == 1, F.lit("all")).otherwise(F.col("split")).alias("split"),
                      *[F.coalesce(c, F.lit(0)).alias(c) for c in ("num_images", "num_annotations")])


def capture_manifest(images: DataFrame, frames: DataFrame, objects: DataFrame) -> DataFrame:
    """One record per image with the frame facts that help leak tracking; `has_rich_metadata` false without a frame.

    `object_quality_tiers` lists the tiers in object order, `quality_tiers` counts them.
    """
    order = F.array_sort(F.collect_list(F.struct("object_id", "quality_tier")))
    listed = objects.groupBy("image_id").agg(F.transform(order, lambda o: o["quality_tier"]).alias("object_quality_tiers"))
    tiers = objects.groupBy("image_id", "quality_tier").agg(F.count(F.lit(1)).alias("n"))
    tiers = tiers.groupBy("image_id").agg(F.sum("n").alias("num_objects"), F.map_from_entries(F.array_sort(
        F.collect_list(F.struct("quality_tier", "n")))).alias("quality_tiers"))
    facts = frames.join(tiers, "image_id", "left").join(listed, "image_id", "left")
    out = images.join(facts.withColumn("_rich", F.lit(True)), "image_id", "left")
    rich = F.coalesce(F.col("_rich"), F.lit(False))
    return (out.withColumn("has_rich_metadata", rich)
            .withColumn("source_image", F.concat(F.lit("images/"), F.col("split"), F.lit("/"), F.col("file_name")))
            .withColumn("num_objects", F.when(rich, F.coalesce("num_objects", F.lit(0))))
            .withColumn("usable", F.when(rich, F.coalesce("usable", F.lit(False)))).drop("_rich"))


def exportable(objects: DataFrame, tiers: Sequence[str] = QUALITY_TIERS, classes: Sequence[str] = CLASSES) -> DataFrame:
    """Flags objects that may leave as training boxes and resolves their class id."""
    ids = F.create_map(*[x for i, n in enumerate(classes) for x in (F.lit(n), F.lit(i))])
    tier = F.coalesce(F.col("quality_tier"), F.lit("approximate"))
    allowed = tier.isin(list(tiers)) if tiers else F.lit(True)
    ok = (F.coalesce(F.col("valid"), F.lit(False)) & allowed & F.col("x1").isNotNull() & F.col("class").isin(list(classes)))
    return objects.withColumn("exported", F.coalesce(ok, F.lit(False))).withColumn("category_id", F.try_element_at(ids, F.col("class")))


def frames_to_coco(frames: DataFrame, objects: DataFrame, tiers: Sequence[str] = QUALITY_TIERS,
                   classes: Sequence[str] = CLASSES) -> dict[str, DataFrame]:
    """Usable frames and their exportable objects with dense ids from 1, in frame id and object order."""
    usable = frames.filter(F.coalesce(F.col("usable"), F.lit(False)) & (F.coalesce(F.col("file_name"), F.lit("")) != ""))
    # frames are numbered by their ids alone, objects below their frame
    ids = global_index(usable.select("image_id", "frame_id"), [F.col("frame_id"), F.col("image_id")], "coco_image_id")
    images = usable.join(ids.select("image_id", "coco_image_id"), "image_id")
    kept = exportable(objects, tiers, classes).filter("exported")
    rows = kept.join(ids, "image_id")
    rows = nested_index(rows, [], ["coco_image_id"], [F.col("object_id")], "coco_annotation_id")
    rows = rows.withColumn("w", F.col("x2") - F.col("x1")).withColumn("h", F.col("y2") - F.col("y1"))
    return {"images": images, "annotations": rows.withColumn("area", F.col("w") * F.col("h")).withColumn("iscrowd", F.lit(0))}


def export_stats(frames: DataFrame, objects: DataFrame, tiers: Sequence[str] = QUALITY_TIERS,
                 classes: Sequence[str] = CLASSES) -> DataFrame:
    """Frames and objects seen, exported and skipped (objects of skipped frames are not counted)."""
    ok = F.coalesce(F.col("usable"), F.lit(False)) & (F.coalesce(F.col("file_name"), F.lit("")) != "")
    f = frames.withColumn("_ok", ok)
    o = exportable(objects, tiers, classes).join(f.filter("_ok").select("image_id"), "image_id", "left_semi")
    per_frame = f.agg(F.count(F.lit(1)).alias("frames_seen"), F.count_if("_ok").alias("frames_exported"))
    per_object = o.agg(F.count_if("exported").alias("annotations_exported"), F.count_if(~F.col("exported")).alias("objects_skipped"))
    return per_frame.select("frames_seen", "frames_exported", (F.col("frames_seen") - F.col("frames_exported")).alias("frames_skipped"),
                            *[per_object.select(c).scalar().alias(c) for c in ("annotations_exported", "objects_skipped")])


def yolo_rows(frames: DataFrame, objects: DataFrame, tiers: Sequence[str] = QUALITY_TIERS,
              classes: Sequence[str] = CLASSES) -> DataFrame:
    """One label line per exportable object of a usable frame: class, centre and size at six decimals."""
    usable = frames.filter(F.coalesce(F.col("usable"), F.lit(False))).select("image_id", "frame_id", "width", "height")
    rows = exportable(objects, tiers, classes).filter("exported").join(usable, "image_id")
    cx, cy, w, h = xyxy_to_yolo(box(), F.col("width"), F.col("height"))
    line = F.concat_ws(" ", F.col("category_id").cast("string"), *[fixed_six(v) for v in (cx, cy, w, h)])
    return rows.select("frame_id", "object_id", line.alias("line"))


def yolo_files(frames: DataFrame, rows: DataFrame) -> DataFrame:
    """Label text per frame; empty text for frames without lines. `yolo_rows` is its long form."""
    lists = nest(rows, ["frame_id"], F.col("line"), [F.col("object_id")], "_lines")
    out = frames.select("frame_id").join(lists, "frame_id", "left")
    return out.select("frame_id", F.coalesce(F.array_join("_lines", "\n"), F.lit("")).alias("text"))


def classify_category_set(categories: DataFrame) -> DataFrame:
    """`canonical`, `legacy4` or `unknown` per dataset, from its whole (id, name) set."""
    def known(table: Mapping[int, str]) -> Column:
        pairs = F.struct(F.col("category_id").cast("int").alias("i"), F.col("name").alias("n"))
        listed = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(n).alias("n")) for i, n in table.items()])
        return F.array_contains(listed, pairs)

    rows = categories.select("dataset_id", "category_id", "name").distinct()
    tally = rows.groupBy("dataset_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(known(CANONICAL_SET)).alias("c"), F.count_if(known(LEGACY_SET)).alias("l"))
    kind = (F.when((F.col("n") == 3) & (F.col("c") == 3), F.lit("canonical"))
            .when((F.col("n") == 4) & (F.col("l") == 4), F.lit("legacy4")).otherwise(F.lit("unknown")))
    return tally.select("dataset_id", kind.alias("kind"))


def remap_categories(annotations: DataFrame, remap: Mapping[int, int | None] = LEGACY_REMAP, column: str = "category_id",
                     strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """(annotations with canonical ids, counts of kept and dropped rows per old id). Unmapped ids are an error."""
    keys = list(remap)
    old = F.col(column)
    if strict:
        odd = annotations.filter(~old.isin(keys)).select(column).limit(1).collect()
        if odd:
            raise ValueError(f"category id {odd[0][0]} has no mapping")
    new = F.lit(None).cast("int")
    for k, v in remap.items():
        if v is not None:
            new = F.when(old == k, F.lit(v)).otherwise(new)
    mapped = annotations.withColumn("_new", new)
    counts = mapped.groupBy(old.alias("old_id")).agg(F.count("_new").alias("kept"), F.count_if(F.col("_new").isNull()).alias("dropped"))
    return mapped.filter(F.col("_new").isNotNull()).drop(column).withColumnRenamed("_new", column), counts


def content_marks(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per dataset the number of rows and two sums of 64-bit hashes of their columns, whatever their order; equal contents have
    equal marks. Summed before the shuffle, so a dataset of any size is one row a task."""
    def total(seed: int) -> Column:
        return F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)"))
    return rows.groupBy("dataset_id").agg(F.struct(F.count(F.lit(1)).alias("n"), total(1).alias("a"), total(2).alias("b")).alias("mark"))


def migrate_dataset(images: DataFrame, annotations: DataFrame, categories: DataFrame, target: DataFrame | None = None,
                    columns: Sequence[str] = ("image_id", "ann_id", "category_id", "x", "y", "w", "h")) -> tuple[dict[str, DataFrame], DataFrame]:
    """Canonical tables plus a report row per (dataset, split).

    `action`: `migrate` (legacy classes renumbered, canonical ones passed through), `keep` (`target`, annotations already
    stored, holds the very rows that would be written: nothing is), `refuse` (`target` holds other rows of the dataset) or
    `unknown` (its class set is neither). Only datasets to migrate are in the tables; one of the others stops none."""
    # one row a dataset, read by every step: a few datasets may hold all rows, which must not meet by their dataset in one task
    kinds = F.broadcast(durable(classify_category_set(categories)))
    rows = annotations.join(kinds, "dataset_id")
    moved, _ = remap_categories(rows.filter(F.col("kind") == "legacy4"))
    out = rows.filter(F.col("kind") == "canonical").unionByName(moved)
    if target is None:
        plan = kinds.withColumn("action", F.when(F.col("kind") == "unknown", "unknown").otherwise("migrate"))
    else:
        held = content_marks(target, columns).withColumnRenamed("mark", "_held")
        plan = kinds.join(content_marks(out, columns), "dataset_id", "left").join(held, "dataset_id", "left").select(
            "dataset_id", "kind", F.when(F.col("kind") == "unknown", "unknown").when(F.col("_held").isNull(), "migrate")
            .when(F.col("_held").eqNullSafe(F.col("mark")), "keep").otherwise("refuse").alias("action"))
    n = F.count(F.lit(1))
    key = ["dataset_id", "split"]
    report = (images.groupBy(*key).agg(n.alias("num_images")).join(rows.groupBy(*key).agg(n.alias("before")), key, "left")
              .join(out.groupBy(*key).agg(n.alias("num_annotations")), key, "left").join(plan, "dataset_id"))
    zero = F.lit(0)
    report = report.select(*key, "kind", "action", "num_images", F.coalesce("num_annotations", zero).alias("num_annotations"),
                           (F.coalesce("before", zero) - F.coalesce("num_annotations", zero)).alias("dropped"))
    going = F.broadcast(plan.filter(F.col("action") == "migrate").select("dataset_id"))
    cats = going.select("dataset_id", F.explode(F.array(*[
        F.struct(F.lit(i).alias("category_id"), F.lit(c).alias("name")) for i, c in CANONICAL_SET.items()])).alias("c"))
    return {"images": images.join(going, "dataset_id", "left_semi"), "annotations": out.drop("kind").join(going, "dataset_id", "left_semi"),
            "categories": cats.select("dataset_id", "c.*")}, report


def infer_class(type_name: Column) -> Column:
    name = F.lower(F.coalesce(type_name, F.lit("")))
    out = F.lit(None).cast("string")
    for cls, tokens in reversed(CLASS_TOKENS):
        hit = F.lit(False)
        for token in tokens:
            hit = hit | F.contains(name, F.lit(token))
        out = F.when(hit, F.lit(cls)).otherwise(out)
    return out


def lookup_dimensions(types: DataFrame, catalog: DataFrame, classes: Sequence[str] = CLASSES, strict: bool = False) -> DataFrame:
    """Dimensions per distinct (type_name, class): exact name, name with separators as spaces, first catalog entry
    contained in either (class names excepted), then the class entry; `dimensions_source` tells which. Nothing fits: null,
    or with `strict` an error.

    `catalog` (`ord, key, length, width, height`) may be of any size: all four ways are equi-joins on the key; for contained
    keys every distinct type offers the parts of its name.
    """
    name, plain = F.lower(F.coalesce("type_name", F.lit(""))), name_tokens(F.coalesce("type_name", F.lit("")))

    def parts(text: Column) -> Column:
        at = F.when(F.length(text) > 0, F.sequence(F.lit(1), F.length(text))).otherwise(F.array().cast("array<int>"))
        return F.flatten(F.transform(at, lambda i: F.transform(F.sequence(F.lit(1), F.length(text) - i + 1), lambda n: F.substring(text, i, n))))

    keys = ["type_name", "class"]
    seen = types.select(*keys).distinct()
    # ways in the order they count, each with the keys it asks for
    whole = seen.select(*keys, F.explode(F.array(
        F.struct(F.lit(0).alias("way"), name.alias("key")), F.struct(F.lit(1).alias("way"), plain.alias("key")),
        F.struct(F.lit(3).alias("way"), F.col("class").alias("key")))).alias("w")).select(*keys, "w.*")
    inside = seen.select(*keys, F.lit(2).alias("way"), F.explode(F.array_distinct(F.concat(parts(name), parts(plain)))).alias("key")).where(~F.col("key").isin(list(classes)))
    hits = whole.unionByName(inside).join(catalog, "key")
    best = hits.groupBy(*keys).agg(F.min(F.struct("way", "ord", "length", "width", "height")).alias("b"))
    names = F.array(*[F.lit(n) for n in ("model_catalog", "model_catalog_normalized", "model_catalog_partial_match", "class_catalog")])
    out = types.join(best.select(*keys, F.get(names, F.col("b.way")).alias("dimensions_source"), *[F.col(f"b.{c}").cast("double").alias(c) for c in ("length", "width", "height")]), keys, "left")
    if strict:
        lost = out.where(F.col("dimensions_source").isNull()).select(*keys).limit(1).collect()
        if lost:
            raise KeyError(f"no dimensions for type {lost[0][0]!r}, class {lost[0][1]!r}")
    return out


def image_rows(images: DataFrame, annotations: DataFrame) -> DataFrame:
    """Registry rows of images; `has_objects` from one distinct list of annotated images."""
    some = annotations.select("image_id").distinct().withColumn("_some", F.lit(True))
    return images.join(some, "image_id", "left").select(
        uid(F.col("dataset_id"), F.col("split"), F.col("image_id").cast("string")).alias("image_id"), "dataset_id", "split",
        "file_name", "width", "height", F.concat(F.lit("images/"), F.col("split"), F.lit("/"), F.col("file_name")).alias("storage_path"),
        F.coalesce("_some", F.lit(False)).alias("has_objects"), file_stem(F.col("file_name")).alias("source_frame_id"))


def annotation_rows(annotations: DataFrame) -> DataFrame:
    """Registry rows of annotations (`dataset_id` and `split` already attached)."""
    bbox = F.to_json(F.array("x", "y", "w", "h"))
    return annotations.select(
        uid(F.col("dataset_id"), F.col("split"), F.lit("ann"), F.col("ann_id").cast("string")).alias("annotation_id"), "dataset_id",
        uid(F.col("dataset_id"), F.col("split"), F.col("image_id").cast("string")).alias("image_id"), "category_id",
        bbox.alias("bbox_xywh"), (F.col("w") * F.col("h")).alias("area"), F.lit(False).alias("iscrowd"),
        F.col("ann_id").cast("string").alias("source_annotation_id"))


def limit_per_split(images: DataFrame, n: int, order: str = "image_id") -> DataFrame:
    """First `n` images of every split; each task first keeps its own `n`."""
    rank = F.row_number().over(Window.partitionBy("split").orderBy(order))
    return images.withColumn("_r", rank).filter(F.col("_r") <= n).drop("_r")


def index_by_image(images: DataFrame, annotations: DataFrame) -> DataFrame:
    """Image -> its annotation ids; images without any get an empty list, annotations of unknown images stay listed."""
    lists = nest(annotations, ["image_id"], F.col("ann_id"), [F.col("ann_id")], "ann_ids")
    out = images.select("image_id").join(lists, "image_id", "full")
    return out.select("image_id", F.coalesce("ann_ids", F.array().cast("array<bigint>")).alias("ann_ids"))


def num_classes(categories: DataFrame, datasets: DataFrame) -> DataFrame:
    declared = categories.groupBy("dataset_id").agg(F.count_distinct("category_id").alias("n"))
    return datasets.select("dataset_id").distinct().join(declared, "dataset_id", "left").select(
        "dataset_id", F.coalesce("n", F.lit(len(CANONICAL_SET))).alias("num_classes"))


def normalize_dataset(images: DataFrame, annotations: DataFrame, categories: DataFrame, frames: DataFrame,
                      objects: DataFrame, files: DataFrame | None = None,
                      ratios: Mapping[str, float] = DEFAULT_RATIOS) -> dict[str, DataFrame]:
    """Split tables, capture manifest, counts and warnings about referenced files that do not exist."""
    out = split_dataset(images, annotations, categories, ratios)
    out["manifest"] = capture_manifest(out["images"], frames, objects)
    out["info"] = split_counts(out["images"], out["annotations"])
    if files is not None:
        gone = out["images"].join(files.select("file_name").distinct(), "file_name", "left_anti")
        out["warnings"] = gone.select(F.lit("warning").alias("severity"), F.lit("images").alias("location"),
                                      F.concat(F.lit("source image missing: "), F.col("file_name")).alias("message"))
    return out
