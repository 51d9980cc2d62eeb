"""Dataset validation. Every rule gives rows `severity, location, message`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from detlake.functions.text import file_stem
from detlake.operators.ingest import CANONICAL_SET
from detlake.operators.splits import SPLITS

ISSUE = ["severity", "location", "message"]
IMAGE_FIELDS = ("image_id", "file_name", "width", "height")
ANNOTATION_FIELDS = ("ann_id", "image_id", "category_id", "bbox")
CATEGORY_FIELDS = ("category_id", "name")


class ValidationError(ValueError):
    pass


def _issue(severity: str, location: Column, message: Column) -> Column:
    return F.struct(F.lit(severity).alias("severity"), location.alias("location"), message.alias("message"))


def _say(*parts) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def _at(table: str, key: str) -> Column:
    return _say(f"{table}[", F.coalesce(F.col(key).cast("string"), F.lit("?")), "]")


def _collect(df: DataFrame, issues: Sequence[Column]) -> DataFrame:
    return df.select(F.inline(F.array_compact(F.array(*issues))))


def _complete(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    ok = F.lit(True)
    for f in fields:
        ok = ok & F.col(f).isNotNull()
    return df.filter(ok)


def required_fields(df: DataFrame, table: str, key: str, fields: Sequence[str]) -> DataFrame:
    """Missing and null are the same here; rows with a hole are skipped by the other rules."""
    return _collect(df, [F.when(F.col(f).isNull(), _issue("error", _at(table, key), F.lit(f"missing {f}"))) for f in fields])


def value_rules(images: DataFrame, annotations: DataFrame) -> DataFrame:
    """Sizes, names and boxes. `bbox` is ARRAY<DOUBLE>; `area` and `iscrowd` may be null."""
    i = _complete(images, IMAGE_FIELDS)
    a = _complete(annotations, ANNOTATION_FIELDS)
    at_i, at_a = _at("images", "image_id"), _at("annotations", "ann_id")
    four = F.size("bbox") == 4
    flat = F.coalesce(four & ((F.get("bbox", 2) <= 0) | (F.get("bbox", 3) <= 0)), F.lit(False))
    found_i = _collect(i, [
        F.when((F.col("width") <= 0) | (F.col("height") <= 0),
               _issue("error", at_i, _say("non-positive dimensions ", F.col("width"), "x", F.col("height")))),
        F.when(F.trim("file_name") == "", _issue("error", at_i, F.lit("empty file_name"))),
    ])
    found_a = _collect(a, [
        F.when(~four, _issue("error", at_a, F.lit("bbox must be [x,y,w,h]"))),
        F.when(flat, _issue("error", at_a, F.lit("non-positive bbox size"))),
        F.when(four & (F.col("area") <= 0), _issue("warning", at_a, F.lit("area is non-positive"))),
        F.when(four & F.col("iscrowd").isNull(), _issue("warning", at_a, F.lit("iscrowd missing, defaulting to 0"))),
    ])
    return found_i.unionByName(found_a)


def duplicate_ids(df: DataFrame, table: str, key: str) -> DataFrame:
    """One issue per second and later occurrence. Ids are counted with partial aggregation, never gathered; the
    occurrences of an id come out in blocks that spread over the cluster."""
    block = 100_000
    many = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter((F.col("_n") > 1) & F.col(key).isNotNull())
    blocks = many.withColumn("_b", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 2) / block)))).repartition(key, "_b")
    first = F.col("_b") * block + 2
    return blocks.select(F.lit("error").alias("severity"), _at(table, key).alias("location"), F.lit("duplicate id").alias("message"),
                         F.explode(F.sequence(first, F.least(F.col("_n"), first + block - 1))).alias("occurrence"))


def dangling_refs(annotations: DataFrame, images: DataFrame, categories: DataFrame) -> DataFrame:
    """Annotations never meet by their category, of which a dataset has few: its ids are broadcast."""
    a = _complete(annotations, ANNOTATION_FIELDS)

    def missing(known: DataFrame, key: str, name: str) -> DataFrame:
        lost = a.join(known, key, "left_anti")
        return lost.select(F.lit("error").alias("severity"), _at("annotations", "ann_id").alias("location"),
                           _say(f"{key} ", F.col(key), f" not in {name}").alias("message"))

    kinds = F.broadcast(categories.select("category_id").distinct())
    return missing(images.select("image_id").distinct(), "image_id", "images").unionByName(missing(kinds, "category_id", "categories"))


def missing_files(images: DataFrame, files: DataFrame) -> DataFrame:
    lost = _complete(images, IMAGE_FIELDS).join(files.select("file_name").distinct(), "file_name", "left_anti")
    return lost.select(F.lit("error").alias("severity"), _at("images", "image_id").alias("location"),
                       _say("file does not exist: ", F.col("file_name")).alias("message"))


def validate_coco(images: DataFrame, annotations: DataFrame, categories: DataFrame, files: DataFrame | None = None,
                  strict: bool = False) -> DataFrame:
    out = required_fields(images, "images", "image_id", IMAGE_FIELDS)
    parts = [
        required_fields(annotations, "annotations", "ann_id", ANNOTATION_FIELDS),
        required_fields(categories, "categories", "category_id", CATEGORY_FIELDS),
        value_rules(images, annotations),
        duplicate_ids(_complete(images, IMAGE_FIELDS), "images", "image_id").select(*ISSUE),
        duplicate_ids(_complete(annotations, ANNOTATION_FIELDS), "annotations", "ann_id").select(*ISSUE),
        duplicate_ids(categories, "categories", "category_id").select(*ISSUE),
        dangling_refs(annotations, images, categories),
    ]
    if files is not None:
        parts.append(missing_files(images, files))
    for p in parts:
        out = out.unionByName(p)
    if strict:
        first = out.filter(F.col("severity") == "error").limit(1).collect()
        if first:
            raise ValidationError(f"{first[0]['location']}: {first[0]['message']}")
    return out


def class_contract(categories: DataFrame, annotations: DataFrame) -> DataFrame:
    """Categories that differ from the canonical set, and category ids used outside it."""
    known = F.lit(False)
    for i, n in CANONICAL_SET.items():
        known = known | ((F.col("category_id") == i) & (F.col("name") == n))
    odd = categories.filter(~F.coalesce(known, F.lit(False))).select(
        F.lit("error").alias("severity"), F.lit("categories").alias("location"),
        _say("category ", F.coalesce(F.col("category_id").cast("string"), F.lit("?")), " ", F.coalesce("name", F.lit("?")),
             " is not canonical").alias("message"))
    used = annotations.select("category_id").distinct().filter(~F.col("category_id").isin(list(CANONICAL_SET)))
    return odd.unionByName(used.select(F.lit("error").alias("severity"), F.lit("annotations").alias("location"),
                                       _say("category id ", F.col("category_id"), " is outside the canonical set").alias("message")))


def cross_split_ids(df: DataFrame, table: str, key: str, severity: str) -> DataFrame:
    """Rows of ids that an earlier split already used, counted per split; splits go in their fixed order."""
    order = F.array_position(F.array(*[F.lit(s) for s in SPLITS]), F.col("split"))
    per = df.groupBy(key, "split").agg(F.count(F.lit(1)).alias("n"))
    first = per.groupBy(key).agg(F.min(order).alias("_first"))
    later = per.join(first, key).filter(order > F.col("_first"))
    return later.select(F.lit(severity).alias("severity"), _say(f"{table}:", F.col("split")).alias("location"),
                        _say("id ", F.col(key), " also in another split").alias("message"), "n")


def split_leakage(images: DataFrame) -> DataFrame:
    """Frames present in more than one split, with the splits."""
    frames = images.select(file_stem(F.col("file_name")).alias("frame_id"), "split").distinct()
    return (frames.groupBy("frame_id").agg(F.array_sort(F.collect_set("split")).alias("splits"))
            .filter(F.size("splits") > 1))


def category_set_equal(categories: DataFrame, declared: DataFrame) -> DataFrame:
    """Splits whose category ids differ from the declared ones, with the ids missing and extra."""
    have = categories.select("split", "category_id").distinct()
    want = _declared_per_split(categories, declared)
    both = have.withColumn("_h", F.lit(1)).join(want.withColumn("_w", F.lit(1)), ["split", "category_id"], "full")
    return both.groupBy("split").agg(F.count_if(F.col("_h").isNull()).alias("missing"), F.count_if(F.col("_w").isNull()).alias("extra")).filter(
        (F.col("missing") > 0) | (F.col("extra") > 0))


def _declared_per_split(categories: DataFrame, declared: DataFrame) -> DataFrame:
    names = F.array(*[F.lit(s) for s in SPLITS])
    spread = declared.select("category_id").distinct().withColumn("split", F.explode(names))
    return spread.join(categories.select("split").distinct(), "split", "left_semi")


def count_reconcile(declared: DataFrame, actual: DataFrame) -> DataFrame:
    """Declared against counted images and annotations per split (`all` is the total). Null counts are not compared; in the
    total they, and a null `num_classes` where that is a column, are missing keys."""
    keys = ["num_images", "num_annotations", *(c for c in ("num_classes",) if c in declared.columns)]
    both = declared.select("split", F.col("num_images").alias("_di"), F.col("num_annotations").alias("_da"), *[F.col(k).isNull().alias(f"_no_{k}") for k in keys]).join(actual, "split")
    at = _say("splits.", F.col("split"))

    def differs(name: str, want: str) -> Column:
        return F.when(F.col(want) != F.col(name), _issue("error", at, _say(f"{name}: declared ", F.col(want), ", found ", F.col(name))))

    total = F.col("split") == "all"
    missing = [F.when(total & F.col(f"_no_{k}"), _issue("warning", _say("dataset_info"), _say(f"missing key {k}"))) for k in keys]
    return _collect(both, [differs("num_images", "_di"), F.when(~total, differs("num_annotations", "_da")), *missing])


def manifest_coverage(images: DataFrame, manifest: DataFrame) -> DataFrame:
    """Frames per split that the capture manifest does not mention."""
    frames = images.select("split", file_stem(F.col("file_name")).alias("frame_id")).distinct()
    gone = frames.join(manifest.select("split", "frame_id").distinct(), ["split", "frame_id"], "left_anti")
    return gone.groupBy("split").agg(F.count(F.lit(1)).alias("missing_frames"))


def validate_raw_dataset(images: DataFrame, annotations: DataFrame, categories: DataFrame, declared_counts: DataFrame,
                         manifest: DataFrame, actual_counts: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """All rules of a split dataset in one issue table."""
    out = validate_coco(images, annotations, categories, files)
    leaks = split_leakage(images).select(F.lit("error").alias("severity"), F.lit("split_leakage").alias("location"), _say(
        "frame ", F.col("frame_id"), " is in ", F.array_join("splits", ",")).alias("message"))
    thin = manifest_coverage(images, manifest).select(F.lit("warning").alias("severity"), F.lit("capture_manifest").alias("location"), _say(
        F.col("split"), ": ", F.col("missing_frames"), " frames missing from manifest").alias("message"))
    for p in (class_contract(categories, annotations), cross_split_ids(images, "images", "image_id", "warning").select(*ISSUE),
              cross_split_ids(annotations, "annotations", "ann_id", "error").select(*ISSUE), leaks, count_reconcile(declared_counts, actual_counts), thin):
        out = out.unionByName(p)
    return out


def severity_totals(issues: DataFrame) -> DataFrame:
    return issues.groupBy("severity").agg(F.count(F.lit(1)).alias("n"))


def yolo_line_valid(line: Column) -> Column:
    """Five tokens, class 0..2, centre inside the picture, sizes above 0 and below one half."""
    parts = F.split(F.trim(line), r"\s+")
    num = [F.get(parts, i).try_cast("double") for i in range(5)]
    cls = F.get(parts, 0).try_cast("int")
    ok = (F.size(parts) == 5) & cls.isin([0, 1, 2]) & num[1].between(0, 1) & num[2].between(0, 1)
    ok = ok & (num[3] > 0) & (num[3] < 0.5) & (num[4] > 0) & (num[4] < 0.5)
    return F.coalesce(ok, F.lit(False))


def close_to(a: Column, b: Column, abs_tol: float = 1e-6, rel_tol: float = 1e-9) -> Column:
    """Equal within tolerance; NaN equals NaN, null equals null."""
    near = F.abs(a - b) <= F.greatest(F.lit(abs_tol), F.lit(rel_tol) * F.greatest(F.abs(a), F.abs(b)))
    return F.when(a.isNull() & b.isNull(), True).when(a.isNull() | b.isNull(), False).when(
        F.isnan(a) & F.isnan(b), True).when(F.isnan(a) | F.isnan(b), False).otherwise(near)


def diff_tables(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """`keys, path, kind` for rows on one side only and for changed columns; numbers compare within tolerance."""
    types = dict(left.dtypes)
    a = left.select(*keys, F.struct(*columns).alias("_a"))
    b = right.select(*keys, F.struct(*columns).alias("_b"))
    both = a.join(b, list(keys), "full")

    def same(c: str) -> Column:
        x, y = F.col("_a")[c], F.col("_b")[c]
        if types[c] in ("double", "float"):
            return close_to(x, y)
        return x.eqNullSafe(y)

    def row(path: Column, kind: str) -> Column:
        return F.struct(path.alias("path"), F.lit(kind).alias("kind"))

    here = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    found = [F.when(F.col("_b").isNull(), row(F.lit(""), "only_left")), F.when(F.col("_a").isNull(), row(F.lit(""), "only_right"))]
    found += [F.when(here & ~same(c), row(F.lit(c), "changed")) for c in columns]
    return both.select(*keys, F.inline(F.array_compact(F.array(*found))))


def diff_label_lines(left: DataFrame, right: DataFrame) -> DataFrame:
    """Label lines (`file, line_no, line`) that differ: token count, class, number, or only their format."""
    both = left.withColumnRenamed("line", "_a").join(right.withColumnRenamed("line", "_b"), ["file", "line_no"], "full")
    ta, tb = F.split(F.trim("_a"), r"\s+"), F.split(F.trim("_b"), r"\s+")
    pairs = F.zip_with(F.slice(ta, 2, 1000), F.slice(tb, 2, 1000), lambda x, y: F.coalesce(
        close_to(x.try_cast("double"), y.try_cast("double")) & x.try_cast("double").isNotNull(), F.lit(False)))
    kind = (F.when(F.col("_a").isNull(), "only_right").when(F.col("_b").isNull(), "only_left")
            .when(F.col("_a") == F.col("_b"), None).when(F.size(ta) != F.size(tb), "token_count")
            .when(F.get(ta, 0) != F.get(tb, 0), "class_id").when(~F.forall(pairs, lambda p: p), "value").otherwise("format_only"))
    return both.withColumn("kind", kind).filter(F.col("kind").isNotNull()).select("file", "line_no", "kind")
