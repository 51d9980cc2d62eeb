"""Content hashes and ids for reuse of built tables.

Hashes over many lines are trees with one rule for every size, named in the column `algorithm`: each line falls into one of
a fixed number of leaves by the MD5 of its own key, a leaf is the SHA-256 of its lines in key order, and the hash is the
SHA-256 of the leaves' names and digests. A key's hash thus depends on its own lines alone, and no task needs more than a
leaf of one key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from detlake.functions.text import canonical_double
from detlake.operators.splits import SPLITS

# fixed values: settings that shape tiles, in sorted order, and the algorithm version folded into their hash
TILE_CONFIG_KEYS = ("background_policy", "crop_size", "include_edge_tiles", "keep_background_images", "scales", "stride",
                    "visible_area_threshold")
TILING_ALGORITHM_VERSION = 1
SCHEMA_VERSION = 1
LAYOUT_VERSION = 1
EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
# leaves are named by so many hexadecimal digits of the key's MD5
LEAF_DIGITS = 3
ALGORITHM = "sha256-tree-4096"


def sha_text(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def file_hash(files: DataFrame, content: str = "content") -> DataFrame:
    return files.withColumn("sha256", F.sha2(F.col(content).cast("binary"), 256))


def _tree(rows: DataFrame, keys: Sequence[str], line: str, order: Sequence[str]) -> DataFrame:
    """Tree SHA-256 over the lines of each key; `order` tells the lines of a key apart. Without `order` lines are their own
    order, and a leaf collects nothing beside them."""
    keys = list(keys)
    own = [F.col(c).cast("string") for c in order] or [F.col(line)]
    leaf = F.substring(F.md5(F.concat_ws("\x1f", *own).cast("binary")), 1, LEAF_DIGITS)
    if order:
        lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, line))), lambda e: e[line]), "")
    else:
        lines = F.array_join(F.sort_array(F.collect_list(line)), "")
    leaves = rows.select(*keys, *order, line, leaf.alias("_leaf")).groupBy(*keys, "_leaf").agg(sha_text(lines).alias("_digest"))
    # leaf and digest in one text of fixed width, which sorts by the leaf
    names = F.sort_array(F.collect_list(F.concat("_leaf", F.lit(":"), "_digest", F.lit("\n"))))
    return leaves.groupBy(*keys).agg(sha_text(F.array_join(names, "")).alias("sha256"))


def directory_hash(files: DataFrame, root: str = "root", relpath: str = "relpath", content: str = "content") -> DataFrame:
    """SHA-256 over the sorted lines `relpath NUL filehash LF` of each root."""
    line = F.concat(F.col(relpath), F.lit("\x00"), F.sha2(F.col(content).cast("binary"), 256), F.lit("\n"))
    return _tree(files.select(root, relpath, line.alias("_line")), [root], "_line", [relpath]).withColumn("algorithm", F.lit(ALGORITHM))


def dataset_hash(files: DataFrame, annotations: DataFrame, strict: bool = False) -> DataFrame:
    """Per dataset: annotation rows (`dataset_id, split, ann_id, row_json`) and images (`dataset_id, relpath, length[,
    sha256]`) in one two-part digest; a dataset without any of both is absent here and means the empty hash."""
    size = F.col("sha256") if strict else F.col("length").cast("string")
    img = _tree(files.select("dataset_id", "relpath", F.concat(F.lit("IMG:"), "relpath", size, F.lit("\n")).alias("_line")),
                ["dataset_id"], "_line", ["relpath"]).withColumnRenamed("sha256", "_img")
    ann = _tree(annotations.select("dataset_id", "split", "ann_id", F.concat(F.lit("ANN:"), "split", "row_json", F.lit("\n")).alias("_line")),
                ["dataset_id"], "_line", ["split", "ann_id"]).withColumnRenamed("sha256", "_ann")
    both = img.join(ann, "dataset_id", "full")
    return both.select("dataset_id", sha_text(F.concat(F.coalesce("_ann", F.lit("")), F.lit("|"), F.coalesce("_img", F.lit("")))).alias("dataset_hash"),
                       F.lit(ALGORITHM).alias("algorithm"))


def migration_hash(files: DataFrame, annotations: DataFrame) -> DataFrame:
    """As `dataset_hash`, without the part tags."""
    img = _tree(files.select("dataset_id", "relpath", F.concat("relpath", F.col("length").cast("string")).alias("_line")),
                ["dataset_id"], "_line", ["relpath"]).withColumnRenamed("sha256", "_img")
    ann = _tree(annotations.select("dataset_id", "split", "ann_id", F.col("row_json").alias("_line")), ["dataset_id"], "_line",
                ["split", "ann_id"]).withColumnRenamed("sha256", "_ann")
    both = img.join(ann, "dataset_id", "full")
    return both.select("dataset_id", sha_text(F.concat(F.coalesce("_ann", F.lit("")), F.coalesce("_img", F.lit("")))).alias("content_hash"),
                       F.lit(ALGORITHM).alias("algorithm"))


def split_hash(images: DataFrame) -> DataFrame:
    """Per dataset, over the file names of each split; boxes do not matter. Lines `split NUL file name LF` are their own order."""
    lines = images.where(F.col("split").isin(list(SPLITS))).select("dataset_id", F.concat("split", F.lit("\x00"), "file_name", F.lit("\n")).alias("_line"))
    out = _tree(lines, ["dataset_id"], "_line", []).withColumnRenamed("sha256", "split_hash")
    return out.withColumn("algorithm", F.lit(ALGORITHM))


def config_hash(config: Column, fields: Mapping[str, str]) -> Column:
    """SHA-256 of the tile-shaping settings of a struct column: whitelisted keys in sorted order, doubles at six
    decimals, absent keys left out, algorithm version included. `fields` maps key to its type name."""
    parts = []
    for key in sorted(k for k in TILE_CONFIG_KEYS if k in fields):
        value = config[key]
        parts.append((canonical_double(value) if fields[key] == "double" else value).alias(key))
    body = F.to_json(F.struct(F.struct(*parts).alias("config"), F.lit(TILING_ALGORITHM_VERSION).alias("tiling_algorithm_version")))
    return sha_text(body)


def config_sha(config_json: Column) -> Column:
    return sha_text(config_json)


def cache_id(dataset: Column, split: Column, config: Column) -> Column:
    return F.concat_ws("__", *[F.substring(c, 1, 12) for c in (dataset, split, config)])


def cache_state(wanted: DataFrame, meta: DataFrame) -> DataFrame:
    """For each wanted cache (`tile_cache_id` and three hashes): `reused` when a complete, matching entry with all splits
    exists, else `rebuild`. Datasets whose hash is the empty one are refused."""
    hashes = ("dataset_hash", "split_hash", "tile_config_hash")
    m = meta.select("tile_cache_id", "status", "schema_version", "layout_version", "splits", *[F.col(h).alias(f"_{h}") for h in hashes])
    ok = (F.col("status") == "complete") & (F.col("schema_version") == SCHEMA_VERSION) & (F.col("layout_version") == LAYOUT_VERSION)
    for h in hashes:
        ok = ok & (F.col(f"_{h}") == F.col(h))
    ok = ok & (F.size(F.array_intersect("splits", F.array(*[F.lit(s) for s in SPLITS]))) == len(SPLITS))
    good = wanted.join(m, "tile_cache_id").filter(ok).select("tile_cache_id", *hashes).distinct().withColumn("_ok", F.lit(True))
    state = (F.when(F.col("dataset_hash") == EMPTY_SHA256, "refused_empty").when(F.col("_ok"), "reused").otherwise("rebuild"))
    return wanted.join(good, ["tile_cache_id", *hashes], "left").withColumn("state", state).drop("_ok")


def resolve_cache(wanted: DataFrame, meta: DataFrame) -> DataFrame:
    """Path of each wanted cache by id alone, null when none was registered."""
    return wanted.join(meta.groupBy("tile_cache_id").agg(F.max("storage_path").alias("storage_path")), "tile_cache_id", "left")


def cache_counts(pictures: DataFrame) -> DataFrame:
    """Tiles per cache and split, one column per split."""
    return pictures.groupBy("tile_cache_id").agg(*[F.count_if(F.col("split") == s).alias(f"num_{s}_tiles") for s in SPLITS])
