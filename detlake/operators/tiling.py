"""Sliding-window tiles and the box-to-tile spatial join."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Scale(NamedTuple):
    """`width`/`height` None keeps the source size; `crop` False means one picture instead of tiles."""

    name: str
    width: int | None = None
    height: int | None = None
    crop: bool = True


# fixed values: default enrichment scales, crop and stride
DEFAULT_SCALES = (
    Scale("original"),
    Scale("full_hd", 1920, 1080),
    Scale("intermediate", 1536, 864),
    Scale("final_640", 640, 640, crop=False),
)
CROP = 640
STRIDE = 320


def _check(crop: int, stride: int) -> None:
    if crop <= 0 or stride <= 0:
        raise ValueError(f"crop and stride must be positive, got {crop} and {stride}")


def regular_count(length: Column, crop: int, stride: int) -> Column:
    """Number of unpinned window starts on an axis."""
    return F.when(length <= crop, F.lit(1)).otherwise(F.floor((length - crop) / stride).cast("int") + 1)


def has_pinned(length: Column, crop: int, stride: int, edges: bool) -> Column:
    return F.lit(bool(edges)) & (length > crop) & ((length - crop) % stride != 0)


def axis_positions(length: Column, crop: int, stride: int, edges: bool = True) -> Column:
    """Window starts on one axis; the last one is pinned to the far edge when `edges`."""
    _check(crop, stride)
    regular = F.sequence(F.lit(0), F.greatest(length - crop, F.lit(0)), F.lit(stride))
    regular = F.when(length <= crop, F.array(F.lit(0))).otherwise(regular)
    return F.when(has_pinned(length, crop, stride, edges), F.array_append(regular, length - crop)).otherwise(regular)


def generate_tiles(df: DataFrame, width: str = "width", height: str = "height", crop: int = CROP,
                   stride: int = STRIDE, edges: bool = True) -> DataFrame:
    """One row per tile, y-major, with `crop_id, ox, oy, cw, ch, pad_r, pad_b`."""
    w, h = F.col(width), F.col(height)
    xs, ys = axis_positions(w, crop, stride, edges), axis_positions(h, crop, stride, edges)
    out = df.withColumn("_nx", F.size(xs))
    out = out.select("*", F.posexplode(ys).alias("_yi", "oy")).select("*", F.posexplode(xs).alias("_xi", "ox"))
    cw, ch = F.least(F.lit(crop), w - F.col("ox")), F.least(F.lit(crop), h - F.col("oy"))
    return out.select(*df.columns, (F.col("_yi") * F.col("_nx") + F.col("_xi")).alias("crop_id"), "ox", "oy",
                      cw.alias("cw"), ch.alias("ch"), (F.lit(crop) - cw).alias("pad_r"),
                      (F.lit(crop) - ch).alias("pad_b"))


def scale_plan(images: DataFrame, scales: Sequence[Scale] = DEFAULT_SCALES) -> DataFrame:
    """Images times scales, from a literal array: `scale_ord, scale_name, scale_w, scale_h, sx, sy, crop`."""
    for s in scales:
        if (s.width is None) != (s.height is None):
            raise ValueError(f"scale {s.name!r} must have both sizes or none")
        if s.width is None and not s.crop:
            raise ValueError(f"scale {s.name!r} keeps the source size and must be cropped")
    if not scales:
        raise ValueError("scales must not be empty")
    specs = F.array(*[
        F.struct(F.lit(i).alias("scale_ord"), F.lit(s.name).alias("scale_name"),
                 F.lit(s.width).cast("int").alias("_w"), F.lit(s.height).cast("int").alias("_h"),
                 F.lit(s.crop).alias("crop")) for i, s in enumerate(scales)])
    out = images.select("*", F.inline(specs))
    w, h = F.coalesce("_w", "width"), F.coalesce("_h", "height")
    return (out.withColumn("scale_w", w).withColumn("scale_h", h)
            .withColumn("sx", F.col("scale_w") / F.col("width")).withColumn("sy", F.col("scale_h") / F.col("height"))
            .drop("_w", "_h"))


def _axis_range(low: Column, high: Column, length: Column, crop: int, stride: int, edges: bool) -> tuple[Column, Column]:
    """First and last index of the windows that can meet (low, high); the pinned window is the one after the regular."""
    n = regular_count(length, crop, stride)
    pinned = has_pinned(length, crop, stride, edges) & (high > length - crop)
    first = F.greatest(F.lit(0), F.floor((low - crop) / stride).cast("int") + 1)
    last = F.when(pinned, n).otherwise(F.least(n - 1, F.ceil(high / stride).cast("int") - 1))
    return F.least(first, F.when(pinned, n).otherwise(first)), last


def tile_annotations(annotations: DataFrame, images: DataFrame, scales: Sequence[Scale] = DEFAULT_SCALES,
                     crop: int = CROP, stride: int = STRIDE, edges: bool = True, threshold: float = 0.80,
                     min_area: float = 1.0, whole: bool = False) -> DataFrame:
    """Annotation pieces that stay visible enough in a tile; with `whole` also every box of the uncropped scales (tile -1).

    The tiles a box can meet follow from its coordinates, so there is no join with tiles: after the image sizes are
    looked up, every box generates its few candidate windows per scale and axis, and the exact test filters them. A hot
    image is just more rows. The arithmetic is staged in projections below the generators, where filters cannot repeat it.
    """
    _check(crop, stride)
    sized = annotations.join(images.select("image_id", "width", "height"), "image_id")
    sized = sized.select("image_id", "ann_id", "category_id", "x", "y", "w", "h", "width", "height")
    scaled = scale_plan(sized, scales)
    scaled = scaled if whole else scaled.filter("crop")
    sw, sh, tiled = F.col("scale_w"), F.col("scale_h"), F.col("crop")
    keep = ["image_id", "ann_id", "category_id", "scale_ord", "scale_name", "crop"]
    scaled = scaled.select(*keep, "scale_w", "scale_h", (F.col("x") * F.col("sx")).alias("_bx1"), (F.col("y") * F.col("sy")).alias("_by1"),
                           ((F.col("x") + F.col("w")) * F.col("sx")).alias("_bx2"), ((F.col("y") + F.col("h")) * F.col("sy")).alias("_by2"))
    xlo, xhi = _axis_range(F.col("_bx1"), F.col("_bx2"), sw, crop, stride, edges)
    ylo, yhi = _axis_range(F.col("_by1"), F.col("_by2"), sh, crop, stride, edges)
    # an uncropped scale has one place
    scaled = scaled.select(
        *keep, "_bx1", "_by1", "_bx2", "_by2",
        *[F.when(tiled, c).otherwise(F.lit(0)).alias(n) for n, c in {"_xlo": xlo, "_xhi": xhi, "_ylo": ylo, "_yhi": yhi}.items()],
        *[F.when(tiled, F.greatest(c - crop, F.lit(0))).otherwise(F.lit(0)).alias(n) for n, c in {"_endx": sw, "_endy": sh}.items()],
        (regular_count(sw, crop, stride) + has_pinned(sw, crop, stride, edges).cast("int")).alias("_nx"))
    scaled = scaled.filter((F.col("_xlo") <= F.col("_xhi")) & (F.col("_ylo") <= F.col("_yhi")))
    rest = [c for c in scaled.columns if c not in ("_xlo", "_xhi", "_ylo", "_yhi")]
    spread = (scaled.select(*rest, "_ylo", "_yhi", F.explode(F.sequence("_xlo", "_xhi")).alias("_xi"))
              .select(*rest, "_xi", F.explode(F.sequence("_ylo", "_yhi")).alias("_yi")))
    # the pinned index lies beyond the last regular start, so the smaller of both is its true start
    ox, oy = F.least(F.col("_xi") * stride, F.col("_endx")), F.least(F.col("_yi") * stride, F.col("_endy"))
    left, top = F.greatest(F.col("_bx1"), ox.cast("double")), F.greatest(F.col("_by1"), oy.cast("double"))
    right, bottom = F.least(F.col("_bx2"), (ox + crop).cast("double")), F.least(F.col("_by2"), (oy + crop).cast("double"))
    wide, high = right - left, bottom - top
    area = (F.col("_bx2") - F.col("_bx1")) * (F.col("_by2") - F.col("_by1"))
    # area is positive wherever the overlap is
    kept = ~tiled | ((wide > 0) & (high > 0) & (F.least(F.lit(1.0), wide * high / F.when(area > 0, area)) >= F.lit(float(threshold)))
            & (wide * high >= F.lit(float(min_area))))
    x1, y1, x2, y2 = (F.when(tiled, c).otherwise(F.col(n)) for n, c in {
        "_bx1": left - ox, "_by1": top - oy, "_bx2": right - ox, "_by2": bottom - oy}.items())
    return spread.filter(kept).select(
        "image_id", "scale_ord", "scale_name", F.when(tiled, F.col("_yi") * F.col("_nx") + F.col("_xi")).otherwise(F.lit(-1)).alias("crop_id"),
        ox.alias("ox"), oy.alias("oy"), "ann_id", "category_id", x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"),
        F.when(tiled, F.least(F.lit(1.0), wide * high / F.when(area > 0, area))).otherwise(F.lit(1.0)).alias("visible_ratio"))
