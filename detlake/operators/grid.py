"""Equi-joinable grid cells for boxes: spatial neighbours inside hot images without pairing the whole image."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from detlake.functions.boxes import Box, box


def with_cell_size(df: DataFrame, keys: Sequence[str], reach: float = 0.0) -> DataFrame:
    """Adds `_cell`, a pitch per group near its mean box side (plus the search reach)."""
    side = F.greatest(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    pitch = df.groupBy(*keys).agg(F.greatest(F.avg(side) + F.lit(float(reach)), F.lit(1.0)).alias("_cell"))
    return df.join(pitch, list(keys))


def cell_range(low: Column, high: Column, pitch: Column) -> Column:
    return F.sequence(F.floor(low / pitch), F.floor(F.greatest(low, high) / pitch))


def explode_cells(df: DataFrame, b: Box | None = None, reach: float = 0.0) -> DataFrame:
    """One row per grid cell (`_cx`, `_cy`) a box covers, grown by `reach` on every side."""
    b = b or box()
    r = F.lit(float(reach))
    pitch = F.col("_cell")
    return (df.withColumn("_cx", F.explode(cell_range(b.x1 - r, b.x2 + r, pitch)))
            .withColumn("_cy", F.explode(cell_range(b.y1 - r, b.y2 + r, pitch))))


def meets_here(a: Box, b: Box, pitch: Column, reach: float = 0.0) -> Column:
    """True in exactly one of the cells two grown boxes share: the one of their overlap's lower corner."""
    r = F.lit(float(reach))
    return ((F.floor((F.greatest(a.x1, b.x1) - r) / pitch) == F.col("_cx"))
            & (F.floor((F.greatest(a.y1, b.y1) - r) / pitch) == F.col("_cy")))


def _level(b: Box, reach: float) -> Column:
    """Power of two at or above the longer side of the grown box, so that it covers at most two cells each way."""
    side = F.greatest(b.x2 - b.x1, b.y2 - b.y1, F.lit(0.0)) + F.lit(2.0 * reach)
    return F.ceil(F.log2(F.greatest(side, F.lit(2.0 ** -20)))).cast("int")


def _cells(df: DataFrame, tag: str, level: Column, reach: float) -> DataFrame:
    b, r, pitch = box(tag), F.lit(float(reach)), F.pow(F.lit(2.0), F.col("_level"))
    df = df.withColumn("_level", level)
    return (df.withColumn("_cx", F.explode(cell_range(b.x1 - r, b.x2 + r, pitch)))
            .withColumn("_cy", F.explode(cell_range(b.y1 - r, b.y2 + r, pitch))))


def meeting_pairs(left: DataFrame, right: DataFrame, keys: Sequence[str], reach: float = 0.0) -> DataFrame:
    """Pairs of rows of one key whose boxes, each grown by `reach`, share a point (a few more by rounding), each once; the
    other columns as `a_*` and `b_*`.

    The larger box of a pair stands in the four cells of its own power of two, the smaller one in those of every power
    that occurs in its key. A box thus makes four rows for each of at most some dozens of powers, whatever the sizes of
    the others; rows with null or NaN corners meet nothing.
    """
    keys, reach = list(keys), reach * (1 + 1e-9) + 1e-6

    def side(df: DataFrame, tag: str) -> DataFrame:
        whole = [c.isNotNull() & ~F.isnan(c) for c in box()]
        df = df.filter(whole[0] & whole[1] & whole[2] & whole[3])
        return df.select(*keys, *[F.col(c).alias(tag + c) for c in df.columns if c not in keys]).withColumn(
            f"_own_{tag}", _level(box(tag), reach))

    a, b = side(left, "a_"), side(right, "b_")

    def powers(df: DataFrame, tag: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.collect_set(f"_own_{tag}").alias("_powers"))

    def meet(low: DataFrame, low_tag: str, high: DataFrame, high_tag: str, equal: bool) -> DataFrame:
        own = F.col(f"_own_{low_tag}")
        wide = low.join(powers(high, high_tag), keys)
        wide = _cells(wide, low_tag, F.explode(F.filter("_powers", lambda p: p >= own if equal else p > own)), reach).drop("_powers")
        pairs = wide.join(_cells(high, high_tag, F.col(f"_own_{high_tag}"), reach), [*keys, "_level", "_cx", "_cy"])
        p, q = box("a_"), box("b_")
        touch = ((F.greatest(p.x1, q.x1) - F.least(p.x2, q.x2) <= F.lit(2 * reach))
                 & (F.greatest(p.y1, q.y1) - F.least(p.y2, q.y2) <= F.lit(2 * reach)))
        return pairs.filter(touch & meets_here(p, q, F.pow(F.lit(2.0), F.col("_level")), reach)).drop("_level", "_cx", "_cy", "_own_a_", "_own_b_")

    return meet(a, "a_", b, "b_", True).unionByName(meet(b, "b_", a, "a_", False))
