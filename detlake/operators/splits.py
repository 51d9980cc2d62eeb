"""Deterministic train/val/test assignment."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values
SPLITS = ("train", "val", "test")
BUCKETS = 10_000
DEFAULT_RATIOS = {"train": 0.70, "val": 0.15, "test": 0.15}


def hash_bucket(key: Column, buckets: int = BUCKETS) -> Column:
    """SHA-256 of the key as one big number, modulo `buckets`; twelve hex digits at a time fit a BIGINT."""
    digest = F.sha2(key.cast("binary"), 256)
    rest = F.lit(0).cast("bigint")
    for at in range(0, 64, 12):
        width = min(12, 64 - at)
        chunk = F.conv(F.substring(digest, at + 1, width), 16, 10).cast("bigint")
        rest = (rest * F.lit(pow(16, width, buckets)) + chunk % buckets) % buckets
    return rest


def assign_split(key: Column, ratios: Mapping[str, float] = DEFAULT_RATIOS) -> Column:
    train, val, test = (float(ratios.get(s, 0.0)) for s in SPLITS)
    if abs(train + val + test - 1.0) > 1e-6:
        raise ValueError(f"split ratios must sum to 1, got {train + val + test}")
    first = round(train * BUCKETS)
    second = first + round(val * BUCKETS)
    bucket = hash_bucket(key)
    return F.when(bucket < first, "train").when(bucket < second, "val").otherwise("test")


def with_split(images: DataFrame, key: str = "frame_id", ratios: Mapping[str, float] = DEFAULT_RATIOS) -> DataFrame:
    return images.withColumn("split", assign_split(F.col(key), ratios))
