"""Keeping hot keys out of single tasks.

A key may hold a large share of all rows. Operators whose natural form works on one whole group (array folds, window
sorts, nested lists) use it only for groups whose size was counted; larger groups take another exact way.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# largest group folded as one array (quadratic work) and sorted in one task (linear work)
FOLD_ROWS = 2_000
# largest group whose members are compared pair by pair
PAIR_ROWS = 256
WINDOW_ROWS = 1_000_000


def split_hot(df: DataFrame, keys: Sequence[str], limit: int) -> tuple[DataFrame, DataFrame | None]:
    """(rows of groups up to `limit`, rows of larger groups or None).

    The count is one job with partial aggregation over the key columns only.
    """
    hot_keys = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > limit).drop("_rows")
    if hot_keys.isEmpty():
        return df, None
    cold = df.join(hot_keys, list(keys), "left_anti")
    return cold, df.join(hot_keys, list(keys), "left_semi")


def by_group_size(df: DataFrame, keys: Sequence[str], limit: int, small: Callable[[DataFrame], DataFrame],
                  large: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run `small` on groups up to `limit` rows and `large` on the rest; both must give the same columns."""
    cold, hot = split_hot(df, keys, limit)
    out = small(cold)
    return out if hot is None else out.unionByName(large(hot).select(*out.columns))


def nest(df: DataFrame, keys: Sequence[str], item: Column, order: Sequence[Column], name: str) -> DataFrame:
    """One list of `item` structs per key, ordered by `order`: the export form, always one row per key. The rows themselves
    (the long form) are the product for keys of any size."""
    keys = list(keys)
    entry = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], item.alias("_v"))
    lists = df.select(*keys, entry.alias("_e")).groupBy(*keys).agg(F.array_sort(F.collect_list("_e")).alias("_l"))
    return lists.select(*keys, F.transform("_l", lambda e: e["_v"]).alias(name))
