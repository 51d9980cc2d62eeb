"""Joining a table of groups back to rows where one group may hold a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

#: a group with more than this share of all rows is hot; fewer than `SHARES` groups can be
SHARES = 1000


def attach(rows: DataFrame, groups: DataFrame, keys: Sequence[str], size: str, total: int) -> DataFrame:
    """`rows` with the other columns of `groups` (null without a group). `groups` has each key once, and in `size` how many
    of the `total` rows carry it.

    Hot groups are fewer than `SHARES` by their definition, so they are broadcast and their rows stay where they are; rows of
    the others, none of which fills a task, are shuffled by key."""
    least = total // SHARES
    hot = groups.where(F.col(size) > least).withColumn("_hot", F.lit(True))
    marked = rows.join(F.broadcast(hot), list(keys), "left")
    done = marked.where("_hot").drop("_hot")
    rest = marked.where("_hot IS NULL").select(*rows.columns).join(groups.where(F.col(size) <= least), list(keys), "left")
    return done.unionByName(rest.select(*done.columns))
