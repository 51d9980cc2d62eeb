"""Exact duplicates: rows grouped by a 128-bit hash of their text, one row of each group kept, bytes compared inside groups.

Only hashes and ids are shuffled for the grouping. Texts move for the comparison alone, and of these only texts whose hash
occurs more than once: the hashes that do set bits of a bitmap of bounded size, which goes to every task, and rows without a
bit stay where they are (a full bitmap lets more texts through and changes no result). Equal texts of one task are one row
before they are sent, so a group of any size costs each task one text. Should texts of one hash differ, their rows are
grouped by hash and text instead. Groups that hold a large share of all rows are joined back by broadcast (`hot.attach`).

Defined cases: a null text counts as empty; texts are equal when identical after A-Z are lower-cased; null ids come before all
others, rows of equal id and text are told apart by their place in the table, so each group keeps exactly one row; long
texts count whole; other columns are ignored; an empty table gives no rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from detlake.llm.columns import lower_ascii
from detlake.llm.hot import attach
from detlake.session import durable

#: bitmaps of 32,768 bits (4 KB) in the broadcast table, at most
BITMAPS = 4096
SALTS = 16


def normalised(text: str = "text") -> Column:
    return lower_ascii(F.coalesce(F.col(text), F.lit("")))


def md5_of(value: Column) -> Column:
    return F.unhex(F.md5(value.cast("binary")))


def _bit(digest: str) -> Column:
    """Place of a hash in the bitmaps."""
    return F.pmod(F.xxhash64(digest), F.lit(BITMAPS * 32768)) + 1


def suspects(texts: DataFrame, repeated: DataFrame) -> DataFrame:
    """The rows of `texts` (digest, ...) whose hash may be among `repeated`; none that is goes missing."""
    bits = repeated.select(_bit("digest").alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    at = F.bitmap_bit_position("bit")
    byte = F.conv(F.hex(F.substring("bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    placed = texts.withColumn("bit", _bit("digest")).withColumn("bucket", F.bitmap_bucket_number("bit"))
    return placed.join(F.broadcast(bits), "bucket").where(byte.bitwiseAND(F.expr("shiftleft(1, cast(bitmap_bit_position(bit) % 8 as int))")) != 0).select(*texts.columns)


def copies(docs: DataFrame, largest: bool = False, digest: Callable[[Column], Column] = md5_of, text: str = "text", id: str = "doc_id") -> DataFrame:
    """One row per row of `docs`: (id, keep_id, group_size, kept, text_sha256). The row with the smallest id of each group of
    equal texts is kept, or the one with the `largest`."""
    norm = normalised(text)
    # the checkpoint pins the row numbers; it holds no texts
    rows = durable(docs.select(F.col(id).alias("id"), digest(norm).alias("digest"), F.unhex(F.sha2(norm.cast("binary"), 256)).alias("sha")).withColumn("row", F.monotonically_increasing_id()))
    pick = F.max(F.struct("id", (-F.col("row")).alias("row"))) if largest else F.min(F.struct("id", "row"))
    groups = durable(rows.groupBy("digest").agg(F.count("*").alias("n"), pick.alias("keep")).where("n > 1"))
    texts = docs.select(digest(norm).alias("digest"), norm.alias("norm"))
    # bytes are compared by grouping on them, within the hash
    kinds = suspects(texts, groups).groupBy("digest", "norm").agg(F.count("*").alias("n")).groupBy("digest").agg(F.count("*").alias("kinds"))
    clashes = durable(kinds.where("kinds > 1").select("digest"))
    total = rows.count()
    if not clashes.isEmpty():
        apart = _apart(docs, clashes, largest, digest, text, id)
        rows, groups = rows.join(clashes, "digest", "left_anti"), groups.join(clashes, "digest", "left_anti")
    found = attach(rows, groups, ["digest"], "n", total)
    last = F.abs(F.col("keep")["row"])
    out = found.select("id", F.when(F.col("n").isNotNull(), F.col("keep")["id"]).otherwise(F.col("id")).alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
                       F.coalesce(last == F.col("row"), F.lit(True)).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
    if not clashes.isEmpty():
        out = out.unionByName(apart)
    return out.withColumnRenamed("id", id)


def _apart(docs: DataFrame, clashes: DataFrame, largest: bool, digest: Callable[[Column], Column], text: str, id: str) -> DataFrame:
    """The result for the rows whose hash is shared by unlike texts: grouped by hash and text, the join salted."""
    norm = normalised(text)
    rows = docs.select(F.col(id).alias("id"), digest(norm).alias("digest"), norm.alias("norm")).join(clashes, "digest", "left_semi")
    rows = durable(rows.withColumn("row", F.monotonically_increasing_id()))
    pick = F.max(F.struct("id", (-F.col("row")).alias("row"))) if largest else F.min(F.struct("id", "row"))
    groups = rows.groupBy("digest", "norm").agg(F.count("*").alias("group_size"), pick.alias("keep")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    found = rows.withColumn("salt", F.pmod("row", F.lit(SALTS)).cast("int")).join(groups, ["digest", "norm", "salt"])
    return found.select("id", F.col("keep")["id"].alias("keep_id"), "group_size", (F.abs(F.col("keep")["row"]) == F.col("row")).alias("kept"), F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"))
