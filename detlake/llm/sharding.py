"""Sharding by proportional stratified interleaving, in DataFrame functions only.

Rows of a source are shuffled by a seeded hash and ranked; a row's place is its rank as a fraction of its source; rows sorted
by that fraction are cut into shards whose sizes differ by one at most, so each shard holds every source in proportion.

Both rankings work in cells: rows are counted by source and range of the hash (then by range of the fraction), counts are
summed up to each cell, and only rows of one cell, about `cell_rows`, are sorted together. A source of any size is thus
ranked by many tasks. Texts are read once for size and checksum and never shuffled.

Defined cases: null sources are a source of their own; null and empty texts have size 8 and checksum 0; repeated rows are
rows of their own; null ids are kept; other columns are ignored; an empty table has no shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

CELL_ROWS = 20_000


def stratified_shards(docs: DataFrame, shards: int = 24, seed: str = "shards", cell_rows: int = CELL_ROWS, text: str = "text", id: str = "doc_id", source: str = "source") -> DataFrame:
    """One row per row of `docs`: (id, size, text_crc32, law, shard, slot, grown_shard)."""
    total = docs.count()
    cells = max(1, -(-total // cell_rows))
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id).alias("id"), (F.octet_length(whole) + 8).cast("long").alias("size"), F.crc32(whole.cast("binary")).alias("crc"),
                       F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")).alias("stratum"))
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("crc").cast("string")).cast("binary"))
    # 48 bits of the digest
    rows = rows.withColumn("key", F.conv(F.substring(digest, 1, 12), 16, 10).cast("long"))
    rows = rows.withColumn("cell", F.floor(F.col("key") * F.lit(float(cells)) / F.lit(float(1 << 48))))
    counts = rows.groupBy("stratum", "cell").agg(F.count("*").alias("n"))
    counts = counts.select("stratum", "cell", (F.sum("n").over(W.partitionBy("stratum").orderBy("cell")) - F.col("n")).alias("before"), F.sum("n").over(W.partitionBy("stratum")).alias("of"))
    rank = F.row_number().over(W.partitionBy("stratum", "cell").orderBy("key", "id", "crc", "size"))
    ranked = rows.withColumn("rank", rank).join(counts, ["stratum", "cell"])
    # each source starts at a seeded place of its own, so small sources of equal size do not fall together
    offset = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.col("stratum")).cast("binary")), 1, 12), 16, 10).cast("long") / F.lit(float(1 << 48))
    ranked = ranked.withColumn("share", (F.col("before") + F.col("rank") - 1 + offset) / F.col("of")).withColumn("band", F.floor(F.col("share") * F.lit(float(cells))))
    bands = ranked.groupBy("band").agg(F.count("*").alias("n"))
    # one row a band: about total / cell_rows rows
    bands = bands.select("band", (F.sum("n").over(W.orderBy("band")) - F.col("n")).alias("ahead"))
    place = F.row_number().over(W.partitionBy("band").orderBy("share", "stratum", "key", "id", "crc", "size"))
    placed = ranked.withColumn("place", place).join(bands, "band").withColumn("at", F.col("ahead") + F.col("place") - 1)
    placed = placed.withColumn("shard", F.expr(f"(at * {shards}) div {max(total, 1)}").cast("int"))
    return placed.select(F.col("id").alias(id), "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"), "shard",
                         (F.col("at") - F.expr(f"(shard * {total}L + {shards - 1}) div {shards}")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
